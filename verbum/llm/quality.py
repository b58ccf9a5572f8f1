"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. Word vectors.  Every word is a row of a table of ``CORES + SHAPES`` rows (by
   hash; its letters lower-cased give one row, its case and the signs around it
   another).  Each row has a fixed sparse random index vector; a row's context
   vector is the sum of the index vectors of its neighbours over all texts of
   the corpus.  Tasks add up their share and the tables are summed in two
   steps, so the table's size is fixed by parameters, whatever the corpus.
2. Documents.  A text's vector is the mean of its words' unit context vectors,
   frequent words weighing less, for letters and shapes apart.
3. Network.  Two layers, fitted by the driver on a sample of labelled documents
   of bounded size (``MAX_TRAIN`` rows of features); a part of the sample is kept
   back to fit the temperature that calibrates the probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import word_blocks, worker_cache

CORES, SHAPES, DIM, NONZERO = 32_768, 1024, 64, 2
ROWS = CORES + SHAPES
BLOCK_ROWS, SALTS = 512, 32
CHUNK_WORDS = 200_000
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 0.01, 1e-4
THRESHOLD = 0.3
SEED = 42
CACHE_WORDS = 400_000

_PARTS = re.compile(rb"([\x21-\x40\x5b-\x60\x7b-\x7e]*)(.*?)([\x21-\x40\x5b-\x60\x7b-\x7e]*)", re.S)


class Rows(dict):
    """Word (UTF-8) to its two rows, as letters' row * SHAPES + shape; remembers frequent words."""

    def __missing__(self, word: bytes) -> int:
        before, core, after = _PARTS.fullmatch(word).groups()
        low = core.lower()
        case = b"-" if not core else b"a" if core == low else b"A" if core == core.upper() and len(core) > 1 else b"Aa"
        sign = b"\0".join((before[:3], case, after[:3]))
        found = (xxhash.xxh32_intdigest(low, SEED) % CORES) * SHAPES + xxhash.xxh32_intdigest(sign, SEED) % SHAPES
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


def rows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.fromiter(map(worker_cache("quality", Rows).__getitem__, words), np.int64, len(words))
    return both // SHAPES, both % SHAPES + CORES


def _index() -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of each row's non-zero entries."""
    r = np.random.default_rng(SEED)
    places = r.random((ROWS, DIM)).argpartition(NONZERO, axis=1)[:, :NONZERO]  # without replacement
    return places, r.choice((-1.0, 1.0), (ROWS, NONZERO))


def _contexts(core: np.ndarray, shape: np.ndarray, doc: np.ndarray, index: tuple, out: np.ndarray) -> None:
    """Add to ``out`` (ROWS, DIM + 1) the contexts and counts of one chunk; neighbours are in the same document."""
    near = doc[1:] == doc[:-1]
    a, b, s, t = core[:-1][near], core[1:][near], shape[:-1][near], shape[1:][near]
    row = np.concatenate((a, b, core, shape, s, t))
    of = np.concatenate((b, a, shape, core, t, s))
    where, sign = index
    flat = (row[:, None] * (DIM + 1) + where[of]).ravel()
    seen = np.concatenate((core, shape)) * (DIM + 1) + DIM
    out += np.bincount(np.concatenate((flat, seen)), np.concatenate((sign[of].ravel(), np.ones(len(seen)))), out.size).astype(np.int64).reshape(out.shape)


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The context table of one partition, in blocks of rows."""
    index, out = _index(), np.zeros((ROWS, DIM + 1), np.int64)
    held, n, any_words = [], 0, False

    def add():
        if held:
            core, shape = rows_of([w for words in held for w in words])
            _contexts(core, shape, np.repeat(np.arange(len(held)), [len(w) for w in held]), index, out)
            held.clear()

    for b in batches:
        for text in b.column(0).cast(pa.binary()):
            for words in word_blocks(text.as_py() or b""):
                if words:
                    held.append(words)
                    n += len(words)
                    any_words = True
                if n >= CHUNK_WORDS:
                    add()
                    n = 0
    add()
    if any_words:
        salt = TaskContext.get().partitionId() % SALTS
        blocks = [zlib.compress(out[i:i + BLOCK_ROWS].tobytes(), 1) for i in range(0, ROWS, BLOCK_ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([salt] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())], ["block", "salt", "data"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum blocks that follow one another with the same (block, salt)."""
    key, total = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["block", "salt", "data"])

    for b in batches:
        for block, salt, data in zip(*(c.to_pylist() for c in b.columns)):
            part = np.frombuffer(zlib.decompress(data), np.int64)
            if (block, salt) == key:
                total = total + part
            else:
                if key is not None:
                    yield row()
                key, total = (block, salt), part
    if key is not None:
        yield row()


def word_table(docs: DataFrame) -> np.ndarray:
    """(ROWS, DIM + 1) context vectors and counts over all texts of ``docs``; its size does not depend on them."""
    kind = "block int, salt int, data binary"
    parts = docs.select("text").mapInArrow(_share, kind)
    for salted in (True, False):
        keyed = parts if salted else parts.withColumn("salt", F.lit(0))
        parts = keyed.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(_sum, kind)
    out = np.zeros((ROWS, DIM + 1), np.int64)
    for r in parts.collect():  # ROWS / BLOCK_ROWS rows
        out[r["block"] * BLOCK_ROWS:(r["block"] + 1) * BLOCK_ROWS] = np.frombuffer(zlib.decompress(r["data"]), np.int64).reshape(-1, DIM + 1)
    return out


def word_vectors(table: np.ndarray) -> np.ndarray:
    """(ROWS, DIM + 1) float32: unit context vectors times the word's weight, and the weight."""
    context, count = table[:, :DIM].astype(np.float64), table[:, DIM].astype(np.float64)
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    unit = np.divide(context, norm, out=np.zeros_like(context), where=norm > 0)
    weight = np.ones(ROWS)
    for part in (slice(0, CORES), slice(CORES, ROWS)):
        share = count[part] / max(1.0, count[part].sum())
        weight[part] = 1e-2 / (1e-2 + share)
    return np.hstack((unit * weight[:, None], weight[:, None])).astype(np.float32)


def pooled(text: bytes, vectors: np.ndarray) -> np.ndarray:
    """2 * DIM features of a text; zeros if it has no words."""
    sums = np.zeros((2, DIM + 1))
    for words in word_blocks(text):
        if words:
            for i, rows in enumerate(rows_of(words)):
                for at in range(0, len(rows), CHUNK_WORDS):
                    sums[i] += vectors[rows[at:at + CHUNK_WORDS]].sum(axis=0, dtype=np.float64)
    return np.concatenate([s[:DIM] / s[DIM] if s[DIM] else s[:DIM] for s in sums])


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Fit on four fifths of the rows, the temperature on the rest.

    No rows: every score is 0.5.  One class only: every score is the class's
    share, drawn in by one row of either class.
    """
    dim = x.shape[1] if x.ndim == 2 else 2 * DIM
    still = Network(np.zeros(dim), np.ones(dim), np.zeros((dim, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0)
    if len(y) == 0:
        return still
    share = (y.sum() + 1) / (len(y) + 2)
    still.b2 = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return still
    r = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    order = r.permutation(len(y))
    kept = order[: len(y) // 5]
    train = order[len(kept):] if len(kept) >= 20 else order
    z = (x - mean) / scale
    p = [r.normal(0, dim ** -0.5, (dim, HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN ** -0.5, HIDDEN), np.array(still.b2)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        mixed = r.permutation(train)
        for at in range(0, len(mixed), BATCH):
            k = mixed[at:at + BATCH]
            h = np.tanh(z[k] @ p[0] + p[1])
            out = 1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -50, 50)))
            e = (out - y[k]) / len(k)
            back = e[:, None] * p[2] * (1 - h * h)
            grads = [z[k].T @ back + DECAY * p[0], back.sum(axis=0), h.T @ e + DECAY * p[2], e.sum()]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3]), 1.0)
    check = kept if len(kept) >= 20 else train
    logits = net.logits(x[check])
    net.temperature = float(min(np.logspace(-1, 1.5, 101), key=lambda t: _loss(logits / t, y[check])))
    return net


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, vectors, max_train: int = MAX_TRAIN) -> Network:
    """Fit on labelled documents that are not held out, ``max_train`` at most, chosen by the hash of the id.

    Labels of documents that are not there are left out before the choice.
    """
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~_held_out())
             .groupBy("doc_id").agg(F.max("y").alias("y")).join(there, "doc_id", "left_semi")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [pooled(t.as_py() or b"", vectors.value) for t in b.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("doc_id", "y", "text")
    rows = (chosen.mapInArrow(run, "doc_id long, y int, x array<double>")
            .groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy("doc_id").collect())  # max_train rows at most
    x = np.array([r["x"] for r in rows]) if rows else np.zeros((0, 2 * DIM))
    return fit(x, np.array([r["y"] for r in rows], float))


def _model(docs: DataFrame, labels: DataFrame, max_train: int):
    sc = docs.sparkSession.sparkContext
    vectors = sc.broadcast(word_vectors(word_table(docs)))  # ROWS * (DIM + 1) floats
    return vectors, sc.broadcast(train(docs, labels, vectors, max_train))


def _score_batches(texts: pa.Array, vectors, net) -> pa.Array:
    x = [pooled(t.as_py() or b"", vectors.value) for t in texts.cast(pa.binary())]
    return pa.array(net.value.scores(np.array(x)) if x else [], pa.float64())


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    ``held_out`` rows, crc32(doc_id as text) mod 5 = 0, lend no label (a null
    doc_id: not held out, and never labelled).  ``score`` is the calibrated
    probability of label 1, from the text alone; null, empty and blank texts
    have the zero vector and are scored by it.  ``predicted`` is 1 if score >=
    ``threshold``.  Labels other than 0 and 1 are left out; of several labels of
    one document the larger counts; labels of documents that are not in ``docs``
    are left out.  Without labels every score is 0.5.  A very long text is pooled
    some megabytes at a time.  Rows that repeat or lack a doc_id are scored like
    any other; an empty table gives an empty result; further columns are ignored.
    """
    vectors, net = _model(docs, labels, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _score_batches(b.column(1), vectors, net)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` predicts as 1, with the columns of ``docs``."""
    vectors, net = _model(docs, labels, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = pa.array(np.asarray(_score_batches(b.column("text"), vectors, net)) >= threshold)
            yield b.filter(good)

    return docs.mapInArrow(run, docs.schema)
