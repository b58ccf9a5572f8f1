"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

A text's five-word shingles are hashed once; a hash's upper bits choose one of
``BINS`` bins, which keeps its least hash.  An empty bin takes the value of the
first filled bin on its own fixed random walk over the bins, the same walk for
every text.  Of each bin's value, hashed with the bin's number, the ``BITS`` low
bits are stored.  Two bins that differ agree by chance once in 2**BITS; the
likeness of two fingerprints takes that share out again.

An edited text joins a document with the next one by descending id.  Documents
are dealt to ranges of ids of at most about ``RANGE_ROWS`` rows, whose bounds are
quantiles of all ids; an id that fills more than a range of its own (null is one)
is dealt on by the hash of the text, the order within an id.  Rows of one id and
text that still fill a range go through it once, with their number: each but the
last is followed by its like.  A range gets one more row, the first of the next
range, so each text is shuffled once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import cut, word_blocks, worker_cache

SHINGLE, BINS, BITS = 5, 256, 4
SEED = 42
WALK = 64
CACHE_WORDS = 400_000
RANGE_ROWS = 1 << 18
_BIN_BITS = BINS.bit_length() - 1
_R = np.random.default_rng(SEED)
_MUL = _R.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _R.integers(0, BINS, (WALK, BINS))
_BIN_SALT = _R.integers(1, 1 << 63, BINS, dtype=np.uint64)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - _BIN_BITS)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(worker_cache("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(data: bytes, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of UTF-8 ``data``, A-Z lower-cased; fewer words: one hash of all; none: nothing."""
    tail, any_shingle = np.zeros(0, np.uint64), False
    for words in word_blocks(data.lower()):
        w = np.concatenate((tail, word_hashes(words)))
        n = len(w) - shingle + 1
        if n > 0:
            any_shingle = True
            total = w[:n] * _MUL[0]
            for i in range(1, shingle):
                total += w[i:i + n] * _MUL[i]
            yield mix64(total)
        tail = w[max(0, n):] if n > 0 else w
    if not any_shingle and len(tail):
        yield mix64(np.array([(tail * _MUL[:len(tail)]).sum() + np.uint64(len(tail))], np.uint64))


def fingerprint(data: bytes) -> bytes:
    """BINS * BITS / 8 bytes; empty for a text without words."""
    values, filled = np.full(BINS, np.iinfo(np.uint64).max, np.uint64), np.zeros(BINS, bool)
    for h in shingle_hashes(data):
        h.sort()
        at = np.searchsorted(h, _EDGES)  # the first hash of a bin is its least
        inside = at < len(h)
        least = h[np.minimum(at, len(h) - 1)]
        inside &= (least >> np.uint64(64 - _BIN_BITS)) == np.arange(BINS, dtype=np.uint64)
        values = np.where(inside, np.minimum(values, least), values)
        filled |= inside
    if not filled.any():
        return b""
    empty = np.flatnonzero(~filled)
    for step in _STEPS:
        if not len(empty):
            break
        hit = filled[step[empty]]
        values[empty[hit]] = values[step[empty[hit]]]
        empty = empty[~hit]
    if len(empty):  # the walk met no filled bin: the next one upwards
        full = np.flatnonzero(filled)
        values[empty] = values[full[np.searchsorted(full, empty) % len(full)]]
    low = (mix64(values ^ _BIN_SALT) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return np.packbits(np.unpackbits(low[:, None], axis=1)[:, 8 - BITS:]).tobytes()


def _bins(fp: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(fp, np.uint8)).reshape(BINS, BITS)


def likeness(a: bytes, b: bytes) -> float:
    """The share of common shingles, 0 to 1; a text without words is like another such text only."""
    if not a or not b:
        return float(a == b)
    same = (_bins(a) == _bins(b)).all(axis=1).mean()
    chance = 2.0 ** -BITS
    return float(min(1.0, max(0.0, (same - chance) / (1 - chance))))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many characters of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "times"]
_KIND = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, times long"
_CHUNK = 4096  # rows that one row of a count becomes at a time


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (halo, doc_id, text, n) in order; each is compared with the next, a range's last with its halo row.

    A row that stands for n is followed by itself n - 1 times.
    """
    out, last = [], None  # last: doc_id, text, fingerprint

    def against(text: str, fp: bytes, times: int) -> None:
        new = edited(last[1], text).encode()
        new_fp = fingerprint(new)
        out.append((last[0], len(last[1]), hashlib.sha256(new).hexdigest(), last[2].hex(), new_fp.hex(), likeness(last[2], new_fp), likeness(last[2], fp), times))

    def flush():
        cols = list(zip(*out)) if out else [[]] * len(_NAMES)
        out.clear()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], _NAMES)

    for b in batches:
        for halo, doc_id, text, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
            if halo and last is None:
                continue  # the range's last row has been compared
            text = text.as_py()
            fp = fingerprint(text.encode())
            if last is not None:
                against(text, fp, 1)
            last = None if halo else (doc_id, text, fp)
            if not halo and n > 1:
                against(text, fp, n - 1)
        yield flush()


def _one_row_a_copy(rows: DataFrame) -> DataFrame:
    """``times`` rows for each row, by chunks, so that no array grows with a count."""
    chunks = rows.withColumn("_at", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / _CHUNK))))
    ends = F.least(F.lit(_CHUNK), F.col("times") - F.col("_at") * _CHUNK)
    return chunks.withColumn("_one", F.explode(F.sequence(F.lit(1), ends))).drop("_at", "_one", "times")


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per row of ``docs``.

    The next document is the one after this by descending doc_id, null last,
    and by the text's xxhash64 among rows of one id; after the last comes the
    first, and a single row is its own next.  A null text counts as empty.  A
    very long text is hashed some megabytes at a time.  An empty table gives an
    empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    n_rows = rows.count()
    if not n_rows:
        return spark.createDataFrame([], _KIND).drop("times")
    # Ranges grow in number with the rows; a few per shuffle partition at least.
    n_ranges = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // range_rows))
    full = max(2, -(-n_rows // n_ranges))  # rows of a range
    x = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan")))
    # Ids that fill a range, n_ranges at most.  (Ids beyond 2**53 that are one double stay together.)
    filled = (rows.groupBy(x.alias("x")).agg(F.count("*").alias("n"), F.min("doc_id").alias("i"), F.max("doc_id").alias("j"))
              .filter((F.col("n") >= full) & F.col("i").eqNullSafe(F.col("j"))).collect())
    hot = spark.createDataFrame([(r["i"] or 0, r["i"] is None, -(-r["n"] // full)) for r in filled], "i long, z boolean, subs long")
    shares = [i / n_ranges for i in range(1, n_ranges)]
    bounds = set(rows.select(F.col("doc_id").cast("double").alias("x")).approxQuantile("x", shares, 0.2 / n_ranges))
    # A range of ids holds an id that is dealt on, or others.
    bounds |= {y for r in filled if r["i"] is not None for y in (float(r["i"]), math.nextafter(float(r["i"]), math.inf))}
    splits = [float("-inf"), *sorted(bounds), float("inf")] if bounds else [float("-inf"), 0.0, float("inf")]
    top = len(splits) - 2
    at = Bucketizer(splits=splits, inputCol="x", outputCol="bucket", handleInvalid="keep").transform(rows.withColumn("x", x))
    seq = F.when(F.col("doc_id").isNull(), F.lit(top + 1)).otherwise(F.lit(top) - F.col("bucket").cast("int")).cast("int")
    keyed = at.select(seq.alias("seq"), F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("z"), "doc_id", "text", F.xxhash64("text").alias("h"))
    with_subs = keyed.join(F.broadcast(hot), ["i", "z"], "left")
    share = (F.col("h").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    sub = F.coalesce(F.least(F.floor(share * F.col("subs")), F.col("subs") - 1), F.lit(0)).cast("long")
    columns = ["seq", "i", "z", "doc_id", "text", "h"]
    dealt = with_subs.select(*columns, sub.alias("sub"), F.lit(1).cast("long").alias("n"))
    if filled:
        # Of these ids, texts that fill a range: one row each, with its number.
        own = keyed.join(F.broadcast(hot.select("i", "z")), ["i", "z"], "left_semi").groupBy("i", "z", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= full)
        pairs = F.broadcast(cut(own).select("i", "z", "h"))
        alike = dealt.join(pairs, ["i", "z", "h"], "left_semi").groupBy("seq", "i", "z", "h", "sub").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.sum("n").alias("n"))
        dealt = dealt.join(pairs, ["i", "z", "h"], "left_anti").unionByName(alike)
    dealt = dealt.withColumn("down", F.bitwise_not("doc_id"))
    firsts = dealt.groupBy("seq", "sub").agg(F.min(F.struct("down", "h")).alias("f")).orderBy("seq", "sub").collect()  # a row a range
    following = [(a["seq"], a["sub"], 0 if b["f"]["down"] is None else ~b["f"]["down"], b["f"]["down"] is None, b["f"]["h"]) for a, b in zip(firsts, firsts[1:] + firsts[:1])]
    wanted = spark.createDataFrame(following, "to_seq int, to_sub long, i long, z boolean, h long")
    near = dealt.join(F.broadcast(wanted.select("i", "z").distinct()), ["i", "z"], "left_semi")
    halo = (near.join(F.broadcast(wanted), ["i", "z", "h"])
            .select(F.col("to_seq").alias("seq"), F.col("to_sub").alias("sub"), F.lit(1).alias("halo"), "doc_id", "text", "n", "h", "down"))
    both = dealt.select("seq", "sub", F.lit(0).alias("halo"), "doc_id", "text", "n", "h", "down").unionAll(halo)
    ordered = both.repartition("seq", "sub").sortWithinPartitions("seq", "sub", "halo", F.asc_nulls_last("down"), "h")
    return _one_row_a_copy(ordered.select("halo", "doc_id", "text", "n").mapInArrow(_compare, _KIND))
