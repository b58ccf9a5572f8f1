"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words.  A document starts with the copy
probability its source needs: target / size of the source, at most 2; whole
copies are certain, the rest is a fraction below 1.  Fractions are then settled
in pairs: words are moved from one document's fraction to the other's, in a
random direction whose odds leave both expectations as they were, until one of
the two is 0 or 1.  The sum of words never changes, so a source misses its
target by part of one document.

Pairs are settled along a tree.  A leaf is a bucket of a source's documents
(about ``LEAF`` rows, so a source with a third of all rows has many leaves); it
streams its rows, longest first, and leaves one fraction at most.  ``FAN`` such
residuals meet in a node of the next level, up to the source's last one, which
is rounded to the nearer whole.  Random numbers are seeded by source, level and
bucket, and rows have a fixed order, so reruns agree.

Equal rows (of one id, source and text) are counted in the tasks and dealt out
again with a number of their own each, ``LEAF`` at a time, so many of them have
many buckets too.  What a source needs is handed to its rows over several tasks.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import cut, spread_join

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_COPIES = 2
LEAF, FAN = 4096, 64
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_EPS = 1e-9


def count_words(texts: pa.Array) -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` per text (null: 0), from the column's bytes in one pass."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    out = np.zeros(len(texts), np.int64)
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    if hi == lo:
        return out
    data = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi]
    word = ~_SPACES[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    begin = offsets[:-1] - lo
    full = offsets[1:] > offsets[:-1]
    at = begin[full]
    starts[at] = word[at]
    out[full] = np.add.reduceat(starts, at, dtype=np.int64)
    return out


_KEY = ["doc_id", "source", "h", "r", "size"]


def sized(docs: DataFrame, row_hash: Column | None = None) -> DataFrame:
    """(doc_id, source, h, r, size): h is the xxhash64 of the text (null: of the empty text), r ``row_hash`` or 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(count_words(b.column(4)))], _KEY)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), (F.lit(0).cast("long") if row_hash is None else row_hash).alias("r"), "text")
    return rows.mapInArrow(run, "doc_id long, source string, h long, r long, size long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = TOTAL_SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, rank, n, source_size, target) from rows (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all words; a target stops at ``most`` times its source's
    size and the excess is shared again by weight until none is above.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    n_parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = cut(per.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    # Rank: rows of the partitions before, plus the place within the partition.
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before, total = {}, 0
    for r in ranged.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        before[r["part"]], total = total, total + r["count"]
    offset = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), part), F.lit(0)) if before else F.lit(0)
    ranked = cut(ranged.withColumn("rank", (offset + place).cast("long"))
                 .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))))
    words = ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level = None
    while True:  # the capped set only grows
        capped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > most * F.col("source_size")
        r = ranked.agg(F.sum(F.when(capped, most * F.col("source_size"))).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("w")).first()
        if not r["w"]:
            break
        new = (share * words - (r["full"] or 0)) / r["w"]
        if new == level:
            break
        level = new
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.col("weight") * F.lit(float(level or 0.0)))
    return ranked.select("source", "rank", "n", "source_size", target.cast("double").alias("target"))


_ROW = "doc_id long, h long, r long, k long, size long, rank long, bucket long, source_size long, target double, base long, p double"
_FIELDS = [f.split(" ")[0] for f in _ROW.split(", ")]
_SIZE, _RANK, _BUCKET, _BASE = (_FIELDS.index(f) for f in ("size", "rank", "bucket", "base"))
_KINDS = [pa.float64() if f.endswith("double") else pa.int64() for f in _ROW.split(", ")]


def _settle(a: list, b: list, rng: random.Random) -> list | None:
    """Move words between the fractions of rows a and b until one is whole; the row that is not."""
    up = min((1 - a[-1]) * a[_SIZE], b[-1] * b[_SIZE])
    down = min(a[-1] * a[_SIZE], (1 - b[-1]) * b[_SIZE])
    words = up if rng.random() * (up + down) < down else -down
    a[-1] += words / a[_SIZE]
    b[-1] -= words / b[_SIZE]
    left = [r for r in (a, b) if _EPS < r[-1] < 1 - _EPS]
    return left[0] if left else None


def _pivot(level: int, last: bool, seed: int):
    """Streams rows sorted by (rank, bucket, size descending, doc_id, h, r, k); each node leaves one fraction at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, open_row, rng, done = None, None, None, []

        def whole(r):
            r[_BASE] += r[-1] >= 0.5
            r[-1] = -1.0
            done.append(r)

        def end():
            if open_row is not None:
                whole(open_row) if last else done.append(open_row)

        def flush():
            cols = list(zip(*done)) if done else [[]] * len(_FIELDS)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], _FIELDS)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                row = list(row)
                if (row[_RANK], row[_BUCKET]) != node:
                    end()
                    node, open_row = (row[_RANK], row[_BUCKET]), None
                    rng = random.Random(f"{seed}/{level}/{row[_RANK]}/{row[_BUCKET]}")
                if row[_SIZE] == 0 or not _EPS < row[-1] < 1 - _EPS:
                    whole(row)  # no words, or whole already
                elif open_row is None:
                    open_row = row
                else:
                    left = _settle(open_row, row, rng)
                    for r in (open_row, row):
                        if r is not left:
                            whole(r)
                    open_row = left
            yield flush()
        end()
        yield flush()

    return run


def _taken(docs: DataFrame, weights: Sequence[int], share: float, most: int, seed: int, row_hash: Column | None) -> DataFrame:
    """The rows of ``_ROW``, settled: ``base`` copies are taken of each row."""
    sizes = cut(sized(docs, row_hash))
    targets = cut(source_targets(sizes, weights, share, most))
    # Equal rows are one entry until they have met their source, and then at most LEAF of them leave it together.
    entries = (sizes.groupBy(*_KEY).agg(F.count("*").alias("c"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("c") - 1) / LEAF))))
               .withColumn("of", F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "source")))
               .withColumn("deal", F.xxhash64("doc_id", "h", "r", "chunk")))
    known = targets.select(F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "source")).alias("of"), "rank", "n", "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ends = F.least(F.col("c"), (F.col("chunk") + 1) * LEAF) - 1
    each = spread_join(entries, known, "of", "deal").withColumn("k", F.explode(F.sequence(F.col("chunk") * LEAF, ends)))
    start = each.select("doc_id", "h", "r", "k", "size", "rank",
                        F.pmod(F.xxhash64("doc_id", "size", "h", "r", "k"), F.ceil(F.col("n") / LEAF)).alias("bucket"), "source_size", "target",
                        F.floor(rate + _EPS).alias("base"),
                        # a text without words is never more than certainly taken
                        F.when(F.col("size") > 0, F.greatest(rate - F.floor(rate + _EPS), F.lit(0.0))).otherwise(F.lit(0.0)).alias("p"))
    buckets = targets.agg(F.max(F.ceil(F.col("n") / LEAF)).alias("b")).first()["b"] or 1
    settled, level = None, 0
    while True:
        last = buckets == 1
        rows = (start.repartition("rank", "bucket")
                .sortWithinPartitions("rank", "bucket", F.desc("size"), "doc_id", "h", "r", "k"))
        out = cut(rows.select(*_FIELDS).mapInArrow(_pivot(level, last, seed), _ROW))
        whole = out.filter("p < 0")
        settled = whole if settled is None else settled.unionAll(whole)
        if last:
            return settled
        start = out.filter("p >= 0").withColumn("bucket", F.expr(f"bucket div {FAN}"))
        buckets, level = -(-buckets // FAN), level + 1


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = TOTAL_SHARE, most: int = MOST_COPIES, seed: int = 42) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, h): what the mix takes of each row of ``docs``.

    Size is the number of words ``[^\\x20\\x09-\\x0D]+``; ``taken`` is ``copies``
    whole times the size, at most ``most``.  A null, empty or blank text has size
    0 and no fraction: its copies are the whole ones its source is sure of.  A
    null source is a source of its own, after all others.  Rows that repeat or
    lack a doc_id are rows like any other; ties in size and id are ordered by
    the hash ``h`` of the text.  A very long text is counted from its bytes in
    one pass.  An empty table gives an empty result; further columns are ignored.
    """
    taken = _taken(docs, weights, share, most, seed, None)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("base")).alias("taken"),
                        F.col("base").alias("copies"), "h")


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = TOTAL_SHARE, most: int = MOST_COPIES, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0 to ``most`` times), with the columns of ``docs``.

    Equal rows are combined in the tasks, and one of them comes back as often as
    all of them are taken.
    """
    row = F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns])
    key = ["i", "no_id", "h", "r"]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("no_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), row.alias("r"))
    one = rows.groupBy(*key).agg(F.first("row").alias("row"))
    wanted = (_taken(docs, weights, share, most, seed, row)
              .groupBy(F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("no_id"), "h", "r").agg(F.sum("base").alias("times")).filter("times > 0"))
    out = one.join(wanted, key).select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("one"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
