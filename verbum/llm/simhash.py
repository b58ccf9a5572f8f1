"""SimHash near-duplicates: fingerprints, a self-join of their binary trie, connected classes.

A fingerprint has 64 bits, one per majority of the bits of its word-shingle
hashes.  Fingerprints at most ``k`` bits apart are found by walking the trie of
distinct fingerprints against itself: a frontier of node pairs (two prefixes of
one depth, with the bits they differ in so far) is expanded a few bits at a
time by two equi-joins with the next depth's nodes, and a pair is pruned as
soon as its differing bits exceed the budget of its depth.

The budget grows with depth.  The 64 bits are seen as a ring of k+1 blocks; if
two fingerprints differ in at most k bits there is a rotation of the ring in
which the first l blocks hold at most l-1 differing bits, for every l.  So k+1
rotated tries are walked, each with budget 0 in its first block, 1 in the
second, and so on: the frontier stays in proportion to the number of
fingerprints instead of carrying all pairs of short prefixes.  A node has at
most 2**step children, and a fingerprint at most C(64,1)+C(64,2)+... others
within k bits, so no join key grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import SPREAD, cut, spread_join, word_blocks

SEED = 42
BITS = 64
STEP = 7


def simhash(data: bytes, shingle: int) -> int:
    """Signed 64-bit SimHash of UTF-8 ``data``; 0 if it has no words."""
    ones, total = np.zeros(BITS, np.int64), 0
    tail: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(data.lower()):  # bytes.lower() changes A-Z only
        words = tail + words
        if len(words) >= shingle:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            h = np.array([digest(g, SEED) for g in grams], "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(h)
        tail = words[-(shingle - 1):] if shingle > 1 else []
    if not total and tail:
        h = np.array([digest(b" ".join(tail), SEED)], "<u8")
        ones, total = np.unpackbits(h.view(np.uint8)).astype(np.int64), 1
    return int(np.packbits(2 * ones > total).view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, h, fp) for every row of ``docs``; null text counts as empty; h is the text's xxhash64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [simhash(t.as_py(), shingle) for t in b.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def _rotl(x, by: int):
    return x if by == 0 else F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, BITS - by))


def _depths(k: int) -> list[int]:
    first = BITS // (k + 1)
    inner = list(range(first, BITS - STEP, STEP))
    return [*inner, BITS]


def _budget(depth: int, k: int) -> int:
    width = BITS // (k + 1)
    return min(k, -(-depth // width) - 1)


def trie_self_join(fps: DataFrame, k: int = 2) -> DataFrame:
    """(a, b) for the pairs a != b of distinct values in ``fps.fp`` at most ``k`` bits apart.

    Each pair is returned at least once, in one order.
    """
    width = BITS // (k + 1)
    depths = _depths(k)
    rotated = F.array(*[F.struct(F.lit(r).alias("rot"), _rotl(F.col("fp"), r * width).alias("x")) for r in range(k + 1)])
    leaves = fps.select("fp").distinct().select(F.explode(rotated).alias("t")).select("t.rot", "t.x")

    def node(depth: int):
        return F.col("x") if depth == BITS else F.shiftrightunsigned("x", BITS - depth)

    # Budget 0 down to the first depth: only nodes paired with themselves, and
    # only those with two leaves or more.
    leaves = leaves.withColumn("top", node(depths[0]))
    shared = leaves.groupBy("rot", "top").count().filter("count > 1").drop("count")
    leaves = cut(leaves.join(shared, ["rot", "top"], "left_semi").drop("top"))
    pairs = leaves.select("rot", node(depths[0]).alias("p")).distinct().select("rot", "p", F.col("p").alias("q"), F.lit(0).alias("bits"))
    for above, depth in zip(depths, depths[1:]):
        mask = (1 << (depth - above)) - 1
        kids = leaves.groupBy("rot", node(above).alias("up"), node(depth).alias("kid")).agg(F.count("*").alias("n"))
        left = kids.select("rot", F.col("up").alias("p"), F.col("kid").alias("kp"), F.col("n").alias("np"))
        right = kids.select("rot", F.col("up").alias("q"), F.col("kid").alias("kq"))
        bits = F.col("bits") + F.bit_count(F.col("kp").bitwiseXOR(F.col("kq")).bitwiseAND(F.lit(mask)))
        pairs = (pairs.join(left, ["rot", "p"]).join(right, ["rot", "q"])
                 .filter((bits <= _budget(depth, k))
                         & ((F.col("p") != F.col("q")) | (F.col("kp") < F.col("kq"))
                            | ((F.col("kp") == F.col("kq")) & (F.col("np") > 1))))
                 .select("rot", F.col("kp").alias("p"), F.col("kq").alias("q"), bits.alias("bits")))

    def back(x):
        out = F.col(x)
        for r in range(1, k + 1):
            out = F.when(F.col("rot") == r, _rotl(F.col(x), BITS - r * width)).otherwise(out)
        return out

    return pairs.filter("p != q").select(back("p").alias("a"), back("q").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(x, root) for every value in ``links`` (a, b); root is the least value of its connected class.

    Each round lowers a value's label to the least label among its neighbours,
    hands that to the old label, and then replaces a label by its own label;
    rounds grow with the logarithm of the longest path.  Labels are written to
    the checkpoint folder each round; only one count reaches the driver.  A
    value's neighbours are combined in two steps, and the labels of a class are
    handed back over several tasks, so neither many neighbours nor a large class
    meet in one.
    """
    edges = cut(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())

    def least_of(rows: DataFrame, value: str, name: str) -> DataFrame:
        """(x, name): the least ``value`` of each a, in two steps."""
        part = F.pmod(F.xxhash64("b"), F.lit(SPREAD)).cast("int").alias("part")
        first = rows.groupBy(F.col("a").alias("x"), part).agg(F.min(value).alias("m"))
        return first.groupBy("x").agg(F.min("m").alias(name))

    labels = cut(least_of(edges, "b", "m").select("x", F.least("x", "m").alias("root")))
    while True:
        of_b = labels.select(F.col("x").alias("b"), F.col("root").alias("rb"))
        low = least_of(edges.join(of_b, "b"), "rb", "m")
        lowered = cut(labels.join(low, "x").select("x", "root", F.least("root", "m").alias("new")))
        hooks = lowered.groupBy(F.col("root").alias("x")).agg(F.min("new").alias("h"))
        hooked = cut(lowered.join(hooks, "x", "left").select("x", "root", F.least("new", "h").alias("new")))
        # Each label's own label, a row a label; then back to all that have it.
        own = hooked.select(F.col("x").alias("new"), F.col("new").alias("far"))
        far = hooked.select("new").distinct().join(own, "new")
        jumped = cut(spread_join(hooked, far, "new", "x").select("x", "root", F.col("far").alias("new")))
        changed = jumped.filter("root != new").limit(1).count()
        labels = jumped.select("x", F.col("new").alias("root"))
        if not changed:
            return labels


def _classes(fps: DataFrame, k: int) -> DataFrame:
    """(fp, root): the class of every distinct fingerprint."""
    distinct = cut(fps.select("fp").distinct())
    roots = components(trie_self_join(distinct, k))
    return distinct.join(roots, distinct.fp == roots.x, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, k: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id): classes of documents linked by fingerprints at most ``k`` bits apart.

    * words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles
      of ``shingle`` words joined by one space, repeats counted; fewer words: the
      whole sequence is the one shingle; none (null, empty or blank text):
      fingerprint 0, linked like any other;
    * ``component_id`` is the least doc_id reachable, the row's own included;
      rows with a null doc_id take part but never name a class unless it has no
      other (then null); repeated rows are returned as often as they come;
    * a very long text is hashed some megabytes at a time;
    * an empty table gives an empty result; further columns are ignored.
    """
    fps = cut(fingerprints(docs, shingle))
    classes = cut(_classes(fps, k))
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(classes, "fp")
    ids = least.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = cut(spread_join(classes, ids, "root", "fp").select("fp", "component_id"))
    # Both sides are written, so that the join can split the rows of a frequent fingerprint.
    return (fps.join(of_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, k: int = 2) -> DataFrame:
    """One row of each class of ``near_duplicates``, with the columns of ``docs``.

    The row with the least doc_id stays (null after all others; of several rows
    with that id the one whose text has the least xxhash64, of these the one
    whose columns have the least, of equal rows one).
    """
    fps = cut(fingerprints(docs, shingle))
    classes = cut(_classes(fps, k))
    best = fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("best")).join(classes, "fp")
    stays = cut(best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.doc_id").alias("i"), F.col("best.h").alias("g")))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    kept = rows.join(stays, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")), "left_semi")
    # Rows that share id and text; equal ones are combined before they meet.
    one = kept.groupBy("id", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])
