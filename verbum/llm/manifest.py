"""Merkle manifest of a dataset: a postorder append log written by aligned builders.

Each language's rows are the leaves of one tree; the trees' subroots, in order
of language, are the leaves of a last one, whose root names the whole dataset.
Every two consecutive nodes become their hash, a last single one too.

1. Leaves are ranked within their tree: digests alone (never texts) are dealt to
   ranges of (tree, doc_id) and counted; of every partition one row reaches the
   driver, from which follows how many leaves of its first tree lie before it.
2. A builder has ``2 ** height`` consecutive leaves from a multiple of that on.
   It appends nodes to its segment of the log as they are completed: a leaf, then
   every ancestor whose last leaf it is.  A short last builder finishes with the
   right edge.  A tree that a third of all rows belong to has many builders.
3. The builders' last nodes are the leaves of the next round, until a tree has
   one builder; so a round has ``2 ** height`` times fewer rows.
4. Of a tree of n leaves, node i of level k is completed by leaf
   e = min((i + 1) * 2**k, n) - 1.  Before leaf e the log has the subtrees of all
   leaves before it, 2e - popcount(e) nodes; from leaf e up the levels follow one
   by one.  So the node's place is 2e - popcount(e) + k, and a proof reads each
   sibling at its place.
5. From the root down, each round hands a builder's proof to its leaves behind
   their own siblings.  Joins are on (tree, builder), one row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import cut
from verbum.session import write_and_read

HEIGHT = 10
_DIGEST = 32
LONE, LEFT, RIGHT = b"\x00", b"\x01", b"\x02"  # of a level of a proof: no sibling; one on the left; one on the right
FOREST = ""  # the tree of the subroots


def node_hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf_hash(*fields: Column) -> Column:
    """Hash of the fields, each ``-`` if null and else its UTF-8 length, a colon and itself."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


# ---------------------------------------------------------------- places in the log

def place(level: int, index: int, n: int) -> int:
    """Where the log of a tree of ``n`` leaves has a node."""
    last = min(index + 1 << level, n) - 1
    return 2 * last - last.bit_count() + level


def completed(leaves: list[str], height: int) -> list[str]:
    """All nodes up to ``height`` over the given leaves, in order of completion."""
    log: list[str] = []
    waiting: dict[int, str] = {}  # level to its last left child
    node, level = "", 0
    for i, node in enumerate(leaves):
        log.append(node)
        level = 0
        while i >> level & 1:
            node = node_hash(waiting[level], node)
            log.append(node)
            level += 1
        waiting[level] = node
    while level < height:  # the right edge
        node = node_hash(waiting[level], node) if (len(leaves) - 1) >> level & 1 else node_hash(node)
        log.append(node)
        level += 1
    return log


def height_of(builder: int, size: int, height: int) -> int:
    """The first builder of a tree ends with one node; there is only one if it is not full.  All others end at ``height``."""
    return height if builder else (size - 1).bit_length()


def siblings(segment: bytes, size: int, height: int, leaf: int) -> bytes:
    """The proof of one leaf up to ``height``: for each level a side, and the sibling if there is one."""
    out = []
    for level in range(height):
        index = leaf >> level
        other = index ^ 1
        if other << level >= size:
            out.append(LONE)
        else:
            at = place(level, other, size) * _DIGEST
            out.append((LEFT if index & 1 else RIGHT) + segment[at:at + _DIGEST])
    return b"".join(out)


def fold(leaf: str, path: bytes) -> tuple[str, str]:
    """(root, hash of the siblings in order) that a leaf's digest and a proof lead to."""
    node, at, seen = leaf, 0, []
    while at < len(path):
        side = path[at:at + 1]
        at += 1
        if side == LONE:
            node = node_hash(node)
            continue
        other = path[at:at + _DIGEST].hex()
        at += _DIGEST
        seen.append(other)
        node = node_hash(other, node) if side == LEFT else node_hash(node, other)
    return node, node_hash(*seen)


# ---------------------------------------------------------------- ranks

def _numbered(carry: dict[int, int]):
    """Streams sorted rows (part, tree, ...); appends the row's rank within its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            tree = b.column(1)
            code = tree.dictionary_encode().indices.to_numpy()
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            size = np.diff(np.append(first, len(code)))
            rank = np.arange(len(code)) - np.repeat(first, size)
            if before is None:
                rank[:size[0]] += carry.get(b.column(0)[0].as_py(), 0)
            elif tree[0].as_py() == last:
                rank[:size[0]] += before
            before, last = int(rank[-1]) + 1, tree[-1].as_py()
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(rank, pa.int64())], [*b.schema.names[1:], "rank"])

    return run


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, the place within the row's ``tree`` by ``order``, null first; equal rows in any order."""
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["tree", *order, "_row"]
    # The row's number deals equal rows to several ranges.
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n_parts, *by).sortWithinPartitions(*by)
    held = cut(dealt.select(F.spark_partition_id().alias("part"), "tree", *[c for c in rows.columns if c != "tree"], F.monotonically_increasing_id().alias("_at")))
    per = held.groupBy("part", "tree").agg(F.count("*").alias("n"), F.min("_at").alias("at"))
    ends = (per.groupBy("part").agg(F.min_by("tree", "at").alias("first"), F.max_by("tree", "at").alias("last"), F.max_by("n", "at").alias("n"),
                                    F.count("*").alias("trees")).orderBy("part").collect())  # a row a partition
    carry, last, before = {}, None, 0
    for r in ends:
        carry[r["part"]] = before if last is not None and r["first"] == last else 0
        before = r["n"] + (carry[r["part"]] if r["trees"] == 1 else 0)
        last = r["last"]
    held = held.drop("_at")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields[1:]) + ", rank long"
    return held.mapInArrow(_numbered(carry), kind)


# ---------------------------------------------------------------- builders

_SEGMENT = "tree string, builder long, size int, segment binary, ids array<long>, claims array<string>"
_SEGMENT_NAMES = [f.split(" ")[0] for f in _SEGMENT.split(", ")]


def _build(full: int):
    """Streams nodes (tree, builder, digest, id, claim) in order; a row a builder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaves, ids, claims, done = None, [], [], [], []

        def end():
            log = completed(leaves, height_of(key[1], len(leaves), full))
            done.append((*key, len(leaves), bytes.fromhex("".join(log)), list(ids), list(claims)))
            for x in (leaves, ids, claims):
                x.clear()

        def flush():
            cols = list(zip(*done)) if done else [[]] * len(_SEGMENT_NAMES)
            done.clear()
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], _SEGMENT_NAMES)

        for b in batches:
            for tree, builder, digest, i, claim in zip(*(c.to_pylist() for c in b.columns)):
                if (tree, builder) != key:
                    if key is not None:
                        end()
                    key = (tree, builder)
                leaves.append(digest)
                ids.append(i)
                claims.append(claim)
            yield flush()
        if key is not None:
            end()
        yield flush()

    return run


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The log's segments, round by round, from nodes (tree, rank, digest, id, claim)."""
    out: list[DataFrame] = []
    while True:
        keyed = nodes.select("tree", F.shiftright("rank", height).alias("builder"), "digest", "id", "claim", "rank")
        dealt = keyed.repartition("tree", "builder").sortWithinPartitions("tree", "builder", "rank")
        out.append(write_and_read(dealt.select("tree", "builder", "digest", "id", "claim").mapInArrow(_build(height), _SEGMENT), "segments"))
        if not (out[-1].agg(F.max("builder").alias("m")).first()["m"] or 0):
            return out
        nodes = _tops(out[-1]).select("tree", F.col("builder").alias("rank"), "digest", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("claim"))


def _tops(segments: DataFrame) -> DataFrame:
    """(tree, builder, digest): the last node of each segment."""
    return segments.select("tree", "builder", F.lower(F.hex(F.substring("segment", F.octet_length("segment") - (_DIGEST - 1), F.lit(_DIGEST)))).alias("digest"))


@dataclass
class Manifest:
    rounds: list[DataFrame]  # segments of the trees of rows
    forest: list[DataFrame]  # segments of the tree of subroots
    subroots: DataFrame      # tree, digest, rank in the forest
    root: str | None         # null if there are no rows
    height: int = HEIGHT     # of a full builder


def tree_of(lang: Column) -> Column:
    """The name of a language's tree; null comes first."""
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang.cast("string")))


def build_manifest(docs: DataFrame, claim: Column | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text).

    ``claim`` is a digest per row that somebody else states for it, to be
    verified; null (or none): the row's own.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    rows = docs.select(tree_of(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf_hash(*fields).alias("digest"),
                       (claim if claim is not None else F.lit(None).cast("string")).alias("claim"))
    rounds = _rounds(ranked(write_and_read(rows, "leaves"), ["id", "digest", "claim"]), height)
    subroots = write_and_read(ranked(_tops(rounds[-1]).select(F.lit(FOREST).alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]), "subroots")
    nothing = [F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("claim")]
    forest = _rounds(subroots.select("tree", "rank", "digest", *nothing), height)
    top = _tops(forest[-1]).first()  # one row
    return Manifest(rounds, forest, subroots.select(F.col("name").alias("tree"), "digest", "rank"), top["digest"] if top else None, height)


# ---------------------------------------------------------------- proofs

_DOWN = "tree string, builder long, path binary, subroot string"
_PARTS = ["tree", "builder", "size", "segment", "path", "subroot"]


def _hand_down(full: int):
    """Segments with their paths and subroots to (tree, builder, path, subroot) of the round below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, builder, size, segment, path, subroot in zip(*(c.to_pylist() for c in b.columns)):
                height, first = height_of(builder, size, full), builder << full
                paths = [siblings(segment, size, height, i) + path for i in range(size)]
                yield pa.RecordBatch.from_arrays([pa.array([tree] * size, pa.string()), pa.array(range(first, first + size), pa.int64()), pa.array(paths, pa.binary()), pa.array([subroot] * size, pa.string())],
                                                 ["tree", "builder", "path", "subroot"])

    return run


def _row_proofs(full: int):
    """The first round's segments with paths, subroots, ids and claims to a row a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "leaf", "claim", "subroot", "path"]
        for b in batches:
            for _, builder, size, segment, path, subroot, ids, claims in zip(*(c.to_pylist() for c in b.columns)):
                height = height_of(builder, size, full)
                leaves = [segment[at:at + _DIGEST].hex() for at in (place(0, i, size) * _DIGEST for i in range(size))]
                paths = [siblings(segment, size, height, i) + path for i in range(size)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(leaves, pa.string()), pa.array(claims, pa.string()), pa.array([subroot] * size, pa.string()), pa.array(paths, pa.binary())], names)

    return run


def _down(rounds: list[DataFrame], paths: DataFrame, height: int) -> DataFrame:
    """(tree, builder, path, subroot) of the first round's builders from that of the last's."""
    for segments in reversed(rounds[1:]):
        paths = segments.join(paths, ["tree", "builder"]).select(*_PARTS).mapInArrow(_hand_down(height), _DOWN)
    return paths


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, claim, subroot, root, path), one row per row of the dataset.

    ``path`` holds, level by level from the leaf to the root, a byte (0: no
    sibling, 1: one on the left, 2: one on the right) and the sibling's 32 bytes.
    """
    spark = manifest.subroots.sparkSession
    start = spark.createDataFrame([(FOREST, 0, b"", "")], _DOWN)
    forest = manifest.forest[0].join(_down(manifest.forest, start, manifest.height), ["tree", "builder"]).select(*_PARTS).mapInArrow(_hand_down(manifest.height), _DOWN)
    of_tree = manifest.subroots.join(forest.select(F.col("builder").alias("rank"), "path"), "rank")
    tops = write_and_read(of_tree.select("tree", F.lit(0).cast("long").alias("builder"), "path", F.col("digest").alias("subroot")), "tops")
    rows = manifest.rounds[0].join(_down(manifest.rounds, tops, manifest.height), ["tree", "builder"])
    out = rows.select(*_PARTS, "ids", "claims").mapInArrow(_row_proofs(manifest.height), "doc_id long, leaf string, claim string, subroot string, path binary")
    return out.select("doc_id", "leaf", "claim", "subroot", F.lit(manifest.root).cast("string").alias("root"), "path")


def verify(proven: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the root that each claim (null: the leaf) leads to.

    ``proof_sha256`` is the hash of the siblings in order.
    """
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_id, leaf, claim, subroot, root, path = b.columns
            ends = [fold(c or x, p) for x, c, p in zip(leaf.to_pylist(), claim.to_pylist(), path.to_pylist())]
            yield pa.RecordBatch.from_arrays([doc_id, leaf, subroot, root, pa.array([e[1] for e in ends], pa.string()), pa.array([e[0] for e in ends], pa.string())], names)

    kind = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return proven.select("doc_id", "leaf", "claim", "subroot", "root", "path").mapInArrow(run, kind).withColumn("verified", F.col("folded_root") == F.col("root"))


def log_entries(manifest: Manifest) -> DataFrame:
    """(tree, position, level, index, digest): the whole append log of every tree."""

    full = manifest.height

    def nodes(base: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for tree, builder, size, segment in zip(*(c.to_pylist() for c in b.columns)):
                    rows = []
                    for level in range(1 if base else 0, height_of(builder, size, full) + 1):
                        for i in range(-(-size >> level)):
                            at = place(level, i, size) * _DIGEST
                            rows.append((tree, base + level, (builder << full >> level) + i, segment[at:at + _DIGEST].hex()))
                    cols = list(zip(*rows)) if rows else [[]] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.string()))], ["tree", "level", "index", "digest"])

        return run

    out = None
    for rounds in (manifest.rounds, manifest.forest):
        n = rounds[0].groupBy("tree").agg(F.sum("size").alias("n"))
        for r, segments in enumerate(rounds):
            each = segments.select("tree", "builder", "size", "segment").mapInArrow(nodes(r * full), "tree string, level int, index long, digest string")
            last = F.expr("least(shiftleft(index + 1, level), n) - 1")
            rows = each.join(n, "tree").withColumn("last", last).select("tree", F.expr("2 * last - bit_count(last) + level").alias("position"), "level", "index", "digest")
            out = rows if out is None else out.unionAll(rows)
    return out


def manifest_report(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    Claims are the rows themselves, but for those where 7 divides the crc32 of
    the decimal doc_id: there n_chars is one more (null stays null).  In a tree
    rows ascend by doc_id, null first, rows of one doc_id by digest; equal rows
    are leaves of their own.  A null language is the first tree.  Null fields and
    empty or very long texts are hashed as they are.  An empty table gives an
    empty result; further columns, whatever their names, are ignored.
    """
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")]
    return verify(proofs(build_manifest(docs, F.when(tampered, leaf_hash(*fields)), height)))
