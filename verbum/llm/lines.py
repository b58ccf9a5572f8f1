"""Line deduplication: range-partitioned line hashes, streamed; keep bitmaps instead of text.

1. One row per document and distinct line key: the key's 128-bit hash, the
   document and the positions of its lines with that key.
2. The rows are range-partitioned and sorted by (hash, document).  Because the
   document is part of the range key, a line that a third of all documents hold
   is spread over many partitions.
3. Each partition is streamed once.  All rows of a hash but those of its first
   document lose their lines.  A run that starts at the head of a partition may
   continue one from before; its rows are settled by the first document of the
   hash among the partitions' head and tail runs, at most two a partition.
4. Lost positions become one compressed keep bitmap per document that loses lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import cut

MIN_KEY = 10
_STRIP = b" \t\n\x0b\x0c\r"
_MAX_ID = (1 << 63) - 1  # a null doc_id sorts after all others
_I64 = pa.int64()


def _key(line: bytes, min_key: int) -> bytes | None:
    """The line's key, or None if it has fewer than ``min_key`` code points."""
    key = line.strip(_STRIP)
    if len(key) < min_key or len(key) < 4 * min_key and len(key.decode()) < min_key:
        return None
    return key.lower()  # bytes.lower() changes A-Z only


def _identified(docs: DataFrame) -> DataFrame:
    """(id, rh, text): rows that share doc_id and text get one bitmap."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_MAX_ID)).alias("id"), F.xxhash64(text).alias("rh"), text.alias("text"))


def line_keys(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(h1, h2, id, rh, at) per document and distinct key; ``at`` holds the line positions, little-endian uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                h, ids, rhs, at = [], [], [], []
                part = b.slice(lo, 512)
                texts = part.column(2).cast(pa.binary())
                for i, rh, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    found: dict[bytes, list[int]] = {}
                    for n, line in enumerate(text.as_py().split(b"\n")):
                        key = _key(line, min_key)
                        if key is not None:
                            found.setdefault(xxhash.xxh3_128_digest(key), []).append(n)
                    h += found.keys()
                    at += [np.array(p, "<u4").tobytes() for p in found.values()]
                    ids += [i] * len(found)
                    rhs += [rh] * len(found)
                both = np.frombuffer(b"".join(h), ">i8").reshape(-1, 2).astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(ids, _I64), pa.array(rhs, _I64), pa.array(at, pa.binary())], ["h1", "h2", "id", "rh", "at"])

    return _identified(docs).mapInArrow(run, "h1 long, h2 long, id long, rh long, at binary")


DROP, OPEN, FIRST = 0, 1, 2  # lines lost; not settled yet; first document of an end run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2, id) of one partition; only the run at the end of a batch is carried on."""
    names = ["kind", "h1", "h2", "id", "rh", "at"]

    def rows(kind, h1, h2, ids, rh, at):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind, np.int32)), pa.array(h1), pa.array(h2), pa.array(ids), pa.array(rh), at], names)

    def first(key, doc):
        one = [np.array([x], np.int64) for x in (*key, doc, 0)]
        return rows(FIRST, *one, pa.array([b""], pa.binary()))

    key, doc, in_head = None, 0, True
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, ids, rh = (b.column(i).to_numpy() for i in range(4))
        new = np.ones(len(ids), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if key is None:
            yield first((h1[0], h2[0]), ids[0])  # of the head run
        else:
            new[0] = (h1[0], h2[0]) != key
        start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), -1))
        firsts = np.where(start >= 0, ids[np.maximum(start, 0)], doc)
        run = np.cumsum(new)  # 0: the run that the batch before ended with
        head = run == (1 if key is None else 0) if in_head else np.zeros(len(ids), bool)
        for kind, mask in ((OPEN, head), (DROP, ~head & (ids != firsts))):
            k = np.flatnonzero(mask)
            if len(k):
                yield rows(kind, h1[k], h2[k], ids[k], rh[k], b.column(4).take(pa.array(k)))
        in_head = bool(head[-1])
        key, doc = (h1[-1], h2[-1]), int(firsts[-1])
    if key is not None and not in_head:
        yield first(key, doc)  # of the tail run


def lost_lines(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(id, rh, at): positions of lines whose key an earlier document holds; several rows per document."""
    keys = cut(line_keys(docs, min_key))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(n, "h1", "h2", "id").sortWithinPartitions("h1", "h2", "id")
    found = cut(ranged.mapInArrow(_stream, "kind int, h1 long, h2 long, id long, rh long, at binary"))
    firsts = found.filter(f"kind = {FIRST}").groupBy("h1", "h2").agg(F.min("id").alias("first_id"))
    # At most two rows a partition of the range exchange.
    settled = found.filter(f"kind = {OPEN}").join(F.broadcast(firsts), ["h1", "h2"]).filter("id > first_id")
    return found.filter(f"kind = {DROP}").select("id", "rh", "at").unionAll(settled.select("id", "rh", "at"))


def keep_bitmaps(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(id, rh, lost binary): per document that loses lines, a deflated bitmap with a bit set for each lost line.

    ``id`` is the doc_id (null: 2**63-1) and ``rh`` the xxhash64 of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for parts in b.column(2).to_pylist():
                at = np.frombuffer(b"".join(parts), "<u4")
                bits = np.zeros(int(at.max()) + 1, np.uint8)
                bits[at] = 1
                out.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["id", "rh", "lost"])

    # A document's group holds at most its own lines.
    grouped = lost_lines(docs, min_key).distinct().groupBy("id", "rh").agg(F.collect_list("at").alias("parts"))
    return grouped.mapInArrow(run, "id long, rh long, lost binary")


def kept_lines(text: bytes, lost: bytes | None) -> tuple[list[bytes], int]:
    """The lines that stay, and the number of all lines."""
    lines = text.split(b"\n")
    if not lost:
        return lines, len(lines)
    bits = np.zeros(len(lines), bool)
    found = np.unpackbits(np.frombuffer(zlib.decompress(lost), np.uint8))[: len(lines)]
    bits[: len(found)] = found
    return [x for x, gone in zip(lines, bits) if not gone], len(lines)


def with_bitmaps(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, its text as ``body``, and ``lost`` (null: all lines stay)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), text.alias("body"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(_MAX_ID)).alias("id"), F.xxhash64(text).alias("rh"))
    return rows.join(keep_bitmaps(docs, min_key), ["id", "rh"], "left").select("row", "body", "lost")


def line_report(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row of ``docs``.

    Lines are the parts between \\n (null or empty text: one empty line).  A
    line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
    lower-cased.  Keys of at least ``min_key`` code points that two documents or
    more hold lose their lines except in the smallest doc_id; repeats within
    that document stay.  Rows of one doc_id are one document here; a null
    doc_id counts as the largest.  An empty table gives an empty result;
    further columns are ignored.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, sha = [], [], []
            for text, lost in zip(b.column(1).cast(pa.binary()), b.column(2)):
                kept, total = kept_lines(text.as_py(), lost.as_py())
                n.append(total)
                gone.append(total - len(kept))
                sha.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, _I64), pa.array(gone, _I64), pa.array(sha, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    rows = with_bitmaps(docs.select("doc_id", "text"), min_key).select(F.col("row.doc_id").cast("long").alias("doc_id"), "body", "lost")
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def replace_text(run: Callable[[bytes, bytes | None], bytes]) -> Callable:
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [run(t.as_py(), x.as_py()) for t, x in zip(b.column("body").cast(pa.binary()), b.column("lost"))]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(new, pa.binary()).cast(pa.string())], ["row", "body"])

    return texts


def drop_repeated_lines(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """``docs`` with its columns as they were, but lost lines taken out of ``text`` and ``n_chars`` counted anew.

    Rules as in ``line_report``; a null text stays null, and a row whose lines
    are all lost stays with an empty text.
    """
    rows = with_bitmaps(docs, min_key)
    kind = rows.schema["row"].dataType.simpleString()
    new = rows.mapInArrow(replace_text(lambda text, lost: b"\n".join(kept_lines(text, lost)[0])), f"row {kind}, body string")
    out = []
    for c in docs.columns:
        old = F.col("row")[c]
        if c == "text":
            out.append(F.when(old.isNotNull(), F.col("body")).alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("row")["text"].isNotNull(), F.length("body")).otherwise(old).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(old.alias(c))
    return new.select(*out)
