"""Repeated passages by a sparse suffix array.

A passage is a run of at least ``MIN_WORDS`` words (A-Z lower-cased) that two
documents share.  Of all suffixes only those at minimiser positions are kept:
the least of ``WINDOW`` neighbouring hashes of ``GRAM`` words is chosen by the
text alone, so both copies of a passage keep the same places, and one of them
is among the passage's first ``WINDOW`` words.  From there at least
``SEED = MIN_WORDS - WINDOW + 1`` words of the passage follow.

1. Each kept suffix is hashed over its first ``SEED`` words; hashes that one
   document alone holds go (counts by hash, pre-aggregated in the tasks).
2. The others get ``WINDOW`` words of context on either side, as word hashes,
   and are sorted by (hash, words to the right, words to the left): the sparse
   suffix array, dealt by hash.  A hash with more than ``HOT`` suffixes is dealt
   on by document, so a suffix that a third of all documents hold is spread over
   many partitions.
3. Equal suffixes are extended: for each split of the missing words into some
   to the left and the rest to the right, suffixes that agree on both sides are
   neighbours in the order of that split, and match if two documents hold them.
   Of a hash dealt on by document, splits that one task sees in two documents
   match at once; it sends one row for each split it saw, and Spark settles
   those that a task saw in one document only and links the least document of
   each task to the least of all, so that a split's documents hang together.
4. A document's matches are merged; kept places lie at most ``WINDOW`` words
   apart, so merged matches reach both ends of a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import cut
from verbum.llm.fingerprint import mix64, word_hashes

MIN_WORDS, WINDOW, GRAM = 50, 20, 8
HOT = 4096
CHUNK_ROWS = 100_000
_MUL = np.random.default_rng(7).integers(1, 1 << 63, MIN_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NO_WORD = np.uint32(0)
_MAX_ID = (1 << 63) - 1  # a null doc_id, after all others; each text of it is a document of its own


def _hashes(text: bytes) -> np.ndarray:
    return word_hashes(text.lower().split())


def _runs(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    size = len(w) - n + 1
    total = w[:size] * _MUL[0]
    for i in range(1, n):
        total += w[i:i + size] * _MUL[i]
    return mix64(total)


def places(w: np.ndarray, min_words: int = MIN_WORDS, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Minimiser positions of a text that at least min_words - window + 1 words follow; none in shorter texts than a passage."""
    if len(w) < min_words:
        return np.zeros(0, np.int64)
    g = _runs(w, gram)
    n = len(g) - window + 1
    # The leftmost least of every window, by ever wider strides.
    least, at, width = g.copy(), np.arange(len(g)), 1
    while width < window:
        step = min(width, window - width)
        a, b = least[:len(least) - step], least[step:]
        right = b < a
        at = np.where(right, at[step:], at[:len(at) - step])
        least = np.where(right, b, a)
        width += step
    kept = np.unique(at[:n])
    return kept[kept <= len(w) - (min_words - window + 1)]


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_MAX_ID)).alias("id"), F.xxhash64(text).alias("rh"), text.alias("text"))


def kept_suffixes(rows: DataFrame, min_words: int, window: int, gram: int) -> DataFrame:
    """(id, rh, hs, ps): per text the hashes and positions of its kept suffixes."""
    seed = min_words - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, ps = [], []
            for t in b.column(2).cast(pa.binary()):
                w = _hashes(t.as_py())
                p = places(w, min_words, window, gram)
                hs.append(_runs(w, seed)[p].view(np.int64) if len(p) else p)
                ps.append(p.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hs, pa.list_(pa.int64())), pa.array(ps, pa.list_(pa.int32()))], ["id", "rh", "hs", "ps"])

    return rows.mapInArrow(run, "id long, rh long, hs array<long>, ps array<int>").filter("size(hs) > 0")


LEVELS = 64  # a place and its level travel as place * LEVELS + level


def _with_context(window: int, seed: int):
    """(id, rh, text, codes) to a row per suffix with the words on its right and left as bytes, which sort as the words do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.arange(window)
        for b in batches:
            for i, rh, text, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()), b.column(3)):
                full = _hashes(text.as_py())
                code = np.array(codes.as_py(), np.int64)
                code = code[code // LEVELS <= len(full) - seed]
                if not len(code):
                    continue
                p, level = code // LEVELS, code % LEVELS
                w = (full >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                w = np.concatenate((np.full(window, _NO_WORD), w, np.full(window, _NO_WORD)))
                at = p[:, None] + window
                right, left = w[at + seed + step], w[at - 1 - step]
                both = np.ascontiguousarray(np.concatenate((right, left), axis=1).astype(">u4"))
                n = len(p)
                context = pa.Array.from_buffers(pa.binary(8 * window), n, [None, pa.py_buffer(both.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_runs(full, seed)[p].view(np.int64)), context, pa.array(np.full(n, i)), pa.array(np.full(n, rh)), pa.array(p.astype(np.int32)), pa.array(level.astype(np.int32))], ["h", "context", "id", "rh", "p", "level"])

    return run


# A match; or a split (a hash) that one task saw: of one document (partner is null), to be settled, or of two: its least document's match.
_MATCH = "id long, rh long, lo int, hi int, partner long, split long"


def _extend(window: int, min_words: int):
    """Streams sorted suffixes (h, context, id, rh, p, level); emits matches, and the splits seen of hashes dealt on by document."""
    names = [f.split(" ")[0] for f in _MATCH.split(", ")]

    def splits(h, ctx):
        """(rows, window) hashes of the passage that starts d words to the left, and whether the text has it."""
        right, left = ctx[:, :window].astype(np.uint64), ctx[:, window:].astype(np.uint64)
        n = len(h)
        sides = []
        for words in (right, left):
            hashes, real = np.zeros((n, window), np.uint64), np.ones((n, window), bool)
            for d in range(1, window):
                hashes[:, d] = mix64(hashes[:, d - 1] * _MUL[0] + words[:, d - 1])
                real[:, d] = real[:, d - 1] & (words[:, d - 1] != 0)
            sides.append((hashes, real))
        (r, r_real), (l, l_real) = sides
        d = np.arange(window, dtype=np.uint64)
        key = mix64(h.view(np.uint64)[:, None] * _MUL[1] + l * _MUL[2] + r[:, ::-1] * _MUL[3] + d * _MUL[4])
        return key, l_real & r_real[:, ::-1]

    def batch(ids, rh, lo, hi, partner, split):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rh, pa.int64()), lo, hi, partner, split], names)

    def work(h, ctx, ids, rh, p, level):
        key, real = splits(h, ctx)
        row, d = np.nonzero(real)
        if not len(row):
            return
        k = key[row, d]
        order = np.argsort(k, kind="stable")
        row, d, k = row[order], d[order], k[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        doc = ids[row]
        least, most = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
        texts = rh[row]
        shared = (least != most) | ((least == _MAX_ID) & (np.minimum.reduceat(texts, first) != np.maximum.reduceat(texts, first)))
        size = np.diff(np.append(first, len(k)))
        good = np.repeat(shared, size)
        spread = level[row] > 0
        two = spread[first] & shared
        if two.any():
            mine = np.flatnonzero(doc == np.repeat(least, size))
            seen = mine[np.searchsorted(mine, first[two])]
            lo = p[row[seen]] - d[seen]
            yield batch(least[two], rh[row[seen]], pa.array(lo, pa.int32()), pa.array(lo + min_words, pa.int32()), pa.array(most[two]), pa.array(k[seen].view(np.int64)))
        alone = np.flatnonzero(spread & ~good)
        if len(alone):
            lo = p[row[alone]] - d[alone]
            yield batch(doc[alone], rh[row[alone]], pa.array(lo, pa.int32()), pa.array(lo + min_words, pa.int32()), pa.nulls(len(alone), pa.int64()), pa.array(k[alone].view(np.int64)))
        partner = np.where(doc == np.repeat(least, size), np.repeat(most, size), np.repeat(least, size))
        row, d, partner = row[good], d[good], partner[good]
        if not len(row):
            return
        # All splits of a suffix overlap in its seed, so they make one range; it goes out with each partner they have.
        order = np.lexsort((partner, row))
        row, d, partner = row[order], d[order], partner[order]
        new = np.append(True, row[1:] != row[:-1])
        first = np.flatnonzero(new)
        lo, hi = p[row[first]] - np.maximum.reduceat(d, first), p[row[first]] - np.minimum.reduceat(d, first) + min_words
        each = np.flatnonzero(new | np.append(True, partner[1:] != partner[:-1]))
        at, of = row[each], np.searchsorted(first, each, side="right") - 1
        yield batch(ids[at], rh[at], pa.array(lo[of], pa.int32()), pa.array(hi[of], pa.int32()), pa.array(partner[each]), pa.nulls(len(at), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def columns(b):
            ctx = b.column(1).cast(pa.binary(8 * window))
            raw = np.frombuffer(ctx.buffers()[1], ">u4", count=2 * window * len(ctx), offset=8 * window * ctx.offset)
            return [b.column(0).to_numpy(), raw.reshape(len(ctx), 2 * window), *(b.column(i).to_numpy() for i in range(2, 6))]

        for b in batches:
            if not b.num_rows:
                continue
            held.append(columns(b))
            rows += b.num_rows
            if rows >= CHUNK_ROWS:  # whole hashes only; one has HOT rows at most, or is settled later
                cols = [np.concatenate(c) for c in zip(*held)]
                new = np.flatnonzero(cols[0][1:] != cols[0][:-1]) + 1
                end = int(new[-1]) if len(new) else len(cols[0]) if cols[5][0] > 0 else 0
                if end:
                    yield from work(*(c[:end] for c in cols))
                held, rows = ([[c[end:] for c in cols]], len(cols[0]) - end) if end < len(cols[0]) else ([], 0)
        if held:
            yield from work(*(np.concatenate(c) for c in zip(*held)))

    return run


def matched_ranges(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, rh, lo, hi, partner): word ranges that match another document; they overlap."""
    seed = min_words - window + 1
    rows = _identified(docs)
    suffixes = cut(kept_suffixes(rows, min_words, window, gram))
    each = suffixes.select("id", "rh", F.explode(F.arrays_zip("hs", "ps")).alias("s")).select("id", "rh", F.col("s.hs").alias("h"), F.col("s.ps").alias("p"))
    nameless = F.when(F.col("id") == _MAX_ID, F.col("rh"))
    texts = [F.min(nameless).alias("c"), F.max(nameless).alias("d")]
    # Of two documents: of two ids, or of two texts without an id.
    several = F.expr(f"a < b OR a = {_MAX_ID} AND c < d")
    counts = each.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"), *texts)
    level = F.when(F.col("n") > HOT, F.ceil(F.log2(F.col("n") / HOT))).otherwise(F.lit(0)).cast("long")
    # Written, so that the join can split the rows of a frequent hash over several tasks.
    shared = cut(counts.filter(several).select("h", level.alias("level")))
    found = each.join(shared, "h").select("id", "rh", (F.col("p").cast("long") * LEVELS + F.col("level")).alias("code"))
    # A text's group holds at most its own kept suffixes.
    by_doc = found.groupBy("id", "rh").agg(F.collect_set("code").alias("codes"))
    joined = rows.join(by_doc, ["id", "rh"]).select("id", "rh", "text", "codes")
    context = joined.mapInArrow(_with_context(window, seed), "h long, context binary, id long, rh long, p int, level int")
    salt = F.when(F.col("level") > 0, F.pmod(F.xxhash64("id", "rh"), F.pow(F.lit(2.0), "level").cast("long"))).otherwise(F.lit(0))
    dealt = context.withColumn("salt", salt).repartition("h", "salt").sortWithinPartitions("h", "context")
    out = cut(dealt.select("h", "context", "id", "rh", "p", "level").mapInArrow(_extend(window, min_words), _MATCH))
    seen = out.filter("split IS NOT NULL")
    # A split that one task saw once is settled; of a match sent with its split only the link to the least document is left.
    sides = cut(seen.groupBy("split").agg(F.min("id").alias("a"), F.max(F.coalesce("partner", "id")).alias("b"), F.count("*").alias("n"), F.max("partner").alias("two"), *texts)
                .filter(F.expr("n > 1") & (several | F.col("two").isNotNull())).select("split", "a", "b"))
    late = (seen.join(sides, "split").filter("partner IS NULL OR id > a")
            .withColumn("partner", F.when(F.col("id") == F.col("a"), F.col("b")).otherwise(F.col("a"))))
    pick = ["id", "rh", "lo", "hi", "partner"]
    return out.filter("split IS NULL").select(*pick).unionAll(late.select(*pick))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_spans, n_words, spans, partners): one row per document text with repeated passages.

    ``spans`` are merged word ranges start:end (end exclusive), comma-joined;
    ``n_words`` counts their words; ``partners`` lists doc_ids that share one of
    them, a neighbour of each match.  Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z
    lower-cased.  Null, empty and short texts have none; passages that only one
    document holds, however often, are not reported; rows of one doc_id are one
    document (two texts of one doc_id give two rows, equal rows one); each text
    with a null doc_id is a document, its doc_id null, and null as a partner is
    left out.  An empty table gives an empty result; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_spans, n_words, spans = [], [], []
            for ranges in b.column(2).to_pylist():
                merged: list[list[int]] = []
                for r in sorted((r["lo"], r["hi"]) for r in ranges):
                    if merged and r[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r[1])
                    else:
                        merged.append(list(r))
                n_spans.append(len(merged))
                n_words.append(sum(hi - lo for lo, hi in merged))
                spans.append(",".join(f"{lo}:{hi}" for lo, hi in merged))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_spans, pa.int64()), pa.array(n_words, pa.int64()), pa.array(spans, pa.string()), b.column(3)], ["id", "n_spans", "n_words", "spans", "partners"])

    # A document's group holds at most a match for each of its own kept suffixes and passes.
    per = (matched_ranges(docs, min_words, window, gram).groupBy("id", "rh")
           .agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"), F.sort_array(F.collect_set(F.when(F.col("partner") != _MAX_ID, F.col("partner")))).alias("partners")))
    merged = per.mapInArrow(run, "id long, n_spans long, n_words long, spans string, partners array<long>")
    return merged.select(F.when(F.col("id") != _MAX_ID, F.col("id")).alias("doc_id"), "n_spans", "n_words", "spans", "partners")
