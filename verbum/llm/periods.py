"""Periodic runs of words: recursive frequency splitting, then a scan of lags.

A run is a stretch with smallest period q, at least ``min_words`` and
``min_periods`` * q words long, that no neighbouring word extends.  So each of
its words occurs ``min_periods`` times in it at least.

1. A segment (at first a whole text) is split at every word that occurs less
   often than that within it; pieces shorter than ``min_words`` go.  A piece has
   fewer words, so more of them are rare in it; this is repeated until nothing
   splits.  A run is never split, and nor is a longer one it might be part of.
2. The surviving segments are laid end to end, a word of its own between two,
   and scanned lag by lag.  Up to lag ``DIRECT`` all words are compared with
   those ``q`` before.  Beyond, a run holds ``q`` equal neighbours at a place
   that ``q`` divides, so only the blocks there are compared, by rolling hashes:
   n / q of them for lag q.  A pair of equal blocks inside a run already found
   has that run's period and goes; any other is extended word by word, left and
   right, so no run depends on a hash.

A task works on ``slice_bytes`` of texts at a time (a longer text alone).
Words become numbers by the column's own dictionary, exactly.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS, MIN_PERIODS = 24, 3
DIRECT = 16
SLICE_BYTES = 8 << 20
PAIRS = 1 << 20  # block pairs looked at together
_BASE = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def split_segments(codes: np.ndarray, segment: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """(place, segment) of the words that survive the splitting, segments numbered anew from 0.

    ``codes`` are words as numbers, ``segment`` rises with the place.
    """
    place = np.arange(len(codes))
    while len(place):
        key = segment * (int(codes.max()) + 1) + codes[place]
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        often = times[back] >= min_periods
        held, of = place[often], segment[often]
        new = np.ones(len(held), bool)
        new[1:] = (held[1:] != held[:-1] + 1) | (of[1:] != of[:-1])
        number = np.cumsum(new) - 1
        size = np.bincount(number, minlength=1)
        long = (size >= min_words)[number] if len(held) else np.zeros(0, bool)
        if long.all() and len(held) == len(place):
            return place, number
        place = held[long]
        _, segment = np.unique(number[long], return_inverse=True)
    return place, segment


class _Found:
    """The runs found so far, for 'is [lo, hi) inside one of them?'"""

    def __init__(self):
        self.runs: list[Run] = []
        self.start, self.reach = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def settle(self) -> None:
        """Makes the runs added since known to ``inside``."""
        if self.runs:
            at = np.array(sorted((s, s + n) for s, n, _ in self.runs), np.int64)
            self.start, self.reach = at[:, 0], np.maximum.accumulate(at[:, 1])

    def inside(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(len(lo), bool)
        k = np.searchsorted(self.start, lo, side="right") - 1
        return (k >= 0) & (self.reach[np.maximum(k, 0)] >= hi)


def _equal_from(a: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and from j on, in direction ``step``, are equal; looks at ever wider stretches."""
    most = len(a) - j if step > 0 else i + 1
    done, width = 0, 64
    while done < most:
        n = min(width, most - done)
        x, y = (a[i + done:i + done + n], a[j + done:j + done + n]) if step > 0 else (a[i - done - n + 1:i - done + 1][::-1], a[j - done - n + 1:j - done + 1][::-1])
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done, width = done + n, 4 * width
    return done


def scan_lags(a: np.ndarray, longest: int, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[Run]:
    """All runs of ``a``, whose periods are at most ``longest`` // ``min_periods``; needs ``min_periods`` >= 3."""
    found, top = _Found(), longest // min_periods
    for q in range(1, min(DIRECT, top) + 1):
        same = np.concatenate(([False], a[q:] == a[:-q], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        lo, hi = edge[::2], edge[1::2] + q
        good = hi - lo >= max(min_words, min_periods * q)
        good[good] = ~found.inside(lo[good], hi[good])
        if good.any():
            found.runs += [(int(x), int(y - x), q) for x, y in zip(lo[good], hi[good])]
            found.settle()
    if top <= DIRECT:
        return found.runs
    value = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    power = np.ones(len(a) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(a), _BASE), out=power[1:])
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * power[:-1], dtype=np.uint64)))
    q = DIRECT + 1
    while q <= top:
        end = q + 1  # lags [q, end) have PAIRS pairs or so together
        pairs = len(a) // q
        while end <= top and pairs < PAIRS:
            pairs += len(a) // end
            end += 1
        lags = np.arange(q, end, dtype=np.int64)
        n = np.maximum(len(a) // lags - 1, 0)
        lag = np.repeat(lags, n)
        at = (np.arange(len(lag)) - np.repeat(np.cumsum(n) - n, n)) * lag
        hit = np.flatnonzero((total[at + lag] - total[at]) * power[lag] == total[at + 2 * lag] - total[at + lag])
        lag, at = lag[hit], at[hit]
        fresh = ~found.inside(at, at + 2 * lag)
        new: list[Run] = []  # found among these lags
        starts: list[int] = []
        reach: list[int] = []
        for x, p in zip(at[fresh].tolist(), lag[fresh].tolist()):
            k = bisect_right(starts, x) - 1
            if k >= 0 and reach[k] >= x + 2 * p:
                continue
            lo = x + 1 - _equal_from(a, x, x + p, -1) if a[x] == a[x + p] else x
            hi = x + _equal_from(a, x, x + p, 1) + p
            if hi - lo >= max(min_words, min_periods * p) and lo <= x:
                new.append((lo, hi - lo, p))
                known = sorted((s, s + m) for s, m, _ in new)
                starts, reach = [s for s, _ in known], np.maximum.accumulate([e for _, e in known]).tolist()
        if new:
            found.runs += new
            found.settle()
        q = end
    return found.runs


def runs_of(codes: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> dict[int, list[Run]]:
    """Text number to its runs by start, then period; text i has the words ``codes[offsets[i]:offsets[i + 1]]``."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place, segment = split_segments(codes, text, min_words, min_periods)
    if not len(place):
        return {}
    first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    size = np.diff(np.append(first, len(place)))
    # Segments end to end, a number of its own behind each.
    a = np.full(len(place) + len(first), -1, np.int64)
    a[np.arange(len(place)) + segment] = codes[place]
    gaps = first + size + np.arange(len(first))
    a[gaps] = int(codes.max()) + 1 + np.arange(len(first))
    out: dict[int, list[Run]] = {}
    laid = first + np.arange(len(first))
    for x, n, q in sorted(scan_lags(a, int(size.max()), min_words, min_periods), key=lambda r: (r[0], r[2])):
        k = int(np.searchsorted(laid, x, side="right")) - 1
        i = int(text[place[first[k]]])
        out.setdefault(i, []).append((int(place[first[k]] - offsets[i]) + x - int(laid[k]), n, q))
    return {i: sorted(r, key=lambda r: (r[0], r[2])) for i, r in out.items()}


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of every word, offsets per text, the distinct words) of ``[^\\x20\\x09-\\x0D]+`` in each text."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    offsets = np.asarray(split.offsets).astype(np.int64)
    flat = split.flatten()
    coded = flat.dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) if len(texts) else np.zeros(0, bool)
    blank = (np.diff(offsets) == 1) & np.asarray(pc.equal(pc.binary_length(flat.take(pa.array(np.minimum(offsets[:-1], max(len(flat) - 1, 0))))), 0)) if len(flat) else empty
    if blank.any():  # such a text is split into one empty word
        keep = np.ones(len(codes), bool)
        keep[offsets[:-1][blank]] = False
        codes = codes[keep]
        offsets = offsets - np.concatenate(([0], np.cumsum(blank)))
    return codes, offsets, coded.dictionary


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words are left if of every run the first period alone stays."""
    kept = np.ones(n, bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return kept


_KIND = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, runs, collapsed), one row per row of ``docs``.

    ``runs`` are the text's runs (start, length, period, in words numbered from
    0) by start, then period.  ``collapsed`` is the text's words, one space
    between, without those that a run holds after its first period.  Words are
    ``[^\\x20\\x09-\\x0D]+``; a null, empty or blank text has none, no runs, and
    collapses to nothing.  Runs may overlap; of two periods of one stretch the
    smaller counts.  A very long text is worked on alone, in memory that grows
    with its own length.  Rows that repeat or lack a doc_id are rows like any
    other; an empty table gives an empty result; further columns, whatever
    their names, are ignored.
    """
    if min_periods < 3:
        raise ValueError("a run has at least three periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _slices(b.column(1), slice_bytes):
                texts = pc.fill_null(b.column(1).slice(lo, hi - lo), "").cast(pa.large_string())
                codes, offsets, words = _words(texts)
                runs = runs_of(codes, offsets, min_words, min_periods)
                keep = np.ones(len(codes), bool)
                for i, found in runs.items():
                    keep[offsets[i]:offsets[i + 1]] = kept_words(int(offsets[i + 1] - offsets[i]), found)
                left = np.concatenate(([0], np.cumsum(keep)))[offsets]
                kept = words.take(pa.array(codes[keep]))
                collapsed = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left), kept), pa.scalar(" ", pa.large_string()))
                lists = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(i, [])] for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(lists, pa.list_(_RUN)), collapsed.cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _KIND)


def run_report(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) from ``periodic_runs``.

    The run named is that of the greatest exact length / period (ties: smallest
    start, then period); without a run its four columns are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "length", "period")
        for b in batches:
            best, shas = [], []
            for runs in b.column(1).to_pylist():
                rows = [tuple(r[n] for n in names) for r in runs or []]
                top = max(rows, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if rows else (None, None, None)
                best.append((len(rows), *top, 1000 * top[1] // top[2] if rows else None))
                shas.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()).hexdigest())
            cols = list(zip(*best)) if best else [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols), pa.array(shas, pa.string()), b.column(2)],
                                             ["doc_id", "n_runs", *names, "exponent_milli", "runs_sha256", "collapsed"])

    kind = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string"
    return found.select("doc_id", "runs", "collapsed").mapInArrow(run, kind).withColumn("collapsed_sha256", F.sha2("collapsed", 256)).drop("collapsed")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text in ten made periodic from some word on, by the crc32 of its decimal doc_id.

    With h that crc32, g = h div 10 and n words: if 10 divides h and n > 0, word
    i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    All other texts, those of null ids too, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.expr("transform(sequence(a, n - 1), i -> w[cast(a + (i - a) % p AS int)])")
    planted = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a").cast("int")), tail)
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
