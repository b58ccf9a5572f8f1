import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbum.llm import periods

KIND = "doc_id long, text string"


def slow_runs(w):
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s = w[i:j + q]
            if len(s) >= max(24, 3 * q) and not any(s[p:] == s[:-p] for p in range(1, q)):
                out.append((i, len(s), q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(r):
    size, out = r.randint(1, 6), []
    for _ in range(r.randint(0, 4)):
        out += [r.randint(0, size) for _ in range(r.randint(0, 30))]
        period = [r.randint(0, size) for _ in range(r.randint(1, 40))]
        out += (period * 6)[:r.randint(0, 4 * len(period) + 10)]
        if r.random() < 0.3:
            out.append(r.randint(100, 200))
        if r.random() < 0.2:
            out *= r.randint(1, 4)
    return out[:500]


@pytest.mark.parametrize("pairs,direct", [(1 << 20, 16), (1 << 20, 2), (50, 16), (50, 2)])
def test_runs_against_brute_force(monkeypatch, pairs, direct):
    monkeypatch.setattr(periods, "PAIRS", pairs)
    monkeypatch.setattr(periods, "DIRECT", direct)
    r = random.Random(4)
    for _ in range(20):
        texts = [some_words(r) for _ in range(4)]
        got = periods.runs_of(np.array([x for t in texts for x in t], np.int64), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
        for i, w in enumerate(texts):
            assert got.get(i, []) == slow_runs(w), w


def test_splitting_keeps_what_a_run_may_hold():
    a = np.array([0, 1] * 20 + [2] + [3, 4, 5] * 7 + [6, 7] * 4)
    place, segment = periods.split_segments(a, np.zeros(len(a), np.int64))
    # The word 2 is rare; 3 to 7 are left in pieces of 21 words and 8 at first, too short together only with nothing rare between.
    assert place.tolist() == list(range(40)) + list(range(41, 70)) and set(segment.tolist()) == {0, 1}
    assert periods.runs_of(a, np.array([0, len(a)])) == {0: [(0, 40, 2)]}
    nothing = periods.split_segments(np.arange(100), np.zeros(100, np.int64))
    assert len(nothing[0]) == 0 and periods.runs_of(np.zeros(0, np.int64), np.array([0, 0])) == {}


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = slow_runs(w)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_query_against_brute_force(spark):
    r = random.Random(6)
    rows = [(i, " ".join("w%d" % x for x in some_words(r)[:200])) for i in range(150)]
    rows += [(1000 + i, "\t".join(r.choice("abcdefgh") for _ in range(r.randint(0, 90))) + "\n") for i in range(100)]
    rows += [(None, "é ü " * 30), (None, None), (-5, ""), (7, " \t\n"), (7, " \t\n"), (8, "a"), (8, "x " * 24), (8, "x " * 23), (9, "\x85 a\xa0 " * 20)]
    rows += [(i, None) for i in range(2000, 2020)] + [(i, "") for i in range(2020, 2040)]
    docs = spark.createDataFrame(rows, KIND).withColumn("runs", F.lit(1)).withColumn("n", F.lit(2)).withColumn("collapsed", F.lit("x")).repartition(3)
    want = sorted((expected(*row) for row in rows), key=str)
    for size in (periods.SLICE_BYTES, 300):
        got = periods.run_report(periods.periodic_runs(periods.with_planted_runs(docs), slice_bytes=size))
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert periods.run_report(periods.periodic_runs(periods.with_planted_runs(docs.limit(0)))).count() == 0


def test_very_long_texts(spark):
    r = np.random.default_rng(1)
    period = " ".join("w%d" % x for x in r.integers(0, 500, 20_000))
    rows = [(1, "a " * 2_000_000), (2, " ".join(map(str, r.integers(0, 2, 500_000)))), (3, " ".join([period] * 12)), (4, "x" * 5_000_000)]
    got = {x["doc_id"]: x for x in periods.periodic_runs(spark.createDataFrame(rows, KIND)).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 2_000_000, 1)] and got[1]["collapsed"] == "a"
    assert [tuple(x) for x in got[3]["runs"]] == [(0, 240_000, 20_000)] and got[3]["collapsed"] == period
    assert got[4]["runs"] == [] and got[4]["collapsed"] == rows[3][1]
    assert all(n >= max(24, 3 * q) for _, n, q in got[2]["runs"])


def test_too_few_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periods.periodic_runs(spark.createDataFrame([], KIND), 24, 2)
