"""What a pass of a trainer reads: packed arrays, written feature vectors, tokens that are written once."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from verbum.operators import logreg as lg
from verbum.operators import parse as ps
from verbum.operators import svm

from conftest import SF001


def test_a_pass_adds_up_slices_of_positions(spark, monkeypatch):
    monkeypatch.setattr(svm, "SLICE", 7)
    k = 30
    rows = [(1 if i % 3 else -1, None if i % 11 == 5 else sorted({(i * 7 + j * 5) % k for j in range(i % 9)})) for i in range(120)]
    w, b = np.linspace(-1, 1, k), 0.1
    want, hinge, gb = np.zeros(k), 0.0, 0.0
    for y, idx in rows:
        m = y * (sum(w[i] for i in idx or []) - b)
        hinge += max(0.0, 1 - m)
        if m < 1:
            gb += y
            want[idx or []] -= y
    blocks = svm._arrays(svm.pack_blocks(spark.createDataFrame(rows, "label int, idx array<int>").repartition(5)), k)
    bw = spark.sparkContext.broadcast(w)
    got = svm._iteration_sums(blocks, bw, b, k)
    assert (got[0] == want).all() and abs(got[1] - hinge) < 1e-12 and got[2] == gb
    assert svm._iteration_sums(blocks.filter(lambda _: False), bw, b, k)[0].tolist() == [0.0] * k


def test_features_are_written_vectors(spark):
    v = spark.createDataFrame([("a", 1, [0, 3]), ("a", 0, []), (None, 1, [4, 2, 2, 5, -1])], "doc_key string, label int, idx array<int>")
    f = lg.ml_features(v, 5)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "UDF" not in plan
    got = {(r.doc_key, r.label): (r.features.size, list(r.features.indices), list(r.features.values)) for r in f.collect()}
    assert got == {("a", 1): (5, [0, 3], [1.0, 1.0]), ("a", 0): (5, [], []), (None, 1): (5, [2, 4], [1.0, 1.0])}


def test_each_side_is_tokenised_once(spark, monkeypatch):
    seen, real = [], ps.corpus_tokens
    for name in ("svm_model_comparison", "task_reduced_both_small"):
        seen.clear()
        with monkeypatch.context() as m:
            m.setattr(ps, "corpus_tokens", lambda lines: seen.append(lines) or real(lines))
            m.setattr("verbum.plans.tasks.corpus_tokens", lambda lines: real(lines).where(F.raise_error(F.lit("tokenised again")).isNull()))
            assert E.queries()[name](spark, SF001).count() == 2
        assert len(seen) == 2
