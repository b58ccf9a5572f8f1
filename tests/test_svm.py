"""SVM trainer against an independent dense NumPy loop (brute force) and FIXTURES.md values."""

import numpy as np
import pytest

from verbum.operators import svm
from verbum.operators.svm import pack_blocks, svm_early_stop, svm_predict, svm_train
from verbum.operators.vectors import with_signed_label
from verbum.params import FIXTURE_PARAMS as P
from verbum.plans import tasks as tk
from verbum.sources.corpus import TEST, TRAIN, fixture_corpus

from conftest import SF001


def dense_reference(X, y, iters, rate, tol, c_div=1e16):
    n = float(len(y))
    c = n / c_div
    w = np.zeros(X.shape[1])
    b = 0.0
    old = float("inf")
    costs = []
    for _ in range(iters):
        m = X @ w - b
        cost = (1.0 / n) * np.maximum(0.0, 1 - y * m).sum() + (1.0 / 2.0 * n * c) * np.linalg.norm(w) ** 2
        act = y * m < 1
        grad = (1.0 / n) * (-(y[act, None] * X[act]).sum(axis=0)) + (2.0 / n * c) * w
        gb = (1.0 / n) * y[act].sum()
        w = w - rate * grad
        b = b - rate * gb
        rate = rate * 1.05 if old > cost else rate * 0.5
        costs.append(cost)
        if old - cost < tol:
            break
        old = cost
    return w, b, costs


@pytest.fixture(scope="module")
def fixture_vectors(spark):
    # the corpus that the values of FIXTURES.md were measured on
    train = fixture_corpus(spark, SF001, TRAIN, missing_url=True)
    test = fixture_corpus(spark, SF001, TEST, missing_url=True)
    d = tk.dictionary_of(train, P.k)
    return (with_signed_label(tk.vectors_of(train, d, P.k)), with_signed_label(tk.vectors_of(test, d, P.k)))


def _dense(rows, k):
    X = np.zeros((len(rows), k))
    for i, r in enumerate(rows):
        X[i, r.idx] = 1.0
    return X, np.array([float(r.label) for r in rows])


def test_matches_dense_reference_and_fixture_costs(spark, fixture_vectors):
    tr, te = fixture_vectors
    model = svm_train(tr, P.k, P)
    X, y = _dense(tr.collect(), P.k)
    w, b, costs = dense_reference(X, y, P.svm_max_iter, P.svm_rate, P.svm_tol)
    assert np.allclose(model.w, w, atol=1e-12) and abs(model.intercept - b) < 1e-12
    got = [r[1] for r in model.trace_rows]
    assert np.allclose(got, costs, atol=1e-12)
    # FIXTURES.md section 4, sf0.001
    assert np.allclose(got, [1, 0.435193, 0.307881, 0.21983, 0.159319], atol=5e-7)
    assert got[0] == 1.0
    pred = svm_predict(te, model.weights(spark), model.intercept, P.k).collect()
    tp = sum(1 for r in pred if r.label == 1 and r.prediction == 1)
    fp = sum(1 for r in pred if r.label == -1 and r.prediction == 1)
    fn = sum(1 for r in pred if r.label == 1 and r.prediction == -1)
    tn = sum(1 for r in pred if r.label == -1 and r.prediction == -1)
    assert (tp, fp, fn, tn) == (10, 0, 0, 29)


def test_first_step_is_rate_times_mean_yx(spark, fixture_vectors):
    tr, _ = fixture_vectors
    model = svm_train(tr, P.k, P.with_(svm_max_iter=1))
    X, y = _dense(tr.collect(), P.k)
    assert np.allclose(model.w, P.svm_rate * (y[:, None] * X).mean(axis=0), atol=1e-15)


def test_model_does_not_depend_on_partitions(spark, fixture_vectors):
    tr, _ = fixture_vectors
    models = [svm_train(tr, P.k, P, blocks=pack_blocks(tr.repartition(n))) for n in (1, 4, 64)]
    for m in models[1:]:
        assert np.allclose(models[0].w, m.w, atol=1e-12) and abs(models[0].intercept - m.intercept) < 1e-12


def test_early_stop(spark, fixture_vectors):
    tr, _ = fixture_vectors
    model = svm_train(tr, P.k, P)
    r = svm_early_stop(model.trace(spark), 0.1).first()
    assert (r.stop_iter, r.converged) == (4, True)
    stopped = svm_train(tr, P.k, P.with_(svm_tol=0.1))
    assert stopped.iterations == 4 and stopped.converged


def test_task_svm_coefficient_report_round_trip(spark, tmp_path):
    """Task 2 writes its model as a coefficient report; task 3's loader reads back the same K weights."""
    from verbum.sources.coefficients import load_coefficients

    tr, te = fixture_corpus(spark, SF001, TRAIN), fixture_corpus(spark, SF001, TEST)
    r = tk.task_svm_full(tr, te, P)
    path = tk.write_svm_coefficients(r, P, str(tmp_path / "coef-report"))
    got = load_coefficients(spark, path).orderBy("pos").toPandas()
    assert list(got["pos"]) == list(range(len(r.model.w)))
    np.testing.assert_allclose(got["coef"].to_numpy(), r.model.w, rtol=1e-12, atol=0)
    text = [x.value for x in spark.read.text(path).collect()]
    assert any(x.startswith("[") for x in text)
    assert sum(1 for x in text if x.startswith("(")) == min(P.top_n, len(r.model.w))


def test_blocks_hold_the_documents_in_order(spark, monkeypatch):
    rows = [(1 if i % 3 else -1, None if i % 11 == 5 else [(i * 7 + j) % 50 for j in range(i % 9)]) for i in range(300)] + [(1, list(range(40)))]
    df = spark.createDataFrame(rows, "label int, idx array<int>").coalesce(1)
    for docs, positions in ((4096, 1 << 20), (7, 1 << 20), (100, 20)):
        kernel = []
        monkeypatch.setattr(svm, "BLOCK_DOCS", docs)
        monkeypatch.setattr(svm, "BLOCK_POSITIONS", positions)
        batches = df.select("label", "idx").toArrow().to_batches(max_chunksize=64)
        # the packer itself, as a task runs it
        monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: kernel.append(f))
        svm.pack_blocks(df)
        monkeypatch.undo()
        monkeypatch.setattr(svm, "BLOCK_DOCS", docs)
        monkeypatch.setattr(svm, "BLOCK_POSITIONS", positions)
        got, sizes = [], []
        for b in kernel[0](iter(batches)):
            for r in b.to_pylist():
                y, n, p = (np.frombuffer(r[c], t) for c, t in (("y", "<i1"), ("sizes", "<i4"), ("positions", "<i4")))
                assert r["n"] == len(y) == len(n) and n.sum() == len(p)
                sizes.append((len(y), len(p)))
                ends = np.cumsum(n)
                got += [(int(a), p[e - m:e].tolist()) for a, m, e in zip(y, n, ends)]
        assert got == [(y, x or []) for y, x in rows]
        assert all(n <= docs and m <= positions + 40 for n, m in sizes)


def test_packed_blocks_are_smaller_than_rows(spark, fixture_vectors):
    from pyspark import StorageLevel

    tr, _ = fixture_vectors
    sizes = []
    for df in (tr.selectExpr("CAST(label AS DOUBLE) AS y", "idx"), pack_blocks(tr)):
        held = df.coalesce(1).persist(StorageLevel.MEMORY_AND_DISK)
        held.count()
        sizes.append(held._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        held.unpersist()
    assert sizes[1] < sizes[0]


class _Lost(Exception):
    pass


def test_a_stopped_training_goes_on_where_it_was(spark, fixture_vectors, tmp_path, monkeypatch):
    tr, _ = fixture_vectors
    p = P.with_(svm_rate=0.01, svm_max_iter=70, svm_tol=1e-9)
    whole = svm_train(tr, P.k, p)
    real, passes = svm._iteration_sums, []

    def dies_at(n):
        def sums(*a):
            if len(passes) == n:
                raise _Lost
            passes.append(1)
            return real(*a)
        return sums

    folder = f"file:{tmp_path}/training"
    monkeypatch.setattr(svm, "_iteration_sums", dies_at(53))
    with pytest.raises(_Lost):
        svm_train(tr, P.k, p, resume=folder, save_every=10)
    assert svm._steps(spark, folder) == [40, 50]
    # a state that was not written to its end does not count
    (tmp_path / "training" / "step-60" / "weights").mkdir(parents=True)
    passes.clear()
    monkeypatch.setattr(svm, "_iteration_sums", dies_at(None))
    again = svm_train(tr, P.k, p, resume=folder, save_every=10)
    assert len(passes) == whole.iterations - 50
    assert again.iterations == whole.iterations and np.abs(again.w - whole.w).max() <= 1e-12
    assert np.abs(np.array(again.trace_rows, float) - np.array(whole.trace_rows, float)).max() <= 1e-12
    # a finished training is read back; another training's state is refused
    passes.clear()
    done = svm_train(tr, P.k, p, resume=folder)
    assert not passes and done.trace_rows == again.trace_rows and (done.w == again.w).all()
    with pytest.raises(ValueError, match="another training"):
        svm_train(tr, P.k, p.with_(svm_rate=0.02), resume=folder)


def test_a_converged_training_stays_so(spark, fixture_vectors, tmp_path):
    tr, _ = fixture_vectors
    folder = f"file:{tmp_path}/training"
    first = svm_train(tr, P.k, P.with_(svm_tol=0.1), resume=folder)
    second = svm_train(tr, P.k, P.with_(svm_tol=0.1), resume=folder)
    assert first.converged and second.converged and first.trace_rows == second.trace_rows
