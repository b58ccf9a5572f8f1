"""LR: JVM feature vectors, and the log-loss gradient vanishes at the fit on non-separable labels."""

import numpy as np
from pyspark.sql import functions as F

from verbum.operators import logreg as lg
from verbum.operators.logreg import lr_predict, lr_train, ml_features
from verbum.operators.parse import corpus_tokens
from verbum.operators.vectors import doc_vectors
from verbum.operators.vocab import build_dictionary, word_counts
from verbum.params import Params
from verbum.sources.corpus import fixture_corpus, read_table

from conftest import SF01


def test_ml_features_are_sparse_binary(spark):
    v = spark.createDataFrame([("a", 1, [0, 3])], "doc_key string, label int, idx array<int>")
    f = ml_features(v, 5).first().features
    assert f.size == 5 and list(f.indices) == [0, 3] and list(f.values) == [1.0, 1.0]


def test_lr_gradient_near_zero(spark):
    k = 12
    lines = fixture_corpus(spark, SF01)
    toks = corpus_tokens(lines)
    d = build_dictionary(word_counts(toks), k)
    v = doc_vectors(toks, d, k)
    labels = read_table(spark, SF01, "labels").select(
        F.col("doc_id").cast("string").alias("id"), "quality")
    v = v.withColumn("id", F.regexp_replace("doc_key", "^(AU|WK)", "")).join(labels, "id") \
        .select("doc_key", F.col("quality").alias("label"), "idx")
    model = lr_train(v, k, Params(lr_max_iter=200, lr_tol=1e-10))
    rows = v.collect()
    X = np.zeros((len(rows), k))
    for i, r in enumerate(rows):
        X[i, r.idx] = 1.0
    y = np.array([r.label for r in rows], dtype=float)
    assert 0 < y.sum() < len(y)
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-X @ w))
    grad = X.T @ (p - y) / len(y)
    assert np.abs(grad).max() < 1e-4
    pred = lr_predict(model, v, k).collect()
    assert {r.prediction for r in pred} <= {0, 1}


def _separable(spark):
    rows = [("AU%d" % i if i % 2 else "WK%d" % i, i % 2, sorted({i % 5 + 5 * (i % 2), 10 + i % 3})) for i in range(60)]
    return spark.createDataFrame(rows, "doc_key string, label int, idx array<int>")


def test_certificate_against_numpy(spark):
    v, k = _separable(spark), 14
    fit = lg.lr_fit(v, k, Params())
    rows = v.collect()
    X, y = np.zeros((len(rows), k)), np.array([float(r.label) for r in rows])
    for i, r in enumerate(rows):
        X[i, r.idx] = 1.0
    for w in (fit.w, np.zeros(k), 0.02 * fit.w, -fit.w):
        weights = spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)], "pos int, weight double")
        sums = lg.lr_gradient_sums(v, weights, k)
        s = X @ w
        grad = X.T @ (1 / (1 + np.exp(-s)) - y) / len(y)
        loss = np.logaddexp(0, np.where(y == 1, -s, s)).mean()
        got = {r.pos: r.grad for r in lg.lr_gradient(sums, weights).collect()}
        assert np.abs(np.array([got[i] for i in range(k)]) - grad).max() < 1e-12
        c = lg.lr_certificate(sums, 1e-3).first()
        assert c.n == len(y) and abs(c.loss - loss) < 1e-12 and abs(c.grad_norm - np.linalg.norm(grad)) < 1e-12 and abs(c.grad_max - np.abs(grad).max()) < 1e-12
        # only the fit passes; no model and wrong models do not
        assert (c.stationary and c.learned) == (w is fit.w)
    assert fit.iterations == len(fit.history) - 1 and fit.history[-1] < fit.history[0]
    empty = lg.lr_certificate(lg.lr_gradient_sums(v.limit(0), weights, k), 1e-3).first()
    assert empty.n is None and empty.loss is None


def test_the_model_and_its_weight_table_score_alike(spark):
    v, k = _separable(spark), 14
    fit = lg.lr_fit(v, k, Params())
    a = {r.doc_key: (r.label, r.probability, r.prediction) for r in lr_predict(fit.model, v, k).collect()}
    b = {r.doc_key: (r.label, r.probability, r.prediction) for r in lg.lr_score(v, fit.weights(spark), k).collect()}
    assert a.keys() == b.keys() and all(a[d][0] == b[d][0] and a[d][2] == b[d][2] and abs(a[d][1] - b[d][1]) < 1e-12 for d in a)


def test_models_are_compared_in_one_scan(spark):
    from verbum.operators.evaluate import confusion_matrix, confusion_matrix_signed, confusion_of_models
    from verbum.operators.svm import svm_predict, svm_train
    from verbum.operators.vectors import with_signed_label

    v, k = _separable(spark), 14
    fit, svm = lg.lr_fit(v, k, Params(lr_max_iter=2)), svm_train(with_signed_label(v), k, Params(svm_max_iter=3))
    models = {"lr": (fit.weights(spark), lambda s: F.lit(1.0) / (F.lit(1.0) + F.exp(-s)) > F.lit(0.5)),
              "svm": (svm.weights(spark), lambda s: s - F.lit(float(svm.intercept)) >= 0), "none": (fit.weights(spark), lambda s: F.lit(False))}
    both = confusion_of_models(v, models, k)
    got = {r.model: (r.tp, r.fp, r.fn, r.tn) for r in both.collect()}
    assert got["lr"] == tuple(confusion_matrix(lg.lr_score(v, fit.weights(spark), k)).first())
    assert got["svm"] == tuple(confusion_matrix_signed(svm_predict(with_signed_label(v), svm.weights(spark), svm.intercept, k)).first())
    assert got["none"] == (0, 0, 30, 30)
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter (size(idx") == 1  # the documents are read once
