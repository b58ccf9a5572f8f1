"""Whole pipelines composed from the operators (the reference's three programs).

``task_lr_full``      LR on the full K-word dictionary
``task_svm_full``     linear SVM on the full dictionary
``task_reduced_both`` both models on m of the K words, chosen from a coefficient table
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.operators.evaluate import confusion_matrix, confusion_matrix_signed, confusion_of_models, f1_score, metrics_report
from verbum.operators.logreg import LrFit, lr_fit, lr_score
from verbum.operators.parse import corpus_tokens
from verbum.operators.select import (known_positions, minmax_normalize, sample_features_uniform, sample_features_weighted,
                                     top_coefficient_words)
from verbum.operators.svm import SvmModel, svm_predict, svm_train
from verbum.operators.vectors import doc_vectors, with_binary_label, with_signed_label
from verbum.operators.vocab import build_dictionary, filter_dictionary, reindex_dictionary, word_counts
from verbum.params import Params
from verbum.session import materialize, write_and_read
from verbum.sources.coefficients import coefficient_report_lines, write_coefficient_report


def dictionary_of(train_lines: DataFrame, k: int) -> DataFrame:
    """Top-K dictionary ``(word, pos)`` of a training corpus."""
    return build_dictionary(word_counts(corpus_tokens(train_lines)), k)


def vectors_of(lines: DataFrame, dictionary: DataFrame, k: int, any_size: bool = False) -> DataFrame:
    """Presence vectors ``(doc_key, idx)`` of a corpus against a (training) dictionary; ``any_size`` as in ``doc_vectors``."""
    return doc_vectors(corpus_tokens(lines), dictionary, k, any_size)


def _dictionary_and_tokens(train_lines: DataFrame, k: int, dictionary: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The dictionary, written once (K rows) if there is none, and the training tokens, written if they are read twice."""
    tokens = corpus_tokens(train_lines)
    if dictionary is not None:
        return dictionary, tokens
    tokens = write_and_read(tokens, "train-tokens")
    return materialize(build_dictionary(word_counts(tokens), k), "dictionary"), tokens


@dataclass
class TaskResult:
    metrics: DataFrame          # one row: tp fp fn tn precision recall f1 f1_pct
    predictions: DataFrame      # doc_key label [score|probability] prediction
    report: DataFrame           # (ord, line)
    model: object = None
    dictionary: DataFrame = None  # (word, pos) the features are numbered by


def _result(pred: DataFrame, signed: bool, model=None) -> TaskResult:
    conf = confusion_matrix_signed(pred) if signed else confusion_matrix(pred)
    metrics = f1_score(conf)
    return TaskResult(metrics, pred, metrics_report(metrics), model)


def run_svm(train_vectors: DataFrame, test_vectors: DataFrame, k: int, params: Params, resume: str | None = None) -> TaskResult:
    """``resume`` as in ``svm_train``."""
    spark = train_vectors.sparkSession
    model = svm_train(with_signed_label(train_vectors), k, params, resume=resume)
    pred = svm_predict(with_signed_label(test_vectors), model.weights(spark), model.intercept, k)
    return _result(pred, True, model)


def run_lr(train_vectors: DataFrame, test_vectors: DataFrame, k: int, params: Params,
           written: bool = False) -> TaskResult:
    """``written=True``: ``train_vectors`` is already a written table (trained on as is).

    The fit leaves its weights as a written table; the scores come from that table alone.
    """
    # Spark ML caches its own instance blocks for an uncached input, so the
    # written table is only read once here: written, not cached
    train = with_binary_label(train_vectors) if written else write_and_read(with_binary_label(train_vectors), "lr-train")
    model = lr_fit(train, k, params)
    weights = write_and_read(model.weights(train_vectors.sparkSession), "lr-weights")
    return _result(lr_score(with_binary_label(test_vectors), weights, k), False, model)


def compare_models(test_vectors: DataFrame, lr: LrFit, svm: SvmModel, k: int, n_features: int, suffix: str = "") -> DataFrame:
    """Comparison rows of both models from one scan of the test vectors."""
    spark = test_vectors.sparkSession
    models = {"logistic_regression" + suffix: (lr.weights(spark), lambda s: F.lit(1.0) / (F.lit(1.0) + F.exp(-s)) > F.lit(0.5)),
              "linear_svm" + suffix: (svm.weights(spark), lambda s: s - F.lit(float(svm.intercept)) >= 0)}
    rows = f1_score(confusion_of_models(test_vectors, models, k))
    return rows.select("model", F.lit(n_features).cast("int").alias("n_features"), "tp", "fp", "fn", "tn", "f1_pct")


def task_svm_full(train_lines: DataFrame, test_lines: DataFrame, params: Params = Params(),
                  dictionary: DataFrame | None = None, resume: str | None = None) -> TaskResult:
    """``dictionary``: the written dictionary of the training side, if there is one already; ``resume`` as in ``svm_train``."""
    d, tokens = _dictionary_and_tokens(train_lines, params.k, dictionary)
    r = run_svm(doc_vectors(tokens, d, params.k), vectors_of(test_lines, d, params.k), params.k, params, resume)
    r.dictionary = d
    return r


def task_lr_full(train_lines: DataFrame, test_lines: DataFrame, params: Params = Params(),
                 dictionary: DataFrame | None = None) -> TaskResult:
    """``dictionary`` as in ``task_svm_full``."""
    d, tokens = _dictionary_and_tokens(train_lines, params.k, dictionary)
    r = run_lr(doc_vectors(tokens, d, params.k), vectors_of(test_lines, d, params.k), params.k, params)
    r.dictionary = d
    return r


def write_coefficients(weights: DataFrame, dictionary: DataFrame, cost: float | None, params: Params, path: str) -> str:
    """Write the coefficient report of any ``(pos, weight)`` table: top words, final cost, the list by position.

    This is the file the reduced-dictionary task reads its coefficients from.
    """
    top = top_coefficient_words(weights.withColumnRenamed("weight", "coef"), dictionary, params.k, params.top_n)
    return write_coefficient_report(coefficient_report_lines(weights, top, cost, params.top_n), path)


def write_svm_coefficients(result: TaskResult, params: Params, path: str) -> str:
    """The report of a trained SVM; the cost is that of its last iteration."""
    model: SvmModel = result.model
    cost = model.trace_rows[-1][1] if model.trace_rows else None
    return write_coefficients(model.weights(result.dictionary.sparkSession), result.dictionary, cost, params, path)


def write_lr_coefficients(result: TaskResult, params: Params, path: str) -> str:
    """The report of a fitted logistic regression; the cost is its last log-loss."""
    model: LrFit = result.model
    cost = model.history[-1] if model.history else None
    return write_coefficients(model.weights(result.dictionary.sparkSession), result.dictionary, cost, params, path)


def select_positions(coefs: DataFrame | None, dictionary: DataFrame, params: Params, weighted: bool = True) -> DataFrame:
    """m positions: weighted by min-max normalised coefficients, or uniform.

    A coefficient report holds K values even if the dictionary is shorter; only
    positions that a word has are normalised and drawn, so the result has
    min(m, dictionary size) positions.
    """
    if weighted:
        coefs = known_positions(coefs, dictionary, params.k)
        return sample_features_weighted(minmax_normalize(coefs), params.m, params.seed)
    return sample_features_uniform(dictionary.select("pos"), params.m, params.seed)


def reduced_dictionary(dictionary: DataFrame, coefs: DataFrame | None, params: Params, weighted: bool = True) -> DataFrame:
    """Select m positions, keep those dictionary words, re-number them 0..m-1."""
    sel = select_positions(coefs, dictionary, params, weighted)
    return reindex_dictionary(filter_dictionary(dictionary, sel, params.m))


def task_reduced_both(train_lines: DataFrame, coefs: DataFrame | None, test_lines: DataFrame,
                      params: Params = Params(), weighted: bool = True,
                      dictionary: DataFrame | None = None,
                      tokens: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, TaskResult, TaskResult]:
    """LR and SVM on the reduced dictionary; returns (comparison rows, LR result, SVM result).

    ``tokens``: the written tokens of both sides, if there are already.
    ``comparison_report`` of the rows is the report of both.
    """
    d, train_tokens = _dictionary_and_tokens(train_lines, params.k, dictionary)
    train_tokens, test_tokens = tokens if tokens is not None else (train_tokens, corpus_tokens(test_lines))
    rd = materialize(reduced_dictionary(d, coefs, params, weighted), "reduced-dictionary")
    m = params.m
    # both sides are written once: both models train on / score the same tables
    train_v = materialize(doc_vectors(train_tokens, rd, m), "reduced-train")
    test_v = materialize(doc_vectors(test_tokens, rd, m), "reduced-test")
    try:
        lr = run_lr(train_v, test_v, m, params.with_(lr_max_iter=params.lr_max_iter_reduced), written=True)
        svm = run_svm(train_v, test_v, m, params)
        rows = write_and_read(compare_models(test_v, lr.model, svm.model, m, rd.count()), "reduced-rows")
    finally:
        # the written tables stay readable; only the caches go
        train_v.unpersist()
        test_v.unpersist()
    return rows, lr, svm


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column (cross-engine comparison of floating sums)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            # "+ 0.0" turns a rounded -0.0 into 0.0
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
