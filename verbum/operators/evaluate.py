"""Confusion counts, precision / recall / F1, model comparison, text report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbum.functions.text import label_binary
from verbum.operators.linear import weight_array


def confusion_matrix(pred: DataFrame, positive: int = 1, negative: int = 0) -> DataFrame:
    """One row ``(tp, fp, fn, tn)`` from ``(label, prediction)``; zeros on empty input."""
    y, p = F.col("label"), F.col("prediction")
    return pred.agg(
        F.count_if((y == positive) & (p == positive)).alias("tp"),
        F.count_if((y == negative) & (p == positive)).alias("fp"),
        F.count_if((y == positive) & (p == negative)).alias("fn"),
        F.count_if((y == negative) & (p == negative)).alias("tn"))


def confusion_matrix_signed(pred: DataFrame) -> DataFrame:
    return confusion_matrix(pred, positive=1, negative=-1)


def precision_recall(conf: DataFrame) -> DataFrame:
    """Adds ``precision = tp/(tp+fp)`` and ``recall = tp/(tp+fn)``; NULL on a zero denominator."""
    tp = F.col("tp").cast("double")
    return conf.select("*",
                       F.try_divide(tp, (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
                       F.try_divide(tp, (F.col("tp") + F.col("fn")).cast("double")).alias("recall"))


def f1_score(conf: DataFrame) -> DataFrame:
    """Adds precision, recall, ``f1 = 2PR/(P+R)`` and ``f1_pct`` (percent, 2 decimals)."""
    pr = precision_recall(conf)
    p, r = F.col("precision"), F.col("recall")
    f1 = F.try_divide(F.lit(2.0) * p * r, p + r)
    return pr.withColumn("f1", f1).withColumn("f1_pct", F.round(F.col("f1") * F.lit(100.0), 2))


def model_row(metrics: DataFrame, model: str, n_features: int) -> DataFrame:
    return metrics.select(F.lit(model).alias("model"), F.lit(n_features).cast("int").alias("n_features"),
                          "tp", "fp", "fn", "tn", "f1_pct")


def _dot(weights: str) -> Column:
    return F.aggregate("idx", F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get(weights, p), F.lit(0.0)))


def score_models(vectors: DataFrame, models: dict[str, DataFrame], k: int) -> DataFrame:
    """``vectors`` with a column of scores w.x per named weight table, in one pass; rows without positions go."""
    out = vectors.where(F.size("idx") > 0)
    for i, weights in enumerate(models.values()):
        out = out.withColumn(f"_w{i}", weight_array(weights, k))
    for i, name in enumerate(models):
        out = out.withColumn(name, _dot(f"_w{i}"))
    return out.drop(*[f"_w{i}" for i in range(len(models))])


def confusion_of_models(vectors: DataFrame, models: dict[str, tuple[DataFrame, Callable[[Column], Column]]], k: int) -> DataFrame:
    """``(model, tp, fp, fn, tn)``, a row per model, from one scan of ``vectors`` and one aggregate.

    A model is a weight table over the K positions and what decides from the
    score that a document is positive.
    """
    scores = score_models(vectors.select("doc_key", "idx"), {f"_s{i}": w for i, (w, _) in enumerate(models.values())}, k)
    y = label_binary("doc_key") == 1
    counts = []
    for i, (_, positive) in enumerate(models.values()):
        p = positive(F.col(f"_s{i}"))
        counts += [F.count_if(c).alias(f"{kind}{i}") for kind, c in (("tp", y & p), ("fp", ~y & p), ("fn", y & ~p), ("tn", ~y & ~p))]
    rows = [F.struct(F.lit(name).alias("model"), *[F.col(f"{kind}{i}").alias(kind) for kind in ("tp", "fp", "fn", "tn")]) for i, name in enumerate(models)]
    return scores.agg(*counts).select(F.inline(F.array(*rows)))


def model_comparison(rows: list[DataFrame]) -> DataFrame:
    """Bag union of one-row model results."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# Fixed report wording.
F1_LINE = "F1 score for classifier = "
COUNT_LINES = ("Number of True Positives", "Number of False Positives",
               "Number of False Negatives", "Number of True Negatives")


def _metric_lines() -> list:
    f1 = F.when(F.col("f1_pct").isNull(), F.lit("undefined")).otherwise(F.format_string("%.2f", F.col("f1_pct")))
    counts = [F.concat(F.lit(label + " = "), F.col(c).cast("string")) for label, c in zip(COUNT_LINES, ("tp", "fp", "fn", "tn"))]
    return [F.concat(F.lit(F1_LINE), f1, F.lit(" %")), *counts]


def metrics_report(metrics: DataFrame) -> DataFrame:
    """``(ord int, line string)`` rows from one metrics row (about ten lines, bounded)."""
    arr = F.array(*[F.struct(F.lit(i + 1).alias("ord"), ln.alias("line")) for i, ln in enumerate(_metric_lines())])
    return metrics.select(F.inline(arr))


def comparison_report(rows: DataFrame) -> DataFrame:
    """``(ord int, line string)``: a section per row of ``model_row``, by name of the model.

    One row a model, so the ranking window is bounded.
    """
    heading = F.concat(F.col("model"), F.lit(" on "), F.col("n_features").cast("string"), F.lit(" words"))
    parts = [heading, *_metric_lines()]
    first = (F.row_number().over(Window.orderBy("model", "n_features")) - 1) * len(parts)
    arr = F.array(*[F.struct((F.col("_first") + i + 1).alias("ord"), ln.alias("line")) for i, ln in enumerate(parts)])
    return rows.withColumn("_first", first).select(F.inline(arr))
