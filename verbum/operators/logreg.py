"""Logistic regression: Spark ML L-BFGS trainer, table-driven scoring, and a certificate of the fit.

Fit and score are apart: ``lr_fit`` leaves a weight table, and everything
downstream (scores, classes, the certificate) reads that table alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from verbum.operators.linear import dot_product, scored
from verbum.params import Params
from verbum.session import write_and_read


def ml_features(vectors: DataFrame, k: int, out: str = "features") -> DataFrame:
    """Add a K-wide sparse 0/1 ``features`` vector built from ``idx`` on the JVM; positions outside 0..K-1 are left out.

    The vectors are written as the struct that a vector column is stored as and
    read back as vectors: no position passes through a string or a hash table,
    and each pass of the trainer reads the files.
    """
    inside = F.array_sort(F.array_distinct(F.filter("idx", lambda i: (i >= 0) & (i < k))))
    as_stored = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(k).alias("size"), F.col("_inside").alias("indices"),
                         F.array_repeat(F.lit(1.0), F.size("_inside")).alias("values"))
    table = write_and_read(vectors.withColumn("_inside", inside).withColumn(out, as_stored).drop("_inside"), "features",
                           StructType([*vectors.schema.fields, StructField(out, VectorUDT())]))
    return table


def lr_train(vectors: DataFrame, k: int, params: Params = Params()) -> LogisticRegressionModel:
    """Binary LR on ``(doc_key, label in {0,1}, idx)``: no regularisation, no intercept.

    Same settings as the reference's L-BFGS call: regParam 0, fitIntercept
    false, tolerance 1e-6, feature scaling on, iteration cap as given.
    """
    data = ml_features(vectors, k).select(F.col("label").cast("double").alias("label"), "features")
    lr = LogisticRegression(maxIter=params.lr_max_iter, regParam=0.0, elasticNetParam=0.0,
                            fitIntercept=False, tol=params.lr_tol, standardization=True,
                            family="binomial", threshold=0.5)
    return lr.fit(data)


def lr_predict(model: LogisticRegressionModel, vectors: DataFrame, k: int) -> DataFrame:
    """``(doc_key, label, probability, prediction int)`` from the fitted model."""
    out = model.transform(ml_features(vectors, k))
    from pyspark.ml.functions import vector_to_array
    return out.select("doc_key", "label",
                      vector_to_array("probability")[1].alias("probability"),
                      F.col("prediction").cast("int").alias("prediction"))


def lr_weights(model: LogisticRegressionModel, spark) -> DataFrame:
    """The fitted coefficients as a ``(pos, weight)`` table (K rows)."""
    return _weight_table(model.coefficients.toArray(), spark)


def _weight_table(w: np.ndarray, spark) -> DataFrame:
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame({"pos": np.arange(len(w), dtype=np.int32), "weight": w}),
                                 "pos int, weight double")


def lr_score(vectors: DataFrame, weights: DataFrame, k: int, threshold: float = 0.5) -> DataFrame:
    """Logistic scoring from a weight table: ``p = 1 / (1 + e^(-w.x))``, class 1 when ``p > threshold``."""
    s = dot_product(vectors, weights, k)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")))
    return (s.select("doc_key", "label", p.alias("probability"))
            .withColumn("prediction", F.when(F.col("probability") > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))))


@dataclass
class LrFit:
    w: np.ndarray             # K coefficients
    history: list[float]      # mean log-loss at the start and after each iteration
    model: LogisticRegressionModel

    @property
    def iterations(self) -> int:
        return max(0, len(self.history) - 1)

    def weights(self, spark) -> DataFrame:
        """``(pos, weight)``: K rows built from the driver's copy."""
        return _weight_table(self.w, spark)


def lr_fit(vectors: DataFrame, k: int, params: Params = Params()) -> LrFit:
    """``lr_train`` with its loss history; ``weights`` is the table that scoring and the certificate read."""
    model = lr_train(vectors, k, params)
    history = [float(x) for x in model.summary.objectiveHistory] if model.hasSummary else []
    return LrFit(model.coefficients.toArray(), history, model)


# Sentinel positions of the two scalars that travel with the gradient.
LOSS_POS, ROWS_POS = -1, -2


def lr_gradient_sums(vectors: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``(pos, g)``: X'(p - y) per position, and the summed log-loss and the row count at two sentinel positions.

    One pass over ``(doc_key, label in {0,1}, idx)``: each row is scored against
    the weight array where it lies, its positions leave with p - y, and partial
    sums meet by position (K + 2 keys).
    """
    rows = scored(vectors, weights, k)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")))
    # ln(1 + e^-m) with m = score for label 1 and -score for label 0
    m = F.when(F.col("label") == 1, F.col("score")).otherwise(-F.col("score"))
    loss = F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))
    rows = rows.select("idx", (p - F.col("label")).alias("r"), loss.alias("loss"))
    scalars = F.array(F.struct(F.lit(LOSS_POS).alias("pos"), F.col("loss").alias("g")), F.struct(F.lit(ROWS_POS).alias("pos"), F.lit(1.0).alias("g")))
    terms = F.concat(F.transform("idx", lambda i: F.struct(i.alias("pos"), F.col("r").alias("g"))), scalars)
    return rows.select(F.inline(terms)).groupBy("pos").agg(F.sum("g").alias("g"))


def lr_gradient(sums: DataFrame, weights: DataFrame) -> DataFrame:
    """``(pos, weight, grad)``: per row of the training set, the gradient of the mean log-loss, from ``lr_gradient_sums``."""
    n = sums.where(F.col("pos") == ROWS_POS).select("g").scalar()
    return (weights.join(sums, "pos", "left")
            .select("pos", "weight", F.coalesce(F.try_divide(F.col("g"), n), F.lit(0.0)).alias("grad")))


def lr_certificate(sums: DataFrame, grad_bound: float) -> DataFrame:
    """One row ``(n, loss, grad_norm, grad_max, stationary, learned)`` from ``lr_gradient_sums``.

    ``loss`` is the mean log-loss, ``grad_norm`` and ``grad_max`` are the L2 norm
    and the largest entry of its gradient.  ``stationary``: the norm is at most
    ``grad_bound``; ``learned``: the loss is below ln 2, that of no model.  A
    training set without rows has nulls.
    """
    at = lambda pos: F.max(F.when(F.col("pos") == pos, F.col("g")))
    own = F.when(F.col("pos") >= 0, F.col("g"))
    t = sums.agg(at(ROWS_POS).alias("n"), at(LOSS_POS).alias("loss"), F.coalesce(F.sum(own * own), F.lit(0.0)).alias("sq"),
                 F.coalesce(F.max(F.abs(own)), F.lit(0.0)).alias("top"))
    out = t.select(F.col("n").cast("long").alias("n"), (F.col("loss") / F.col("n")).alias("loss"),
                   (F.sqrt("sq") / F.col("n")).alias("grad_norm"), (F.col("top") / F.col("n")).alias("grad_max"))
    return out.select("*", (F.col("grad_norm") <= F.lit(float(grad_bound))).alias("stationary"),
                      (F.col("loss") < F.log(F.lit(2.0))).alias("learned"))
