"""Linear-model building blocks as DataFrame operators.

A model is a weight table ``(pos int, weight double)`` with one row per
dictionary position (at most K rows) plus a scalar intercept.  Documents are
``(doc_key, label, idx array<int>)`` with binary features, so ``w.x`` is the
sum of the weights at the document's positions.

Scalars that depend on data (n, min, max, sums) enter expressions as scalar
subqueries, never as driver-collected values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbum.session import broadcast_max_rows, check_bound, write_and_read


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def zero_weights(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("pos", F.lit(0.0).alias("weight"))


def row_count(vectors: DataFrame) -> Column:
    """n as a scalar subquery (double)."""
    return vectors.select(F.count(F.lit(1)).cast("double")).scalar()


def reg_constant(n: Column, c_divisor: float) -> Column:
    """C = n / divisor."""
    return n / F.lit(float(c_divisor))


def weight_array(weights: DataFrame, k: int) -> Column:
    """The weights in order of position as one array (at most K doubles), a scalar subquery.

    Positions must run from 0 without a gap and weights must not be null;
    otherwise the query fails.
    """
    check_bound(weights.sparkSession, k)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "weight"))), lambda s: s["weight"].cast("double"))
    whole = ((F.count("weight") == F.count(F.lit(1))) & (F.count_distinct("pos") == F.count(F.lit(1)))
             & (F.coalesce(F.max("pos") + 1, F.lit(0)) == F.count(F.lit(1))))
    return weights.agg(F.when(whole, ordered).otherwise(F.raise_error(F.lit("weights have a gap"))).alias("w")).scalar()


# The most weights that one array holds; more are joined.
WEIGHT_ARRAY_MAX = 1 << 18
# Of those, the weights of the most frequent positions that an array still holds.
WEIGHT_ARRAY_HEAD = 1 << 16


def _scored_by_join(vectors: DataFrame, weights: DataFrame, most: int) -> DataFrame:
    """``scored`` for any K: weights of positions below ``most`` as an array in the row, the others joined by position.

    Positions are ranks by frequency, so few of a document's are joined.  The
    rows are written once, numbered, and their sums come back by number.
    """
    held = write_and_read(vectors.where(F.size("idx") > 0).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = weights.where(F.col("pos") >= most)
    whole = ((F.count("weight") == F.count(F.lit(1))) & (F.count_distinct("pos") == F.count(F.lit(1)))
             & (F.coalesce(F.max("pos") + 1 - most, F.lit(0)) == F.count(F.lit(1))))
    checked = rare.agg(F.when(whole, F.lit(0.0)).otherwise(F.raise_error(F.lit("weights have a gap"))).alias("w")).scalar()
    terms = held.select("_row", F.explode(F.filter("idx", lambda p: p >= most)).alias("pos"))
    sums = terms.join(rare, "pos").groupBy("_row").agg(F.sum("weight").alias("_rare"))
    v = held.join(sums, "_row", "left").withColumn("_w", weight_array(weights.where(F.col("pos") < most), most))
    score = F.aggregate("idx", F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get("_w", p), F.lit(0.0)))
    return v.withColumn("score", score + F.coalesce("_rare", F.lit(0.0)) + checked).drop("_w", "_row", "_rare")


def scored(vectors: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``vectors`` with ``score`` = w.x; documents without positions are left out.

    Evaluated row by row against the array of weights: no explode, no shuffle.
    Beyond ``WEIGHT_ARRAY_MAX`` weights (or the broadcast bound) rare ones are joined.
    """
    bound = broadcast_max_rows(vectors.sparkSession)
    if k > min(bound, WEIGHT_ARRAY_MAX):
        return _scored_by_join(vectors, weights, min(bound, WEIGHT_ARRAY_HEAD))
    v = vectors.where(F.size("idx") > 0).withColumn("_w", weight_array(weights, k))
    score = F.aggregate("idx", F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get("_w", p), F.lit(0.0)))
    return v.withColumn("score", score).drop("_w")


def dot_product(vectors: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``(doc_key, label, score)`` with score = w.x; no shuffle of the documents."""
    return scored(vectors, weights, k).select("doc_key", "label", "score")


def weight_norm_margin(weights: DataFrame) -> DataFrame:
    """``(norm, margin)``: the L2 norm of w and 2 / norm (NULL when w = 0)."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    return weights.agg(norm.alias("norm")).select(
        "norm", F.try_divide(F.lit(2.0), F.col("norm")).alias("margin"))


def margins(vectors: DataFrame, weights: DataFrame, intercept, k: int) -> DataFrame:
    """``(doc_key, label, idx, score, margin)`` with margin = w.x - b."""
    s = scored(vectors, weights, k)
    return s.select("doc_key", "label", "idx", "score", (F.col("score") - _lit(intercept)).alias("margin"))


def _active() -> Column:
    """A document is active when y(w.x - b) < 1."""
    return F.col("label") * F.col("margin") < F.lit(1.0)


def hinge_cost(vectors: DataFrame, weights: DataFrame, intercept, k: int,
               c_divisor: float = 1e16) -> DataFrame:
    """``cost = (1/n) * sum(max(0, 1 - y(w.x - b))) + (1/2 * n * C) * ||w||^2``."""
    n = row_count(vectors)
    c = reg_constant(n, c_divisor)
    m = margins(vectors, weights, intercept, k)
    hinge = m.agg(F.sum(F.greatest(F.lit(0.0), F.lit(1.0) - F.col("label") * F.col("margin"))).alias("h"))
    wsq = weights.select(F.pow(F.sqrt(F.sum(F.col("weight") * F.col("weight"))), 2.0)).scalar()
    return hinge.select(
        ((F.lit(1.0) / n) * F.coalesce(F.col("h"), F.lit(0.0))
         + (F.lit(1.0) / F.lit(2.0) * n * c) * wsq).alias("cost"))


def hinge_gradient(vectors: DataFrame, weights: DataFrame, intercept, k: int,
                   c_divisor: float = 1e16) -> DataFrame:
    """``(pos, grad)``: ``(1/n) * sum over active docs of -y x  +  (2/n * C) * w``.

    A document is active when ``y(w.x - b) < 1``.  The positions of the active
    rows are exploded once and summed by a partial + final aggregate keyed by
    position (K keys): one shuffle of the data.
    """
    n = row_count(vectors)
    c = reg_constant(n, c_divisor)
    m = margins(vectors, weights, intercept, k).where(_active())
    s = m.select(F.explode("idx").alias("pos"), (-F.col("label")).alias("g")).groupBy("pos").agg(F.sum("g").alias("s"))
    return (weights.join(s, "pos", "left")
            .select("pos", ((F.lit(1.0) / n) * F.coalesce(F.col("s").cast("double"), F.lit(0.0))
                            + (F.lit(2.0) / n * c) * F.col("weight")).alias("grad")))


def intercept_gradient(vectors: DataFrame, weights: DataFrame, intercept, k: int) -> DataFrame:
    """``(1/n) * sum of y over active documents``."""
    n = row_count(vectors)
    m = margins(vectors, weights, intercept, k)
    s = m.agg(F.sum(F.when(_active(), F.col("label")).otherwise(F.lit(0))).cast("double").alias("s"))
    return s.select(((F.lit(1.0) / n) * F.coalesce(F.col("s"), F.lit(0.0))).alias("intercept_grad"))


def svm_step(weights: DataFrame, grad: DataFrame, intercept, intercept_grad: DataFrame,
             rate: float) -> DataFrame:
    """One update: ``w -= rate * grad``, ``b -= rate * gradb`` -> ``(pos, weight, intercept)``."""
    gb = intercept_grad.select("intercept_grad").scalar()
    return (weights.join(grad, "pos", "inner")
            .select("pos",
                    (F.col("weight") - F.lit(float(rate)) * F.col("grad")).alias("weight"),
                    (_lit(intercept) - F.lit(float(rate)) * gb).alias("intercept")))


def svm_first_step(vectors: DataFrame, dictionary: DataFrame, k: int, rate: float,
                   c_divisor: float = 1e16) -> DataFrame:
    """The model after one step from zero weights and zero intercept."""
    w0 = zero_weights(dictionary)
    g = hinge_gradient(vectors, w0, 0.0, k, c_divisor)
    gb = intercept_gradient(vectors, w0, 0.0, k)
    return svm_step(w0, g, 0.0, gb, rate)
