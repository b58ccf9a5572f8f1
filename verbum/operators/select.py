"""Feature selection from a coefficient table ``(pos, coef)``.

All selections are deterministic: random draws come from a seeded md5 of the
position, so the same positions are chosen on any cluster and in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbum.functions.text import seeded_uniform
from verbum.session import bounded_broadcast, broadcast_max_rows


def coefficient_min_max(coefs: DataFrame) -> DataFrame:
    return coefs.agg(F.max("coef").alias("max_coef"), F.min("coef").alias("min_coef"))


def minmax_normalize(coefs: DataFrame) -> DataFrame:
    """``(pos, coef, p)`` with ``p = (coef - min) / (max - min)``, NULL when max = min."""
    mm = coefficient_min_max(coefs)
    mx = mm.select("max_coef").scalar()
    mn = mm.select("min_coef").scalar()
    return coefs.select("pos", "coef", F.try_divide(F.col("coef") - mn, mx - mn).alias("p"))


def known_positions(coefs: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """The coefficients whose position a dictionary word has; a dictionary beyond the broadcast bound is shuffled."""
    known = dictionary.select("pos")
    if k <= broadcast_max_rows(dictionary.sparkSession):
        known = bounded_broadcast(known, k)
    return coefs.join(known, "pos", "left_semi")


def sample_features_uniform(positions: DataFrame, m: int, seed: int) -> DataFrame:
    """m of the positions without replacement, uniformly: the m smallest seeded keys."""
    u = seeded_uniform(seed, F.col("pos"))
    return (positions.select("pos", u.alias("u")).orderBy("u", "pos").limit(m)
            .select(F.col("pos").cast("int").alias("pos")))


def sample_features_weighted(normalized: DataFrame, m: int, seed: int) -> DataFrame:
    """m positions without replacement with probability proportional to ``p``.

    Efraimidis-Spirakis: key = -ln(u) / p, keep the m smallest keys; this has
    the distribution of m successive weighted draws.  Positions with p = 0 (or
    NULL) are taken, uniformly, only when fewer than m others are there.
    """
    u = seeded_uniform(seed, F.col("pos"))
    key = F.when(F.col("p") > 0, -F.log(u) / F.col("p"))
    return (normalized.select("pos", key.alias("key"), u.alias("u"))
            .orderBy(F.asc_nulls_last("key"), "u", "pos").limit(m).select(F.col("pos").cast("int").alias("pos")))


def select_top_features(coefs: DataFrame, n: int = 5) -> DataFrame:
    """The n positions with the largest coefficients (ties: lower position first)."""
    return coefs.orderBy(F.col("coef").desc(), F.col("pos").asc()).limit(n).select("pos", "coef")


def top_coefficient_words(coefs: DataFrame, dictionary: DataFrame, k: int, n: int = 5) -> DataFrame:
    """``(rank, word, coef, pos)`` for the n largest coefficients."""
    top = select_top_features(known_positions(coefs, dictionary, k), n)
    j = top.join(bounded_broadcast(dictionary.select("word", "pos"), k), "pos", "inner")
    w = Window.orderBy(F.col("coef").desc(), F.col("pos").asc())
    return j.select((F.row_number().over(w) - 1).cast("int").alias("rank"), "word", "coef", "pos")
