"""Coefficient report files: write one from a weight table, read one back.

File layout (FIXTURES.md section 1): a heading, the top words as
``(word, coef, pos)`` lines, a blank line, the final cost, a blank line, a
heading, then the coefficient list ``[c0, c1, ...]`` on one line.  The reader
does not rely on line numbers: it takes the line that starts with ``[``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COST_LABEL = "cost after the last step:"
LIST_HEADING = "all coefficients by position:"


def split_list_line(lines: DataFrame, col: str = "value") -> DataFrame:
    """``[a, b, ...]`` lines -> ``(pos int, coef double)`` rows.

    Only the brackets are stripped, so a last number written with an
    exponent (``...e-05]``) keeps all its digits.
    """
    stripped = F.regexp_replace(F.trim(F.col(col)), r"[\[\]]", "")
    return (lines.select(F.posexplode(F.split(stripped, ",")).alias("pos", "tok"))
            .select(F.col("pos").cast("int").alias("pos"),
                    F.trim(F.col("tok")).cast("double").alias("coef")))


def coefficient_list_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.where(F.trim(F.col(col)).startswith("["))


def load_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """Read a coefficient report and return ``(pos, coef)``."""
    return split_list_line(coefficient_list_lines(spark.read.text(path)))


def coefficient_list_line(weights: DataFrame, pos: str = "pos", value: str = "weight") -> DataFrame:
    """One row ``value = '[w0, w1, ...]'`` ordered by position.

    The weight table holds one row per dictionary position (at most K rows),
    so the single line is bounded by the dictionary size.  Positions must run
    from 0 without a gap and weights must not be null, as the reader counts
    places; otherwise the query fails.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))
    items = F.transform(ordered, lambda s: s["v"].cast("string"))
    whole = (F.count(value) == F.count(F.lit(1))) & (F.count_distinct(pos) == F.count(F.lit(1))) & (F.coalesce(F.max(pos) + 1, F.lit(0)) == F.count(F.lit(1)))
    line = F.concat(F.lit("["), F.concat_ws(", ", items), F.lit("]"))
    return weights.agg(F.when(whole, line).otherwise(F.raise_error(F.lit("coefficients have a gap"))).alias("value"))


def coefficient_report_lines(weights: DataFrame, top_words: DataFrame, final_cost: float | None, top_n: int) -> DataFrame:
    """Report rows ``(ord int, value string)``: heading, top words, cost, list.

    ``top_words`` is ``(rank, word, coef, pos)`` with at most ``top_n`` rows.
    """
    spark = weights.sparkSession
    tw = top_words.select(
        (F.col("rank") + F.lit(1)).cast("int").alias("ord"),
        F.format_string("(%s, %s, %d)", F.col("word"), F.col("coef").cast("string"), F.col("pos")).alias("value"))
    fixed = spark.createDataFrame(
        [(0, f"{top_n} words of the largest coefficients:"), (top_n + 1, ""), (top_n + 2, f"{COST_LABEL} {final_cost}"), (top_n + 3, ""), (top_n + 4, LIST_HEADING)],
        "ord int, value string")
    lst = coefficient_list_line(weights).select(F.lit(top_n + 5).alias("ord"), "value")
    return fixed.unionByName(tw).unionByName(lst)


def write_coefficient_report(report: DataFrame, path: str) -> str:
    """Write the report as one text file (bounded: K values on one line)."""
    report.coalesce(1).sortWithinPartitions("ord").select("value").write.mode("overwrite").text(path)
    return path
