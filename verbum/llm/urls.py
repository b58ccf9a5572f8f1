"""URL filter by host-suffix and path-prefix expressions.

Each distinct (host, path) is expanded into host suffixes of as many labels as
rules' hosts have, times the path prefixes of the lengths that rules have;
expressions meet rules by an equi-join on a short hash prefix, and the full
digest confirms.  The longest rule that fits decides.  So a url has at most
(labels of the longest rule host) x (lengths of rule paths) expressions, however
long it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
OTHERWISE = "allow"
PREFIX_BYTES = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url) -> tuple:
    """Columns host and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.when(F.substring(F.substring(rest, F.length(host) + 1, F.lit(1)), 1, 1) == "/", path).otherwise(F.lit(""))


def _digest(x):
    return F.sha2(x, 256)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, otherwise: str = OTHERWISE) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    A rule is a host, a path that starts with ``/``, and a verdict; it fits its
    host and all its subdomains where the url's path starts with the rule's.
    The longest rule wins, then the longer host; of one rule with both verdicts
    block wins.  Without a rule the verdict is ``otherwise`` and ``rule`` is
    null; a null url, or one without ``://``, has an empty host and path and no
    rule.  A very long host or path costs time in proportion to its length.
    Rows that repeat or lack a page_id are rows like any other; an empty
    table gives an empty result; further columns are ignored.
    """
    spark = pages.sparkSession
    # The rules are an argument, so their number is that of the caller's list.
    given = spark.createDataFrame([(r, v) for r, v in rules], "rule string, verdict string")
    listed = (given.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # "block" sorts after "allow"
              .withColumn("digest", _digest(F.col("rule"))).withColumn("short", F.substring("digest", 1, 2 * PREFIX_BYTES)))
    if not rules:
        host, path = host_and_path(F.col("url"))
        return pages.select("page_id", host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    lengths = sorted({len(r) - r.index("/") for r, _ in rules})
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    distinct = rows.filter("host != ''").select("host", "path").distinct()
    depths = sorted({r[:r.index("/")].count(".") + 1 for r, _ in rules})
    n_labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    suffixes = F.array(*[F.when(n_labels >= d, F.substring_index("host", ".", -d)) for d in depths])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    parts = (distinct.withColumn("suffix", F.explode(suffixes)).filter("suffix IS NOT NULL")
             .withColumn("prefix", F.explode(prefixes)).filter("prefix IS NOT NULL")
             .withColumn("full", _digest(F.concat("suffix", "prefix")))
             .withColumn("short", F.substring("full", 1, 2 * PREFIX_BYTES)))
    found = parts.join(listed, "short").filter("full = digest")
    best = (found.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), F.length("suffix").alias("m"), "rule", "verdict")).alias("best"))
            .select(F.col("host").alias("h"), F.col("path").alias("p"), "best.rule", "best.verdict"))
    return (rows.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")))
