"""Corpus sources.

``scan_corpus`` reads a real line-per-document text corpus (local, HDFS, s3a,
gs paths — whatever the cluster's Hadoop file systems support).

``documents_as_lines`` turns the driver's ``documents`` table into the same
line format (FIXTURES.md section 4), so that every operator downstream is the
one a user of a text corpus runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN = "train"
TEST = "test"
ALL = "all"

# Fixed values of the fixture adapter (FIXTURES.md section 4):
#   key prefix "AU" for lang = 'de', else "WK";
#   with missing_url, lines of doc_id % 50 = 7 carry no url= attribute;
#   doc_id % 5 = 0 is the held-out test side, the rest is training.
POSITIVE_LANG = "de"
NO_URL_MOD, NO_URL_REM = 50, 7
TEST_MOD, TEST_REM = 5, 0


def scan_corpus(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """One row per text line: ``value string``.

    Splits follow ``spark.sql.files.maxPartitionBytes``; ``partitions`` deals
    the lines out anew, for a small input in too few splits.
    """
    lines = spark.read.text(path)
    return lines if partitions is None else lines.repartition(partitions)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_as_lines(documents: DataFrame, side: str = ALL, missing_url: bool = False) -> DataFrame:
    """``documents(doc_id, text, lang, source)`` -> corpus lines ``value string``.

    ``missing_url`` leaves the attribute out of some lines, for queries on the line filter itself.
    """
    doc_id = F.col("doc_id")
    if side == TRAIN:
        documents = documents.where(doc_id % TEST_MOD != TEST_REM)
    elif side == TEST:
        documents = documents.where(doc_id % TEST_MOD == TEST_REM)
    elif side != ALL:
        raise ValueError(f"unknown corpus side {side!r}")
    key = F.concat(F.when(F.col("lang") == POSITIVE_LANG, F.lit("AU")).otherwise(F.lit("WK")),
                   doc_id.cast("string"))
    # each CR and each LF becomes one space
    body = F.replace(F.replace(F.col("text"), F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    url = F.concat(F.lit(' url="http://'), F.col("source"), F.lit("/"), doc_id.cast("string"), F.lit('"'))
    if missing_url:
        url = F.when(doc_id % NO_URL_MOD == NO_URL_REM, F.lit("")).otherwise(url)
    value = F.concat(F.lit('<doc id="'), key, F.lit('"'), url, F.lit(' title="t">'), body, F.lit("</doc>"))
    # the array keeps Catalyst from writing the line's expression into every
    # marker filter and column of the parser, where it would be built anew
    return documents.select(F.explode(F.array(value)).alias("value"))


def fixture_corpus(spark: SparkSession, sf_dir: str, side: str = ALL, partitions: int | None = None, missing_url: bool = False) -> DataFrame:
    """Corpus lines built from ``{sf_dir}/documents.parquet``; ``partitions`` as in ``scan_corpus``."""
    documents = read_table(spark, sf_dir, "documents")
    return documents_as_lines(documents if partitions is None else documents.repartition(partitions), side, missing_url)


def range_source(spark: SparkSession, k: int, limit_col=None) -> DataFrame:
    """Positions ``0 .. k-1`` as a distributed set (``pos bigint``).

    ``limit_col`` (a scalar-subquery column) optionally trims the range to a
    size that Spark computes from the data, e.g. the vocabulary size.
    """
    r = spark.range(k).withColumnRenamed("id", "pos")
    if limit_col is not None:
        r = r.where(F.col("pos") < limit_col)
    return r
