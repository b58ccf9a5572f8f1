"""A corpus pipeline of five stages, each calling one operator of ``verbum.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from verbum.llm.common import table
from verbum.llm.lines import drop_repeated_lines
from verbum.llm.mixing import mixed
from verbum.llm.packing import pack
from verbum.llm.quality import keep_good
from verbum.llm.simhash import keep_one
from verbum.session import checkpoint_root, own_tables, remove_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

# A trained network, tokens and a random mix: not for SQL; tests/llm/test_pipeline.py holds each stage's rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``.

    What a stage makes on the way, and the result of the stage before, go once
    its own result is written; the last one's files stay for the reader.
    """
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        with own_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        if before is not None:
            remove_folder(spark, before)
        before = f"{root}/{name}"
        docs = spark.read.parquet(before)
    return docs
