import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
import corpus_pipeline
from verbum.llm import queries

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    want, got = con.execute(queries.ORACLE_SQL[name]).df(), queries.QUERIES[name](spark, SF001).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    want, got = (x[cols].sort_values(cols).reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_all_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(os.path.join(SF001, "documents.parquet"))
    first, columns = {r["doc_id"] for r in docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} <= first
        if name != "packing":
            assert docs.columns == columns
    assert sum(r["length"] for r in docs.collect()) > 0
    empty = spark.read.parquet(os.path.join(SF001, "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0
