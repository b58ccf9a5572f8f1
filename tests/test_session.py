"""Bounded broadcast, written tables, explicit partition counts."""

import pytest

from verbum.operators import parse as ps
from verbum.operators import vocab as vc
from verbum.operators.vectors import doc_vectors
from verbum.session import BROADCAST_MAX_ROWS_CONF, materialize
from verbum.sources.corpus import TRAIN, fixture_corpus

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_bound(spark):
    toks = ps.corpus_tokens(fixture_corpus(spark, SF001, TRAIN))
    d = vc.build_dictionary(vc.word_counts(toks), 1000)
    small = doc_vectors(toks, d, 1000)
    assert "BroadcastHashJoin" in _plan(small)
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "10")
    try:
        with pytest.raises(ValueError, match="maxRows"):
            doc_vectors(toks, d, 1000)
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)


def test_written_tables_keep_their_partitions(spark):
    back = materialize(spark.range(1000).repartition(7), "parts")
    try:
        assert "Coalesce" not in _plan(back) and "Exchange" not in _plan(back) and back.count() == 1000
    finally:
        back.unpersist()


def test_scans_are_dealt_out_on_request_only(spark):
    assert "Exchange" not in _plan(fixture_corpus(spark, SF001))
    assert fixture_corpus(spark, SF001, partitions=5).rdd.getNumPartitions() == 5
