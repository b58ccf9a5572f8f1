"""Dictionaries beyond the broadcast bound: the same rows as within it."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from verbum.operators import linear as lin
from verbum.operators.select import known_positions
from verbum.session import BROADCAST_MAX_ROWS_CONF

LETTERS = "abcdefghij"


def _word(i):
    return "w" + "".join(LETTERS[int(c)] for c in str(i))


def test_a_vocabulary_beyond_the_bound_gives_the_same_dictionary(spark, tmp_path):
    """12,560 words, of which 12,000 are drawn, with a bound of 12,000."""
    text = [" ".join(_word((doc * 157 + j) % 12560) for j in range(320)) for doc in range(100)]
    rows = {"doc_id": pa.array(range(100), pa.int64()), "text": text, "lang": ["de" if i % 3 else "en" for i in range(100)], "source": ["s"] * 100}
    pq.write_table(pa.table(rows), tmp_path / "documents.parquet")
    query = E.queries()["reduced_dictionary_short_vocabulary"]
    want = sorted(map(tuple, query(spark, str(tmp_path)).collect()))
    assert len(want) == 12000 and [p for _, p in sorted(want, key=lambda r: r[1])] == list(range(12000))
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "12000")
    try:
        assert sorted(map(tuple, query(spark, str(tmp_path)).collect())) == want
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)


def test_scores_beyond_the_bound(spark):
    rows = [("d%d" % (i % 7), 1, sorted({(i * j) % 40 for j in range(i % 6)})) for i in range(60)] + [(None, -1, [0, 39]), ("n", 1, None)]
    vectors = spark.createDataFrame(rows, "doc_key string, label int, idx array<int>").repartition(3)
    weights = spark.createDataFrame([(i, i * 0.25 - 3) for i in range(40)], "pos int, weight double")
    read = lambda k: sorted(((r.doc_key, r.label, r.idx, r.score) for r in lin.scored(vectors, weights, k).collect()), key=str)
    coefs = weights.selectExpr("pos", "weight AS coef")
    known = weights.where("pos % 3 = 0")
    want, want_known = read(40), sorted(known_positions(coefs, known, 40).collect())
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "10")
    try:
        assert read(40) == want and sorted(known_positions(coefs, known, 40).collect()) == want_known
        for bad in (weights.where("pos <> 30"), weights.where("pos <> 3")):
            with pytest.raises(Exception, match="gap"):
                lin.scored(vectors, bad, 40).collect()
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)
