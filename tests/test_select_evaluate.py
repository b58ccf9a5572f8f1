"""Coefficient parsing, selection and evaluation (Q17-Q23)."""

import pytest
from pyspark.sql import functions as F

from verbum.operators import evaluate as ev
from verbum.operators import select as sl
from verbum.sources import coefficients as co


def test_split_list_line_keeps_exponent(spark):
    df = spark.createDataFrame([("[0.5, -2.0, -4.54671956047722e-05]",)], "value string")
    got = [(r.pos, r.coef) for r in co.split_list_line(df).orderBy("pos").collect()]
    assert got == [(0, 0.5), (1, -2.0), (2, -4.54671956047722e-05)]


def test_coefficient_report_round_trip(spark, tmp_path):
    w = spark.createDataFrame([(0, 0.25), (1, -1.5e-07), (2, 3.0)], "pos int, weight double")
    d = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, pos int")
    top = sl.top_coefficient_words(w.withColumnRenamed("weight", "coef"), d, 3, 2)
    path = co.write_coefficient_report(co.coefficient_report_lines(w, top, 1.5, 5), str(tmp_path / "rep"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0].startswith("5 words") and lines[1] == "(c, 3.0, 2)" and lines[-1].startswith("[")
    got = [(r.pos, r.coef) for r in co.load_coefficients(spark, path).orderBy("pos").collect()]
    assert got == [(0, 0.25), (1, -1.5e-07), (2, 3.0)]


def test_minmax_equal_values_gives_null(spark):
    c = spark.createDataFrame([(0, 1.0), (1, 1.0)], "pos int, coef double")
    assert [r.p for r in sl.minmax_normalize(c).collect()] == [None, None]


def test_sampling_exact_m_distinct_and_deterministic(spark):
    pos = spark.range(1000).select(F.col("id").cast("int").alias("pos"))
    a = [r.pos for r in sl.sample_features_uniform(pos, 100, 42).collect()]
    b = [r.pos for r in sl.sample_features_uniform(pos, 100, 42).collect()]
    assert len(set(a)) == 100 and sorted(a) == sorted(b)
    coefs = pos.select("pos", F.when(F.col("pos") < 10, F.lit(0.0)).otherwise(F.col("pos").cast("double")).alias("coef"))
    w = [r.pos for r in sl.sample_features_weighted(sl.minmax_normalize(coefs), 100, 42).collect()]
    assert len(set(w)) == 100 and min(w) >= 10  # p = 0 is never drawn
    # heavier positions are drawn more often
    assert sum(1 for p in w if p >= 500) > sum(1 for p in w if p < 500)


@pytest.mark.parametrize("tp,fp,fn,pct", [(374, 0, 3, 99.60), (377, 1, 0, 99.87), (368, 0, 9, 98.79), (0, 0, 0, None)])
def test_known_f1(spark, tp, fp, fn, pct):
    conf = spark.createDataFrame([(tp, fp, fn, 0)], "tp bigint, fp bigint, fn bigint, tn bigint")
    assert ev.f1_score(conf).first().f1_pct == pct


def test_confusion_counts_cover_all_rows(spark):
    pred = spark.createDataFrame([(1, 1), (1, -1), (-1, 1), (-1, -1), (-1, -1)], "label int, prediction int")
    r = ev.confusion_matrix_signed(pred).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 2)
    empty = ev.confusion_matrix(pred.where("false")).first()
    assert (empty.tp, empty.fp, empty.fn, empty.tn) == (0, 0, 0, 0)
    rep = [r.line for r in ev.metrics_report(ev.f1_score(ev.confusion_matrix_signed(pred))).orderBy("ord").collect()]
    assert rep[0] == "F1 score for classifier = 50.00 %" and rep[4] == "Number of True Negatives = 2"


def test_report_sink_single_file(spark, tmp_path):
    import os

    from verbum.sources.report import write_report

    conf = spark.createDataFrame([(374, 0, 3, 18347)], "tp bigint, fp bigint, fn bigint, tn bigint")
    path = write_report(ev.metrics_report(ev.f1_score(conf)), str(tmp_path / "report"))
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1
    lines = open(os.path.join(path, parts[0])).read().splitlines()
    assert lines == ["F1 score for classifier = 99.60 %", "Number of True Positives = 374",
                     "Number of False Positives = 0", "Number of False Negatives = 3",
                     "Number of True Negatives = 18347"]


def test_short_vocabulary_gives_all_its_words(spark):
    """K coefficients, fewer words: exactly min(m, words) positions, none of them without a word."""
    from verbum.params import Params
    from verbum.plans.tasks import reduced_dictionary

    words = spark.createDataFrame([(f"w{i}", i) for i in range(20)], "word string, pos int")
    coefs = spark.range(100).selectExpr("CAST(id AS INT) AS pos", "CAST(id % 7 AS DOUBLE) AS coef")
    for m in (5, 19, 20, 50):
        got = reduced_dictionary(words, coefs, Params(k=100, m=m, seed=1)).collect()
        assert len(got) == min(m, 20) and sorted(r.pos for r in got) == list(range(min(m, 20)))


def test_coefficient_line_refuses_gaps(spark):
    import pytest

    ok = spark.createDataFrame([(1, 2.0), (0, 1.0)], "pos int, weight double")
    assert co.coefficient_list_line(ok).first().value == "[1.0, 2.0]"
    for bad in ([(0, 1.0), (2, 1.0)], [(0, None), (1, 1.0)], [(0, 1.0), (0, 2.0)]):
        with pytest.raises(Exception, match="gap"):
            co.coefficient_list_line(spark.createDataFrame(bad, "pos int, weight double")).collect()


def test_report_lines_stay_in_order_for_any_top_n(spark):
    w = spark.range(150).selectExpr("CAST(id AS INT) AS pos", "CAST(id AS DOUBLE) AS weight")
    top = spark.range(120).selectExpr("CAST(id AS INT) AS rank", "concat('w', id) AS word", "1.0D AS coef", "CAST(id AS INT) AS pos")
    lines = [r.value for r in co.coefficient_report_lines(w, top, 0.5, 120).orderBy("ord").collect()]
    assert [x[:3] for x in lines[1:121]] == [f"(w{i}"[:3] for i in range(120)] and lines[-1].startswith("[0.0, 1.0")
