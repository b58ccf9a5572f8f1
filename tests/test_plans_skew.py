"""Plan shapes the design relies on, and a hot document key checked by brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbum.operators import parse as ps
from verbum.operators import vocab as vc
from verbum.operators.linear import dot_product, hinge_gradient
from verbum.operators.logreg import lr_score
from verbum.operators.svm import svm_predict
from verbum.operators.vectors import binary_vectors, dictionary_join, doc_position_lists, doc_vectors, tf_vectors, word_bags
from verbum.session import write_and_read
from verbum.sources.corpus import TRAIN, fixture_corpus

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_words_plan_partial_agg_then_take_ordered(spark):
    d = vc.top_words(vc.word_counts(ps.corpus_tokens(fixture_corpus(spark, SF001, TRAIN))), 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(d)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_count" in plan
    assert "TakeOrderedAndProject" in plan


def _exchanges(df):
    """Shuffles of the main plan; those of subqueries (K-row weight tables) and broadcasts are left out."""
    found, inside = [], None
    for line in _plan(df).splitlines():
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        if inside is not None and depth > inside:
            continue
        inside = depth if name.startswith("Subquery") else None
        if name.startswith("Exchange"):
            found.append(name.split("(")[0])
    return found


def _model(spark):
    vec = spark.createDataFrame([("a", 1, [0, 2]), ("b", -1, [1]), ("c", 1, [])], "doc_key string, label int, idx array<int>")
    return vec, spark.createDataFrame([(2, 2.0), (0, 0.5), (1, -1.0)], "pos int, weight double")


def test_scoring_shuffles_no_documents(spark):
    vec, w = _model(spark)
    s = dot_product(vec, w, 3)
    assert {r.doc_key: r.score for r in s.collect()} == {"a": 2.5, "b": -1.0}
    for df in (s, svm_predict(vec, w, 0.0, 3), lr_score(vec, w, 3)):
        assert _exchanges(df) == []


def test_scoring_refuses_weights_with_a_gap(spark):
    vec, w = _model(spark)
    for bad in (w.where("pos <> 1"), w.withColumn("weight", F.when(F.col("pos") > 0, F.col("weight")))):
        with pytest.raises(Exception, match="gap"):
            dot_product(vec, bad, 3).collect()


def test_gradient_shuffles_positions_once(spark):
    vec, w = _model(spark)
    g = hinge_gradient(vec, w, 0.0, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _exchanges(hinge_gradient(vec, w, 0.0, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one of the K weights and one of the data, both by position
    assert plan == ["Exchange hashpartitioning"] * 2
    assert {r.pos: round(r.grad, 12) for r in g.collect()} == {0: 0.0, 1: 0.0, 2: 0.0}
    zero = w.withColumn("weight", F.lit(0.0))
    assert {r.pos: r.grad for r in hinge_gradient(vec, zero, 0.0, 3).collect()} == {0: -1 / 3, 1: 1 / 3, 2: -1 / 3}


def test_presence_vectors_shuffle_once(spark):
    toks = ps.corpus_tokens(fixture_corpus(spark, SF001, TRAIN))
    d = write_and_read(vc.build_dictionary(vc.word_counts(toks), 1000), "dictionary")
    assert _exchanges(doc_vectors(toks, d, 1000)) == ["Exchange hashpartitioning"]


def test_hot_document_key_matches_brute_force(spark):
    """One doc_key holds a third of all rows; vectors stay whole and K-bounded."""
    k = 50
    rows = []
    for i in range(3000):
        rows.append(("hot", (i * 7) % k))
    for i in range(6000):
        rows.append((f"d{i % 300}", (i * 13) % k))
    pos = spark.createDataFrame(rows, "doc_key string, pos int").repartition(8)

    by_doc = defaultdict(Counter)
    for d, p in rows:
        by_doc[d][p] += 1

    got_bin = {r.doc_key: list(r.idx) for r in binary_vectors(pos).collect()}
    assert got_bin == {d: sorted(c) for d, c in by_doc.items()}
    assert max(len(v) for v in got_bin.values()) <= k

    # the same as words, several rows a document id
    d = spark.createDataFrame([("w%d" % i, i) for i in range(k)], "word string, pos int")
    words = [(doc, ["w%d" % p, "unknown"]) for doc, p in rows] + [("none", ["unknown"]), ("none", []), ("none", None), (None, ["w1"])]
    toks = spark.createDataFrame(words, "doc_key string, words array<string>").repartition(8)
    by_doc[None][1] += 1
    bags = word_bags(toks, d, k)
    assert _exchanges(bags).count("Exchange hashpartitioning") == 1 and "Generate" not in _plan(bags)  # the other is the test's own
    got_lists = {r.doc_key: (list(r.idx), list(r.cnt)) for r in doc_position_lists(toks, d, k).collect()}
    assert got_lists == {d: (sorted(c), [c[p] for p in sorted(c)]) for d, c in by_doc.items()}

    got_tf = {(r.doc_key, r.pos): r.tf for r in tf_vectors(bags).collect()}
    want_tf = {(d, p): n / sum(c.values()) for d, c in by_doc.items() for p, n in c.items()}
    assert got_tf.keys() == want_tf.keys()
    assert all(abs(got_tf[x] - want_tf[x]) < 1e-15 for x in want_tf)
    assert word_bags(toks.limit(0), d, k).count() == 0 and word_bags(toks, d.limit(0), k).count() == 0


def test_bags_are_added_up_beyond_the_waiting_bound(spark, monkeypatch):
    from verbum.operators import vectors as vx

    monkeypatch.setattr(vx, "_WAITING", 3)
    batches = [vx._bag_rows(["a", "a", "b"], np.array([2, 4, 5]), np.array([0, 5, 1, 5, 2]), np.array([1, 2, 3, 4, 5])), vx._bag_rows(["b"], np.array([3]), np.array([0, 1, 2]), np.array([1, 1, 1]))]
    got = [r for b in vx._merge_bags(iter(batches)) for r in b.to_pylist()]
    assert got == [{"doc_key": "a", "idx": [0, 1, 5], "cnt": [1, 3, 6]}, {"doc_key": "b", "idx": [0, 1, 2], "cnt": [1, 1, 6]}]


def test_join_beyond_the_broadcast_bound_gives_the_same_rows(spark):
    """Hot words are broadcast, the rest meets salted; a word of a third of all rows that the dictionary lacks is spread."""
    k = 60
    d = spark.createDataFrame([("w%d" % i, i) for i in range(k)], "word string, pos int")
    pairs = [("d%d" % (i % 50), "w%d" % ((i * i) % 90)) for i in range(3000)] + [("d%d" % (i % 50), "w40") for i in range(1500)] + [(None, "w1"), ("d1", None)]
    df = spark.createDataFrame(pairs, "doc_key string, word string").repartition(4)
    want = sorted(((x, w, int(w[1:])) for x, w in pairs if w and int(w[1:]) < k), key=str)
    assert sorted(((r.doc_key, r.word, r.pos) for r in dictionary_join(df, d, k).collect()), key=str) == want
    spark.conf.set("verbum.broadcast.maxRows", "10")
    try:
        split = dictionary_join(df, d, k)
        assert _exchanges(split).count("Exchange hashpartitioning") == 2  # pairs with rare words, and these words
        assert sorted(((r.doc_key, r.word, r.pos) for r in split.collect()), key=str) == want
    finally:
        spark.conf.unset("verbum.broadcast.maxRows")


def test_ranks_meet_in_no_single_task(spark):
    counts = spark.createDataFrame([("w%03d" % i, 7 if i % 3 else i) for i in range(500)], "word string, n long").repartition(6)
    want = [w for w, _ in sorted(((r.word, r.n) for r in counts.collect()), key=lambda x: (-x[1], x[0]))]
    d = vc.build_dictionary(counts, 300)
    assert {r.word: r.pos for r in d.collect()} == {w: i for i, w in enumerate(want[:300])}
    part = vc.filter_dictionary(d, d.where("pos % 3 = 1").select("pos"), 100)
    again = vc.reindex_dictionary(part)
    assert {r.word: r.pos for r in again.collect()} == {w: i for i, w in enumerate(want[1:300:3])}
    for df in (d, again):
        assert "SinglePartition" not in _plan(df) and "Window" not in _plan(df)
    assert vc.build_dictionary(counts.limit(0), 5).count() == 0
