
from pyspark.sql import functions as F

from verbum.operators import parse as ps
from verbum.operators import vectors as vx
from verbum.operators import vocab as vc
from verbum.plans import tasks as tk
from verbum.sources.corpus import TRAIN, fixture_corpus

from conftest import SF001

DOCS = ['<doc id="AU1" url="u">b a a c</doc>', '<doc id="WK2" url="u">c c d</doc>',
        '<doc id="au3" url="u">zz yy</doc>', '<doc id="AU1" url="u">e a</doc>']


def test_top_words_tie_break_and_small_vocabulary(lines):
    toks = ps.corpus_tokens(lines(DOCS))
    d = vc.build_dictionary(vc.word_counts(toks), 100)
    got = [(r.word, r.pos) for r in d.orderBy("pos").collect()]
    # counts: a3 c3 b1 d1 e1 yy1 zz1 -> order n desc, word asc; K' = vocabulary size (Q5, Q6)
    assert got == [("a", 0), ("c", 1), ("b", 2), ("d", 3), ("e", 4), ("yy", 5), ("zz", 6)]


def test_vectors_tf_and_binary(lines):
    toks = ps.corpus_tokens(lines(DOCS))
    d = vc.build_dictionary(vc.word_counts(toks), 3)  # a c b
    pos = vx.doc_positions(vx.dictionary_join(ps.word_doc_pairs(toks), d, 3))
    tf = {(r.doc_key, r.pos): r.tf for r in vx.tf_vectors(vx.word_bags(toks, d, 3)).collect()}
    # duplicate id AU1 merges; TF divides by in-dictionary tokens only (Q7); au3 has none (Q8)
    assert tf == {("AU1", 0): 0.6, ("AU1", 1): 0.2, ("AU1", 2): 0.2, ("WK2", 1): 1.0}
    bv = {r.doc_key: r.idx for r in vx.binary_vectors(pos).collect()}
    assert bv == {"AU1": [0, 1, 2], "WK2": [1]}
    lists = {r.doc_key: (r.idx, r.cnt) for r in vx.doc_position_lists(toks, d, 3).collect()}
    assert lists == {"AU1": ([0, 1, 2], [3, 1, 1]), "WK2": ([1], [2])}
    fast = {r.doc_key: r.idx for r in vx.doc_vectors(toks, d, 3).collect()}
    assert fast == bv


def test_labels_are_case_sensitive(lines):
    v = vx.doc_vectors(ps.corpus_tokens(lines(DOCS)), vc.build_dictionary(
        vc.word_counts(ps.corpus_tokens(lines(DOCS))), 10), 10)
    b = {r.doc_key: r.label for r in vx.with_binary_label(v).collect()}
    s = {r.doc_key: r.label for r in vx.with_signed_label(v).collect()}
    assert b == {"AU1": 1, "WK2": 0, "au3": 0}
    assert s == {"AU1": 1, "WK2": -1, "au3": -1}


def test_reindex_dictionary_keeps_position_order(spark):
    d = spark.createDataFrame([("x", 7), ("y", 2), ("z", 30)], "word string, pos int")
    got = [(r.word, r.pos) for r in vc.reindex_dictionary(d).orderBy("pos").collect()]
    assert got == [("y", 0), ("x", 1), ("z", 2)]


def test_fixture_properties(spark):
    train = fixture_corpus(spark, SF001, TRAIN, missing_url=True)
    d = tk.dictionary_of(train, 1000)
    pos = vx.doc_positions(vx.dictionary_join(ps.word_doc_pairs(ps.corpus_tokens(train)), d, 1000))
    tf = vx.tf_vectors(vx.word_bags(ps.corpus_tokens(train), d, 1000))
    sums = tf.groupBy("doc_key").agg(F.sum("tf").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)
    v = vx.binary_vectors(pos).collect()
    assert len(v) == 156  # FIXTURES.md: 156 training documents at sf0.001
    for r in v:
        assert all(a < b for a, b in zip(r.idx, r.idx[1:])) and r.idx[-1] < 1000
