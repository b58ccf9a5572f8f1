"""File-stream scoring equals batch scoring of the same lines."""

from verbum.operators.svm import svm_train
from verbum.operators.vectors import with_signed_label
from verbum.params import FIXTURE_PARAMS as P
from verbum.plans import tasks as tk
from verbum.sources.corpus import TEST, TRAIN, fixture_corpus
from verbum.streaming import read_scored, score_lines, start_scoring

from conftest import SF001


def test_stream_scoring_matches_batch(spark, tmp_path):
    train = fixture_corpus(spark, SF001, TRAIN)
    d = tk.dictionary_of(train, P.k).persist()
    model = svm_train(with_signed_label(tk.vectors_of(train, d, P.k)), P.k, P)
    w = model.weights(spark)
    src = str(tmp_path / "in")
    test_lines = fixture_corpus(spark, SF001, TEST)
    test_lines.write.text(src)
    q = start_scoring(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), d, w, model.intercept, P.k)
    q.awaitTermination(300)
    got = {(r.doc_key, r.prediction, round(r.score, 9)) for r in read_scored(spark, str(tmp_path / "out")).collect()}
    want = {(r.doc_key, r.prediction, round(r.score, 9))
            for r in score_lines(spark.read.text(src), d, w, model.intercept, P.k).collect()}
    assert got == want and len(got) == 39
