"""The front end builds a line once a row."""

from verbum.operators import parse as ps
from verbum.sources.corpus import documents_as_lines


def test_a_line_is_built_once_a_row(spark):
    docs = spark.createDataFrame([(1, "a\r\nb", "de", "s"), (2, None, "en", "s"), (3, "", None, "s")], "doc_id long, text string, lang string, source string")
    tokens = ps.corpus_tokens(documents_as_lines(docs))
    assert tokens._jdf.queryExecution().executedPlan().toString().count("concat(") == 1
    assert {(r.doc_key, tuple(r.words)) for r in tokens.collect()} == {("AU1", ("a", "b")), ("WK3", ())}
