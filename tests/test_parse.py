"""Corpus-line rules Q1-Q4 and the hand-made inputs of FIXTURES.md section 5."""

from verbum.operators import parse as ps

VALID = '<doc id="AU1" url="http://x/1" title="t">Hello, World! Über-cool text</doc>'


def test_valid_line_requires_both_markers(lines):
    df = lines([VALID, '<doc url="u">no identifier here</doc>', '<doc id="X" title="t">no url</doc>',
                'plain text'])
    out = [r.value for r in ps.valid_doc_lines(df).collect()]
    # the second line contains "id" inside "identifier", so it counts as valid (Q1)
    assert out == [VALID, '<doc url="u">no identifier here</doc>']


def test_extract_id_and_text(lines):
    got = ps.parse_documents(lines([VALID])).collect()
    assert [(r.doc_key, r.body) for r in got] == [("AU1", "Hello, World! Über-cool text")]


def test_missing_markers_drop_the_row(lines):
    # valid (contains id and url=) but no 'id="' -> Python would raise; we drop it
    df = lines(['<doc xid=AU2 url="u">text here</doc>', '<doc id="AU3" url=u>text</doc>',
                '<doc id="AU4" url="u" no close marker'])
    assert ps.parse_documents(df).count() == 0


def test_text_drops_last_six_chars_even_without_closing_tag(lines):
    df = lines(['<doc id="A" url="u">abcdefghij', '<doc id="B" url="u">abc', '<doc id="C" url="u">a">b</doc>'])
    got = {r.doc_key: r.body for r in ps.parse_documents(df).collect()}
    assert got == {"A": "abcd", "B": "", "C": 'a">b'}


def test_tokenize_letters_only_lowercase_no_empties(lines):
    got = ps.corpus_tokens(lines([VALID])).first().words
    # accented letters separate words (Q4)
    assert got == ["hello", "world", "ber", "cool", "text"]


def test_normalize_text_keeps_length(lines):
    got = ps.normalize_text(ps.parse_documents(lines([VALID]))).first().text
    assert got == "hello  world   ber cool text"


def test_explode_and_pairs_keep_duplicates(lines):
    df = lines(['<doc id="A" url="u">a b a</doc>'])
    toks = ps.corpus_tokens(df)
    assert sorted(r.word for r in ps.explode_words(toks).collect()) == ["a", "a", "b"]
    assert ps.word_doc_pairs(toks).count() == 3
