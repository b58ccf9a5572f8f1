"""Line filtering, document parsing and tokenisation (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.functions.text import ID_CLOSE, ID_OPEN, TEXT_OPEN, doc_id_of, doc_text_of, is_valid_line, normalized, words_of


def valid_doc_lines(lines: DataFrame) -> DataFrame:
    """Keep lines containing both ``id`` and ``url=``."""
    return lines.where(is_valid_line("value"))


def extract_doc_id(lines: DataFrame) -> DataFrame:
    """Valid lines -> ``doc_key``; lines without both id markers are dropped."""
    v = F.col("value")
    return (lines.where(is_valid_line("value") & (F.instr(v, ID_OPEN) > 0) & (F.instr(v, ID_CLOSE) > 0))
            .select(doc_id_of("value").alias("doc_key")))


def has_markers(value="value"):
    """The line carries all three markers the parser needs (cheap ``instr`` tests).

    Filtering on the raw line, not on the parsed columns, keeps the pushed-down
    predicate from re-evaluating the parse expressions.
    """
    v = F.col(value)
    return (F.instr(v, ID_OPEN) > 0) & (F.instr(v, ID_CLOSE) > 0) & (F.instr(v, TEXT_OPEN) > 0)


def parse_documents(lines: DataFrame) -> DataFrame:
    """Valid lines -> ``(doc_key, body)``; a line lacking any marker is dropped."""
    return (lines.where(is_valid_line("value") & has_markers("value"))
            .select(doc_id_of("value").alias("doc_key"), doc_text_of("value").alias("body")))


def normalize_text(docs: DataFrame) -> DataFrame:
    """``(doc_key, body)`` -> ``(doc_key, text)`` with non-letters as spaces, lower-case."""
    return docs.select("doc_key", normalized("body").alias("text"))


def tokenize(docs: DataFrame) -> DataFrame:
    """``(doc_key, body)`` -> ``(doc_key, words array<string>)``."""
    return docs.select("doc_key", words_of("body").alias("words"))


def explode_tokens(words, alias: str = "word"):
    """``explode`` for token arrays without an inferred ``size(words) > 0`` filter.

    Catalyst infers that filter for an inner ``explode`` and pushes it below
    the projection that tokenises, where it would run the tokeniser a second
    time.  ``explode_outer`` infers nothing; its single NULL row for an empty
    array is removed by the caller's ``isNotNull`` filter, so rows are the same.
    """
    return F.explode_outer(words).alias(alias)


def explode_words(tokens: DataFrame) -> DataFrame:
    """All tokens of all documents, duplicates kept: ``(word, one)``."""
    return (tokens.select(explode_tokens("words"), F.lit(1).alias("one"))
            .where(F.col("word").isNotNull()))


def word_doc_pairs(tokens: DataFrame) -> DataFrame:
    """``(doc_key, word)`` per token occurrence, duplicates kept."""
    return tokens.select("doc_key", explode_tokens("words")).where(F.col("word").isNotNull())


def corpus_tokens(lines: DataFrame) -> DataFrame:
    """Lines -> tokens: the shared front end (ops 5-9)."""
    return tokenize(parse_documents(lines))
