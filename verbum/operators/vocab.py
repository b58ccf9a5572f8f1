"""Word counts, top-K vocabulary, dictionary positions, reduced dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.operators.parse import explode_tokens
from verbum.session import bounded_broadcast, ranked


def word_counts(tokens: DataFrame) -> DataFrame:
    """``(word, n)``: partial (map-side) + final hash aggregate on word.

    Hot words are combined inside each task before the shuffle, so a word
    holding a large share of all tokens ships one row per task.
    """
    return (tokens.select(explode_tokens("words")).where(F.col("word").isNotNull())
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def _rank_order():
    # fixed tie-break at the cut: count descending, then word ascending
    return [F.col("n").desc(), F.col("word").asc()]


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The K most frequent words (``TakeOrderedAndProject``, K rows)."""
    return counts.orderBy(*_rank_order()).limit(k)


def build_dictionary(counts: DataFrame, k: int) -> DataFrame:
    """``(word, pos int)``, positions ``0..K'-1`` in rank order, K' = min(K, vocabulary).

    The counts are dealt to ranges of the rank order and numbered range by
    range (``ranked``), so neither K nor the vocabulary meets in one task.
    """
    return ranked(counts, _rank_order(), "pos", k).select("word", "pos")


def filter_dictionary(dictionary: DataFrame, selected: DataFrame, m: int) -> DataFrame:
    """Keep dictionary rows whose position is selected (left-semi join, m-row side)."""
    return dictionary.join(bounded_broadcast(selected.select("pos"), m), "pos", "left_semi")


def reindex_dictionary(dictionary: DataFrame) -> DataFrame:
    """Dense re-numbering ``0..m-1`` in ascending order of the old position, range by range."""
    return ranked(dictionary.select("word", F.col("pos").alias("_old")), [F.col("_old")], "pos").select("word", "pos")
