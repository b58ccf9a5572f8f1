"""Documents as sparse vectors over the dictionary, labels, labelled points.

Vectors are never dense: a document is the set (or bag) of its dictionary
positions.  Bags are counted where the row lies and cross the network as sparse
vectors, one per document and batch, that are added up where they meet; sets are
combined before they are collected.  Either way a document's group is bounded by
K positions a task, however long its text and however often its id repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.functions.text import label_binary, label_signed
from verbum.operators.parse import explode_tokens
from verbum.session import bounded_broadcast, broadcast_max_rows, check_bound

# Tasks that the rows of one rare word are dealt over in a join beyond the broadcast bound.
TAIL_SALTS = 16


def dictionary_join(pairs: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """Inner equi-join of ``(doc_key, word)`` pairs with the K-row dictionary.

    Up to ``verbum.broadcast.maxRows`` words the dictionary is broadcast and no
    pair is shuffled.  A larger one is cut by rank: its most frequent words, so
    many, are broadcast; pairs with other words are shuffled to the rest of the
    dictionary by word and a salt of the document, so that a word frequent on
    this side alone (one outside the dictionary, say) is dealt over
    ``TAIL_SALTS`` tasks.  The rows are the same.
    """
    words = dictionary.select("word", "pos")
    most = broadcast_max_rows(dictionary.sparkSession)
    if k <= most:
        return pairs.join(bounded_broadcast(words, k), "word", "inner")
    # positions are ranks by frequency, so the first are the heavy hitters
    both = pairs.join(bounded_broadcast(words.where(F.col("pos") < most), most), "word", "left")
    hot = both.where(F.col("pos").isNotNull())
    tail = words.where(F.col("pos") >= most).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(TAIL_SALTS - 1))))
    others = (both.where(F.col("pos").isNull()).drop("pos")
              .withColumn("_salt", F.pmod(F.xxhash64("doc_key", F.monotonically_increasing_id()), F.lit(TAIL_SALTS)).cast("int")))
    rare = others.join(tail.hint("shuffle_hash"), ["word", "_salt"], "inner").drop("_salt")
    return hot.unionByName(rare)


def doc_positions(joined: DataFrame) -> DataFrame:
    """Drop the word: ``(doc_key, pos)``."""
    return joined.select("doc_key", "pos")


_BAG = "doc_key string, idx array<int>, cnt array<long>"


def _bag_rows(keys: list, ends: np.ndarray, idx: np.ndarray, cnt: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (idx.astype(np.int32), cnt.astype(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *lists], ["doc_key", "idx", "cnt"])


def _add_up(group: np.ndarray, n: int, idx: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, idx, cnt) of n groups: the positions of each, ascending, with their counts summed."""
    wide = int(idx.max()) + 1 if len(idx) else 1
    key, back = np.unique(group.astype(np.int64) * wide + idx, return_inverse=True)
    total = np.bincount(back, weights=cnt, minlength=len(key)).astype(np.int64)
    return np.searchsorted(key, np.arange(1, n + 1) * wide), key % wide, total


def _count_words(vocabulary):
    """(doc_key, words) to a bag per document of the batch; words outside the vocabulary go, documents without any too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in batches:
            words = b.column(1)
            pos = pc.index_in(words.flatten(), value_set=known)
            has = pc.is_valid(pos).to_numpy(zero_copy_only=False)
            keys = b.column(0).dictionary_encode(null_encoding="encode")
            size = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
            group = np.repeat(keys.indices.to_numpy(), size)[has]
            ends, idx, cnt = _add_up(group, len(keys.dictionary), pos.drop_null().to_numpy(), np.ones(len(group)))
            full = np.diff(np.concatenate(([0], ends))) > 0
            yield _bag_rows([x for x, f in zip(keys.dictionary.to_pylist(), full) if f], ends[full], idx, cnt)

    return run


# Entries of one document that wait to be added up; a bag has K at most.
_WAITING = 1 << 20


def _merge_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams bags sorted by doc_key and adds up those of one document."""
    key, parts, held = None, [], 0

    def summed():
        idx, cnt = (np.concatenate(x) for x in zip(*parts))
        ends, idx, cnt = _add_up(np.zeros(len(idx), np.int64), 1, idx, cnt)
        return idx, cnt

    def rows(done):
        ends = np.cumsum([len(i) for _, i, _ in done]) if done else np.zeros(0)
        join = (lambda x: np.concatenate(x) if x else np.zeros(0))
        return _bag_rows([d[0] for d in done], ends, join([d[1] for d in done]), join([d[2] for d in done]))

    for b in batches:
        done = []
        for doc_key, idx, cnt in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            if parts and doc_key != key:
                done.append((key, *summed()))
                parts, held = [], 0
            key = doc_key
            parts.append((idx.values.to_numpy(), cnt.values.to_numpy()))
            held += len(parts[-1][0])
            if held > _WAITING:
                parts = [summed()]
                held = len(parts[0][0])
        yield rows(done)
    if parts:
        yield rows([(key, *summed())])


def word_bags(tokens: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """Tokens -> ``(doc_key, idx, cnt)``: all dictionary positions of a document with multiplicity.

    ``idx`` is ascending and ``cnt[i]`` is how often ``idx[i]`` occurs.  Words
    are counted in the row against the K words (a broadcast value, ``check_bound``);
    the bags of one document id, one per batch at most, meet in one exchange by
    ``doc_key`` and are added up as they stream by.  No (document, word) pair is
    ever a row.
    """
    spark = tokens.sparkSession
    check_bound(spark, k)
    t = dictionary.select("word", "pos").toArrow().sort_by("pos")  # K rows
    pos, words = t.column("pos").to_numpy(), t.column("word").combine_chunks()
    if len(pos) and (pos != np.arange(len(pos))).any():
        raise ValueError("dictionary positions must run from 0 without a gap")
    known = spark.sparkContext.broadcast(pa.concat_arrays(words.chunks) if isinstance(words, pa.ChunkedArray) else words)
    bags = tokens.select("doc_key", "words").mapInArrow(_count_words(known), _BAG)
    return bags.repartition("doc_key").sortWithinPartitions("doc_key").mapInArrow(_merge_bags, _BAG)


def doc_position_lists(tokens: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """All positions per document with multiplicity: ``word_bags``."""
    return word_bags(tokens, dictionary, k)


def tf_vectors(bags: DataFrame) -> DataFrame:
    """``(doc_key, pos, tf)`` from ``word_bags``: count over the document's in-dictionary token count, in the row."""
    total = F.aggregate("cnt", F.lit(0).cast("long"), lambda a, n: a + n)
    return (bags.withColumn("_total", total)
            .select("doc_key", "_total", F.inline(F.arrays_zip("idx", "cnt")))
            .select("doc_key", F.col("idx").alias("pos"), (F.col("cnt") / F.col("_total")).alias("tf")))


def binary_vectors(positions: DataFrame) -> DataFrame:
    """``(doc_key, idx array<int>)``: ascending distinct positions (presence vector).

    One shuffle by ``doc_key``: a task collects the distinct positions of a
    document before it sends them, so a document id that a third of all rows
    hold ships at most K positions per task.
    """
    return positions.groupBy("doc_key").agg(F.array_sort(F.collect_set("pos")).alias("idx"))


def doc_vectors(tokens: DataFrame, dictionary: DataFrame, k: int, any_size: bool = False) -> DataFrame:
    """Tokens -> presence vectors.

    Presence does not need repeats, so each document's tokens are
    de-duplicated in the row before exploding.  A K above the broadcast bound
    is refused; ``any_size`` takes it, by the join that shuffles rare words.
    """
    if not any_size:
        check_bound(tokens.sparkSession, k)
    pairs = (tokens.select("doc_key", explode_tokens(F.array_distinct("words")))
             .where(F.col("word").isNotNull()))
    return binary_vectors(doc_positions(dictionary_join(pairs, dictionary, k)))


def with_binary_label(vectors: DataFrame) -> DataFrame:
    return vectors.select("doc_key", label_binary("doc_key").alias("label"), "idx")


def with_signed_label(vectors: DataFrame) -> DataFrame:
    return vectors.select("doc_key", label_signed("doc_key").alias("label"), "idx")


def labeled_points(vectors: DataFrame, signed: bool = False) -> DataFrame:
    """``(doc_key, label, idx)``; labels {0,1} for LR, {-1,+1} for the SVM."""
    return with_signed_label(vectors) if signed else with_binary_label(vectors)


def training_row_count(vectors: DataFrame) -> DataFrame:
    return vectors.agg(F.count(F.lit(1)).alias("n"))
