"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Every text is cut into blocks of ``block`` code points.  The distinct blocks
are sorted and numbered: equal blocks get one integer name, different blocks
different names.  Then adjacent names are paired, the distinct pairs are sorted
and numbered in the same way, and so on until each text is one name.  Two
texts with the same number of blocks are equal exactly if their last names
are; no step relies on a hash being free of collisions.

The text is shuffled once, for the distinct blocks (after partial
aggregation, so a block that a third of all rows hold is sent once per task).
Names go back to their places by a 64-bit hash of the block; hashes that two
different blocks share are set apart and joined by the block itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import cut

BLOCK = 4096


def _named(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Distinct rows sorted within their partitions and numbered; names are unique over all partitions."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _first_names(pieces: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, sha, pos, name) for pieces (doc_id, sha, pos, piece)."""
    names = cut(_named(pieces.select("piece").distinct(), ["piece"])
                .select(hash_of(F.col("piece")).alias("h"), "name"))
    shared = names.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    keyed = pieces.withColumn("h", hash_of(F.col("piece")))
    places = keyed.select("doc_id", "sha", "pos", "h")
    if shared.limit(1).count() == 0:
        return places.join(names, "h").select("doc_id", "sha", "pos", "name")
    alone = names.join(shared, "h", "left_anti").select("h", "name")
    plain = places.join(alone, "h").select("doc_id", "sha", "pos", "name")
    # Blocks whose hash another block shares: named anew, joined by the block itself.
    twins = keyed.join(shared, "h", "left_semi").select("doc_id", "sha", "pos", "piece")
    top = names.agg(F.coalesce(F.max("name"), F.lit(0)).alias("m")).first()["m"]
    again = cut(_named(twins.select("piece").distinct(), ["piece"]).select("piece", (F.col("name") + F.lit(top + 1)).alias("name")))
    return plain.unionAll(twins.join(again, "piece").select("doc_id", "sha", "pos", "name"))


def text_identities(rows: DataFrame, block: int = BLOCK, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, sha, rounds, name) for rows (doc_id, sha, body); equal texts, and only they, share (rounds, name)."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("body")), F.lit(block))
    pieces = (rows.select("doc_id", "sha", "body", F.posexplode(starts).alias("pos", "start"))
              .select("doc_id", "sha", "pos", F.substring(F.col("body"), F.col("start"), F.lit(block)).alias("piece")))
    level = cut(_first_names(pieces, hash_of))
    longest = level.agg(F.max("pos").alias("m")).first()["m"] or 0
    done, rounds = None, 0
    while True:
        # Texts of one name are finished; a text of n blocks takes ceil(log2 n) rounds.
        if longest == 0:
            last = level.select("doc_id", "sha", F.lit(rounds).alias("rounds"), "name")
            return last if done is None else done.unionAll(last)
        sizes = level.groupBy("doc_id", "sha").agg(F.max("pos").alias("m"))
        single = sizes.filter("m = 0").select(F.col("doc_id").alias("d"), F.col("sha").alias("s"))
        same = level["doc_id"].eqNullSafe(F.col("d")) & (level["sha"] == F.col("s"))
        ended = level.join(single, same, "left_semi").select("doc_id", "sha", F.lit(rounds).alias("rounds"), "name")
        done = ended if done is None else done.unionAll(ended)
        rest = level.join(single, same, "left_anti")
        half = F.expr("pos div 2").cast("int")
        pairs = cut(rest.groupBy("doc_id", "sha", half.alias("pos"))
                    .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
                         F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r")))
        names = cut(_named(pairs.select("l", "r").distinct(), ["l", "r"]))
        level = cut(pairs.join(names, ["l", "r"]).select("doc_id", "sha", "pos", "name"))
        longest, rounds = longest // 2, rounds + 1


def exact_duplicates(docs: DataFrame, block: int = BLOCK, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal if identical as they are; a null text counts as empty.  Of
    each group the row with the largest doc_id stays.  Rows with a null doc_id
    are below all others; rows that repeat (same doc_id and text) each count in
    ``group_size`` and get the same answer, so all copies of the kept row are
    marked kept.  An empty table gives an empty result; other columns are ignored.
    """
    # Rows that share doc_id and text are one entry of the naming, and come back by the same key.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("body"))
    keyed = keyed.withColumn("sha", F.sha2("body", 256))
    rows = cut(keyed.select("doc_id", "sha"))
    identities = text_identities(keyed, block, hash_of).distinct().withColumnsRenamed({"doc_id": "i", "sha": "s"})
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("sha") == F.col("s"))
    each = cut(rows.join(identities, same).select("doc_id", "sha", "rounds", "name"))
    # Written, so that the join below can split the rows of a large group over several tasks.
    groups = cut(each.groupBy("rounds", "name").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return (each.join(groups, ["rounds", "name"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))
