"""What the operators share: reading a table, cutting lineage, words of a text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbum.session import checkpointed

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; a lost executor re-reads files.

    The files go at the end of the caller's ``own_tables``, if there is one.
    """
    return checkpointed(df)


SPREAD = 16


def spread_join(rows: DataFrame, one: DataFrame, key: str, by: str, spread: int = SPREAD) -> DataFrame:
    """``rows`` joined with ``one``, which has a row per ``key``; rows of one key are dealt over ``spread`` tasks by ``by``.

    ``one`` is sent ``spread`` times, so it should be narrow.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(spread)).cast("int"))
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


_held: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """What a worker process remembers between tasks; it holds one operator's at a time, as workers serve many."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 ``data`` in order, one list per about ``size`` bytes."""
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        if end < len(data):
            m = _SPACE.search(data, end)
            end = m.start() if m else len(data)
        yield data[at:end].split()
        at = end
