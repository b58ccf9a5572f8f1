"""Session helpers: builder, reliable checkpoint folder, bounded broadcast, written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Largest number of rows a parameter (K, m) may give a table that is broadcast.
# A larger K or m is refused: the token stream is never shuffled for a dictionary.
BROADCAST_MAX_ROWS_CONF = "verbum.broadcast.maxRows"
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000


def build_session(master: str | None = None, app: str = "verbum",
                  shuffle_partitions: int | None = None) -> SparkSession:
    master = master or os.environ.get("VERBUM_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system);
    only a local-mode session (tests, bench) gets a private folder here.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="verbum-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder for written tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broadcast_max_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_MAX_ROWS_CONF, str(DEFAULT_BROADCAST_MAX_ROWS)))


def check_bound(spark: SparkSession, row_bound: int) -> None:
    """Raises ``ValueError`` if the parameter (K, m) is above ``verbum.broadcast.maxRows``."""
    most = broadcast_max_rows(spark)
    if row_bound > most:
        raise ValueError(f"a dictionary of {row_bound} rows exceeds {BROADCAST_MAX_ROWS_CONF} = {most}")


def bounded_broadcast(df: DataFrame, row_bound: int) -> DataFrame:
    """``df`` marked for broadcast; ``row_bound`` is the parameter (K, m) that bounds its rows (``check_bound``)."""
    check_bound(df.sparkSession, row_bound)
    return F.broadcast(df)


def ranked(df: DataFrame, order: list[Column], name: str, first: int | None = None) -> DataFrame:
    """``df`` with ``name`` (int), the place 0, 1, ... of each row by ``order``; ``first``: only so many rows.

    Rows are dealt to ranges of the order and counted; a row a partition reaches
    the driver, from which follows how many rows lie before each range.  No rank
    is computed over all rows in one task.  The order must be total.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    held = write_and_read(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # The upper bits of monotonically_increasing_id number the partition, the lower ones the row in it.
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, total = [], 0
    for r in held.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():  # a row a partition
        before.append((r["_part"], total))
        total += r["n"]
    offsets = F.create_map(*[F.lit(x) for pair in before for x in pair]) if before else F.create_map(F.lit(0), F.lit(0))
    at = (F.element_at(offsets, F.col("_part")) + place).cast("int")
    out = held.select(*df.columns, at.alias(name))
    return out if first is None else out.where(F.col(name) < first)


_owned: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("verbum_owned_tables", default=None)


def write_and_read(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return a DataFrame reading it (as ``schema``, if given).

    Cuts the lineage: every later pass (and every re-run after a lost
    executor) reads the written files instead of recomputing the input.
    The table stays until the enclosing ``own_tables`` ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    table = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    owned = _owned.get()
    if owned is not None:
        owned.append((path, table))
    return table


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint under ``spark.checkpoint.dir``; rows keep their partition and order.

    Its files stay until the enclosing ``own_tables`` ends.
    """
    checkpoint_root(df.sparkSession)
    out = df.checkpoint(eager=True)
    owned = _owned.get()
    if owned is not None:
        file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            owned.append((file.get(), out))
    return out


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``write_and_read``, ``materialize`` and ``checkpointed`` make inside it, and their caches.

    What is to last must be written elsewhere before the end.
    """
    outer = _owned.set([])
    try:
        yield
    finally:
        made = _owned.get() or []
        _owned.reset(outer)
        for path, table in made:
            table.unpersist()
            remove_folder(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``write_and_read`` plus a MEMORY_AND_DISK cache, for inputs read many times.

    The table is read back in splits of ``spark.sql.files.maxPartitionBytes``,
    so its partitions are sized by bytes, whatever the cluster.
    """
    from pyspark import StorageLevel

    return write_and_read(df, name).persist(StorageLevel.MEMORY_AND_DISK)
