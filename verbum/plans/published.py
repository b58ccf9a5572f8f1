"""Weight tables for the SQL checks.

A fitted regression cannot be restated in SQL, what follows from its weights
can.  On a local session a query that fits one leaves the K weights, which the
driver holds anyway, as ``(pos, weight)`` in a file whose place the SQL knows.
A cluster has no SQL check beside it: nothing is written there.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession


def weights_file(name: str) -> str:
    return os.path.join(tempfile.gettempdir(), "verbum-weights", f"{name}.parquet")


def publish(spark: SparkSession, name: str, w: np.ndarray) -> None:
    if not spark.sparkContext.master.startswith("local["):
        return
    path = weights_file(name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{os.getpid()}"
    pq.write_table(pa.table({"pos": np.arange(len(w), dtype=np.int32), "weight": np.asarray(w, np.float64)}), part)
    os.replace(part, path)
