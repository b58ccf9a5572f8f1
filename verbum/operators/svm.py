"""Linear SVM: full-batch sub-gradient descent with a bold-driver step size.

Training keeps the documents packed, some thousand to a row as compressed sparse
rows, in a written, cached table, so a pass hands a few large buffers to Python.
Each iteration is ONE Spark job: the driver broadcasts the K weights, a
vectorised per-partition kernel returns partial sums (cost, intercept gradient
and the per-position gradient in a single pass), and the driver (holding only K
doubles) applies the update and the step-size rule.  The partials are arrays cut
into slices of positions and added up by slice, so the driver fetches K + 2
doubles an iteration whatever the data.  The job is planned once, on an RDD of
arrays, and not by the SQL planner in each iteration.

  cost  = (1/n) sum max(0, 1 - y(w.x - b)) + (1/2 n C) ||w||^2,   C = n / 1e16
  grad  = (1/n) sum_{active} -y x + (2/n C) w,   active: y(w.x - b) < 1
  gradb = (1/n) sum_{active} y
  w -= rate grad;  b -= rate gradb       (cost uses the weights before the update)
  rate *= 1.05 if the cost fell, else 0.5
  stop after the update when old_cost - cost < tol
  predict +1 when w.x - b >= 0, else -1; the reported score is w.x
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbum.operators.linear import dot_product
from verbum.params import Params
from verbum.session import write_and_read

# Partial sums: the sum of -y over active documents for positions 0..K-1, then
# the hinge sum and the active y sum; cut into slices of so many.
SLICE = 1 << 16
TRACE_SCHEMA = "iter int, cost double, learning_rate double, intercept double, margin double"


# A block of documents packed as compressed sparse rows: labels (int8), the number
# of positions of each document and the positions (int32), all little-endian.
BLOCK_SCHEMA = "n int, y binary, sizes binary, positions binary"
BLOCK_DOCS, BLOCK_POSITIONS = 4096, 1 << 20


def pack_blocks(vectors: DataFrame) -> DataFrame:
    """``(n, y, sizes, positions)``: the rows ``(label, idx)`` of each partition, some thousand to a block.

    A block ends at ``BLOCK_DOCS`` documents or ``BLOCK_POSITIONS`` positions,
    whichever comes first, so it is bounded by one document beyond that.  Null
    ``idx`` counts as no positions.
    """

    def run(batches):
        held, docs, size = [], 0, 0

        def block():
            y, sizes, positions = (np.concatenate(x) for x in zip(*held))
            held.clear()
            cols = [pa.array([len(y)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (y, sizes, positions))]
            return pa.RecordBatch.from_arrays(cols, ["n", "y", "sizes", "positions"])

        for rb in batches:
            lst = rb.column(1)
            y = rb.column(0).to_numpy(zero_copy_only=False).astype("<i1")
            sizes = pc.list_value_length(lst).fill_null(0).to_numpy(zero_copy_only=False).astype("<i4")
            flat = lst.flatten().to_numpy(zero_copy_only=False).astype("<i4")
            ends = np.cumsum(sizes, dtype=np.int64)
            at = 0
            while at < len(y):
                begin = int(ends[at - 1]) if at else 0
                room = int(np.searchsorted(ends, begin + max(1, BLOCK_POSITIONS - size), side="left")) + 1
                to = min(len(y), at + BLOCK_DOCS - docs, room)
                held.append((y[at:to], sizes[at:to], flat[begin:int(ends[to - 1])]))
                docs, size = docs + to - at, size + int(ends[to - 1]) - begin
                at = to
                if docs >= BLOCK_DOCS or size >= BLOCK_POSITIONS:
                    yield block()
                    docs = size = 0
        if held:
            yield block()

    return vectors.select("label", "idx").mapInArrow(run, BLOCK_SCHEMA)


def _folder(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


# Bytes of packed documents that one task folds into one set of partial sums.
PASS_BYTES = 1 << 30


def training_blocks(vectors: DataFrame) -> DataFrame:
    """The packed training set, written once (``svm_train`` caches its arrays).

    A task of a pass folds about ``PASS_BYTES`` into at most K + 2 partial rows,
    so the shuffle of a pass stays far below its data; where that would leave
    cores idle, tasks are smaller.
    """
    spark = vectors.sparkSession
    table = write_and_read(pack_blocks(vectors), "svm-train")
    size = sum(_folder(spark, f)[0].getFileStatus(_folder(spark, f)[1]).getLen() for f in table.inputFiles())
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-size // PASS_BYTES))
    return table.coalesce(int(tasks))


def _arrays(blocks: DataFrame, k: int):
    """The blocks as an RDD of arrays ``(y, sizes, positions)``; 2 bytes a position where K allows."""
    small = np.uint16 if k <= 1 << 16 else np.int32

    def unpacked(r):
        return (np.frombuffer(r["y"], "<i1"), np.frombuffer(r["sizes"], "<i4"), np.frombuffer(r["positions"], "<i4").astype(small))

    return blocks.rdd.map(unpacked)


def _partials_kernel(bw, b: float, k: int):
    """Per-partition partial sums for one iteration over the blocks' arrays (runs on executors)."""

    def run(blocks):
        w = bw.value
        s = np.zeros(k + 2, dtype=np.float64)
        for labels, sizes, positions in blocks:
            y = labels.astype(np.float64)
            dot = np.zeros(len(y))
            full = np.flatnonzero(sizes)
            if len(full):
                starts = np.concatenate(([0], np.cumsum(sizes[full], dtype=np.int64)[:-1]))
                dot[full] = np.add.reduceat(w[positions], starts)
            ym = y * (dot - b)
            active = ym < 1.0
            s[k] += float(np.sum(np.maximum(0.0, 1.0 - ym)))
            s[k + 1] += float(np.sum(y[active]))
            # x is 0 or 1, so a position's sum is two counts
            for sign, some in ((1.0, active & (y < 0)), (-1.0, active & (y > 0))):
                if some.any():
                    s[:k] += sign * np.bincount(positions[np.repeat(some, sizes)], minlength=k)
        for i, at in enumerate(range(0, k + 2, SLICE)):
            yield i, s[at:at + SLICE]

    return run


def _iteration_sums(blocks, bw, b: float, k: int):
    """One pass over the training set's arrays: (per-position sum of -y, hinge sum, active y sum)."""
    slices = -(-(k + 2) // SLICE)
    parts = blocks.mapPartitions(_partials_kernel(bw, b, k))
    found = dict(parts.reduceByKey(np.add, min(slices, blocks.context.defaultParallelism)).collect())
    s = np.concatenate([found[i] for i in range(slices)])
    return s[:k], float(s[k]), float(s[k + 1])


@dataclass
class SvmModel:
    w: np.ndarray
    intercept: float
    trace_rows: list = field(default_factory=list)
    n: int = 0
    converged: bool = False

    @property
    def iterations(self) -> int:
        return len(self.trace_rows)

    def weights(self, spark) -> DataFrame:
        """``(pos, weight)``: K rows built from the driver's model copy."""
        import pandas as pd
        pdf = pd.DataFrame({"pos": np.arange(len(self.w), dtype=np.int32), "weight": self.w})
        return spark.createDataFrame(pdf, "pos int, weight double")

    def trace(self, spark) -> DataFrame:
        return spark.createDataFrame(self.trace_rows, TRACE_SCHEMA)


# ---------------------------------------------------------------- resuming

STATE_SCHEMA = "k int, n double, settings string, rate double, old double, intercept double, done boolean, trace array<struct<iter: int, cost: double, learning_rate: double, intercept: double, margin: double>>"


def _steps(spark, folder: str) -> list[int]:
    """The iterations whose state is whole, ascending; the state is written last."""
    fs, p = _folder(spark, folder)
    if not fs.exists(p):
        return []
    names = [str(x.getPath().getName()) for x in fs.listStatus(p)]
    found = [int(x[5:]) for x in names if x.startswith("step-") and x[5:].isdigit()]
    return sorted(i for i in found if fs.exists(_folder(spark, f"{folder}/step-{i}/state/_SUCCESS")[1]))


def _settings(params: Params) -> str:
    return f"rate {params.svm_rate!r}, tolerance {params.svm_tol!r}, divisor {params.c_divisor!r}"


def save_state(spark, folder: str, model: SvmModel, rate: float, old: float, params: Params) -> None:
    """Writes the training's state as ``folder/step-N``: the K weights, then the scalars and the trace; drops older steps but one."""
    at, before = f"{folder}/step-{model.iterations}", _steps(spark, folder)
    model.weights(spark).coalesce(1).write.mode("overwrite").parquet(f"{at}/weights")
    row = (len(model.w), float(model.n), _settings(params), float(rate), float(old), float(model.intercept), model.converged, model.trace_rows)
    spark.createDataFrame([row], STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{at}/state")
    for i in before[:-1]:
        fs, p = _folder(spark, f"{folder}/step-{i}")
        fs.delete(p, True)


def load_state(spark, folder: str, k: int, n: float, params: Params) -> tuple[SvmModel, float, float] | None:
    """(model, rate, old cost) of the last whole step in ``folder``; None if there is none.

    Raises ``ValueError`` if it is of another training: another K, number of
    documents, rate, tolerance or divisor.
    """
    steps = _steps(spark, folder)
    if not steps:
        return None
    at = f"{folder}/step-{steps[-1]}"
    r = spark.read.parquet(f"{at}/state").first()
    if (r["k"], r["n"], r["settings"]) != (k, float(n), _settings(params)):
        raise ValueError(f"{at} is the state of another training")
    w = np.zeros(k)
    t = spark.read.parquet(f"{at}/weights").toArrow()  # K rows
    w[t.column("pos").to_numpy()] = t.column("weight").to_numpy()
    return SvmModel(w, r["intercept"], [tuple(x) for x in r["trace"]], int(n), r["done"]), r["rate"], r["old"]


def svm_train(vectors: DataFrame, k: int, params: Params = Params(), blocks: DataFrame | None = None,
              resume: str | None = None, save_every: int = 25) -> SvmModel:
    """Train on ``(doc_key, label in {-1,+1}, idx)``; returns the model and its trace.

    ``blocks``: the training set packed already (``training_blocks``).
    ``resume``: a shared folder; the state is written there every ``save_every``
    iterations and at the end, and training goes on from the last state found.
    """
    spark = vectors.sparkSession
    sc = spark.sparkContext
    data = _arrays(blocks if blocks is not None else training_blocks(vectors), k).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = float(data.map(lambda block: len(block[0])).sum())
        c = n / params.c_divisor
        model, rate, old = SvmModel(np.zeros(k, dtype=np.float64), 0.0, [], int(n), False), params.svm_rate, float("inf")
        if n == 0:
            return model
        if resume is not None:
            model, rate, old = load_state(spark, resume, k, n, params) or (model, rate, old)
        saved = model.iterations
        while model.iterations < params.svm_max_iter and not model.converged:
            w, b = model.w, model.intercept
            bw = sc.broadcast(w)
            s, hsum, gbsum = _iteration_sums(data, bw, b, k)
            bw.destroy()
            cost = (1.0 / n) * hsum + (1.0 / 2.0 * n * c) * (np.linalg.norm(w) ** 2)
            grad = (1.0 / n) * s + (2.0 / n * c) * w
            gradb = (1.0 / n) * gbsum
            model.w = w - rate * grad
            model.intercept = b - rate * gradb
            used = rate
            rate = rate * 1.05 if old > cost else rate * 0.5
            norm = float(np.linalg.norm(model.w))
            model.trace_rows.append((model.iterations + 1, float(cost), float(used), float(model.intercept), (2.0 / norm) if norm > 0 else None))
            model.converged = bool(old - cost < params.svm_tol)
            if not model.converged:
                old = cost
            if resume is not None and model.iterations - saved >= save_every:
                save_state(spark, resume, model, rate, old, params)
                saved = model.iterations
        if resume is not None and saved < model.iterations:
            save_state(spark, resume, model, rate, old, params)
        return model
    finally:
        data.unpersist()


def svm_predict(vectors: DataFrame, weights: DataFrame, intercept: float, k: int) -> DataFrame:
    """``(doc_key, label, score, prediction)``: +1 when ``w.x - b >= 0``; score is ``w.x``."""
    s = dot_product(vectors, weights, k)
    pred = F.when(F.col("score") - F.lit(float(intercept)) >= 0, F.lit(1)).otherwise(F.lit(-1))
    return s.select("doc_key", "label", "score", pred.alias("prediction"))


def svm_early_stop(trace: DataFrame, tol: float) -> DataFrame:
    """``(stop_iter, converged)``: first iteration with ``old_cost - cost < tol``.

    The trace has at most ``max_iter`` rows, so the unpartitioned window is bounded.
    """
    prev = F.lag("cost").over(Window.orderBy("iter"))
    drop = F.when(prev.isNull(), F.lit(float("inf"))).otherwise(prev - F.col("cost"))
    t = trace.select("iter", drop.alias("drop"))
    return t.agg(
        F.coalesce(F.min(F.when(F.col("drop") < F.lit(float(tol)), F.col("iter"))), F.max("iter")).alias("stop_iter"),
        F.max(F.col("drop") < F.lit(float(tol))).alias("converged"))
