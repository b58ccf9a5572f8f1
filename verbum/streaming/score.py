"""Score newly arriving corpus files with a trained linear model.

This is the held-out scoring path of the batch tasks (parse, tokenise,
presence vectors against the *training* dictionary, ``w.x - b >= 0``) applied
to each micro-batch of a file stream.  Nothing here keeps state across
batches: a document is one line, so each batch is scored on its own, and
the dictionary and weights (at most K rows each) are static broadcast sides.

Every batch is written to ``{out}/epoch={id}`` with overwrite, so a batch
replayed after a failure replaces its own output instead of duplicating it.
Unlike the batch path, a document id repeated in two different batches is
scored twice (once per batch) rather than merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verbum.operators.parse import corpus_tokens
from verbum.operators.svm import svm_predict
from verbum.operators.vectors import doc_vectors, with_signed_label


def score_lines(lines: DataFrame, dictionary: DataFrame, weights: DataFrame, intercept: float, k: int) -> DataFrame:
    """Batch scoring of corpus lines: ``(doc_key, label, score, prediction)``."""
    v = with_signed_label(doc_vectors(corpus_tokens(lines), dictionary, k))
    return svm_predict(v, weights, intercept, k)


def start_scoring(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                  dictionary: DataFrame, weights: DataFrame, intercept: float, k: int,
                  available_now: bool = True) -> StreamingQuery:
    """Stream text files from ``source_dir``; write scored rows under ``out_dir``."""
    lines = spark.readStream.format("text").load(source_dir)

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        scored = score_lines(batch, dictionary, weights, intercept, k)
        scored.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id}")

    w = lines.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    """All scored batches (``epoch`` comes from the folder names)."""
    return spark.read.parquet(out_dir).withColumn("epoch", F.col("epoch").cast("long"))
