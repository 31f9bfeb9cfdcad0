"""The fingerprint as a stream, and predictions as idempotent micro-batches.

An extension: the batch engine runs on a schedule and has no stream of its own.
The window is its bucket and the watermark its grace around a span.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernweave.functions.text import distinct_text
from fernweave.operators.fingerprint import train_text
from fernweave.sources import store
from fernweave.sources.http_log import COLUMNS

WINDOW, GRACE = "30 minutes", "15 minutes"


def log_stream(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """The HTTP log from a growing folder of event files, or a glob of files."""
    schema = spark.read.parquet(path).schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return events.select(*[F.expr(sql).alias(name) for name, sql in COLUMNS.items()])


def fingerprints(log: DataFrame) -> DataFrame:
    """Windows that the watermark has closed, each with its distinct normalised texts."""
    rows = log.withColumn("at", F.col("logtime").cast("timestamp")).withColumn("text", train_text())
    out = rows.withWatermark("at", GRACE).groupBy(F.window("at", WINDOW).alias("w"), "src_ip", "dst_ip")
    return out.agg(distinct_text("text").alias("agnt_qry"), F.count("*").alias("n")).select(F.col("w.start").alias("lgtime"), "src_ip", "dst_ip", "agnt_qry", "n")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process all there is and stop; a restart goes on from the checkpoint."""
    stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def predict_batches(stream: DataFrame, predict: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Each micro-batch's predictions under its own version; a batch that is run again is not written again."""

    def write(batch: DataFrame, epoch: int) -> None:
        store.insert_version(predict(batch), path, f"{epoch:014d}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
