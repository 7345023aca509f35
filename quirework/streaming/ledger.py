"""Streams of batch results and stage timings.  An extension: batch jobs poll folders for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "plan_digest string, batch_id string, status string, elapsed double, completed_at timestamp"
TIMING = "attempt_id string, stage string, started_at timestamp, completed_at timestamp, status string"


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Result files as they arrive."""
    return spark.readStream.schema(RESULT).json(folder)


def first_results(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """The first result of every batch; repeats within the watermark go."""
    return stream.withWatermark("completed_at", late).dropDuplicatesWithinWatermark(["plan_digest", "batch_id"])


def stage_totals(stream: DataFrame, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Seconds by stage and window of completion."""
    seconds = F.unix_micros("completed_at") - F.unix_micros("started_at")
    timed = stream.withWatermark("completed_at", late).where("completed_at >= started_at")
    return timed.groupBy(F.window("completed_at", window).alias("w"), "stage").agg(F.sum(seconds / 1e6).alias("seconds"), F.count("*").alias("attempts")).select(F.col("w.start").alias("window_start"), "stage", "seconds", "attempts")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Stretches of work per stage with pauses shorter than ``gap``."""
    timed = stream.withWatermark("completed_at", late)
    return timed.groupBy(F.session_window("completed_at", gap).alias("w"), "stage").agg(F.count("*").alias("attempts")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "stage", "attempts")


def run_once(stream: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Everything that is there now, into a memory table; returns when done."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
