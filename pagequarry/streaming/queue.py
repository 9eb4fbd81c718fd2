"""Streaming forms: resuming, a leased work queue, and additions over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def resume(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, transform) -> None:
    """Processes the files of a folder that no earlier call has, and stops; the checkpoint remembers which."""
    rows = spark.readStream.schema(schema).parquet(source)
    transform(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def pending(frontier: DataFrame, done: DataFrame, key: str, now: str, lease_seconds: int = 900) -> DataFrame:
    """Rows to claim: not done, and never claimed or claimed longer ago than the lease."""
    free = F.col("claimed_at").isNull() | (F.col("claimed_at") < F.to_timestamp(F.lit(now)) - F.make_interval(secs=F.lit(lease_seconds)))
    return frontier.where(free).join(done.select(key), key, "left_anti")


def snapshot(spark: SparkSession, folder: str, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of a named stage of a job: those an earlier run wrote, else made and written now."""
    path = f"{folder.rstrip('/')}/{stage}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # neither unwritten nor broken off
            raise
    made = make()
    made.write.mode("overwrite").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def windowed(events: DataFrame, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Beyond the reference: counts and sums by tumbling windows of event time, late rows up to a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Beyond the reference: sessions of each user, ended by a gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
