"""Incremental intake: stages one and two are narrow, so they run on streams as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmbridge import config, schemas
from ohmbridge.operators import standardise


def raw_stream(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """JSON lines of one record type as they arrive in a folder."""
    lines = spark.readStream.text(path).where(F.get_json_object("value", "$.record_type") == kind)
    return lines.select(F.from_json("value", schemas.raw(kind)).alias("r")).select("r.*")


def validate_stream(stream: DataFrame, kind: str, out: str, checkpoint: str, cat: dict | None = None):
    """Appends validated records to a Parquet folder: each file once, by the checkpoint. Runs over what is there and stops."""
    valid = standardise.clean(stream, kind, cat or config.catalog())
    return valid.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()


def windowed_activity(events: DataFrame, at: str = "ts", late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts and sums by type and event-time window, with a bound on lateness."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
