"""Subnet and target-address monitors over a stream of visits.

The same counts as A-01 and A-04, keyed additionally by an event-time
window, so they run incrementally with ``readStream``: the watermark bounds
the state (a window's counts are final and dropped from state once the
watermark passes its end), and late rows beyond it are ignored by design.
File sources and sinks with a checkpoint location under the shared
checkpoint folder give exactly-once output across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adsentry.functions.ip import is_quad, matches_target, subnet24
from adsentry.sources.fixtures import EVENTS_SCHEMA, visits_from_events


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    # Watermarks need TIMESTAMP; wall-clock NTZ values are read in the session zone.
    return df.withColumn("_et", F.col(ts).cast("timestamp"))


def subnet_pv_windows(visits: DataFrame, window: str = "1 hour", watermark: str = "2 hours", ts: str = "ts") -> DataFrame:
    """``(window_start, window_end, subnet, pv)``: A-01 per event-time window."""
    ips = _event_time(visits, ts).select("_et", F.explode(F.col("orders")["view_ip"]).alias("view_ip"))
    return (
        ips.where(is_quad("view_ip"))
        .withWatermark("_et", watermark)
        .groupBy(F.window("_et", window).alias("w"), subnet24("view_ip").alias("subnet"))
        .agg(F.count(F.lit(1)).alias("pv"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "subnet", "pv")
    )


def ip_hour_windows(
    visits: DataFrame, target: str, match: str = "contains", watermark: str = "2 hours", ts: str = "ts"
) -> DataFrame:
    """``(window_start, window_end, n)``: A-04's hourly counts of a target as a stream."""
    rows = _event_time(visits, ts).where(matches_target("ip", target, match))
    return (
        rows.withWatermark("_et", watermark)
        .groupBy(F.window("_et", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    )


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet event files arriving under ``path`` as a stream of visits."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return visits_from_events(reader.parquet(path))


def start_subnet_monitor(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    window: str = "1 hour",
    watermark: str = "2 hours",
    available_now: bool = False,
) -> StreamingQuery:
    """Run :func:`subnet_pv_windows` from parquet files to parquet files (append mode).

    ``checkpoint`` is a folder in shared storage that stays the same across
    restarts: with another one everything would be read and appended again.
    """
    counts = subnet_pv_windows(read_event_stream(spark, source), window, watermark)
    writer = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
