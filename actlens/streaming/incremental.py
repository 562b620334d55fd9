"""The activity counts and the behaviour profile over an arriving stream of
activity files (Structured Streaming).

The batch operators are reused unchanged on a streaming DataFrame: Spark
keeps the aggregation state (per key, or per entity) in its fault-tolerant
state store and updates it per micro-batch; progress and state live in the folder
that the caller names, so a query restarted with it resumes where it stopped.  Event-time counts use a watermark so the state of
closed windows is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from actlens.operators.anomaly import flag_anomalies, user_behavior
from actlens.operators.prepare import drop_incomplete, parse_time
from actlens.sources.schema import RAW_ACTIVITY


def read_activity_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_ACTIVITY,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Activity files appearing under ``path`` as a prepared streaming frame
    (time parsed, incomplete rows dropped)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)  # as the batch reader: headers are checked
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return drop_incomplete(parse_time(reader.load(path)))


def running_counts(stream: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Events per value of ``key`` since the stream started (update mode)."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def windowed_counts(stream: DataFrame, key: str, window: str = "1 hour", watermark: str = "2 hours",
                    name: str = "count") -> DataFrame:
    """Events per event-time window and ``key``; a window is final (and its
    state dropped) once the watermark passes its end (append mode)."""
    # Watermarks need an instant type: the wall-clock time is read in the
    # session time zone for this, and window bounds are turned back.
    instant = stream.withColumn("_event_time", F.col("time").cast("timestamp"))
    return (
        instant.withWatermark("_event_time", watermark)
        .groupBy(F.window("_event_time", window).alias("window"), key)
        .agg(F.count(F.lit(1)).alias(name))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            key, name,
        )
    )


def running_profile(stream: DataFrame, by: Sequence[str] = ("user_id",), **rules) -> DataFrame:
    """The flagged behaviour profile, updated as events arrive (update mode)."""
    return flag_anomalies(user_behavior(stream, by), **rules)


def start(result: DataFrame, sink: str, checkpoint: str, output_mode: str = "update", **options) -> StreamingQuery:
    """Start ``result`` into the named sink.  ``checkpoint`` is the folder (on
    the cluster's shared file system) that holds progress and state: a query
    restarted with the same folder resumes where it stopped."""
    writer = result.writeStream.outputMode(output_mode).format(sink).option("checkpointLocation", checkpoint)
    for k, v in options.items():
        writer = writer.queryName(v) if k == "name" else writer.option(k, v)
    return writer.start()
