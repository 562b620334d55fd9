"""The prepared activity table, written once and read many times (IO4 at scale).

Sessionising and cleaning raw events is the expensive, shared first step of
every analysis.  On a cluster it is materialised once as parquet under a
shared folder, partitioned by event date: later analyses read only the
columns they use and, with a date filter, only the matching folders
(partition pruning).  Inside a date, rows are sorted by the columns that filters
name, so that row groups are skipped by their statistics, and single users are found through
Bloom filters.  The written table also cuts the lineage, so a lost
executor never forces the sessionisation to run again.

:func:`add_days` and :func:`read_days` keep such a table up to date: a day is added, or loaded
again, without touching what other days hold.  Sessions run across midnight, so a
row is stored with its session's number *within its user's day*, and beside the events stands a
boundary state, one row per user and day: first and last event, sessions.  From that alone
the reader tells which days' first sessions go on from the day before, and adds up the numbers;
a day that arrives late shifts the numbers of later days without rewriting them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actlens.functions.exprs import epoch_micros
from actlens.sources.events import SESSION_GAP_SECONDS, gap_sessions
from actlens.sources.scratch import materialize

#: Columns that filters name, and columns looked up by single values.
CLUSTER_BY = ("action", "category", "device")
LOOKED_UP = ("user_id",)


def _write_dates(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str], mode: str,
                 options: dict[str, str]) -> None:
    balanced = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
    writer = balanced.write.partitionBy(*partition_by).options(**options)
    if mode == "dates":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def save_prepared(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    mode: str = "dates",
    cluster_by: Sequence[str] = CLUSTER_BY,
    looked_up: Sequence[str] = LOOKED_UP,
    row_group_bytes: int = 128 << 20,
) -> str:
    """Write the prepared activity frame as parquet partitioned by date.

    By default only the dates that ``df`` holds are replaced (``mode="dates"``); other modes
    are Spark's and concern the whole folder.  Rows are rebalanced on the partition columns
    (adaptive execution splits a date holding a large share of the rows into several tasks) and
    sorted within tasks by date and ``cluster_by``, so each task writes few, large files whose
    row groups hold narrow ranges of those columns; ``looked_up`` columns get Bloom filters.
    Columns that ``df`` lacks are left out."""
    if "date" in partition_by and "date" not in df.columns:
        df = df.withColumn("date", F.to_date("time"))
    have = lambda names: [c for c in names if c in df.columns and c not in partition_by]
    options = {"parquet.block.size": str(row_group_bytes), "parquet.bloom.filter.adaptive.enabled": "true"}
    options |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in have(looked_up)}
    _write_dates(df, path, list(partition_by), have([*cluster_by, *looked_up]), mode, options)
    return path


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by :func:`save_prepared`."""
    return spark.read.parquet(path)


def add_days(df: DataFrame, path: str, gap_seconds: int = SESSION_GAP_SECONDS) -> None:
    """Add the whole days of ``df`` (prepared events with ``user_id`` and ``time``, no session) to
    the store at ``path``, in any order; a day that is there already is replaced.

    Only the events of these days are sessionised.  Events are replaced first, their
    state right after: until then a reader sees the old state of these days."""
    day = df.withColumn("date", F.to_date("time")).withColumn("_day", F.struct("user_id", "date"))
    # Written once: the events and their state then come from the same rows.
    rows = materialize(gap_sessions(day, "_day", "time", gap_seconds, "run").drop("_day"), "days")
    save_prepared(rows, f"{path}/events")
    state = rows.groupBy("user_id", "date").agg(
        F.min(epoch_micros("time")).alias("first_us"), F.max(epoch_micros("time")).alias("last_us"), F.max("run").alias("runs"))
    _write_dates(state.withColumn("gap_us", F.lit(int(gap_seconds) * 1_000_000)), f"{path}/state", ["date"], ["user_id"], "dates", {})


def day_offsets(state: DataFrame) -> DataFrame:
    """``user_id, date, offset``: what a day's own session numbers are raised by, from
    the boundary state (a row per user and day; a window per user over the days)."""
    by_day = Window.partitionBy("user_id").orderBy("date")
    goes_on = F.coalesce(F.col("first_us") - F.lag("last_us").over(by_day) <= F.col("gap_us"), F.lit(False)).cast("long")
    known = state.withColumn("_goes_on", goes_on)
    before = F.coalesce(F.sum(F.col("runs") - F.col("_goes_on")).over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return known.select("user_id", "date", (before - F.col("_goes_on")).alias("offset"))


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The events of a store filled by :func:`add_days`, with ``session_id`` as one load of
    all days would give it.  A filter on ``date`` prunes the events' folders."""
    offsets = day_offsets(spark.read.parquet(f"{path}/state"))
    events = spark.read.parquet(f"{path}/events").join(offsets, ["user_id", "date"])
    number = (F.col("offset") + F.col("run")).cast("string")
    return events.withColumn("session_id", F.concat_ws("-", "user_id", number)).drop("run", "offset")
