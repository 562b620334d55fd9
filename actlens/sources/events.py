"""Adapter from the generic ``events`` table to the activity schema.

The activity analysis expects user, session, action, category, product,
time, hour, weekday and device per event.  ``events`` carries
``event_id, ts, user_id, event_type, value, props``; the mapping is

* ``k``            = integer ``props.k``
* ``user_id``      = text of ``user_id``
* ``action``       = ``click`` read as ``cart``; other types unchanged
* ``category``     = ``'C' || pmod(k, 6)``;  ``product_id`` = ``'P' || k``
* ``device``       = desktop / mobile / tablet by ``pmod(k, 3)``
* ``hour``, ``day_of_week`` from ``ts``
* ``session_id``   = ``user || '-' || n``: the n-th run of a user's events
  in which consecutive events are at most ``gap`` apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actlens.functions.exprs import count_of, epoch_micros, time_text
from actlens.functions.masks import count_bits, masks
from actlens.sources.tables import table

# FIXED VALUES of the mapping (see module docstring).
CLICK = "click"
CLICK_AS = "cart"
DEVICES = ("desktop", "mobile", "tablet")
CATEGORIES = tuple(f"C{i}" for i in range(6))
SESSION_GAP_SECONDS = 12 * 3600


def _k() -> Column:
    # A typed JSON parse of the one field (faster than a path lookup on text).
    return F.from_json("props", "k int")["k"]


def _buckets(df: DataFrame, user_col: str, time_col: str, gap_seconds: int, *aggs: Column):
    """(events with their bucket, per (user, bucket) table with ``_start``: 1
    where a session begins in the bucket, and the given aggregates)."""
    gap_us = int(gap_seconds) * 1_000_000
    us = epoch_micros(time_col)
    bucket = ((us - F.pmod(us, F.lit(gap_us))) / F.lit(gap_us)).cast("long")
    with_bucket = df.withColumn("_us", us).withColumn("_bucket", bucket)

    per_bucket = with_bucket.groupBy(user_col, "_bucket").agg(
        F.min("_us").alias("_first_us"), F.max("_us").alias("_last_us"), *aggs)
    w = Window.partitionBy(user_col).orderBy("_bucket")
    prev_bucket = F.lag("_bucket").over(w)
    prev_last = F.lag("_last_us").over(w)
    starts = (
        prev_bucket.isNull()
        | (prev_bucket < F.col("_bucket") - 1)
        | (F.col("_first_us") - prev_last > F.lit(gap_us))
    )
    return with_bucket, per_bucket.withColumn("_start", starts.cast("int"))


def gap_sessions(
    df: DataFrame,
    user_col: str = "user_id",
    time_col: str = "time",
    gap_seconds: int = SESSION_GAP_SECONDS,
    out_col: str = "session_no",
) -> DataFrame:
    """Number each user's gap sessions: a new session starts when the time
    since the user's previous event exceeds ``gap_seconds``.

    Skew-safe formulation.  Time is cut into buckets exactly ``gap`` wide.
    Two events in one bucket are less than ``gap`` apart, so at most one
    session can start inside a bucket, and only at its first event: it does
    when the previous non-empty bucket of the user is not adjacent, or its
    last event is more than ``gap`` before this bucket's first.  So the
    session numbers are decided on the (user, bucket) aggregate -- computed
    with partial aggregation, at most span/gap rows per user however many
    events a user has -- and joined back on (user, bucket).  No window or
    group ever holds all events of one user.
    """
    with_bucket, buckets = _buckets(df, user_col, time_col, gap_seconds)
    w = Window.partitionBy(user_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = buckets.withColumn(out_col, F.sum("_start").over(w).cast("long")).select(user_col, "_bucket", out_col)
    # Every event finds its bucket, so a left join returns the same rows as an
    # inner one -- and, the right side being unique on the join keys, lets
    # Catalyst drop the join from plans that never read the session number.
    return with_bucket.join(numbered, [user_col, "_bucket"], "left").drop("_us", "_bucket")


def user_totals(
    df: DataFrame,
    user_col: str = "user_id",
    time_col: str = "time",
    gap_seconds: int = SESSION_GAP_SECONDS,
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """Per user: ``views``, ``carts``, ``purchases``, ``total_actions``, ``total_sessions`` and
    ``categories_browsed``, all from the (user, bucket) table: one scan of the
    events and two-phase aggregates, no join.  Categories travel as bit masks over
    the ``categories`` that there are."""
    counts = {"views": count_of("view"), "carts": count_of("cart"), "purchases": count_of("purchase"),
              "total_actions": F.count(F.lit(1))}
    held = masks("category", categories) if "category" in df.columns else {}
    _, buckets = _buckets(df, user_col, time_col, gap_seconds, *[c.alias(n) for n, c in (counts | held).items()])
    totals = buckets.groupBy(user_col).agg(*[F.sum(n).alias(n) for n in counts], F.sum("_start").alias("total_sessions"),
                                           *[F.bit_or(m).alias(m) for m in held])
    return totals.select(user_col, *counts, "total_sessions", *([count_bits(held).alias("categories_browsed")] if held else []))


def activity_from_events(
    events: DataFrame,
    sessions: bool = True,
    raw_time: bool = False,
    gap_seconds: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Map ``events`` rows to activity rows (plus ``event_id`` as event key).

    ``raw_time=True`` renders ``time`` as text in the file layout, as an
    activity CSV would hold it; otherwise ``time`` is TIMESTAMP_NTZ.
    ``sessions=False`` skips sessionisation (and the ``session_id`` column)
    for analyses that do not read it.
    """
    # Rows with a null source field are incomplete (any derived column would
    # be null): dropping them here is the cleaning step, decided on the five
    # source columns -- pushed to the parquet scan -- rather than on every
    # derived column, which would force all derivations for every query.
    source = ["event_id", "ts", "user_id", "event_type", "props"]
    complete = F.lit(True)
    for c in source:
        complete = complete & F.col(c).isNotNull()
    # Rows whose props hold no k are incomplete too.  Exploding the non-null
    # parsed value keeps them out with a single JSON parse per row; a filter
    # on the parsed column would be copied below the projection by the
    # optimizer and parse every row twice.
    parsed = F.explode(F.filter(F.array(_k()), lambda v: v.isNotNull())).alias("k")
    events = events.filter(complete).select("*", parsed)
    k = F.col("k")
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICES]), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    act = events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == CLICK, F.lit(CLICK_AS)).otherwise(F.col("event_type")).alias("action"),
        F.concat(F.lit("C"), F.pmod(k, F.lit(len(CATEGORIES))).cast("string")).alias("category"),
        F.concat(F.lit("P"), k.cast("string")).alias("product_id"),
        F.col("ts").alias("time"),
        F.hour("ts").cast("int").alias("hour"),
        F.date_format("ts", "EEEE").alias("day_of_week"),
        device.alias("device"),
        "k",
    )
    if sessions:
        act = gap_sessions(act, "user_id", "time", gap_seconds, "session_no").withColumn(
            "session_id", F.concat_ws("-", "user_id", F.col("session_no").cast("string"))
        ).drop("session_no")
    if raw_time:
        act = act.withColumn("time", time_text("time"))
    cols = ["event_id", "user_id", "session_id", "action", "category", "product_id",
            "time", "hour", "day_of_week", "device", "k"]
    return act.select(*[c for c in cols if c in act.columns])


def activity(spark: SparkSession, sf_dir: str, sessions: bool = True, raw_time: bool = False) -> DataFrame:
    """Activity rows derived from ``{sf_dir}/events.parquet``."""
    return activity_from_events(table(spark, sf_dir, "events"), sessions=sessions, raw_time=raw_time)


__all__ = ["activity", "activity_from_events", "gap_sessions", "user_totals", "DEVICES"]
