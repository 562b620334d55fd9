"""Preparation, filters and previews (PR1-PR9, IO4)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actlens.functions import labels as L
from actlens.functions.exprs import parse_timestamp_ntz
from actlens.sources.schema import CORRUPT


def parse_time(df: DataFrame, column: str = "time", fmt: str = L.TIME_FORMAT) -> DataFrame:
    """PR1: text ``time`` -> TIMESTAMP_NTZ; malformed text -> null.

    A column that is already a timestamp is only normalised to NTZ."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return df
    if isinstance(dtype, T.TimestampType):
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df.withColumn(column, parse_timestamp_ntz(column, fmt))


def _complete(df: DataFrame, subset: Sequence[str] | None = None) -> Column:
    cols = list(subset) if subset else df.columns
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """PR2: drop rows with a null in any (or any of ``subset``) column.

    Written as a conjunction of ``IS NOT NULL`` tests (same result as
    ``dropna``), which the parquet scan accepts as pushed filters."""
    return df.filter(_complete(df, subset))


REASON, KEPT = "reject_reason", "kept"


def with_reject_reason(raw: DataFrame, columns: Sequence[str] | None = None, fmt: str = L.TIME_FORMAT) -> DataFrame:
    """Raw rows (``time`` as text) with ``reject_reason``: why cleaning drops the row, null if
    it keeps it.  In this order: ``bad csv`` (a line kept as corrupt by the reader), ``bad time``
    (text that is no time), ``null <column>`` for the first of ``columns`` (all of them by default) without a value."""
    reason = F.lit(None).cast("string")
    names = [c for c in (columns or raw.columns) if c != CORRUPT]
    for c in reversed(names):
        reason = F.when(F.col(c).isNull(), F.lit(f"null {c}")).otherwise(reason)
    if "time" in raw.columns and isinstance(raw.schema["time"].dataType, T.StringType):
        bad_time = F.col("time").isNotNull() & parse_timestamp_ntz("time", fmt).isNull()
        reason = F.when(bad_time, F.lit("bad time")).otherwise(reason)
    if CORRUPT in raw.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("bad csv")).otherwise(reason)
    return raw.withColumn(REASON, reason)


def accepted(marked: DataFrame) -> DataFrame:
    """The rows of :func:`with_reject_reason` that are kept, as they were read."""
    return marked.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)


def rejects(marked: DataFrame) -> DataFrame:
    """The rows that are not kept, as they were read, with their reason (and line, if corrupt)."""
    return marked.where(F.col(REASON).isNotNull())


def reject_report(marked: DataFrame) -> DataFrame:
    """Rows by reason, and the kept ones: together all rows read.  One two-phase aggregate."""
    return marked.groupBy(F.coalesce(REASON, F.lit(KEPT)).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))


def cleaning_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """PR3: rows before, after and removed by :func:`drop_incomplete`, one pass; for rows
    with a ``reject_reason``, after and removed by that."""
    kept = F.col(REASON).isNull() if REASON in df.columns else _complete(df, subset)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def add_calendar(df: DataFrame, column: str = "time") -> DataFrame:
    """PR4: ``date``, ``hour_extracted`` and ``month`` from the event time."""
    return (
        df.withColumn("date", F.to_date(column))
        .withColumn("hour_extracted", F.hour(column).cast("int"))
        .withColumn("month", F.month(column).cast("int"))
    )


def prepare(df: DataFrame, subset: Sequence[str] | None = None, calendar: bool = True) -> DataFrame:
    """PR1 + PR2 (+ PR4): the cleaned activity frame every analysis reads."""
    out = drop_incomplete(parse_time(df), subset)
    return add_calendar(out) if calendar else out


def persist_prepared(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> DataFrame:
    """IO4: keep the prepared frame for reuse by several analyses.

    Columns are pruned *before* persisting, because a cached relation hides
    the scan from column pruning and filter pushdown.  Blocks spill to disk
    instead of being dropped; lost blocks are recomputed from lineage.
    Call ``unpersist()`` when done."""
    pruned = df.select(*columns) if columns else df
    return pruned.persist(level)


def selection(
    actions: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
    devices: Iterable[str] | None = None,
    term: str | None = None,
) -> Column:
    """Predicate of PR5 (+ PR7): action, category and device each in the
    chosen set (``None`` keeps all values, an empty set keeps no row), and the
    user id matching the upper-cased search term when one is given."""
    cond = F.lit(True)
    for name, values in (("action", actions), ("category", categories), ("device", devices)):
        if values is None:
            continue
        values = list(values)
        cond = cond & (F.col(name).isin(*values) if values else F.lit(False))
    if term:
        cond = cond & F.col("user_id").rlike(term.upper())
    return cond


def filter_activity(
    df: DataFrame,
    actions: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
    devices: Iterable[str] | None = None,
) -> DataFrame:
    """PR5: keep rows whose action, category and device are each in the chosen
    set.  ``None`` keeps all values; an empty set keeps no row."""
    return df.filter(selection(actions, categories, devices))


def domains(df: DataFrame, columns: Sequence[str] = ("action", "category", "device")) -> DataFrame:
    """PR6: distinct non-null values of each column as (column_name, value),
    sorted (first-seen order has no meaning on a distributed scan).  Rows are
    grouped by the columns together first, so that few are unpivoted."""
    long = df.select(*columns).distinct().select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("cv")
    ).select("cv.column_name", "cv.value")
    return long.filter(F.col("value").isNotNull()).distinct().orderBy("column_name", "value")


def search_users(df: DataFrame, term: str | None, column: str = "user_id") -> DataFrame:
    """PR7: rows whose user id matches the upper-cased term as a regular
    expression; an empty term keeps every row."""
    if not term:
        return df
    return df.filter(F.col(column).rlike(term.upper()))


def preview(
    df: DataFrame,
    n: int = 10,
    columns: Sequence[str] = L.PREVIEW_COLUMNS,
    order_by: Sequence[str] = ("time", "event_id"),
) -> DataFrame:
    """PR8: first ``n`` rows by a stable order (a top-k, not a full sort)."""
    keys = [c for c in order_by if c in df.columns]
    return df.orderBy(*keys).limit(n).select(*columns)


def coverage(
    df: DataFrame,
    actions: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
    devices: Iterable[str] | None = None,
    term: str | None = None,
) -> DataFrame:
    """PR9: rows shown after filter + search, out of all rows, in one scan."""
    keep = selection(actions, categories, devices, term)
    return df.agg(F.count_if(keep).alias("shown"), F.count(F.lit(1)).alias("total"))
