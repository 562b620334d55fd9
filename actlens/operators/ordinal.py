"""Exact positions, ranks and running totals inside groups, without sending a
group to one task.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` hash-partitions on the
key, so one hot key -- a session holding a third of all events -- lands in a
single task that must sort all of it.  Here every input, large or small, takes
the same path, on which no task holds more than one range of rows:

1. range-partition on (key, order...): a hot key is cut into many ranges.  The
   rows are written once, with their range number, to the shared scratch folder:
   range bounds come from a sample, and the numbering and the summary below
   must both see the very same ranges, also after an executor is lost.
   (Callers prune columns first.)  The written table is bucketed by the range
   number, one range a bucket, so that what follows reads its distribution
   from the table: the rows are shuffled once, not twice.
2. number or rank rows inside each (range, key) -- bounded groups;
3. per range keep the first and last key and the totals of the last key, and
   for ranks the first and last tie group and the rows of the last one: one row
   per range, a table as small as the partition count;
4. a key that starts in an earlier range continues its totals: the carry is the
   running total of that key over the preceding ranges.  A tie group that
   starts in an earlier range keeps the rank at which it began there.

The result equals the window function's for every row; nulls in keys or order are
values like others (first in order).  For positions and running totals the order must
be total: end it with a unique column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actlens.sources.scratch import materialize_bucketed

#: Range number of a row, in order, and the number that stands for it in the bucketed table.
_RANGE, _BUCKET = "_range", "_bucket"

#: What :func:`_bucket_values` found, by number of buckets.
_KNOWN: dict[int, list[int]] = {}


def _bucket_values(df: DataFrame, n: int) -> list[int]:
    """``n`` numbers that fall into the buckets 0 to n-1 of an n-bucket table."""
    if n in _KNOWN:
        return _KNOWN[n]
    found: dict[int, int] = {}
    width = start = 16 * n + 64
    at = 0
    while len(found) < n:
        tried = df.sparkSession.sql(
            f"SELECT transform(sequence({at}, {at + width - 1}), x -> pmod(hash(cast(x AS int)), {n})) AS b").first().b
        for value, bucket in enumerate(tried, at):
            found.setdefault(bucket, value)
        at, width = at + width, start
    _KNOWN[n] = [found[b] for b in range(n)]
    return _KNOWN[n]


def _ranged(df: DataFrame, keys: list[str], order: list[str], partitions: int | None) -> DataFrame:
    """The rows, range-partitioned on (keys, order) and written once, with their range number."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = F.expr(f"array({', '.join(map(str, _bucket_values(df, n)))})")
    rows = df.repartitionByRange(n, *keys, *order).withColumn(_RANGE, F.spark_partition_id())
    return materialize_bucketed(rows.withColumn(_BUCKET, F.element_at(values, F.col(_RANGE) + 1)), n, _BUCKET, "ranged")


def _struct(columns: Sequence[str]) -> Column:
    return F.struct(*columns) if columns else F.struct(F.lit(0).alias("_k"))


def _carry(summary: DataFrame, first: str, last: str, totals: Mapping[str, str]) -> DataFrame:
    """To a frame with one row per range, add for each (out, total) of ``totals`` what
    the group ``first`` has gathered in the preceding ranges, 0 if it begins here.

    One row per range: ordering it in one window is bounded by the partition
    count, not by the data."""
    by_range = Window.orderBy(_RANGE)
    before = F.lag(last).over(by_range)
    goes_on = F.lag(F.lit(True), 1, False).over(by_range) & F.col(first).eqNullSafe(before)
    out = summary.withColumn("_goes_on", goes_on).withColumn("_chain", F.sum(
        F.when(F.col("_goes_on") & F.col(first).eqNullSafe(F.col(last)), 0).otherwise(1)).over(
        by_range.rowsBetween(Window.unboundedPreceding, 0)))
    in_chain = Window.partitionBy("_chain").orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, 0)
    for name, total in totals.items():
        out = out.withColumn("_run", F.sum(total).over(in_chain))
        out = out.withColumn(name, F.when(F.col("_goes_on"), F.lag("_run").over(by_range)).otherwise(F.lit(0)))
    return out.drop("_goes_on", "_chain", "_run")


def _step(df: DataFrame, weight: str | None) -> Column:
    if weight is None:
        return F.lit(1).cast("long")
    whole = F.col(weight) if isinstance(df.schema[weight].dataType, T.DecimalType) else F.col(weight).cast("long")
    return F.coalesce(whole, F.lit(0))


def running_totals_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Mapping[str, str | None],
                          partitions: int | None = None, keep_range: bool = False) -> DataFrame:
    """Add for each (out, weight) of ``totals`` the running total of the column ``weight``
    (long or decimal; 1 per row when None) over the rows of each ``keys`` group in
    ``order``, inclusive of the row itself.  With no weight this is the 1-based
    position (``row_number``).

    With ``keep_range`` the frame also tells a row's range, for :func:`group_in_ranges`."""
    keys, order = list(keys), list(order)
    ranged = _ranged(df, keys, order, partitions)
    steps = {out: _step(df, weight) for out, weight in totals.items()}
    upto = Window.partitionBy(_BUCKET, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(s).over(upto).alias(f"_local_{out}") for out, s in steps.items()])

    key = _struct(keys)
    per_key = ranged.groupBy(_BUCKET, _RANGE, *keys).agg(*[F.sum(s).alias(f"_tot_{out}") for out, s in steps.items()])
    summary = per_key.groupBy(_BUCKET, _RANGE).agg(
        F.min(key).alias("_first"), F.max(key).alias("_last"), *[F.max_by(f"_tot_{out}", key).alias(f"_tot_{out}") for out in steps])
    summary = _carry(summary, "_first", "_last", {f"_carry_{out}": f"_tot_{out}" for out in steps})
    # No join hint: adaptive execution broadcasts the summary if it is measured small.
    joined = local.join(summary.select(_BUCKET, "_first", *[f"_carry_{out}" for out in steps]), _BUCKET)
    same = key.eqNullSafe(F.col("_first"))
    return joined.select(*df.columns, *[
        (F.col(f"_local_{out}") + F.when(same, F.col(f"_carry_{out}")).otherwise(F.lit(0))).cast(
            "long" if not isinstance(local.schema[f"_local_{out}"].dataType, T.DecimalType) else "decimal(38,0)").alias(out)
        for out in steps], *([_BUCKET] if keep_range else []))


def running_total_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, weight: str | None = None,
                         partitions: int | None = None) -> DataFrame:
    """:func:`running_totals_within` for one column."""
    return running_totals_within(df, keys, order, {out: weight}, partitions)


def ordinal_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
                   partitions: int | None = None, keep_range: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its ``keys`` group in
    ``order`` (ascending; must be a total order within a group)."""
    return running_totals_within(df, keys, order, {out: None}, partitions, keep_range)


def group_in_ranges(ranged: DataFrame, columns: Sequence[str], *aggs: Column) -> DataFrame:
    """Aggregate a frame made with ``keep_range`` by ``columns`` inside each of its
    ranges, without a shuffle: a row per group and range."""
    return ranged.groupBy(_BUCKET, *columns).agg(*aggs).drop(_BUCKET)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """``rank()`` within ``keys`` by ``order``: rows tied on ``order`` share the
    position of the first of them.  ``tiebreak`` has no influence on ranks; it lets a
    large tie group be cut into ranges as well.

    Ranks come from the same pass as positions would: inside a range by ``rank()``, and
    across ranges by what the summary carries, the rows of the key before the range and
    the rows of the tie group that goes on in it."""
    keys, order = list(keys), list(order)
    ranged = _ranged(df, keys, [*order, *tiebreak], partitions)
    key, tie = _struct(keys), F.struct(*keys, *order)
    local = ranged.withColumn("_local", F.rank().over(Window.partitionBy(_BUCKET, *keys).orderBy(*order)).cast("long"))
    ties = ranged.groupBy(_BUCKET, _RANGE, *keys, *order).agg(F.count(F.lit(1)).alias("_n"))
    per_key = ties.groupBy(_BUCKET, _RANGE, *keys).agg(
        F.sum("_n").alias("_n_key"), F.max_by("_n", F.struct(*order)).alias("_n_tie"), F.min(tie).alias("_tie"),
        F.max(tie).alias("_tie_max"))
    summary = per_key.groupBy(_BUCKET, _RANGE).agg(
        F.min(key).alias("_first"), F.max(key).alias("_last"), F.max_by("_n_key", key).alias("_n_key"),
        F.max_by("_n_tie", key).alias("_n_tie"), F.min("_tie").alias("_first_tie"), F.max("_tie_max").alias("_last_tie"))
    summary = _carry(summary, "_first", "_last", {"_before": "_n_key"})
    summary = _carry(summary, "_first_tie", "_last_tie", {"_tied": "_n_tie"})
    joined = local.join(summary.select(_BUCKET, "_first", "_first_tie", "_before", "_tied"), _BUCKET)
    began = F.when(tie.eqNullSafe(F.col("_first_tie")), F.lit(1) - F.col("_tied")).otherwise(F.col("_local"))
    rank = F.when(key.eqNullSafe(F.col("_first")), F.col("_before") + began).otherwise(F.col("_local"))
    return joined.select(*df.columns, rank.cast("long").alias(out))
