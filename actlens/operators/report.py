"""Whole-table reports: schema profile (IO2), KPI summary (AG13) and the
per-column describe table (AG14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actlens.functions import labels as L
from actlens.functions.exprs import epoch_micros, exact_pct, time_text
from actlens.operators.quantiles import brackets, present, quantiles_between, sketch
from actlens.sources.scratch import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)
QUANTILES = (0.25, 0.5, 0.75)


def schema_profile(df: DataFrame) -> DataFrame:
    """IO2: one row per column (position, name, type) with the table's row and
    column counts.  The row count is a scalar subquery over the data."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    listing = spark.createDataFrame(rows, "position int, column_name string, data_type string")
    return listing.withColumn("n_rows", df.select(F.count(F.lit(1))).scalar()).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("int")
    )


def summary(df: DataFrame, prof: DataFrame, normal: str = L.FLAG_NORMAL, approx: bool = False,
            unit: str = "users") -> DataFrame:
    """AG13: events, users, sessions, normal and anomalous entities of the
    profile (named by ``unit``), anomaly rate (percent, 1 digit), peak hour and
    peak weekday -- one row, one plan.

    One two-phase aggregate of the events, by hour and by weekday side by side (a row per value,
    however many values the columns have), gives the events and both peaks.
    Users and flags come from the profile; sessions too
    where it has ``total_sessions`` per entity, else they are counted from
    ``df`` (``approx=True``: with sketches).  Peaks take the lowest value on ties."""
    sides = df.select(F.explode(F.array(
        F.struct(F.lit("hour").alias("of"), F.col("hour"), F.lit(None).cast("string").alias("day")),
        F.struct(F.lit("day").alias("of"), F.lit(None).cast(df.schema["hour"].dataType).alias("hour"),
                 F.col("day_of_week").cast("string").alias("day")))).alias("x")).select("x.*")
    ranked = sides.groupBy("of", "hour", "day").agg(F.count(F.lit(1)).alias("n"))
    peak = lambda of: F.min(F.when(F.col("of") == of, F.struct((-F.col("n")).alias("neg"), F.col(of).alias("v"))))["v"]
    cells = ranked.agg(F.sum(F.when(F.col("of") == "hour", F.col("n"))).alias("events"),
                       peak("hour").alias("peak_hour"), peak("day").alias("peak_day"))
    distinct = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.count_distinct
    own_sessions = "total_sessions" in prof.columns
    flags = prof.agg(F.struct(
        F.count_if(F.col("anomaly_flag") == normal).alias("normal"),
        F.count_if(F.col("anomaly_flag") != normal).alias("anomalous"),
        F.count(F.lit(1)).alias("entities"),
        (F.count(F.lit(1)) if unit == "users" else distinct("user_id")).alias("users"),
        (F.sum("total_sessions") if own_sessions else F.lit(None).cast("long")).alias("sessions"))).scalar()
    one = cells.withColumn("_flags", flags)
    if not own_sessions:
        one = one.withColumn("_sessions", df.agg(distinct("session_id")).scalar())
    sessions = F.col("_flags.sessions") if own_sessions else F.col("_sessions")
    return one.select(
        F.coalesce("events", F.lit(0)).alias("total_events"), F.col("_flags.users").alias("total_users"),
        F.coalesce(sessions, F.lit(0)).alias("total_sessions"),
        F.col("_flags.normal").alias(f"normal_{unit}"), F.col("_flags.anomalous").alias(f"anomalous_{unit}"),
        *([] if unit == "users" else [F.col("_flags.entities").alias(f"total_{unit}")]),
        exact_pct(F.col("_flags.anomalous"), F.col("_flags.entities"), 1).alias("anomaly_rate"),
        F.col("peak_hour").cast("int").alias("peak_hour"), "peak_day")


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, NUMERIC):
        return "numeric"
    if isinstance(dtype, TEMPORAL):
        return "datetime"
    return "text"


#: Characters of a text that are counted as they are; longer ones by these and a hash.
HEAD = 64


def _text_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, count, unique, top, freq`` of text columns with a value.

    Values are counted by their first :data:`HEAD` characters and, only if there are
    more, 128 bits of a hash, so that long texts are never shuffled.  The counts that
    ``unique`` needs anyway also give ``freq``.  ``top`` is the lowest of the most
    frequent values: its head is known then, and only where that head is not yet the whole
    value, the values that begin with it are counted whole."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                         for c in columns])).alias("x")).select("x.*").where("value is not null")
    head, more = F.left("value", F.lit(HEAD)), F.char_length("value") > HEAD
    rest = F.when(more, F.struct(F.xxhash64("value").alias("a"), F.xxhash64(F.lit(7), "value").alias("b")))
    counts = long.groupBy("column_name", head.alias("head"), rest.alias("rest")).agg(F.count(F.lit(1)).alias("n"))
    found = materialize(counts.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("head"), F.col("rest").isNotNull().alias("more"))).alias("t"),
    ).select("column_name", "count", "unique", "t.head", "t.more", (-F.col("t.neg")).alias("freq")), "texts")
    # A whole value stands before longer ones with the same head, so it is the lowest.
    open_ = found.where("more").select("column_name", "head", "freq").collect()  # at most a row per column
    if not open_:
        return found.select("column_name", "count", "unique", F.col("head").alias("top"), "freq")
    picked = F.lit(False)
    for r in open_:
        picked = picked | ((F.col("column_name") == r.column_name) & (head == F.lit(r["head"])) & more)
    tops = long.where(picked).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("column_name").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("t")).select("column_name", F.col("t.value").alias("top"))
    return found.join(tops, "column_name", "left").select(
        "column_name", "count", "unique", F.coalesce("top", "head").alias("top"), "freq")


def describe_all(df: DataFrame, display: bool = False, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """AG14: pandas ``describe(include="all")``, one row per column of ``df``
    (also of an empty one: count 0).

    count for every column; unique, top (most frequent, lowest value on ties)
    and freq for text; mean, min, 25/50/75 % and max for numeric and datetime
    columns (datetimes as epoch seconds); std (sample) for numeric only.  As in pandas, NaN
    is a missing value.  ``display=True`` renders every cell as text, a missing one as an em dash.

    Exact, in four scans: numeric columns are one aggregate of single rows, with the sketches that
    bracket the quantiles (:mod:`.quantiles`, two more scans); text columns are counted
    by value (:func:`_text_statistics`).  What reaches the driver is a row per column.
    ``approx=True`` keeps memory bounded whatever the data:
    sketches for unique, top and freq (``approx_top_k``) and quantiles
    (``percentile_approx``, no interpolation), one aggregate, one row a column."""
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
    text_cols = [c for c, k in kinds.items() if k == "text"]
    num_cols = [c for c, k in kinds.items() if k != "text"]
    time_cols = [c for c, k in kinds.items() if k == "datetime"]

    def micros(c):
        dtype = df.schema[c].dataType
        return epoch_micros(F.col(c).cast("timestamp_ntz") if isinstance(dtype, (T.DateType, T.TimestampType)) else F.col(c))

    def number(c):
        if kinds[c] == "datetime":
            return micros(c).cast("double") / F.lit(1_000_000.0)
        return present(F.col(c)) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c).cast("double")

    # One row for the whole table: every number's moments and sketch (and, approximately, the rest).
    aggs = []
    for i, c in enumerate(num_cols):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        if kinds[c] == "datetime":
            aggs.append(F.sum(micros(c).cast("decimal(38,0)")).alias(f"us{i}"))
        aggs.append(F.percentile_approx(x, list(QUANTILES), accuracy).alias(f"q{i}") if approx else sketch(x).alias(f"sketch{i}"))
    if approx:
        for i, c in enumerate(text_cols):
            x = F.col(c).cast("string")
            aggs += [F.count(c).alias(f"tn{i}"), F.approx_count_distinct(x).alias(f"tu{i}"),
                     F.filter(F.expr(f"approx_top_k(cast(`{c}` as string), 2)"), lambda e: e["item"].isNotNull()).alias(f"tt{i}")]

    def mean(i, c):
        if kinds[c] != "datetime":
            return F.col(f"mean{i}")
        # Total microseconds / count, rounded half-up to a whole microsecond on
        # integers (exact at any row count), then in seconds.
        a = F.col(f"us{i}") * 2 + F.col(f"n{i}").cast("decimal(38,0)")
        b = F.col(f"n{i}").cast("decimal(38,0)") * 2
        return F.when(F.col(f"n{i}") > 0, (F.try_divide(a - F.pmod(a, F.when(b > 0, b)), b) / F.lit(1_000_000)).cast("double"))

    null = lambda kind: F.lit(None).cast(kind)
    rows = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), mean(i, c).alias("mean"),
        (null("double") if kinds[c] == "datetime" else F.col(f"std{i}")).alias("std"), F.col(f"min{i}").alias("min"),
        F.col(f"max{i}").alias("max"),
        *([F.col(f"q{i}")[j].alias(p) for j, p in enumerate(("p25", "p50", "p75"))] if approx else
          [brackets(F.col(f"sketch{i}"), F.col(f"n{i}"), QUANTILES).alias("sides")]))
        for i, c in enumerate(num_cols)]
    one = df.agg(*aggs) if aggs else None
    shape = "column_name string, count long, mean double, std double, min double, max double, p25 double, p50 double, p75 double"
    numeric = one.select(F.inline(F.array(*rows))) if rows else df.sparkSession.createDataFrame([], shape)
    if approx:
        texts = [F.struct(F.lit(c).alias("column_name"), F.col(f"tn{i}").alias("count"), F.col(f"tu{i}").alias("unique"),
                          F.try_element_at(f"tt{i}", F.lit(1))["item"].alias("top"),
                          F.try_element_at(f"tt{i}", F.lit(1))["count"].alias("freq")) for i, c in enumerate(text_cols)]
        text = one.select(F.inline(F.array(*texts))) if texts else None
    else:
        if num_cols:
            # A row per column, used twice: for the brackets and in the result.
            numeric = materialize(numeric, "moments")
            sides = {r.column_name: (r["count"], r.sides) for r in numeric.collect()}
            at = quantiles_between(df, {c: number(c) for c in num_cols}, sides, QUANTILES).groupBy("column_name").agg(*[
                F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in zip(QUANTILES, ("p25", "p50", "p75"))])
            numeric = numeric.drop("sides").join(at, "column_name", "left")
        text = _text_statistics(df, text_cols) if text_cols else None

    cols = ["column_name", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"]
    listing = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    found = numeric if text is None else text.unionByName(numeric, allowMissingColumns=True)
    for c in ("unique", "top", "freq"):
        found = found if c in found.columns else found.withColumn(c, null("string" if c == "top" else "long"))
    empty_text = F.col("column_name").isin(*text_cols) if text_cols else F.lit(False)
    out = listing.join(found, "column_name", "left").select(
        "column_name", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        F.coalesce("unique", F.when(empty_text, 0)).cast("long").alias("unique"),
        F.col("top").cast("string").alias("top"), F.col("freq").cast("long").alias("freq"),
        *[F.col(c).cast("double").alias(c) for c in cols[5:]])
    if display:
        # Datetime statistics are shown as timestamps, as pandas does; epoch
        # seconds are turned back by interval arithmetic, free of time zones.
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        is_dt = F.col("column_name").isin(*time_cols) if time_cols else F.lit(False)

        def shown(c: str):
            text = F.col(c).cast("string")
            if c in ("mean", "min", "p25", "p50", "p75", "max"):
                as_time = time_text(epoch + F.make_dt_interval(secs=F.col(c).cast("decimal(18,6)")))
                text = F.when(is_dt, as_time).otherwise(text)
            return F.coalesce(text, F.lit("—")).alias(c)

        out = out.select(*[shown(c) for c in cols])
    return out
