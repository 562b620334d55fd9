"""Exact, linearly interpolated quantiles computed across the cluster.

``percentile`` keeps every distinct value of a column in one aggregation
buffer.  Here a mergeable KLL sketch per column (:func:`sketch`) brackets each wanted
rank between two values; a second scan counts exactly how many values lie below
each bracket and up to its end, and a bracket side that missed its rank is opened.
Only the values inside the brackets, a few thousandths of all whatever their
distribution, are then counted one by one, and ranked by a running total over ranges of
values, so that no task holds a whole bracket.

Interpolation matches ``quantile_cont`` / pandas: for probability q over n
values the 0-based rank h = (n - 1) q, and the result is
v[floor h] + (h - floor h) * (v[ceil h] - v[floor h]).  Nulls and NaN are no values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.operators.ordinal import running_total_within

#: Size of a sketch, and the part of all values by which a bracket reaches beyond
#: the wanted rank on either side: several times the sketch's usual error (1 / 1000).
#: Results do not depend on them, only how many values are counted one by one.
SKETCH_SIZE, MARGIN = 2048, 0.004


def present(value: Column) -> Column:
    """``value`` as double, with NaN as null."""
    x = value.cast("double")
    return F.when(~F.isnan(x), x)


def sketch(value: Column) -> Column:
    """Aggregate: a KLL sketch of a double column (nulls ignored)."""
    return F.kll_sketch_agg_double(value, SKETCH_SIZE)


def brackets(sketched: Column, count: Column, probs: Sequence[float]) -> Column:
    """Array with, per probability, the two values between which the sketch
    sees the wanted rank (null without values)."""
    at = lambda p: F.kll_sketch_get_quantile_double(sketched, F.lit(min(max(float(p), 0.0), 1.0)))
    return F.when(count > 0, F.array(*[F.struct(at(p - MARGIN).alias("lo"), at(p + MARGIN).alias("hi")) for p in probs]))


def quantiles_between(df: DataFrame, columns: Mapping[str, Column], sides: Mapping[str, tuple[int, Sequence]],
                      probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of the double ``columns`` of ``df``: ``column_name, prob, quantile``.

    ``sides`` has for each column its number of values and the brackets of its
    quantiles, as sketched.  ``df`` is read twice: once to count what is below and up to
    each bracket (one row), once for the values inside."""
    spark = df.sparkSession
    wanted = [(name, p, (n - 1) * p, *side) for name, (n, found) in sides.items() if n for p, side in zip(probs, found)]
    result = "column_name string, prob double, quantile double"
    if not wanted:
        return spark.createDataFrame([], result)
    counted = df.agg(*[F.struct(F.count_if(columns[name] < lo).alias("below"), F.count_if(columns[name] <= hi).alias("upto")).alias(f"b{i}")
                       for i, (name, _, _, lo, hi) in enumerate(wanted)]).first()
    ranks, inside = [], []
    for i, (name, p, h, lo, hi) in enumerate(wanted):
        below, upto = counted[i]
        missed_low, missed_high = math.floor(h) < below, math.ceil(h) >= upto
        x = columns[name]
        keep = x.isNotNull() & (F.lit(True) if missed_low else x >= lo) & (F.lit(True) if missed_high else x <= hi)
        before = 0 if missed_low else below
        ranks.append((i, name, p, math.floor(h) - before, math.ceil(h) - before, h - math.floor(h)))
        inside.append(F.when(keep, F.struct(F.lit(i).alias("i"), x.alias("v"))))
    values = df.select(F.explode(F.filter(F.array(*inside), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counts = values.groupBy("i", "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_total_within(counts, ["i"], ["v"], "upto", weight="c")
    ranks = spark.createDataFrame(ranks, "i int, column_name string, prob double, low long, high long, mix double")
    at = lambda r: (F.col(r) >= F.col("upto") - F.col("c")) & (F.col(r) < F.col("upto"))
    found = ranked.join(ranks, "i").where(at("low") | at("high")).groupBy("column_name", "prob").agg(
        F.max(F.when(at("low"), F.col("v"))).alias("a"), F.max(F.when(at("high"), F.col("v"))).alias("b"), F.max("mix").alias("mix"))
    return found.select("column_name", "prob", (F.col("a") + F.col("mix") * (F.col("b") - F.col("a"))).alias("quantile"))


def exact_quantiles(long: DataFrame, probs: Sequence[float], key: str = "column_name", value: str = "value") -> DataFrame:
    """Quantiles of ``value`` per ``key`` for a long (key, value) frame with few
    keys (columns).  Returns (key, prob, quantile); a key with no value yields no
    rows.  ``long`` is read three times: sketches, counts, values inside the brackets."""
    rows = long.select(F.col(key).alias("_key"), present(F.col(value)).alias("_v"))
    seen = rows.groupBy("_key").agg(F.count("_v").alias("n"), sketch(F.col("_v")).alias("s")).select(
        "_key", "n", brackets(F.col("s"), F.col("n"), probs).alias("b")).collect()  # a row per key
    names = {str(i): r["_key"] for i, r in enumerate(seen)}
    columns = {i: F.when(F.col("_key").eqNullSafe(F.lit(k)), F.col("_v")) for i, k in names.items()}
    found = quantiles_between(rows, columns, {str(i): (r.n, r.b or []) for i, r in enumerate(seen)}, probs)
    kind = long.schema[key].dataType
    back = long.sparkSession.createDataFrame(list(names.items()), "column_name string, _key " + kind.simpleString())
    return found.join(back, "column_name").select(F.col("_key").alias(key), "prob", "quantile")
