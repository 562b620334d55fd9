"""Per-entity behaviour profile and anomaly rules (AG9, AG11, AN1-AN7,
TK5, TK6, PR10).

An *entity* is a user by default; ``by`` may add more grain (for example
user and week).  The profile is one two-phase aggregate with conditional
counts -- no Python per row.  The hyperactivity threshold is a scalar
subquery over the profile, so the whole rule is one plan without a driver
round trip or a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.functions import labels as L
from actlens.functions.exprs import count_of, exact_pct, exact_ratio
from actlens.operators.explore import count_by, user_activity, with_share
from actlens.sources.scratch import materialize as _materialize

METRICS = ("views", "carts", "purchases", "total_actions", "view_purchase_ratio", "anomaly_flag", "behavior_type")


def keys_of(prof: DataFrame) -> list[str]:
    """Entity key columns of a profile: every column that is not a metric."""
    return [c for c in prof.columns if c not in METRICS]


def user_behavior(df: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """AG9: views, carts, purchases and all actions per entity."""
    return df.groupBy(*by).agg(
        count_of(L.VIEW).alias("views"),
        count_of(L.CART).alias("carts"),
        count_of(L.PURCHASE).alias("purchases"),
        F.count(F.lit(1)).alias("total_actions"),
    )


def with_ratio(prof: DataFrame, digits: int = L.RATIO_DIGITS) -> DataFrame:
    """AN1: views / purchases rounded half-up; the views themselves when there
    is no purchase.  Always DOUBLE."""
    return prof.withColumn(
        "view_purchase_ratio",
        F.when(F.col("purchases") == 0, F.col("views").cast("double")).otherwise(
            exact_ratio("views", "purchases", digits)
        ),
    )


def flag_anomalies(
    prof: DataFrame,
    min_views: int = L.MIN_VIEWS_NO_PURCHASE,
    max_ratio: float = L.MAX_VIEW_RATIO,
    digits: int = L.RATIO_DIGITS,
    high: str = L.FLAG_HIGH,
    moderate: str = L.FLAG_MODERATE,
    normal: str = L.FLAG_NORMAL,
) -> DataFrame:
    """AN2: HIGH when views >= min_views and no purchase; MODERATE when the
    rounded ratio exceeds max_ratio with purchases; else NORMAL."""
    if "view_purchase_ratio" not in prof.columns:
        prof = with_ratio(prof, digits)
    return prof.withColumn(
        "anomaly_flag",
        F.when((F.col("views") >= min_views) & (F.col("purchases") == 0), F.lit(high))
        .when((F.col("view_purchase_ratio") > max_ratio) & (F.col("purchases") > 0), F.lit(moderate))
        .otherwise(F.lit(normal)),
    )


def profile(df: DataFrame, by: Sequence[str] = ("user_id",), **rules) -> DataFrame:
    """AG9 + AN1 + AN2: the flagged behaviour profile."""
    return flag_anomalies(user_behavior(df, by), **rules)


def user_stats(df: DataFrame, categories: Sequence | None = None, **rules) -> DataFrame:
    """The combined per-user table: actions by kind, distinct categories and sessions, ratio and flag."""
    return profile(df, **rules).join(user_activity(df, categories=categories).drop("total_actions"), "user_id").select(
        "user_id", "total_actions", "views", "carts", "purchases", "categories_browsed", "total_sessions",
        "view_purchase_ratio", "anomaly_flag")


def flagged(prof: DataFrame, normal: str = L.FLAG_NORMAL) -> DataFrame:
    """AN3: only entities with a non-normal flag."""
    return prof.filter(F.col("anomaly_flag") != normal)


def anomaly_totals(prof: DataFrame, normal: str = L.FLAG_NORMAL, digits: int = 1,
                   rounding: str = "half_up") -> DataFrame:
    """AN4: flagged, normal and all entities, and the anomaly rate in percent
    (null when there is no entity).  The batch report shows one digit; the
    dashboard card a whole percent rounded half to even
    (``digits=0, rounding="half_even"``)."""
    return prof.agg(
        F.count_if(F.col("anomaly_flag") != normal).alias("anomalous_users"),
        F.count_if(F.col("anomaly_flag") == normal).alias("normal_users"),
        F.count(F.lit(1)).alias("total_users"),
    ).withColumn("anomaly_rate", exact_pct("anomalous_users", "total_users", digits, rounding))


def flag_counts(prof: DataFrame) -> DataFrame:
    """AN5: entities per flag with their share."""
    return with_share(count_by(prof, "anomaly_flag"), "count", "percentage")


def views_threshold(prof: DataFrame, k: float = L.STDDEV_K) -> DataFrame:
    """AG11: mean and sample standard deviation of views, and mean + k * std
    (null with fewer than two entities), as a one-row frame."""
    return prof.agg(
        F.mean("views").alias("mean_views"),
        F.stddev_samp("views").alias("std_views"),
    ).withColumn("threshold", F.col("mean_views") + F.lit(float(k)) * F.col("std_views"))


def label_hyperactive(
    prof: DataFrame,
    k: float = L.STDDEV_K,
    suspected: str = L.BEHAVIOR_SUSPECTED,
    normal: str = L.BEHAVIOR_NORMAL,
    materialize: bool = False,
) -> DataFrame:
    """AN6: label entities whose views exceed mean + k * std.  The threshold is
    a scalar subquery; a null threshold labels nobody.

    The profile is read twice (threshold and labels).  ``materialize=True``
    writes it once to the checkpoint folder first, so the events are
    aggregated once -- worth it when the events are large and the profile
    (one row per entity) is not."""
    if materialize:
        prof = _materialize(prof)
    threshold = views_threshold(prof, k).select("threshold").scalar()
    return prof.withColumn(
        "behavior_type",
        F.when(F.col("views") > threshold, F.lit(suspected)).otherwise(F.lit(normal)),
    )


def hyperactive(prof: DataFrame, k: float = L.STDDEV_K, normal: str = L.BEHAVIOR_NORMAL,
                materialize: bool = False) -> DataFrame:
    """AN7: only the entities suspected of hyperactivity."""
    labelled = label_hyperactive(prof, k, normal=normal, materialize=materialize)
    return labelled.filter(F.col("behavior_type") != normal)


def behavior_report(prof: DataFrame, n: int = 20) -> DataFrame:
    """TK5: the ``n`` entities with most views (ties by key), a top-k."""
    keys = keys_of(prof)
    return prof.orderBy(F.desc("views"), *[F.asc(c) for c in keys]).limit(n)


def anomaly_report(prof: DataFrame) -> DataFrame:
    """TK6: every entity with its counts, ratio and flag, ordered by flag."""
    keys = keys_of(prof)
    return prof.select(*keys, "views", "carts", "purchases", "view_purchase_ratio", "anomaly_flag").orderBy(
        "anomaly_flag", *keys
    )


def user_points(prof: DataFrame) -> DataFrame:
    """PR10: per-entity points of the views/purchases scatter."""
    keys = keys_of(prof)
    return prof.select(*keys, "views", "purchases", "anomaly_flag", "total_actions")
