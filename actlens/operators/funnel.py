"""Purchase funnel (AG10, FN1-FN6).

The user x action matrix is a single two-phase aggregate of conditional
counts (the same result as pivoting ``action`` over the three funnel
values, without the pivot's second aggregation and shuffle).  Reach and
conversion are one-row aggregates over the profile, unpivoted afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.functions import labels as L
from actlens.functions.exprs import count_of, exact_pct, half_even_div
from actlens.operators.anomaly import keys_of


def action_matrix(df: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """AG10: one row per entity with ``view_count``, ``cart_count`` and
    ``purchase_count`` (0 when absent; other actions count nowhere but keep
    the entity's row)."""
    return df.groupBy(*by).agg(*[count_of(a).alias(f"{a}_count") for a in L.ACTIONS])


def funnel_stage(
    matrix: DataFrame,
    complete: str = L.STAGE_COMPLETE,
    partial: str = L.STAGE_PARTIAL,
    browse: str = L.STAGE_BROWSE,
) -> DataFrame:
    """FN1: Complete with any purchase, else Partial with any cart, else Browse."""
    return matrix.withColumn(
        "funnel_stage",
        F.when(F.col("purchase_count") > 0, F.lit(complete))
        .when(F.col("cart_count") > 0, F.lit(partial))
        .otherwise(F.lit(browse)),
    )


def funnel_stage_summary(staged: DataFrame) -> DataFrame:
    """FN2: entities per stage, most first."""
    return staged.groupBy("funnel_stage").agg(F.count(F.lit(1)).alias("user_count")).orderBy(
        F.desc("user_count"), F.asc("funnel_stage")
    )


def funnel_reach(prof: DataFrame, percent_initial: bool = False, digits: int = L.SHARE_DIGITS) -> DataFrame:
    """FN3 (+FN4): entities with at least one view, cart and purchase,
    counted independently, as three rows (step, stage, users[, percent of
    the first stage])."""
    one = prof.agg(
        F.count_if(F.col("views") > 0).alias("v"),
        F.count_if(F.col("carts") > 0).alias("c"),
        F.count_if(F.col("purchases") > 0).alias("p"),
    )
    rows = [(1, L.REACH_VIEWED, "v"), (2, L.REACH_CARTED, "c"), (3, L.REACH_PURCHASED, "p")]
    fields = lambda step, stage, c: [
        F.lit(step).alias("step"),
        F.lit(stage).alias("stage"),
        F.col(c).alias("users"),
    ] + ([exact_pct(c, "v", digits).alias("percent_initial")] if percent_initial else [])
    return one.select(F.inline(F.array(*[F.struct(*fields(*r)) for r in rows])))


def conversion(prof: DataFrame) -> DataFrame:
    """FN5: view->cart and cart->purchase rates as whole percents (half-even,
    as Python's round); null when the earlier stage is empty."""
    one = prof.agg(
        F.count_if(F.col("views") > 0).alias("viewers"),
        F.count_if(F.col("carts") > 0).alias("carters"),
        F.count_if(F.col("purchases") > 0).alias("purchasers"),
    )

    def rate(num: str, den: str):
        return half_even_div(F.col(num) * 100, F.col(den))

    return one.select(
        "viewers", "carters", "purchasers",
        rate("carters", "viewers").alias("view_to_cart_rate"),
        rate("purchasers", "carters").alias("cart_to_purchase_rate"),
    )


def stacked_actions(prof: DataFrame, ordered: bool = False) -> DataFrame:
    """FN6: per-entity views / carts / purchases in long form (action, n);
    ``ordered=True`` sorts the most active entities first, ties by key."""
    keys = keys_of(prof)
    ids = keys + (["total_actions"] if "total_actions" in prof.columns else [])
    out = prof.unpivot(ids, ["views", "carts", "purchases"], "action", "n")
    return out.orderBy(F.desc("total_actions"), *keys, "action") if ordered else out
