"""Exploratory aggregates and top-k (AG1-AG8, AG12, TK1-TK4).

Every aggregate is a two-phase hash aggregate (partial before the shuffle,
final after), so a hot key is pre-combined on each task before it moves.
Shares divide by a scalar subquery: the total is computed once by Spark and
inlined as a value -- no join, no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.functions import labels as L
from actlens.functions.exprs import exact_pct
from actlens.functions.masks import count_bits, masks

#: Values of a domain up to which distinct counts use bit masks (a few longs per group).
MASK_CODES = 1008


def count_by(df: DataFrame, key: str, name: str = "count", ordered: bool = False) -> DataFrame:
    """AG1/AG3-AG6: rows per value of ``key``; ``ordered=True`` sorts most
    first, ties by key (a global sort: only when the ranking is the result)."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), F.asc(key)) if ordered else out


def with_share(counts: DataFrame, count_col: str = "count", name: str = "percentage",
               digits: int = L.SHARE_DIGITS) -> DataFrame:
    """AG2/AG7: add each row's percent of the column total (half-up digits)."""
    total = counts.select(F.sum(count_col)).scalar()
    # Bind the subquery once as a column; the rounding refers to it several times.
    return counts.withColumn("_total", total).withColumn(
        name, exact_pct(F.col(count_col), F.col("_total"), digits)
    ).drop("_total")


def domain_of(df: DataFrame, column: str, most: int = MASK_CODES) -> list | None:
    """The distinct non-null values of a small domain, in order; None if there are more than ``most``."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    return sorted(found) if len(found) <= most else None


def user_activity(df: DataFrame, approx: bool = False, rsd: float = 0.01, sessions: DataFrame | None = None,
                  ordered: bool = False, categories: Sequence | None = None) -> DataFrame:
    """AG8: per user total actions, distinct sessions, distinct categories (nulls are
    no values); ``ordered=True`` sorts the most active first, ties by user.

    Exact by default, without the Expand that two distinct counts cost: rows are grouped by
    user and session first, which makes sessions rows to count, and each such group carries
    its categories as a bit mask (a bit per value of the domain), merged by ``bit_or``.
    The domain is ``categories`` or, by default, is listed first; a domain of
    more than :data:`MASK_CODES` values is counted by Catalyst's rewrite.
    ``approx=True`` uses HyperLogLog sketches instead.  ``sessions`` (``user_id, total_sessions``)
    gives the session counts where they are known per user; ``df`` then needs
    no ``session_id``, and the two tables are joined user by user."""
    domain = None if approx else list(categories) if categories is not None else domain_of(df, "category")
    if sessions is not None:
        df = df.withColumn("session_id", F.lit(None).cast("string"))
    if domain is None:
        distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
        by_user = df.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("total_actions"), distinct("session_id").alias("total_sessions"),
            distinct("category").alias("categories_browsed"))
    else:
        held = masks("category", domain)
        by_session = df.groupBy("user_id", "session_id").agg(F.count(F.lit(1)).alias("_n"), *[m.alias(c) for c, m in held.items()])
        by_user = by_session.groupBy("user_id").agg(
            F.sum("_n").alias("total_actions"), F.count("session_id").alias("total_sessions"),
            *[F.bit_or(c).alias(c) for c in held]).select(
            "user_id", "total_actions", "total_sessions", count_bits(held).alias("categories_browsed"))
    if sessions is not None:
        by_user = by_user.drop("total_sessions").join(sessions.select("user_id", "total_sessions"), "user_id").select(
            "user_id", "total_actions", "total_sessions", "categories_browsed")
    return by_user.orderBy(F.desc("total_actions"), F.asc("user_id")) if ordered else by_user


def totals(df: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """AG12: distinct users, distinct sessions and events, one row.

    Exact by default (every distinct key is shuffled once); ``approx=True``
    merges HyperLogLog sketches instead (relative error ``rsd``)."""
    distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return df.agg(
        distinct("user_id").alias("total_users"),
        distinct("session_id").alias("total_sessions"),
        F.count(F.lit(1)).alias("total_events"),
    )


def peak(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """TK1-TK3: the value of ``key`` with most rows (lowest value on ties)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(key)).limit(1)


def top_users(df: DataFrame, n: int = 10, approx: bool = False, sessions: DataFrame | None = None,
              categories: Sequence | None = None) -> DataFrame:
    """TK4: the ``n`` most active users (ties by user id), from one pass over the
    events: a top-k of :func:`user_activity`."""
    return user_activity(df, approx, sessions=sessions, categories=categories).orderBy(F.desc("total_actions"), F.asc("user_id")).limit(n)
