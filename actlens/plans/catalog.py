"""Named analyses over a scale-factor folder of parquet tables.

Every entry reads ``events`` through the activity adapter (so its work grows
with the table) and returns a DataFrame without collecting it.  Column names
are aliased to match :mod:`actlens.plans.oracle`.

Grain: totals, reach, conversion and the summary are per user, as in the
reference; their ``*_by_week`` entries run per (user, week) and name what they
count ``entities``.  The anomaly, funnel-stage and hyperactivity listings run
per (user, week), because in the test tables every user buys at some point,
which would leave those rules with nothing to find; the ``*_by_user`` entries
run them per user.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.operators import anomaly as an
from actlens.operators import explore as ex
from actlens.operators import funnel as fn
from actlens.operators import prepare as pr
from actlens.operators import report as rp
from actlens.operators import sequence as sq
from actlens.sources.csv import read_activity, write_csv
from actlens.sources.events import CATEGORIES, activity, user_totals
from actlens.sources.schema import ACTIVITY_COLUMNS
from actlens.sources.scratch import scratch_path
from actlens.sources.store import add_days, read_days, read_prepared, save_prepared

GRAIN = ("user_id", "week")

# Parameters of the registered filter / search examples.
FILTER_ACTIONS = ("view", "purchase")
FILTER_CATEGORIES = ("C0", "C2", "C4")
FILTER_DEVICES = ("mobile", "tablet")
SEARCH_TERM = "12"
COVERAGE = dict(actions=("view", "cart"), categories=None, devices=("desktop", "mobile"), term="3")
EXPORT = dict(actions=("view", "cart", "purchase"), categories=("C0", "C1", "C2", "C3"),
              devices=("mobile", "tablet"), term="1")
NULL_CATEGORY_MOD = 17      # the null-cleaning examples null category where k % 17 = 0
SEQUENCE_SEGMENT = 100_000  # events in one row of a session's text sequence
SHORT_SEGMENT = 3           # the same for the entry that shows segments
MALFORMED_TIME_MOD = 23     # the parsing example garbles time where k % 23 = 0
BAD_HOUR_MOD = 29           # the rejects example writes text as hour where k % 29 = 0


def _act(spark: SparkSession, sf: str, sessions: bool = False) -> DataFrame:
    """Prepared activity rows.  The adapter already drops incomplete events
    on their source columns, so only the time parsing step remains."""
    return pr.parse_time(activity(spark, sf, sessions=sessions))


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    return _act(spark, sf).withColumn("week", F.trunc(F.to_date("time"), "week"))


def _prof(spark: SparkSession, sf: str) -> DataFrame:
    return an.profile(_weekly(spark, sf), by=GRAIN)


def _users(spark: SparkSession, sf: str) -> DataFrame:
    """Per-user profile with session counts: one scan, no join of events."""
    return an.flag_anomalies(user_totals(activity(spark, sf, sessions=False)))


def _per_user(spark: SparkSession, sf: str) -> DataFrame:
    return an.profile(_act(spark, sf))


def _with_null_category(spark: SparkSession, sf: str) -> DataFrame:
    act = activity(spark, sf, sessions=False)
    return act.withColumn(
        "category", F.when(F.col("k") % NULL_CATEGORY_MOD == 0, F.lit(None)).otherwise(F.col("category"))
    )


# ---------------------------------------------------------------- sources
def src_csv_scan(spark, sf):
    raw = activity(spark, sf, sessions=True, raw_time=True).select(*ACTIVITY_COLUMNS)
    path = write_csv(raw, scratch_path(spark, "activity-csv") + "/data")
    return pr.parse_time(read_activity(spark, path))


def src_profile(spark, sf):
    return rp.schema_profile(pr.parse_time(activity(spark, sf, sessions=True).select(*ACTIVITY_COLUMNS)))


def sink_csv(spark, sf):
    act = activity(spark, sf, sessions=True, raw_time=True).select(*ACTIVITY_COLUMNS)
    chosen = act.filter(pr.selection(**EXPORT))
    path = write_csv(chosen, scratch_path(spark, "export-csv") + "/data")
    return pr.parse_time(read_activity(spark, path))


def reuse_cached(spark, sf):
    """Two results from one prepared table that is written once (and removed
    when the application ends): events and sessions per action."""
    columns = ["user_id", "session_id", "action", "time"]
    path = save_prepared(_act(spark, sf, sessions=True).select(*columns), scratch_path(spark, "prepared") + "/data")
    stored = read_prepared(spark, path)
    events = ex.count_by(stored, "action", "n").select(F.lit("events").alias("result"), "action", "n")
    sessions = ex.count_by(stored.select("session_id", "action").distinct(), "action", "n")
    return events.union(sessions.select(F.lit("sessions").alias("result"), "action", "n"))


def prepared_by_day(spark, sf):
    """A store filled in three loads of every third day, the last of them late: each day is
    sessionised alone, and the sessions are those of one load."""
    act, path = _act(spark, sf), scratch_path(spark, "store") + "/data"
    day = F.pmod(F.date_diff(F.to_date("time"), F.lit("1970-01-01").cast("date")), F.lit(3))
    for load in (0, 2, 1):
        add_days(act.select("event_id", "user_id", "action", "time").where(day == load), path)
    return read_days(spark, path).groupBy("user_id", "session_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("time").alias("started"), F.max("time").alias("ended"))


# ---------------------------------------------------------- preparation
def prep_timestamp(spark, sf):
    raw = activity(spark, sf, sessions=False, raw_time=True)
    garbled = F.concat(F.col("time").substr(9, 2), F.lit("/"), F.col("time").substr(6, 2), F.lit("/"),
                       F.col("time").substr(1, 4))
    raw = raw.withColumn("time", F.when(F.col("k") % MALFORMED_TIME_MOD == 0, garbled).otherwise(F.col("time")))
    return pr.parse_time(raw).select("event_id", "time")


def prep_drop_nulls(spark, sf):
    return pr.drop_incomplete(_with_null_category(spark, sf)).select(
        "event_id", "user_id", "action", "category", "device", "time", "hour")


def prep_drop_report(spark, sf):
    return pr.cleaning_report(_with_null_category(spark, sf))


def prep_calendar(spark, sf):
    return pr.add_calendar(_act(spark, sf)).select("event_id", "date", "hour_extracted", "month")


def filter_multi(spark, sf):
    return pr.filter_activity(_act(spark, sf), FILTER_ACTIONS, FILTER_CATEGORIES, FILTER_DEVICES).select(
        "event_id", "user_id", "action", "category", "device")


def filter_stored(spark, sf):
    """PR5 over the stored layout: the values are pushed to the scan, row groups are skipped."""
    columns = ["event_id", "user_id", "action", "category", "device"]
    path = save_prepared(_act(spark, sf).select(*columns, "time"), scratch_path(spark, "prepared") + "/data")
    return pr.filter_activity(read_prepared(spark, path), FILTER_ACTIONS, FILTER_CATEGORIES, FILTER_DEVICES).select(*columns)


def _raw_with_faults(spark, sf):
    """Activity CSV in which some lines are no valid CSV of the schema, some times are no
    times and some categories are missing, read with the reader's corrupt lines."""
    act = activity(spark, sf, sessions=False, raw_time=True).withColumn("session_id", F.concat(F.lit("s"), "user_id"))
    faulty = act.withColumn("hour", F.when(F.col("k") % BAD_HOUR_MOD == 0, F.lit("noon")).otherwise(F.col("hour").cast("string"))).withColumn(
        "time", F.when(F.col("k") % MALFORMED_TIME_MOD == 0, F.regexp_replace("time", "-", "/")).otherwise(F.col("time"))).withColumn(
        "category", F.when(F.col("k") % NULL_CATEGORY_MOD != 0, F.col("category")))
    path = write_csv(faulty.select(*ACTIVITY_COLUMNS), scratch_path(spark, "faulty-csv") + "/data")
    return pr.with_reject_reason(read_activity(spark, path, keep_corrupt=True))


def prep_reject_report(spark, sf):
    return pr.reject_report(_raw_with_faults(spark, sf))


def prep_rejects(spark, sf):
    """The rejected rows themselves, as read, with their reason."""
    return pr.rejects(_raw_with_faults(spark, sf)).select("user_id", "action", "product_id", "device", "time", "reject_reason")


def filter_domains(spark, sf):
    return pr.domains(_act(spark, sf))


def user_search(spark, sf):
    return pr.search_users(_act(spark, sf), SEARCH_TERM).select("event_id", "user_id", "action")


def preview_rows(spark, sf):
    return pr.preview(_act(spark, sf), 10)


def filter_coverage(spark, sf):
    return pr.coverage(_act(spark, sf), **COVERAGE)


def user_points(spark, sf):
    return an.user_points(_prof(spark, sf))


# ---------------------------------------------------------- aggregations
def action_counts(spark, sf):
    return ex.count_by(_act(spark, sf), "action", "total_count", ordered=True)


def action_share(spark, sf):
    return ex.with_share(ex.count_by(_act(spark, sf), "action", "total_count"), "total_count")


def hour_counts(spark, sf):
    return ex.count_by(_act(spark, sf), "hour", "activity_count", ordered=True)


def weekday_counts(spark, sf):
    return ex.count_by(_act(spark, sf), "day_of_week", "activity_count", ordered=True)


def category_counts(spark, sf):
    return ex.count_by(_act(spark, sf), "category", "interactions", ordered=True)


def device_counts(spark, sf):
    return ex.count_by(_act(spark, sf), "device", "count")


def device_share(spark, sf):
    return ex.with_share(ex.count_by(_act(spark, sf), "device", "count"), "count")


def user_activity(spark, sf):
    """From the per-user totals of the adapter: one scan, no join."""
    return _users(spark, sf).select("user_id", "total_actions", "total_sessions", "categories_browsed").orderBy(
        F.desc("total_actions"), F.asc("user_id"))


def user_activity_rows(spark, sf):
    """The same from activity rows that name their session, as a CSV has them."""
    return ex.user_activity(_act(spark, sf, sessions=True), categories=CATEGORIES)


def user_behavior(spark, sf):
    return an.user_behavior(_act(spark, sf))


def user_action_matrix(spark, sf):
    return fn.action_matrix(_act(spark, sf))


def views_threshold(spark, sf):
    t = an.views_threshold(_prof(spark, sf))
    return t.select(*[F.round(c, 6).alias(c) for c in ("mean_views", "std_views", "threshold")])


def distinct_totals(spark, sf):
    return _users(spark, sf).agg(
        F.count("user_id").alias("total_users"), F.coalesce(F.sum("total_sessions"), F.lit(0)).alias("total_sessions"),
        F.coalesce(F.sum("total_actions"), F.lit(0)).alias("total_events"))


def summary_kpis(spark, sf):
    return rp.summary(_act(spark, sf), _users(spark, sf))


def summary_kpis_by_week(spark, sf):
    return rp.summary(_act(spark, sf, sessions=True), _prof(spark, sf), unit="entities")


def _described(df):
    d = rp.describe_all(df)
    return d.select(*[F.round(c, 6).alias(c) if c in ("mean", "std", "min", "p25", "p50", "p75", "max") else c
                      for c in d.columns])


def describe_all(spark, sf):
    return _described(_act(spark, sf, sessions=True).select(*ACTIVITY_COLUMNS))


def describe_missing(spark, sf):
    """Columns without any value are described too."""
    act = _act(spark, sf).select("event_id", "action", "hour")
    return _described(act.withColumn("coupon", F.when(F.col("hour") < 0, F.col("action"))).withColumn(
        "discount", F.when(F.col("hour") < 0, F.col("hour"))))


# ----------------------------------------------------------- top-k
def peak_hour(spark, sf):
    return ex.peak(_act(spark, sf), "hour", "activity_count")


def peak_weekday(spark, sf):
    return ex.peak(_act(spark, sf), "day_of_week", "activity_count")


def top_action(spark, sf):
    return ex.peak(_act(spark, sf), "action", "total_count")


def top_users(spark, sf):
    return user_activity(spark, sf).limit(10)


def behavior_report(spark, sf):
    return an.behavior_report(_prof(spark, sf), 20)


def anomaly_report(spark, sf):
    return an.anomaly_report(_prof(spark, sf))


# ----------------------------------------------------- session windows
def session_rank(spark, sf):
    act = _act(spark, sf, sessions=True).select("event_id", "session_id", "time")
    return sq.session_rank(act).select("event_id", "session_id", "action_rank")


def session_row_number(spark, sf):
    act = _act(spark, sf, sessions=True).select("event_id", "session_id", "time")
    return sq.session_position(act).select("event_id", "session_id", "rn")


def session_events(spark, sf):
    return sq.session_events(_act(spark, sf, sessions=True))


def session_sequences(spark, sf):
    return sq.session_sequences(_act(spark, sf, sessions=True), SEQUENCE_SEGMENT)


def session_sequence_segments(spark, sf):
    return sq.session_sequences(_act(spark, sf, sessions=True), SHORT_SEGMENT)


def complete_funnel_sessions(spark, sf):
    return sq.complete_sessions(_act(spark, sf, sessions=True))


def complete_funnel_count(spark, sf):
    return sq.complete_session_count(_act(spark, sf, sessions=True))


# --------------------------------------------------------------- funnel
def funnel_stage(spark, sf):
    return fn.funnel_stage(fn.action_matrix(_weekly(spark, sf), by=GRAIN))


def funnel_stage_summary(spark, sf):
    return fn.funnel_stage_summary(funnel_stage_by_user(spark, sf))


def funnel_stage_summary_by_week(spark, sf):
    return fn.funnel_stage_summary(funnel_stage(spark, sf)).withColumnRenamed("user_count", "entities")


def funnel_reach(spark, sf):
    return fn.funnel_reach(_per_user(spark, sf))


def funnel_reach_by_week(spark, sf):
    return fn.funnel_reach(_prof(spark, sf)).withColumnRenamed("users", "entities")


def funnel_percent_initial(spark, sf):
    return fn.funnel_reach(_per_user(spark, sf), percent_initial=True)


def funnel_percent_initial_by_week(spark, sf):
    return fn.funnel_reach(_prof(spark, sf), percent_initial=True).withColumnRenamed("users", "entities")


def funnel_conversion(spark, sf):
    return fn.conversion(_per_user(spark, sf))


def funnel_conversion_by_week(spark, sf):
    out = fn.conversion(_prof(spark, sf))
    return out.withColumnsRenamed({c: f"{c}_entities" for c in ("viewers", "carters", "purchasers")})


def stacked_actions(spark, sf):
    return fn.stacked_actions(_prof(spark, sf), ordered=True)


def user_stats(spark, sf):
    """The combined per-user table: actions by kind, categories, sessions, ratio, flag."""
    return _users(spark, sf).select(
        "user_id", "total_actions", "views", "carts", "purchases", "categories_browsed", "total_sessions",
        "view_purchase_ratio", "anomaly_flag")


# -------------------------------------------------------------- anomaly
def view_purchase_ratio(spark, sf):
    return an.with_ratio(an.user_behavior(_weekly(spark, sf), by=GRAIN))


def anomaly_flag(spark, sf):
    return _prof(spark, sf)


def flagged_users(spark, sf):
    return an.flagged(_prof(spark, sf))


def anomaly_totals(spark, sf):
    return an.anomaly_totals(_per_user(spark, sf))


def anomaly_totals_by_week(spark, sf):
    return an.anomaly_totals(_prof(spark, sf)).withColumnsRenamed(
        {f"{c}_users": f"{c}_entities" for c in ("anomalous", "normal", "total")})


def flag_counts(spark, sf):
    return an.flag_counts(_prof(spark, sf))


def behavior_type(spark, sf):
    return an.label_hyperactive(_prof(spark, sf), materialize=True)


def hyperactive_users(spark, sf):
    return an.hyperactive(_prof(spark, sf), materialize=True)


# ------------------------------------------- the reference's per-user grain
def anomaly_flag_by_user(spark, sf):
    return an.profile(_act(spark, sf))


def funnel_stage_by_user(spark, sf):
    return fn.funnel_stage(fn.action_matrix(_act(spark, sf)))


def behavior_type_by_user(spark, sf):
    return an.label_hyperactive(an.profile(_act(spark, sf)), materialize=True)


def anomaly_totals_by_user(spark, sf):
    return an.anomaly_totals(an.profile(_act(spark, sf)))


def views_threshold_by_user(spark, sf):
    t = an.views_threshold(an.profile(_act(spark, sf)))
    return t.select(*[F.round(c, 6).alias(c) for c in ("mean_views", "std_views", "threshold")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        src_csv_scan, src_profile, sink_csv, reuse_cached,
        prep_timestamp, prep_drop_nulls, prep_drop_report, prep_calendar, filter_multi, filter_domains,
        user_search, preview_rows, filter_coverage, user_points,
        action_counts, action_share, hour_counts, weekday_counts, category_counts, device_counts,
        device_share, user_activity, user_behavior, user_action_matrix, views_threshold, distinct_totals,
        summary_kpis, describe_all,
        peak_hour, peak_weekday, top_action, top_users, behavior_report, anomaly_report,
        session_rank, session_row_number, session_events, session_sequences, complete_funnel_sessions,
        complete_funnel_count,
        funnel_stage, funnel_stage_summary, funnel_reach, funnel_percent_initial, funnel_conversion,
        stacked_actions,
        view_purchase_ratio, anomaly_flag, flagged_users, anomaly_totals, flag_counts, behavior_type,
        hyperactive_users,
        anomaly_flag_by_user, funnel_stage_by_user, views_threshold_by_user, behavior_type_by_user,
        anomaly_totals_by_user,
        summary_kpis_by_week, describe_missing, session_sequence_segments, funnel_stage_summary_by_week,
        funnel_reach_by_week, funnel_percent_initial_by_week, funnel_conversion_by_week, anomaly_totals_by_week,
        user_stats, user_activity_rows, prepared_by_day, filter_stored, prep_reject_report, prep_rejects,
    )
}

__all__ = ["QUERIES", "GRAIN"]
