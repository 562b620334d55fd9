"""The prepared table round-trips and date filters prune partitions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from actlens.operators import explore as ex
from actlens.operators.prepare import parse_time
from actlens.operators.prepare import filter_activity
from actlens.sources.events import activity, gap_sessions
from actlens.sources.store import add_days, read_days, read_prepared, save_prepared

SF = "/root/testdata/sf0.001"


def test_round_trip_and_partition_pruning(spark, tmp_path):
    act = parse_time(activity(spark, SF, sessions=True))
    path = save_prepared(act, str(tmp_path / "prepared"))
    back = read_prepared(spark, path)
    assert back.count() == act.count()
    want = {r.action: r["count"] for r in ex.count_by(act, "action").collect()}
    assert {r.action: r["count"] for r in ex.count_by(back, "action").collect()} == want

    day = back.filter(F.col("date") == F.lit("2024-01-02").cast("date"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
    assert day.count() == act.filter(F.to_date("time") == F.lit("2024-01-02").cast("date")).count()


def test_only_the_dates_written_are_replaced(spark, tmp_path):
    rows = [(i, "view", dt.datetime(2024, 1, 1 + i % 3, 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, action string, time timestamp_ntz")
    path = save_prepared(df, str(tmp_path / "p"))
    again = df.where(F.dayofmonth("time") == 2).withColumn("action", F.lit("cart"))
    save_prepared(again, path)
    got = {(r.date.day, r.action): r["count"] for r in read_prepared(spark, path).groupBy("date", "action").count().collect()}
    assert got == {(1, "view"): 10, (2, "cart"): 10, (3, "view"): 10}


def scanned(df) -> tuple[int, str]:
    """Rows that left the parquet scans of a query, and its plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves, rows = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        rows += leaves.apply(i).metrics().apply("numOutputRows").value()
    return rows, plan.toString()


def test_row_groups_are_skipped(spark, tmp_path):
    """Filters on values reach the scan of the stored layout and skip row groups by statistics
    and Bloom filters, with the same result."""
    n = 60_000
    df = spark.range(n).select(
        F.col("id").alias("event_id"), F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(5000)) * 2).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "cart", "purchase", "share"))), (F.col("id") % 4 + 1).cast("int")).alias("action"),
        F.concat(F.lit("C"), F.col("id") % 9).alias("category"), F.concat(F.lit("d"), F.col("id") % 5).alias("device"),
        F.lit("2024-03-01 10:00:00").cast("timestamp_ntz").alias("time")).repartition(1)
    path = save_prepared(df, str(tmp_path / "p"), row_group_bytes=20_000)
    stored = read_prepared(spark, path)
    for actions, categories, most in ((["cart"], None, 0.4), (["view", "purchase"], ["C3"], 0.4), (["cart"], ["C8"], 0.2)):
        got = filter_activity(stored, actions, categories)
        rows, plan = scanned(got)
        want = filter_activity(df, actions, categories)
        assert got.count() == want.count() > 0 and rows < most * n
        assert "PushedFilters: [" in plan and ("In(action" in plan or "EqualTo(action" in plan)
    # A user who is not there, inside the range of those who are.
    rows, plan = scanned(stored.where("user_id = 'u4001'"))
    assert rows == 0 and "EqualTo(user_id,u4001)" in plan


def test_scratch_is_released(spark, tmp_path):
    import os

    from actlens.sources.scratch import materialize, materialize_bucketed, release_scratch, scratch_root

    release_scratch(spark)
    a = materialize(spark.range(5), "kept-a")
    b = materialize_bucketed(spark.range(5).withColumn("k", F.col("id").cast("int")), 3, "k", "kept-b")
    assert a.count() == b.count() == 5
    mine = [x for x in os.listdir(scratch_root(spark)) if x.startswith("kept-")]
    assert len(mine) == 2 and release_scratch(spark) == 2 and release_scratch(spark) == 0
    assert not set(mine) & set(os.listdir(scratch_root(spark)))


def sessions_of(df):
    return {r.event_id: r.session_id for r in df.select("event_id", "session_id").collect()}


@pytest.mark.parametrize("seed, gap", [(1, 12 * 3600), (2, 3600), (3, 30 * 3600)])
def test_day_by_day_equals_one_load(spark, tmp_path, seed, gap):
    """In any order of days, with a late day, sessions over midnight and over whole days, and a day loaded twice."""
    rnd = random.Random(seed)
    start = dt.datetime(2024, 2, 27)
    rows = [(i, f"u{rnd.randrange(6)}" if rnd.random() < 0.7 else "hot",
             start + dt.timedelta(seconds=rnd.choice([0, 1, gap, 86_399]) + rnd.randrange(6 * 86_400))) for i in range(250)]
    df = spark.createDataFrame(rows, "event_id long, user_id string, time timestamp_ntz")
    one = gap_sessions(df, "user_id", "time", gap, "n").withColumn("session_id", F.concat_ws("-", "user_id", F.col("n").cast("string")))
    want, path = sessions_of(one), str(tmp_path / "store")
    days = sorted({r[2].date() for r in rows})
    late = days.pop(2)
    order = rnd.sample(days, len(days))
    for load in ([order[0]], order[1:3], order[3:], [late], [order[0], late]):
        add_days(df.where(F.to_date("time").isin(load)), path, gap)
    back = read_days(spark, path)
    assert sessions_of(back) == want
    day = back.where(F.col("date") == F.lit(late))
    assert sessions_of(day) == {r[0]: want[r[0]] for r in rows if r[2].date() == late}
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()
