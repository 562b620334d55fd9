"""Plan properties of every registered query: built-in expressions only, no
cartesian or nested-loop joins, cleaning pushed into the parquet scans."""

from __future__ import annotations

import os
import re

import pytest

from actlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_plans_stay_jvm_side_and_push_filters(spark):
    problems, seen_scans = {}, 0
    for name, fn in QUERIES.items():
        df = fn(spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        bad = [f for f in FORBIDDEN if f in plan]
        scans = re.findall(r"FileScan parquet \[[^\]]*\][^\n]*", plan)
        events_scans = [s for s in scans if "events.parquet" in s]
        seen_scans += len(events_scans)
        unpushed = [s for s in events_scans if "PushedFilters: [IsNotNull" not in s]
        if bad or unpushed:
            problems[name] = (bad, len(unpushed))
        if df.is_cached:
            df.unpersist()
    assert not problems, problems
    assert seen_scans >= len(QUERIES) // 2  # the plan text was read


#: Scans of ``events`` and hash shuffles a query may have with broadcast joins off.
AT_MOST = {"summary_kpis": (2, 5), "distinct_totals": (1, 3), "user_activity": (2, 6), "top_users": (1, 4), "action_counts": (1, 2), "user_stats": (1, 3), "user_activity_rows": (2, 6),
           "session_rank": (2, 5), "session_row_number": (2, 3)}


def _nodes(plan) -> list:
    """Every node of a physical plan as text, scalar subqueries included."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        out.append(node.simpleString(200))
        for group in (node.children(), node.subqueries()):
            todo += [group.apply(i) for i in range(group.size())]
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_scans_and_shuffles_without_broadcast(spark):
    quiet = spark.newSession()
    quiet.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    quiet.conf.set("spark.sql.adaptive.enabled", "false")
    for name, (scans, shuffles) in AT_MOST.items():
        nodes = _nodes(QUERIES[name](quiet, SF)._jdf.queryExecution().executedPlan())
        n_scans = sum("FileScan parquet" in x for x in nodes)
        n_shuffles = sum(x.startswith("Exchange") for x in nodes)
        assert n_scans <= scans and n_shuffles <= shuffles, (name, n_scans, n_shuffles)
        assert not any("CartesianProduct" in x or "NestedLoop" in x for x in nodes), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_ranged_rows_are_not_shuffled_again(spark):
    """What numbers or ranks the written ranges reads their distribution from the bucketed
    table: no exchange carries rows, only the summary with a row per range."""
    quiet = spark.newSession()
    quiet.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    quiet.conf.set("spark.sql.adaptive.enabled", "false")
    for name in ("session_rank", "session_row_number", "session_events"):
        plan = QUERIES[name](quiet, SF)._jdf.queryExecution().executedPlan()
        nodes = _nodes(plan)
        assert sum("Bucketed: true" in x for x in plan.toString().split("\n")) == 2, name
        assert not [x for x in nodes if x.startswith("Exchange hash") and re.search(r"session_id|user_id|event_id", x)], name
    # The table that the frame was read through is gone from the catalog.
    assert not [t for t in quiet.catalog.listTables() if t.name.startswith("scratch_")]


def test_skewed_bucket_join_is_split(spark):
    """One user with nearly all events inside one bucket: adaptive execution splits
    that partition of the join with the (user, bucket) table."""
    from pyspark.sql import functions as F

    from actlens.sources.events import gap_sessions

    quiet = spark.newSession()
    for k, v in {"autoBroadcastJoinThreshold": "-1", "adaptive.autoBroadcastJoinThreshold": "-1",
                 "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "adaptive.skewJoin.skewedPartitionFactor": "2",
                 "adaptive.advisoryPartitionSizeInBytes": "20k", "adaptive.coalescePartitions.enabled": "false"}.items():
        quiet.conf.set(f"spark.sql.{k}", v)
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = quiet.range(0, 60_000, 1, 16).select(
        "id", F.when(F.col("id") % 20 > 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user_id"),
        (day + F.make_dt_interval(secs=F.col("id") % 3600)).alias("time"), F.md5(F.col("id").cast("string")).alias("pad"))
    df = gap_sessions(rows)
    assert df.agg(F.count("session_no"), F.count("pad")).first() == (60_000, 60_000)
    df = gap_sessions(rows).select("id", "pad", "session_no")
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
