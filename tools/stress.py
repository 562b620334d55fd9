"""Skew trial: a larger `events` table derived from a given one, with one user
holding a large share of all rows inside one minute (a single giant
session), then selected queries checked against DuckDB.

    python tools/stress.py [src_sf_dir] [replicas] [hot_share] [query ...]

The derived table goes to a new temporary folder (nothing is committed).
Each replica gets its own user ids; a ``hot_share`` fraction of all rows is
re-assigned to user 0 with timestamps 20 microseconds apart.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from actlens.plans.session import build_session  # noqa: E402
from tools.oracle_check import compare  # noqa: E402

DEFAULT_QUERIES = ["session_row_number", "session_rank", "session_sequences", "complete_funnel_count",
                   "user_activity", "anomaly_flag", "summary_kpis", "describe_all"]


def derive(spark, src: str, out: str, replicas: int, hot_share: float) -> str:
    ev = spark.read.parquet(f"{src}/events.parquet")
    n_users = ev.agg(F.max("user_id")).first()[0] + 1
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("r"))
    hot = F.pmod(F.xxhash64("event_id", "r"), F.lit(1_000_000)) < F.lit(int(hot_share * 1_000_000))
    base = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    derived = rep.select(
        (F.col("event_id") + F.col("r") * F.lit(10_000_000)).alias("event_id"),
        F.when(hot, base + F.make_dt_interval(secs=(F.col("event_id") * replicas + F.col("r")) * F.lit(0.00002)))
        .otherwise(F.col("ts")).alias("ts"),
        F.when(hot, F.lit(0)).otherwise(F.col("user_id") + 1 + F.col("r") * F.lit(n_users)).alias("user_id"),
        "event_type", "value", "props",
    )
    # The source is one row group; spread the derived rows over many files so
    # the trial is read in parallel, as a large table would be.
    files = max(8, replicas)
    derived.repartition(files).write.mode("errorifexists").parquet(f"{out}/events.parquet")
    return out


if __name__ == "__main__":
    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    replicas = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    share = float(sys.argv[3]) if len(sys.argv) > 3 else 0.4
    names = sys.argv[4:] or DEFAULT_QUERIES
    spark = build_session(app_name="actlens-stress")
    out = derive(spark, src, tempfile.mkdtemp(prefix="actlens-stress-"), replicas, share)
    hot_rows = spark.read.parquet(f"{out}/events.parquet").filter("user_id = 0").count()
    print(f"derived {out}: {replicas} replicas, hot user rows {hot_rows}", flush=True)
    t0 = time.time()
    res = compare(spark, out, names, verbose=True, exact=True)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    print(f"{len(res) - len(bad)}/{len(res)} ok in {time.time() - t0:.0f} s")
    sys.exit(1 if bad else 0)
