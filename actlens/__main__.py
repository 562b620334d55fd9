"""Run the whole activity analysis over activity CSV files.

    python -m actlens <csv path or glob> [--out DIR] [--rows N] [--master URL]

Without ``--out`` each result is shown (first ``--rows`` rows); with it, each
result is written as parquet to ``DIR/<name>`` by the executors.
"""

from __future__ import annotations

import argparse

from actlens.functions import labels as L
from actlens.operators import anomaly as an
from actlens.operators import explore as ex
from actlens.operators import funnel as fn
from actlens.operators import prepare as pr
from actlens.operators import report as rp
from actlens.operators import sequence as sq
from actlens.sources.csv import read_activity
from actlens.sources.schema import CORRUPT


USED = ["user_id", "session_id", "action", "category", "time", "hour", "day_of_week", "device"]
SEQUENCE_SEGMENT = 100_000  # events in one row of a session's text sequence


def analyses(marked, df, prof):
    """(name, DataFrame) pairs in the order of the batch report.  Schema,
    cleaning, rejects and describe are about the raw rows (``marked`` with why
    they are rejected), the rest about the prepared ones."""
    raw = pr.parse_time(marked.drop(pr.REASON, CORRUPT))
    matrix = fn.funnel_stage(fn.action_matrix(df))
    return [
        ("schema", rp.schema_profile(raw)),
        ("cleaning", pr.cleaning_report(marked)),
        ("reject_reasons", pr.reject_report(marked)),
        ("rejects", pr.rejects(marked)),
        ("action_share", ex.with_share(ex.count_by(df, "action", "total_count", ordered=True), "total_count")),
        ("hour_counts", ex.count_by(df, "hour", "activity_count", ordered=True)),
        ("peak_hour", ex.peak(df, "hour", "activity_count")),
        ("weekday_counts", ex.count_by(df, "day_of_week", "activity_count", ordered=True)),
        ("top_users", ex.top_users(df, 10)),
        ("category_counts", ex.count_by(df, "category", "interactions", ordered=True)),
        ("device_share", ex.with_share(ex.count_by(df, "device", ordered=True))),
        ("funnel_stage", matrix),
        ("funnel_stage_summary", fn.funnel_stage_summary(matrix)),
        ("funnel_reach", fn.funnel_reach(prof, percent_initial=True)),
        ("funnel_conversion", fn.conversion(prof)),
        ("session_sequences", sq.session_sequences(df, SEQUENCE_SEGMENT)),
        ("complete_sessions", sq.complete_session_count(df)),
        ("behavior_report", an.behavior_report(prof, 20)),
        ("flagged_users", an.flagged(prof)),
        ("anomaly_totals", an.anomaly_totals(prof)),
        ("views_threshold", an.views_threshold(prof, L.STDDEV_K)),
        ("hyperactive_users", an.hyperactive(prof)),
        ("user_stats", an.user_stats(df)),
        ("user_points", an.user_points(prof)),
        ("anomaly_report", an.anomaly_report(prof)),
        ("summary", rp.summary(df, prof)),
        ("describe", rp.describe_all(raw, display=True)),
    ]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m actlens", description=__doc__.split("\n\n")[0])
    ap.add_argument("path", help="activity CSV file, folder or glob")
    ap.add_argument("--out", help="write each result as parquet under this folder")
    ap.add_argument("--rows", type=int, default=20, help="rows to show per result")
    ap.add_argument("--master", help="Spark master (default: the environment's)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("actlens")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    marked = pr.with_reject_reason(read_activity(spark, args.path, keep_corrupt=True))
    # The prepared rows feed most analyses: the CSV is parsed once (IO4), and
    # only the columns that an analysis reads are kept.  Events at the same
    # time are ordered by their other columns, so results do not depend on
    # how files are split.
    df = pr.persist_prepared(pr.prepare(pr.accepted(marked), calendar=False), USED)
    prof = an.profile(df)
    try:
        for name, result in analyses(marked, df, prof):
            if args.out:
                result.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
            else:
                print(f"== {name}")
                result.show(args.rows, truncate=False)
    finally:
        df.unpersist()


if __name__ == "__main__":
    main()
