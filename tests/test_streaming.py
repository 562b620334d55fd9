"""Streaming counts and profile equal the batch results over the same files."""

from __future__ import annotations

from actlens.operators import anomaly as an
from actlens.operators import explore as ex
from actlens.sources.csv import write_csv
from actlens.sources.events import activity
from actlens.sources.schema import ACTIVITY_COLUMNS
from actlens.streaming import read_activity_stream, running_counts, running_profile, start, windowed_counts

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark, tmp_path):
    raw = activity(spark, SF, sessions=True, raw_time=True).select(*ACTIVITY_COLUMNS)
    src = str(tmp_path / "in")
    write_csv(raw.repartition(4), src)
    stream = read_activity_stream(spark, src, max_files_per_trigger=1)

    q1 = start(running_counts(stream, "action"), "memory", str(tmp_path / "c1"), name="stream_action_counts")
    q2 = start(running_profile(stream), "memory", str(tmp_path / "c2"), name="stream_profile")
    q3 = start(windowed_counts(stream, "action", "1 day", "1 hour"), "memory", str(tmp_path / "c3"),
               output_mode="append", name="stream_daily")
    for q in (q1, q2, q3):
        q.processAllAvailable()
        q.stop()

    batch = activity(spark, SF, sessions=False)
    want = {r.action: r["count"] for r in ex.count_by(batch, "action").collect()}
    got = {r.action: r["count"] for r in spark.sql("SELECT * FROM stream_action_counts").collect()}
    assert got == want

    prof = {tuple(r) for r in an.profile(batch).collect()}
    streamed = spark.sql("SELECT * FROM stream_profile").collect()
    # update mode appends a row per change; the last version of each user wins
    latest = {}
    for r in streamed:
        latest[r.user_id] = tuple(r)
    assert set(latest.values()) == prof

    daily = spark.sql("SELECT * FROM stream_daily").collect()
    assert 0 < sum(r["count"] for r in daily) <= sum(want.values())


def test_restarted_query_resumes(spark, tmp_path):
    """With the same checkpoint folder, files that were read are not read again."""
    raw = activity(spark, SF, sessions=True, raw_time=True).select(*ACTIVITY_COLUMNS)
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for part in (raw.where("action = 'view'"), raw.where("action != 'view'")):
        write_csv(part, src, mode="append")
        q = start(read_activity_stream(spark, src).select("action"), "parquet", state, output_mode="append", path=out)
        q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(out).count() == raw.count()
