"""The command line runs every analysis over a CSV and writes the results."""

from __future__ import annotations

import csv

from actlens.__main__ import main
from tests.conftest import fixture_rows

HEADER = ["user_id", "session_id", "action", "category", "product_id", "time", "hour", "day_of_week", "device"]


def test_cli_writes_every_result(spark, tmp_path):
    """A malformed time and a missing value are counted as removed; schema
    and describe are about the nine columns of the file."""
    rows = fixture_rows()
    bad = [(*rows[0][:5], "01/05/2023", *rows[0][6:]), (None, *rows[1][1:]), rows[2][:4], (*rows[3], "too", "many"),
           (*rows[4][:6], "noon", *rows[4][7:]), (None, None, *rows[5][2:5], "never", *rows[5][6:])]
    with open(tmp_path / "activity.csv", "w", newline="") as f:
        csv.writer(f).writerows([HEADER, *rows, *bad])
    out = tmp_path / "results"
    main([str(tmp_path / "activity.csv"), "--out", str(out)])
    written = {p.name for p in out.iterdir()}
    assert {"action_share", "summary", "session_sequences", "hyperactive_users", "describe"} <= written
    read = lambda name: spark.read.parquet(str(out / name))
    assert tuple(read("cleaning").first()) == (len(rows) + 6, len(rows), 6)
    reasons = dict(map(tuple, read("reject_reasons").collect()))
    assert reasons == {"kept": len(rows), "bad csv": 3, "bad time": 2, "null user_id": 1}
    rejected = read("rejects").collect()
    assert sorted(r.reject_reason for r in rejected) == ["bad csv"] * 3 + ["bad time"] * 2 + ["null user_id"]
    assert {r._corrupt_record for r in rejected if r.reject_reason == "bad csv"} == {
        ",".join(map(str, r)) for r in (rows[2][:4], (*rows[3], "too", "many"), (*rows[4][:6], "noon", *rows[4][7:]))}
    assert sorted(r.column_name for r in read("describe").collect()) == sorted(HEADER)
    assert {(r.n_rows, r.n_columns) for r in read("schema").collect()} == {(len(rows) + 6, 9)}
    summary = read("summary").first()
    assert (summary.total_events, summary.total_users) == (len(rows), 17)
    described = {r.column_name: r["count"] for r in read("describe").collect()}
    # of the short line, four fields; of the others all but the missing ones, and times that are times
    assert described["time"] == str(len(rows) + 3) and described["user_id"] == str(len(rows) + 4)
    assert described["action"] == str(len(rows) + 6) and described["hour"] == str(len(rows) + 4)
    assert {"user_stats", "user_points", "anomaly_report"} <= written
