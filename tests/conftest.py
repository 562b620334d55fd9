from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("actlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="actlens-test-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


# ---------------------------------------------------------------------------
# Generated activity fixture: every user's actions, and the other columns,
# follow from the numbers below.  The tests derive their expectations from
# these rows with plain Python.
ACTION = {"v": "view", "c": "cart", "p": "purchase"}
CATEGORIES = ("Garden", "Music", "Toys", "Tools")
DEVICES = ("phone", "laptop", "kiosk")


def actions_of(user: int) -> str:
    """Single session of a user, by the user's number modulo 5; user 16 views a lot for one purchase."""
    if user == 16:
        return "v" * 19 + "pp"
    return {0: "v" * user, 1: "vcp", 2: "vvcpp", 3: "v" * user + "c", 4: "vcvp"}[user % 5]


def fixture_rows(users: int = 17):
    rows = []
    for u in range(1, users + 1):
        for i, a in enumerate(actions_of(u)):
            t = dt.datetime(2023, 5, 1 + u % 3, 7 + (u + i) // 4, (7 * u + 11 * i) % 60, i)
            t = max(t, rows[-1][5] + dt.timedelta(seconds=1)) if i else t  # in order within the session
            rows.append((f"u-{u:02d}", f"s-{100 - u}", ACTION[a], CATEGORIES[(u + i * i) % 4], f"item{(3 * u + i) % 23}", t,
                         t.hour, t.strftime("%A"), DEVICES[(u * i) % 3]))
    return [(*r[:5], r[5].strftime("%Y-%m-%d %H:%M:%S"), *r[6:]) for r in rows]


@pytest.fixture(scope="session")
def fixture_csv(tmp_path_factory):
    import csv

    path = tmp_path_factory.mktemp("fixture") / "activity.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["user_id", "session_id", "action", "category", "product_id", "time", "hour", "day_of_week",
                    "device"])
        w.writerows(fixture_rows())
    return str(path)


@pytest.fixture(scope="session")
def act(spark, fixture_csv):
    """The generated fixture read and prepared like the reference input,
    with a row key for stable ordering."""
    from pyspark.sql import functions as F

    from actlens.operators.prepare import prepare
    from actlens.sources.csv import read_activity

    df = prepare(read_activity(spark, fixture_csv))
    return df.withColumn("event_id", F.monotonically_increasing_id()).cache()


def activity_frame(spark, rows, with_id=True):
    """Inline activity rows (user, session, action, time text[, category, device])."""
    from pyspark.sql import functions as F

    from actlens.operators.prepare import parse_time

    full = []
    for i, r in enumerate(rows):
        r = list(r) + [None] * (6 - len(r))
        user, session, action, time, category, device = r
        full.append((i, user, session, action, category or "Books", time, device or "mobile"))
    df = spark.createDataFrame(
        full, "event_id long, user_id string, session_id string, action string, category string, time string, "
              "device string")
    df = parse_time(df).withColumn("hour", F.hour("time").cast("int")).withColumn(
        "day_of_week", F.date_format("time", "EEEE"))
    return df if with_id else df.drop("event_id")
