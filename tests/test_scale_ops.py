"""Skew-safe building blocks against brute force on small data with a hot key."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from actlens.operators.ordinal import ordinal_within, rank_within, running_total_within, running_totals_within
from actlens.operators import quantiles
from actlens.operators.quantiles import exact_quantiles
from actlens.sources.events import gap_sessions


def skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(200)}"
        rows.append((i, key, rnd.randrange(50), rnd.randrange(5)))
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(skewed_rows(), "id long, key string, t int, w int")


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ordinal_equals_row_number(spark, skewed, partitions):
    got = ordinal_within(skewed, ["key"], ["t", "id"], "pos", partitions=partitions)
    ref = skewed.withColumn("ref", F.row_number().over(Window.partitionBy("key").orderBy("t", "id")))
    joined = got.join(ref.select("id", "ref"), "id")
    assert joined.count() == skewed.count()
    assert joined.filter(F.col("pos") != F.col("ref")).count() == 0


def test_hot_key_is_split_across_range_partitions(spark, skewed):
    ranged = skewed.repartitionByRange(16, "key", "t", "id").withColumn("pid", F.spark_partition_id())
    assert ranged.filter(F.col("key") == "hot").select("pid").distinct().count() > 1


def test_running_total_equals_window_sum(spark, skewed):
    got = running_total_within(skewed, ["key"], ["t", "id"], "run", weight="w", partitions=7)
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = skewed.withColumn("ref", F.sum("w").over(w))
    assert got.join(ref.select("id", "ref"), "id").filter(F.col("run") != F.col("ref")).count() == 0


def test_global_ordinal_without_keys(spark, skewed):
    got = ordinal_within(skewed, [], ["t", "id"], "pos", partitions=5).toPandas()
    exp = skewed.toPandas().sort_values(["t", "id"]).reset_index(drop=True)
    exp["pos"] = np.arange(1, len(exp) + 1)
    m = got.merge(exp[["id", "pos"]], on="id", suffixes=("", "_exp"))
    assert (m["pos"] == m["pos_exp"]).all()


def test_rank_equals_window_rank(spark, skewed):
    got = rank_within(skewed, ["key"], ["t"], ["id"], "rk")
    ref = skewed.withColumn("ref", F.rank().over(Window.partitionBy("key").orderBy("t")))
    assert got.join(ref.select("id", "ref"), "id").filter(F.col("rk") != F.col("ref")).count() == 0


@pytest.mark.parametrize("size, margin", [(2048, 0.004), (8, 0.02), (8, 0.0)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, size, margin):
    """Exact whatever the sketch says, also where its brackets miss the ranks."""
    monkeypatch.setattr(quantiles, "SKETCH_SIZE", size)
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 40, 1001).astype(float)
    b = rnd.normal(size=57)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("b", None), ("b", float("nan")), ("c", None)]
    long = spark.createDataFrame(rows, "column_name string, value double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.9]
    got = {(r.column_name, r.prob): r.quantile for r in exact_quantiles(long, probs).collect()}
    for name, arr in (("a", a), ("b", b)):
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.quantile(arr, p), rel=1e-12, abs=1e-12)


def brute_sessions(pdf, gap_s):
    out = {}
    for user, g in pdf.sort_values(["time", "id"]).groupby("user_id"):
        n, prev = 0, None
        for _, r in g.iterrows():
            if prev is None or (r.time - prev).total_seconds() > gap_s:
                n += 1
            out[r.id] = n
            prev = r.time
    return out


@pytest.mark.parametrize("gap_s", [60, 1800, 43200])
def test_gap_sessions_match_brute_force(spark, gap_s):
    rnd = random.Random(gap_s)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1500):
        user = "hot" if rnd.random() < 0.35 else f"u{rnd.randrange(30)}"
        # clustered times so gaps land on both sides of the threshold, incl. exact ties
        t = base + dt.timedelta(seconds=rnd.choice([0, gap_s, 2 * gap_s, gap_s + 1]) * rnd.randrange(40)
                                + rnd.randrange(3))
        rows.append((i, user, t))
    df = spark.createDataFrame(rows, "id long, user_id string, time timestamp_ntz")
    got = {r.id: r.session_no for r in gap_sessions(df, "user_id", "time", gap_s).collect()}
    exp = brute_sessions(pd.DataFrame(rows, columns=["id", "user_id", "time"]), gap_s)
    assert got == exp


def test_global_rank(spark, skewed):
    glob = rank_within(skewed, [], ["t"], ["id"], "rk").toPandas()
    exp = skewed.toPandas()
    exp["exp"] = exp["t"].rank(method="min").astype(int)
    m = glob.merge(exp[["id", "exp"]], on="id")
    assert (m["rk"] == m["exp"]).all()


def test_giant_session_in_segments_is_whole(spark):
    from actlens.functions import labels as L
    from actlens.operators import sequence as sq

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):  # one giant session holding most events, plus small ones
        sess = "S-hot" if i % 5 else f"S{i % 7}"
        t = base + dt.timedelta(seconds=rnd.randrange(100))  # many equal times: event id breaks ties
        rows.append((i, sess, "U1", rnd.choice(["view", "cart", "purchase"]), t))
    df = spark.createDataFrame(rows, "event_id long, session_id string, user_id string, action string, "
                                     "time timestamp_ntz")
    got = sq.session_sequences(df, 37).collect()
    pdf = pd.DataFrame(rows, columns=["event_id", "session_id", "user_id", "action", "time"])
    for sess, g in pdf.sort_values(["time", "event_id"]).groupby("session_id"):
        parts = sorted((r.segment, r.first_position, r.action_sequence) for r in got if r.session_id == sess)
        assert [(c, f) for c, f, _ in parts] == [(i, 37 * i + 1) for i in range(len(parts))]
        assert all(len(p.split(L.SEQUENCE_SEP)) <= 37 for _, _, p in parts)
        assert L.SEQUENCE_SEP.join(p for _, _, p in parts) == L.SEQUENCE_SEP.join(g["action"])
    ranks = {r.event_id: r.action_rank for r in sq.session_rank(df).collect()}
    pdf["exp"] = pdf.groupby("session_id")["time"].rank(method="min").astype(int)
    assert all(ranks[e] == x for e, x in zip(pdf["event_id"], pdf["exp"]))


@pytest.mark.parametrize("kind", ["nulls", "equal times"])
def test_rank_and_position_with_nulls_and_ties(spark, kind):
    from actlens.operators import sequence as sq

    rnd = random.Random(5)
    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)] if kind == "nulls" else [dt.datetime(2024, 1, 1)]
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice(times)) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, session_id string, time timestamp_ntz").repartition(5)
    rank = df.withColumn("w", F.rank().over(Window.partitionBy("session_id").orderBy("time")))
    number = df.withColumn("w", F.row_number().over(Window.partitionBy("session_id").orderBy("time", "event_id")))
    assert {r.event_id: r.action_rank for r in sq.session_rank(df).collect()} == {r.event_id: r.w for r in rank.collect()}
    assert {r.event_id: r.rn for r in sq.session_position(df).collect()} == {r.event_id: r.w for r in number.collect()}


def test_user_totals_match_sessionised_rows(spark):
    from actlens.sources.events import activity, user_totals

    sf = "/root/testdata/sf0.01"
    counted = activity(spark, sf).groupBy("user_id").agg(F.count_distinct("session_id"), F.count("*"),
                                                         F.count_if(F.col("action") == "view"))
    summed = user_totals(activity(spark, sf, sessions=False)).select("user_id", "total_sessions", "total_actions", "views")
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, summed.collect()))


def test_negative_k_is_read(spark):
    from actlens.sources.events import activity_from_events

    rows = [(i, dt.datetime(2024, 1, 1), 1, "view", f'{{"k": {k}}}') for i, k in enumerate([-1, -7, 0, 5])]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string")
    got = sorted((r.event_id, r.category, r.device) for r in activity_from_events(ev).collect())
    assert got == [(0, "C5", "tablet"), (1, "C5", "tablet"), (2, "C0", "desktop"), (3, "C5", "tablet")]


def test_ranks_where_ties_cross_ranges(spark):
    """Tie groups longer than a range: the rank at which a group began is carried through ranges
    that hold nothing else, into the range where the group ends and the next begins."""
    rows = [(i, "a" if i < 40 else "b", 1 if i < 25 or 40 <= i < 70 else 2 + i // 90, None) for i in range(120)]
    rows += [(200 + i, None, None, None) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, key string, t int, pad string")
    want = {r.id: r.w for r in df.withColumn("w", F.rank().over(Window.partitionBy("key").orderBy("t"))).collect()}
    for partitions in (2, 16, 60):
        got = {r.id: r.rk for r in rank_within(df, ["key"], ["t"], ["id"], "rk", partitions).collect()}
        assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_ranks_and_positions_of_random_ties(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2, 3])) for i in range(rnd.choice([1, 30, 200]))]
    df = spark.createDataFrame(rows, "id long, key string, t int")
    by = Window.partitionBy("key").orderBy("t")
    want = {r.id: (r.a, r.b) for r in df.withColumn("a", F.rank().over(by)).withColumn(
        "b", F.row_number().over(Window.partitionBy("key").orderBy("t", "id"))).collect()}
    ranks = {r.id: r.rk for r in rank_within(df, ["key"], ["t"], ["id"], "rk", 11).collect()}
    places = {r.id: r.p for r in ordinal_within(df, ["key"], ["t", "id"], "p", 11).collect()}
    assert {i: (ranks[i], places[i]) for i in ranks} == want


def test_several_running_totals_with_decimals(spark):
    rnd = random.Random(5)
    rows = [(i, f"k{rnd.randrange(3)}", rnd.randrange(-9, 9), rnd.randrange(10**18)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, key string, w int, big long").withColumn("big", F.col("big").cast("decimal(38,0)"))
    got = running_totals_within(df, ["key"], ["id"], {"n": None, "s": "w", "b": "big"}, 9)
    assert got.schema["b"].dataType.simpleString() == "decimal(38,0)" and got.schema["n"].dataType.simpleString() == "bigint"
    run = {}
    want = {}
    for i, k, w, b in rows:
        n, s, t = run.get(k, (0, 0, 0))
        run[k] = want[i] = (n + 1, s + w, t + b)
    assert {r.id: (r.n, r.s, int(r.b)) for r in got.collect()} == want


def test_an_outlier_leaves_few_values_to_count(spark, monkeypatch):
    """Values of one day and one in the year 9999: brackets hold a small part of the values all the same."""
    inside = []
    original = quantiles.running_total_within
    monkeypatch.setattr(quantiles, "running_total_within",
                        lambda counts, *a, **k: inside.append(counts.agg(F.sum("c")).first()[0]) or original(counts, *a, **k))
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") == 7, 253_402_300_799.0).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(86_400_000)) / 1000.0 + 1.7e9).alias("value"), F.lit("t").alias("column_name"))
    got = {r.prob: r.quantile for r in exact_quantiles(df, [0.25, 0.5, 0.75]).collect()}
    values = [r.value for r in df.collect()]
    assert all(got[p] == pytest.approx(np.quantile(values, p), rel=1e-15) for p in got) and len(got) == 3
    assert inside[0] < 0.05 * n


def test_describe_counts_as_pandas_does(spark):
    """NaN is a missing value; unique, top and freq of long and short texts."""
    from actlens.operators.report import describe_all

    rnd = random.Random(8)
    head = "x" * 70
    texts = [None, "", "a", "b", "a" * 64, "a" * 65, head, head + "1", head + "2", head + "2", head + "10"]
    frame = pd.DataFrame({"n": [1.0, 2.0, float("nan"), 3.0] + [rnd.choice([float("nan"), 5.0, 0.5]) for _ in range(60)]})
    for c in range(4):  # most frequent: any of them, ties between long values, all unique
        frame[f"t{c}"] = [rnd.choice(texts[: 5 + 2 * c]) for _ in range(64)] if c < 3 else [head + str(i) for i in range(64)]
    rows = [[None if x is None else x for x in r] for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "n double, t0 string, t1 string, t2 string, t3 string")
    got = {r.column_name: r for r in describe_all(df).collect()}
    want = frame["n"].describe()
    assert got["n"]["count"] == want["count"]
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert got["n"][ours] == pytest.approx(want[theirs])
    for c in ("t0", "t1", "t2", "t3"):
        counts = frame[c].dropna().value_counts()
        top = min((-n, v) for v, n in counts.items())
        assert (got[c]["count"], got[c].unique, got[c].top, got[c].freq) == (counts.sum(), len(counts), top[1], -top[0])


@pytest.mark.parametrize("seed, n_categories", [(1, 3), (2, 130), (3, 1200)])
def test_distinct_counts_by_masks(spark, seed, n_categories):
    """Equal to exact distinct counts, with nulls, over one long, several, and beyond the masks' domain."""
    from actlens.operators import explore as ex

    rnd = random.Random(seed)
    pick = lambda values: rnd.choice([None, *values])
    cats = [f"c{i}" for i in range(n_categories)]
    rows = [(pick(["u1", "u2", "u3"]), pick([f"s{i}" for i in range(9)]), pick(cats)) for _ in range(3000)]
    rows += [("u9", None, None)]
    df = spark.createDataFrame(rows, "user_id string, session_id string, category string")
    want = {}
    for u, s, c in rows:
        n, a, b = want.setdefault(u, [0, set(), set()])
        want[u][0] += 1
        a.update([s] if s else [])
        b.update([c] if c else [])
    got = ex.user_activity(df)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {u: (n, len(a), len(b)) for u, (n, a, b) in want.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Expand" in plan) == (n_categories > ex.MASK_CODES)
    assert got.dtypes == ex.user_activity(df.limit(0)).dtypes and ex.user_activity(df.limit(0)).collect() == []
