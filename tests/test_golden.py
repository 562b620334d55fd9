"""Every operator on the generated fixture, against plain Python over its rows."""

from __future__ import annotations

import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from actlens.functions import labels as L
from actlens.operators import anomaly as an
from actlens.operators import explore as ex
from actlens.operators import funnel as fn
from actlens.operators import prepare as pr
from actlens.operators import report as rp
from actlens.operators import sequence as sq
from actlens.sources.csv import read_activity
from tests.conftest import ACTION, actions_of, fixture_rows

ROWS = fixture_rows()
N, USERS = len(ROWS), range(1, 18)
NAME = {u: f"u-{u:02d}" for u in USERS}
VCP = {NAME[u]: tuple(Counter(actions_of(u))[a] for a in "vcp") for u in USERS}
HIGH = {u for u, (v, c, p) in VCP.items() if v >= 5 and p == 0}
MODERATE = {"u-16"}


def counts(column):
    return Counter(r[column] for r in ROWS)


def most_first(column):
    return sorted(counts(column).items(), key=lambda x: (-x[1], x[0]))


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_totals_and_cleaning(spark, fixture_csv, act):
    rep = pr.cleaning_report(pr.parse_time(read_activity(spark, fixture_csv))).first()
    assert (rep.rows_before, rep.rows_after, rep.rows_removed) == (N, N, 0)
    t = ex.totals(act).first()
    assert (t.total_events, t.total_users, t.total_sessions) == (N, 17, 17)


def test_shares(act):
    for key, column in (("action", 2), ("device", 8)):
        got = {r[key]: (r.n, r.percentage) for r in ex.with_share(ex.count_by(act, key, "n"), "n").collect()}
        assert got == {k: (n, pytest.approx(100 * n / N, abs=0.005001)) for k, n in counts(column).items()}


def test_counts_are_ordered_most_first(act):
    for key, column in (("action", 2), ("category", 3), ("hour", 6), ("day_of_week", 7), ("device", 8)):
        assert pairs(ex.count_by(act, key, "n", ordered=True)) == most_first(column)
        assert tuple(ex.peak(act, key, "n").first()) == most_first(column)[0]


def test_user_activity(act):
    users = defaultdict(list)
    for r in ROWS:
        users[r[0]].append(r)
    want = sorted(((u, len(rs), 1, len({r[3] for r in rs})) for u, rs in users.items()), key=lambda x: (-x[1], x[0]))
    assert pairs(ex.user_activity(act, ordered=True)) == want
    assert pairs(ex.top_users(act, 4)) == want[:4]
    known = act.groupBy("user_id").agg(F.count_distinct("session_id").alias("total_sessions"))
    assert pairs(ex.user_activity(act.drop("session_id"), sessions=known, ordered=True)) == want


def test_profile(act):
    assert {r.user_id: (r.views, r.carts, r.purchases) for r in an.user_behavior(act).collect()} == VCP
    assert {r.user_id: (r.view_count, r.cart_count, r.purchase_count) for r in fn.action_matrix(act).collect()} == VCP


def test_funnel(act):
    stage = {u: L.STAGE_COMPLETE if p else L.STAGE_PARTIAL if c else L.STAGE_BROWSE for u, (v, c, p) in VCP.items()}
    staged = fn.funnel_stage(fn.action_matrix(act))
    assert {r.user_id: r.funnel_stage for r in staged.collect()} == stage
    want = sorted(Counter(stage.values()).items(), key=lambda x: (-x[1], x[0]))
    assert pairs(fn.funnel_stage_summary(staged)) == want
    prof = an.profile(act)
    n = [sum(x[i] > 0 for x in VCP.values()) for i in range(3)]
    reach = pairs(fn.funnel_reach(prof, percent_initial=True).orderBy("step"))
    assert [r[2] for r in reach] == n and [r[3] for r in reach] == [pytest.approx(100 * x / n[0], abs=0.005001) for x in n]
    conv = fn.conversion(prof).first()
    assert (conv.view_to_cart_rate, conv.cart_to_purchase_rate) == (round(100 * n[1] / n[0]), round(100 * n[2] / n[1]))
    stacked = pairs(fn.stacked_actions(prof, ordered=True))
    assert sorted((u, a, k) for u, _, a, k in stacked) == sorted(
        (u, a, k) for u, x in VCP.items() for a, k in zip(("views", "carts", "purchases"), x))
    order = [(-t, u, a) for u, t, a, _ in stacked]
    assert order == sorted(order)


def test_sequences(act):
    want = {f"s-{100 - u}": L.SEQUENCE_SEP.join(ACTION[a] for a in actions_of(u)) for u in USERS}
    seqs = sq.session_sequences(act, 100).collect()
    assert {r.session_id: r.action_sequence for r in seqs} == want
    assert all((r.segment, r.first_position) == (0, 1) for r in seqs)
    parts = sorted(map(tuple, sq.session_sequences(act, 3).collect()))
    assert all(p[3] == 3 * p[2] + 1 for p in parts)
    joined = defaultdict(list)
    for s, _, _, _, text in parts:
        joined[s].append(text)
    assert {s: L.SEQUENCE_SEP.join(t) for s, t in joined.items()} == want
    assert max(len(t) for t in joined.values()) > 1
    events = sorted(map(tuple, sq.session_events(act).select("session_id", "position", "action").collect()))
    assert events == sorted((f"s-{100 - u}", i + 1, ACTION[a]) for u in USERS for i, a in enumerate(actions_of(u)))
    complete = {f"s-{100 - u}" for u in USERS if set(actions_of(u)) == set("vcp")}
    assert {r.session_id for r in sq.complete_sessions(act).collect()} == complete
    assert sq.complete_session_count(act).first().complete_sessions == len(complete)


def test_anomalies(act):
    prof = an.profile(act)
    flags = {r.user_id: r.anomaly_flag for r in prof.collect()}
    assert flags == {u: L.FLAG_HIGH if u in HIGH else L.FLAG_MODERATE if u in MODERATE else L.FLAG_NORMAL for u in VCP}
    assert {r.user_id for r in an.flagged(prof).collect()} == HIGH | MODERATE
    tot = an.anomaly_totals(prof).first()
    odd = len(HIGH | MODERATE)
    assert (tot.anomalous_users, tot.normal_users, tot.total_users) == (odd, 17 - odd, 17)
    assert tot.anomaly_rate == pytest.approx(100 * odd / 17, abs=0.05001)
    views = [v for v, _, _ in VCP.values()]
    thr = an.views_threshold(prof).first()
    limit = statistics.mean(views) + 2 * statistics.stdev(views)
    assert (thr.mean_views, thr.std_views, thr.threshold) == pytest.approx((statistics.mean(views), statistics.stdev(views), limit))
    busy = {u for u, (v, _, _) in VCP.items() if v > limit}
    assert busy and {r.user_id for r in an.hyperactive(prof).collect()} == busy
    report = pairs(an.behavior_report(prof, 20).select("user_id"))
    assert [u for (u,) in report] == sorted(VCP, key=lambda u: (-VCP[u][0], u))
    order = pairs(an.anomaly_report(prof).select("anomaly_flag", "user_id"))
    assert order == sorted(order) and len(order) == 17


def summary_row():
    odd = len(HIGH | MODERATE)
    return (N, 17, 17, 17 - odd, odd, pytest.approx(100 * odd / 17, abs=0.05001), most_first(6)[0][0], most_first(7)[0][0])


def test_summary(act):
    assert tuple(rp.summary(act, an.profile(act)).first()) == summary_row()
    assert tuple(rp.summary(act, an.profile(act), approx=True).first()) == summary_row()  # sketches are exact at this size
    known = an.profile(act).withColumn("total_sessions", F.lit(1))
    assert tuple(rp.summary(act.drop("session_id"), known).first()) == summary_row()
    assert tuple(ex.totals(act, approx=True).first()) == (17, 17, N)
    empty = rp.summary(act.limit(0), an.profile(act.limit(0))).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, None, None, None)


def test_filters_search_preview(act):
    assert pr.filter_activity(act).count() == N
    assert pr.filter_activity(act, actions=["purchase"]).count() == counts(2)["purchase"]
    assert pr.filter_activity(act, devices=[]).count() == 0
    upper = act.withColumn("user_id", F.upper("user_id"))
    assert pr.search_users(upper, "u-0").select("user_id").distinct().count() == 9
    assert pr.search_users(act, "").count() == N
    cov = pr.coverage(upper, actions=["view"], term="u-16").first()
    assert (cov.shown, cov.total) == (19, N)
    prev = pr.preview(act, 10)
    assert prev.columns == list(L.PREVIEW_COLUMNS) and prev.count() == 10
    assert set(pairs(pr.domains(act))) == {(k, v) for k, c in (("action", 2), ("category", 3), ("device", 8)) for v in counts(c)}


RAW = ("user_id", "session_id", "action", "category", "product_id", "time", "hour", "day_of_week", "device")


def test_describe(spark, act):
    d = {r.column_name: r for r in rp.describe_all(act.select(*RAW)).collect()}
    assert set(d) == set(RAW)
    for c in (0, 1, 2, 3, 4, 7, 8):
        top = most_first(c)[0]
        r = d[RAW[c]]
        assert (r["count"], r.unique, r.top, r.freq) == (N, len(counts(c)), *top) and r["mean"] is None
    hours = sorted(r[6] for r in ROWS)
    h = d["hour"]
    quart = [statistics.quantiles(hours, n=4, method="inclusive")[i] for i in range(3)]
    assert [h["mean"], h["std"], h["min"], h.p25, h.p50, h.p75, h["max"]] == pytest.approx(
        [statistics.mean(hours), statistics.stdev(hours), hours[0], *quart, hours[-1]])
    assert d["time"].std is None and d["time"]["mean"] is not None and d["hour"].top is None
    approx = {r.column_name: r for r in rp.describe_all(act.select("hour", "time", "action"), approx=True).collect()}
    assert approx["hour"].p50 in (int(quart[1]), int(quart[1]) + 1) and approx["hour"]["count"] == N
    assert (approx["action"].unique, approx["action"].top, approx["action"].freq) == (3, *most_first(2)[0])


def test_describe_without_values(spark, act):
    rows = act.select("action", "hour").withColumn("a", F.lit(None).cast("string")).withColumn(
        "n", F.lit(None).cast("int")).withColumn("t", F.lit(None).cast("timestamp_ntz"))
    for df, n in ((rows, N), (rows.limit(0), 0)):
        for approx in (False, True):
            d = {r.column_name: r for r in rp.describe_all(df, approx=approx).collect()}
            assert set(d) == {"action", "hour", "a", "n", "t"}
            assert d["action"]["count"] == d["hour"]["count"] == n
            assert all(d[c]["count"] == 0 and d[c]["mean"] is None and d[c].top is None for c in "ant")
            assert d["a"].unique == 0 and d["n"].unique is None


def test_describe_display(act):
    shown = {r.column_name: r for r in rp.describe_all(act.select("time", "hour", "action"), display=True).collect()}
    times = sorted(r[5] for r in ROWS)
    assert (shown["time"]["min"], shown["time"]["max"]) == (times[0], times[-1])
    assert shown["time"]["std"] == "—" and shown["hour"]["min"] == "7.0" and shown["action"]["mean"] == "—"


def test_schema_profile(act):
    p = rp.schema_profile(act.select("user_id", "time", "hour")).orderBy("position").collect()
    assert [(r.column_name, r.data_type) for r in p] == [("user_id", "string"), ("time", "timestamp_ntz"), ("hour", "int")]
    assert all(r.n_rows == N and r.n_columns == 3 for r in p)


def test_dashboard_rules(act):
    prof = an.profile(act, **L.DASHBOARD_RULES)
    flags = {r.user_id: r.anomaly_flag for r in prof.collect()}
    assert {u for u, f in flags.items() if f == L.DASHBOARD_FLAG_HIGH} == HIGH
    ratios = {r.user_id: r.view_purchase_ratio for r in prof.collect()}
    assert ratios["u-02"] == 1.0 and ratios["u-15"] == 15.0 and ratios["u-16"] == 9.5
    staged = fn.funnel_stage(fn.action_matrix(act), browse=L.DASHBOARD_STAGE_BROWSE)
    summary = dict(pairs(fn.funnel_stage_summary(staged)))
    assert summary[L.DASHBOARD_STAGE_BROWSE] == sum(not c and not p for _, c, p in VCP.values())


def test_inferred_schema_gives_same_results(spark, fixture_csv):
    inferred = read_activity(spark, fixture_csv, infer=True)
    assert dict(inferred.dtypes)["hour"] == "int"
    df = pr.prepare(inferred)
    assert dict(df.dtypes)["time"] == "timestamp_ntz"
    assert tuple(rp.summary(df, an.profile(df)).first()) == summary_row()


def test_readme_example_without_event_key(spark, fixture_csv):
    from actlens import hyperactive, prepare, profile, read_activity, session_sequences, summary

    df = prepare(read_activity(spark, fixture_csv))
    assert "event_id" not in df.columns
    prof = profile(df)
    assert hyperactive(prof).count() >= 1
    seqs = {r.session_id: r.action_sequence for r in session_sequences(df, 1000).collect()}
    assert seqs["s-96"] == L.SEQUENCE_SEP.join(["view", "cart", "view", "purchase"])
    assert tuple(summary(df, prof).first()) == summary_row()
    assert sq.session_rank(df).count() == N
