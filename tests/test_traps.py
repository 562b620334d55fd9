"""Inline cases the reference data lacks (FIXTURES.md section 3, SURVEY T1-T9)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from actlens.functions import labels as L
from actlens.operators import anomaly as an
from actlens.operators import explore as ex
from actlens.operators import funnel as fn
from actlens.operators import prepare as pr
from actlens.operators import report as rp
from actlens.operators import sequence as sq
from tests.conftest import activity_frame

T0 = "2024-01-15 08:00:0"


def test_malformed_time_becomes_null_and_is_dropped(spark):
    df = activity_frame(spark, [("U1", "S1", "view", "2024-01-15 08:00:00"),
                                ("U1", "S1", "view", "15/01/2024 08:00"),
                                ("U1", "S1", "view", "2024-13-45 99:00:00")])
    assert df.filter(F.col("time").isNull()).count() == 2
    assert pr.drop_incomplete(df).count() == 1
    rep = pr.cleaning_report(df).first()
    assert (rep.rows_before, rep.rows_after, rep.rows_removed) == (3, 1, 2)


def test_timestamp_input_passes_through(spark):
    df = spark.createDataFrame([("2024-01-15 08:00:00",)], "time string").select(F.to_timestamp("time").alias("time"))
    out = pr.parse_time(df)
    assert out.schema["time"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize("col", ["user_id", "session_id", "action", "category", "time", "device"])
def test_null_in_each_column_is_dropped(spark, col):
    df = activity_frame(spark, [("U1", "S1", "view", T0 + "1"), ("U2", "S2", "cart", T0 + "2")])
    df = df.withColumn(col, F.when(F.col("user_id") == "U2", F.lit(None)).otherwise(F.col(col)))
    assert [r.user_id for r in pr.drop_incomplete(df).collect()] == ["U1"]
    assert pr.cleaning_report(df).first().rows_removed == 1


def test_unknown_action_counts_nowhere_but_keeps_user(spark):
    df = activity_frame(spark, [("U1", "S1", "signup", T0 + "1"), ("U2", "S2", "view", T0 + "2")])
    m = {r.user_id: tuple(r)[1:] for r in fn.action_matrix(df).collect()}
    assert m == {"U1": (0, 0, 0), "U2": (1, 0, 0)}
    staged = {r.user_id: r.funnel_stage for r in fn.funnel_stage(fn.action_matrix(df)).collect()}
    assert staged["U1"] == L.STAGE_BROWSE


def test_substring_action_only_matches_in_substring_mode(spark):
    df = activity_frame(spark, [("U1", "S1", "review", T0 + "1"), ("U1", "S1", "cart", T0 + "2"),
                                ("U1", "S1", "purchase", T0 + "3")])
    assert sq.complete_sessions(df).count() == 0
    assert sq.complete_sessions(df, match="substring").count() == 1
    with pytest.raises(ValueError):
        sq.complete_sessions(df, match="fuzzy")


def test_purchase_without_view_is_complete(spark):
    df = activity_frame(spark, [("U1", "S1", "purchase", T0 + "1")])
    assert fn.funnel_stage(fn.action_matrix(df)).first().funnel_stage == L.STAGE_COMPLETE


def test_equal_times_share_rank_and_get_distinct_positions(spark):
    df = activity_frame(spark, [("U1", "S1", "view", T0 + "1"), ("U1", "S1", "cart", T0 + "1"),
                                ("U1", "S1", "purchase", T0 + "2")])
    ranks = sorted(r.action_rank for r in sq.session_rank(df).collect())
    assert ranks == [1, 1, 3]
    pos = {r.event_id: r.rn for r in sq.session_position(df).collect()}
    assert pos == {0: 1, 1: 2, 2: 3}
    seq = sq.session_sequences(df, 10).first().action_sequence
    assert seq == L.SEQUENCE_SEP.join(["view", "cart", "purchase"])


def test_sequence_is_time_ordered_not_input_ordered(spark):
    df = activity_frame(spark, [("U1", "S1", "purchase", T0 + "9"), ("U1", "S1", "view", T0 + "1"),
                                ("U1", "S1", "cart", T0 + "5")])
    assert sq.session_sequences(df, 10).first().action_sequence == L.SEQUENCE_SEP.join(["view", "cart", "purchase"])


def test_tied_counts_pick_lowest_key(spark):
    df = activity_frame(spark, [("U1", "S1", "view", "2024-01-15 14:00:00"), ("U1", "S1", "view", "2024-01-15 09:00:00")])
    assert ex.peak(df, "hour").first().hour == 9


@pytest.mark.parametrize("views,purchases,digits,flag", [
    (16, 2, 2, L.FLAG_NORMAL),      # ratio 8.00
    (2001, 250, 2, L.FLAG_NORMAL),  # 8.004 rounds to 8.00
    (1601, 200, 2, L.FLAG_MODERATE),  # 8.005 rounds half-up to 8.01
    (201, 25, 2, L.FLAG_MODERATE),  # 8.04
    (201, 25, 1, L.FLAG_NORMAL),    # 8.04 at one digit is 8.0
    (9, 1, 2, L.FLAG_MODERATE),
    (5, 0, 2, L.FLAG_HIGH),
    (4, 0, 2, L.FLAG_NORMAL),
])
def test_ratio_rounding_decides_flag(spark, views, purchases, digits, flag):
    prof = spark.createDataFrame([("U1", views, 0, purchases)], "user_id string, views long, carts long, purchases long")
    assert an.flag_anomalies(prof, digits=digits).first().anomaly_flag == flag


def test_ratio_without_purchase_is_views(spark):
    prof = spark.createDataFrame([("U1", 7, 0, 0), ("U2", 23, 0, 40)], "user_id string, views long, carts long, purchases long")
    got = {r.user_id: r.view_purchase_ratio for r in an.with_ratio(prof).collect()}
    assert got == {"U1": 7.0, "U2": 0.58}


def test_single_user_has_no_threshold(spark):
    df = activity_frame(spark, [("U1", "S1", "view", T0 + "1")])
    prof = an.profile(df)
    assert an.views_threshold(prof).first().threshold is None
    assert an.hyperactive(prof).count() == 0
    assert an.label_hyperactive(prof).first().behavior_type == L.BEHAVIOR_NORMAL


def test_empty_input(spark):
    df = activity_frame(spark, [("U1", "S1", "view", T0 + "1")]).limit(0)
    prof = an.profile(df)
    s = rp.summary(df, prof).first()
    assert (s.total_events, s.total_users, s.anomaly_rate, s.peak_hour, s.peak_day) == (0, 0, None, None, None)
    assert an.anomaly_totals(prof).first().anomaly_rate is None
    conv = fn.conversion(prof).first()
    assert conv.view_to_cart_rate is None and conv.cart_to_purchase_rate is None
    assert ex.with_share(ex.count_by(df, "action"), "count").count() == 0


def test_empty_filter_set_keeps_nothing(spark):
    df = activity_frame(spark, [("U1", "S1", "view", T0 + "1")])
    assert pr.filter_activity(df, actions=[]).count() == 0
    assert pr.filter_activity(df, actions=None).count() == 1
    assert pr.coverage(df, categories=[]).first().shown == 0


def test_search_is_regex_on_upper_cased_term(spark):
    df = activity_frame(spark, [("U001", "S1", "view", T0 + "1"), ("U011", "S2", "view", T0 + "2")])
    assert {r.user_id for r in pr.search_users(df, "u0.1").collect()} == {"U001", "U011"}
    assert {r.user_id for r in pr.search_users(df, "u001").collect()} == {"U001"}


def test_conversion_rounds_half_to_even(spark):
    # 1 of 8 viewers carted: 12.5 % -> 12 (Python's round); 3 of 8: 37.5 -> 38
    rows = [("U%d" % i, 1, 1 if i < 1 else 0, 0) for i in range(8)]
    prof = spark.createDataFrame(rows, "user_id string, views long, carts long, purchases long")
    assert fn.conversion(prof).first().view_to_cart_rate == 12
    rows = [("U%d" % i, 1, 1 if i < 3 else 0, 0) for i in range(8)]
    prof = spark.createDataFrame(rows, "user_id string, views long, carts long, purchases long")
    assert fn.conversion(prof).first().view_to_cart_rate == 38


def test_dashboard_labels_are_selectable(spark):
    prof = spark.createDataFrame([("U1", 9, 0, 0)], "user_id string, views long, carts long, purchases long")
    out = an.flag_anomalies(prof, high=L.DASHBOARD_FLAG_HIGH, moderate=L.DASHBOARD_FLAG_MODERATE)
    assert out.first().anomaly_flag == L.DASHBOARD_FLAG_HIGH


def test_recommended_conf_scales_partitions():
    from actlens.plans.session import recommended_conf

    small = recommended_conf(10 * 2**20, 8)
    big = recommended_conf(100 * 2**40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)


def test_dashboard_rate_rounds_half_even(spark):
    # 1 of 8 flagged: 12.5 % -> 12 on the dashboard card, 12.5 in the batch report
    rows = [("U%d" % i, 9 if i == 0 else 1, 0, 0 if i == 0 else 1) for i in range(8)]
    prof = an.flag_anomalies(spark.createDataFrame(rows, "user_id string, views long, carts long, purchases long"))
    assert an.anomaly_totals(prof).first().anomaly_rate == 12.5
    assert an.anomaly_totals(prof, digits=0, rounding="half_even").first().anomaly_rate == 12.0
    assert an.anomaly_totals(prof, digits=0).first().anomaly_rate == 13.0


def test_csv_export_round_trips_prepared_rows(spark, tmp_path):
    from actlens.sources.csv import read_activity, write_csv

    df = activity_frame(spark, [("U1", "S1", "view", "2024-01-15 08:00:01"), ("U1", "S1", "cart", T0 + "2")])
    df = df.withColumn("time", F.when(F.col("action") == "cart", F.col("time") + F.expr("INTERVAL 0.123456 SECOND"))
                       .otherwise(F.col("time")))
    from actlens.sources.schema import ACTIVITY_COLUMNS

    path = write_csv(df.withColumn("product_id", F.lit("P1")).select(*ACTIVITY_COLUMNS), str(tmp_path / "out"))
    back = pr.prepare(read_activity(spark, path), calendar=False)
    assert sorted(str(r.time) for r in back.collect()) == sorted(str(r.time) for r in df.collect())
    text = open(sorted((tmp_path / "out").glob("part-*.csv"))[0]).read() + "".join(
        open(p).read() for p in sorted((tmp_path / "out").glob("part-*.csv"))[1:])
    assert "2024-01-15 08:00:01," in text and ".123456" in text and "T08" not in text


def test_reordered_csv_columns_fail_loudly(spark, tmp_path):
    import pytest as _pytest

    from actlens.sources.csv import read_activity

    p = tmp_path / "bad.csv"
    p.write_text("session_id,user_id,action,category,product_id,time,hour,day_of_week,device\n"
                 "S1,U1,view,Books,P1,2024-01-15 08:00:00,8,Monday,mobile\n")
    with _pytest.raises(Exception):
        read_activity(spark, str(p)).collect()
