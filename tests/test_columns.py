"""Micro-fixtures: one row per rule boundary (see FIXTURES.md)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings as hsettings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acctlens.functions import columns as X
from acctlens.functions.dates import month_boundaries_between, to_utc_timestamp_ntz
from acctlens.functions.numeric import round_div


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_segment_boundaries(spark):
    rows = [("enterprise", 10), ("starter", 501), ("starter", 500), ("growth", 5), ("starter", 51), ("starter", 50)]
    got = _col(spark, rows, "tier string, n long", X.classify_segment(F.col("n"), F.col("tier")))
    assert got == ["enterprise", "enterprise", "mid_market", "mid_market", "mid_market", "smb"]


def test_lifecycle_boundaries(spark):
    rows = [("trial", 10), ("churned", 10), ("active", 90), ("active", 91), ("active", 365), ("active", 366),
            ("suspended", 30), ("active", None)]
    got = _col(spark, rows, "status string, days long", X.lifecycle_stage(F.col("status"), F.col("days")))
    assert got == ["trial", "churned", "onboarding", "growing", "growing", "mature", "onboarding", "mature"]


def test_sla_breach_boundaries(spark):
    rows = [("p1", 240), ("p1", 241), ("p2", 720), ("p2", 721), ("p3", 2880), ("p3", 2881),
            ("p4", 7200), ("p4", 7201), ("p1", None), ("p9", 99999)]
    got = _col(spark, rows, "p string, m long", X.is_sla_breach(F.col("m"), F.col("p")))
    assert got == [False, True, False, True, False, True, False, True, None, False]


def test_sla_target_unknown_priority_is_null(spark):
    got = _col(spark, [("p1",), ("p4",), ("p9",)], "p string", X.sla_target_hours(F.col("p")))
    assert got == [4, 120, None]


def test_resolution_hours_half_up(spark):
    rows = [(3,), (9,), (21,), (60,), (61,), (None,)]
    got = _col(spark, rows, "m long", X.resolution_hours(F.col("m")))
    assert got == [0.1, 0.2, 0.4, 1.0, 1.0, None]


def test_resolution_speed_boundaries(spark):
    rows = [("resolved", 2.0, 4), ("resolved", 4.0, 4), ("resolved", 6.0, 4), ("resolved", 6.1, 4),
            ("open", None, 4), ("escalated", 1.0, 4), ("resolved", None, 4), ("resolved", 1.0, None)]
    got = _col(spark, rows, "s string, h double, t int", X.resolution_speed(F.col("s"), F.col("h"), F.col("t")))
    assert got == ["fast", "on_time", "slow", "critical_breach", "unresolved", "unresolved",
                   "critical_breach", "critical_breach"]


def test_sla_ratio(spark):
    rows = [(0.1, 4), (2.0, 4), (1.0, 12), (None, 4), (1.0, None)]
    got = _col(spark, rows, "h double, t int", X.sla_ratio(F.col("h"), F.col("t")))
    assert got == [0.03, 0.5, 0.08, None, None]


def test_csat_tier_boundaries(spark):
    rows = [(None,), (4.0,), (3.9,), (3.0,), (2.9,)]
    got = _col(spark, rows, "s double", X.csat_tier(F.col("s")))
    assert got == ["no_rating", "satisfied", "neutral", "neutral", "dissatisfied"]


def test_month_boundaries(spark):
    rows = [(dt.date(2025, 2, 1), dt.date(2024, 5, 31)), (dt.date(2025, 1, 1), dt.date(2024, 12, 31)),
            (dt.date(2024, 1, 31), dt.date(2024, 1, 1))]
    got = _col(spark, rows, "a date, b date", month_boundaries_between(F.col("a"), F.col("b")))
    assert got == [9, 1, 0]


def test_support_score_ladder(spark):
    rows = [(0, "4.0", 1), (0, "3.9", 1), (0, "7.9", 2), (0, "0", 0), (2, "3.0", 1), (2, "2.9", 1), (2, "0", 0), (5, "4.5", 1), (6, "4.5", 1)]
    got = _col(spark, [(o, Decimal(s), n) for o, s, n in rows], "o long, s decimal(20,9), n long", X.support_score(F.col("o"), F.col("s"), F.col("n")))
    assert got == [100, 75, 75, 100, 50, 25, 50, 25, 10]


def test_revenue_score_ladder(spark):
    rows = [(Decimal("1"),), (Decimal("0"),), (Decimal("-49"),), (Decimal("-50"),)]
    got = _col(spark, rows, "n decimal(18,2)", X.revenue_score(F.col("n")))
    assert got == [100, 60, 30, 10]


def test_usage_trend_flags(spark):
    rows = [(5, 0), (5, 10), (4, 10), (0, 0)]
    df = spark.createDataFrame(rows, "last long, prev long")
    got = df.select(X.is_usage_declining(F.col("last"), F.col("prev")), X.usage_change_pct(F.col("last"), F.col("prev"))).collect()
    assert [tuple(r) for r in got] == [(False, 0.0), (False, -50.0), (True, -60.0), (False, 0.0)]


def test_feature_breadth(spark):
    got = _col(spark, [(5,), (6,), (3,), (0,)], "c long", X.feature_breadth_pct(F.col("c")))
    assert got == [100.0, 120.0, 60.0, 0.0]


def test_event_category_other(spark):
    got = _col(spark, [("api_call",), ("note_added",), ("made_up",), (None,)], "n string", X.event_category(F.col("n")))
    assert got == ["advanced", "crm_core", "other", "other"]


def test_health_tier_boundaries(spark):
    got = _col(spark, [(80.0,), (79.9,), (60.0,), (40.0,), (20.0,), (19.9,)], "s double", X.health_tier(F.col("s")))
    assert got == ["champion", "healthy", "healthy", "neutral", "at_risk", "critical"]


def test_health_score_all_signal_combinations(spark):
    """Every combination of signal values matches exact decimal HALF_UP rounding."""
    usage = [0, 25, 50, 75, 100]
    support = [10, 25, 50, 75, 100]
    revenue = [10, 30, 50, 60, 100]
    engagement = [0, 25, 50, 75, 100]
    rows = [(u, s, r, e) for u in usage for s in support for r in revenue for e in engagement]
    df = spark.createDataFrame(rows, "u long, s long, r long, e long")
    got = df.select("u", "s", "r", "e", X.health_score(F.col("u"), F.col("s"), F.col("r"), F.col("e")).alias("h")).collect()
    for row in got:
        exact = (Decimal(row.u) * Decimal("0.30") + Decimal(row.s) * Decimal("0.20")
                 + Decimal(row.r) * Decimal("0.25") + Decimal(row.e) * Decimal("0.25"))
        assert row.h == float(exact.quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)), tuple(row)


@hsettings(max_examples=60, deadline=None)
@given(
    num=st.integers(min_value=-10**12, max_value=10**12),
    den=st.integers(min_value=-10**9, max_value=10**9),
    scale=st.integers(min_value=0, max_value=3),
    factor=st.sampled_from([1, 100]),
)
def test_round_div_matches_decimal(spark, num, den, scale, factor):
    got = spark.range(1).select(round_div(F.lit(num), F.lit(den), scale, factor)).first()[0]
    if den == 0:
        assert got is None
        return
    exact = (Decimal(factor * num) / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    assert got == float(exact)


@pytest.mark.parametrize("mrr,prev,movement,exp,contr", [
    (100, None, "new", 100, 0), (150, 100, "expansion", 50, 0), (80, 100, "contraction", 0, 20), (100, 100, "flat", 0, 0),
])
def test_revenue_movement(spark, mrr, prev, movement, exp, contr):
    df = spark.createDataFrame([(mrr, prev)], "m long, p long")
    r = df.select(X.revenue_movement(F.col("m"), F.col("p")), X.expansion_amount(F.col("m"), F.col("p")),
                  X.contraction_amount(F.col("m"), F.col("p"))).first()
    assert tuple(r) == (movement, exp, contr)


def test_filter_on_a_staged_time_evaluates_its_text_once(spark):
    rows = [("1", "2024-01-01 23:00:00", "-05:30"), ("2", "2024-01-02 02:00:00", "+05:30"), ("3", "2024-01-02 02:00:00", ""), ("4", "2024-01-01", ""), ("5", None, "Z")]
    raw = spark.createDataFrame(rows, "ticket_id string, at string, zone string").selectExpr("ticket_id", "concat(at, '', upper(zone)) AS created_at")
    day = to_utc_timestamp_ntz(raw, "created_at").cast("date")
    late = raw.select("ticket_id", day.alias("created_date")).filter(F.col("created_date") >= F.lit("2024-01-02").cast("date")).select("ticket_id")
    assert sorted(r.ticket_id for r in late.collect()) == ["1", "3"]
    assert late._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1


def test_clean_text_trims_every_white_space_and_nothing_else(spark):
    space = [chr(i) for i in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    kept = ["\x1c", "\x1f", "᠎", "​", "﻿", "-", "t"]
    rows = [(f"{a}{b}x{a} y{b}{a}", f"x{a} y") for a in space for b in space] + [(f" {k}x{k}\n", f"{k}x{k}") for k in kept] + [("\t　", ""), ("", ""), (None, None)]
    out = spark.createDataFrame(rows, "c string, wanted string").withColumn("got", X.clean_text(F.col("c")))
    assert out.filter(~F.col("got").eqNullSafe(F.col("wanted"))).count() == 0
