"""Values as messy exports hold them: white space, zones, sub-cent money, scores of any digits, audit times."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from acctlens.config import Settings
from acctlens.functions import columns as X
from acctlens.plans import core, marts
from acctlens.plans.pipeline import Pipeline
from acctlens.plans.staging import stg_invoices, stg_support_tickets, stg_usage_events
from acctlens.sources.driver_tables import AS_OF, load_raw_inputs
from acctlens.sources.raw import RAW_INVOICES, RAW_USAGE_EVENTS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("space", ["\t", "\n", "\u00a0", "\u2003", "\u3000", " \r\n "])
def test_white_space_of_any_kind_is_trimmed(spark, space):
    row = spark.createDataFrame([(f"{space}Open {space}P1{space}",)], "t string").select(X.clean_code(F.col("t")).alias("c")).first()
    assert row.c == f"open {space}p1".lower()


def _event_times(spark, texts):
    rows = [(f"e{i}", "a", "u", "api_call", t, None) for i, t in enumerate(texts)]
    staged = stg_usage_events(spark.createDataFrame(rows, RAW_USAGE_EVENTS))
    return [r.event_timestamp for r in staged.orderBy("event_id").collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_event_times_are_utc_instants(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = _event_times(spark, ["2024-01-01T00:30:00+02:00", "2024-01-01T00:30:00Z", "2024-01-01 00:30:00", "2024-01-01", "2024-06-30T23:00:00.5-0530", None])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    day = dt.datetime(2024, 1, 1)
    half = dt.timedelta(minutes=30)
    assert got == [day - 3 * half, day + half, day + half, day, dt.datetime(2024, 7, 1, 4, 30, 0, 500000), None]


def test_zoned_timestamps_do_not_follow_the_session(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    frame = spark.createDataFrame([("e", "a", "u", "api_call", 1704074400)], "event_id string, account_id string, user_id string, event_name string, s long")
    frame = frame.withColumn("event_timestamp", F.timestamp_seconds("s"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = stg_usage_events(frame).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (row.event_date, row.event_hour) == (dt.date(2024, 1, 1), 2)


def test_sub_cent_money_is_summed_before_rounding(spark):
    rows = [(f"i{i}", "a", "2024-01-05", "10.005", "usd", "paid", None) for i in range(2)]
    raw = spark.createDataFrame(rows, "invoice_id string, account_id string, invoice_date string, amount string, currency string, status string, line_items string")
    assert raw.columns == RAW_INVOICES.fieldNames()
    assert core.monthly_revenue(stg_invoices(raw)).first().mrr == Decimal("20.01")


def test_scores_keep_their_digits(spark):
    columns = "ticket_id string, account_id string, created_at string, resolved_at string, priority string, category string, status string, satisfaction_score double"
    rows = [(f"t{i}", "a", "2025-01-20T00:00:00", "2025-01-20T05:00:00", "p1\t", "bug", "resolved", 3.95) for i in range(2)]
    staged = stg_support_tickets(spark.createDataFrame(rows, columns))
    score = marts.support_scores(staged, Settings(as_of=dt.date(2025, 1, 31))).first()
    assert (score.recent_avg_csat, score.support_score) == (3.95, 75)
    assert staged.first().is_sla_breach is True


def test_audit_columns_reach_every_layer(spark):
    p = Pipeline(load_raw_inputs(spark, SF), Settings(as_of=AS_OF), audit=True)
    for name in p.STAGING:
        assert "_loaded_at" in getattr(p, name).columns
    assert "scored_at" in p.customer_health_scores.columns and "assessed_at" in p.churn_risk_view.columns
    assert "scored_at" not in Pipeline(load_raw_inputs(spark, SF), Settings(as_of=AS_OF)).customer_health_scores.columns


def test_no_account_ranks_in_one_task(spark):
    p = Pipeline(load_raw_inputs(spark, SF), Settings(as_of=AS_OF))
    plan = p.churn_risk_view._jdf.queryExecution().optimizedPlan().toString()
    assert "intervention_priority" not in plan
