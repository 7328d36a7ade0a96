"""Remaining boundary fixtures: trailing-window edges, one-row quantile group,
catalogue fallback for an unknown product, audit columns and the view sink."""

import datetime as dt
from decimal import Decimal


from acctlens.config import Settings
from acctlens.plans import core, marts
from acctlens.sources.sinks import register_views

D = dt.date
AS_OF = D(2025, 1, 31)


def test_usage_trend_window_edges(spark):
    s = Settings(as_of=AS_OF)
    rows = [
        ("a", AS_OF - dt.timedelta(days=30), 5),   # first day of the last window
        ("a", AS_OF - dt.timedelta(days=31), 7),   # last day of the previous window
        ("a", AS_OF - dt.timedelta(days=60), 11),  # first day of the previous window
        ("a", AS_OF - dt.timedelta(days=61), 13),  # outside both
    ]
    usage = spark.createDataFrame(rows, "account_id string, event_date date, total_events long")
    r = marts.usage_trend(usage, s).first()
    assert (r.events_last_30d, r.events_prev_30d) == (5, 18)


def test_one_row_quantile_group(spark):
    t = spark.createDataFrame(
        [("t1", "x", "p3", "resolved", 4.0, 7.5, False, D(2025, 1, 5))],
        "ticket_id string, account_id string, priority string, status string, satisfaction_score double, "
        "resolution_hours double, is_sla_breach boolean, created_date date",
    )
    accounts = spark.createDataFrame([("x", "enterprise", "growth")], "account_id string, account_segment string, plan_tier string")
    r = marts.sla_adherence(t, accounts).filter("dimension_type = 'priority'").first()
    assert (r.median_resolution_hours, r.p90_resolution_hours, r.avg_resolution_hours, r.avg_csat) == (7.5, 7.5, 7.5, 4.0)


def test_unknown_product_uses_fallbacks(spark):
    subs = spark.createDataFrame(
        [("novacrm_platform",), ("api_access",), ("data_export_pack",)], "product_name string"
    )
    rows = {r.product_key: r for r in core.dim_product(subs).collect()}
    assert set(rows) == {
        "novacrm_platform_starter", "novacrm_platform_growth", "novacrm_platform_enterprise",
        "api_access_all", "data_export_pack_all",
    }
    new = rows["data_export_pack_all"]
    assert (new.product_display_name, new.list_price_mrr, new.feature_category, new.product_type) == (
        "Data Export Pack", 0, "other", "addon")
    assert rows["novacrm_platform_enterprise"].list_price_mrr == 499


def test_audit_columns_and_views(spark):
    from acctlens.plans.staging import stg_accounts

    raw = spark.createDataFrame(
        [("1", "Co", "Tech", "10", "starter", "Ann", "europe", "2024-01-01", "active")],
        "account_id string, company_name string, industry string, employee_count string, plan_tier string, "
        "account_owner string, region string, signup_date string, status string",
    )
    staged = stg_accounts(raw, audit=True)
    assert "_loaded_at" in staged.columns
    register_views({"acctlens_test_accounts": staged})
    assert spark.table("acctlens_test_accounts").count() == 1


def test_revenue_trend_recent_values_only_in_window(spark):
    s = Settings(as_of=AS_OF)
    rev = spark.createDataFrame(
        [("a", D(2024, m, 1), Decimal(m), "contraction" if m % 2 else "expansion") for m in range(1, 13)]
        + [("a", D(2025, 1, 1), Decimal(13), "contraction")],
        "account_id string, revenue_month date, mrr decimal(18,2), revenue_movement string",
    )
    r = marts.revenue_trend(rev, s, with_recent_values=True).first()
    # window starts 2024-07-31: months Aug..Jan; contractions in Sep, Nov, Jan
    assert r.contraction_months_6m == 3
    assert r.recent_mrr_values == [Decimal("13.00"), Decimal("12.00"), Decimal("11.00")]


def test_usage_fact_counts_distinct_names_and_users(spark):
    from acctlens.plans.staging import stg_usage_events
    from acctlens.sources.raw import RAW_USAGE_EVENTS

    rows = [
        ("e1", "a", "u1", "api_call", "2025-01-10T09:00:00", None),
        ("e2", "a", "u2", "api_call", "2025-01-10T10:00:00", None),
        ("e3", "a", "u1", "report_created", "2025-01-10T11:00:00", None),
        ("e4", "a", "u1", "made_up_event", "2025-01-10T12:00:00", None),
        ("e5", "b", "u9", "note_added", "2025-01-11T08:00:00", None),
    ]
    events = stg_usage_events(spark.createDataFrame(rows, RAW_USAGE_EVENTS))
    day = {(r.account_id, r.event_date): r for r in core.fct_usage(events).collect()}
    a, b = day[("a", D(2025, 1, 10))], day[("b", D(2025, 1, 11))]
    assert (a.total_events, a.active_users, a.distinct_features_used, a.distinct_categories_used) == (4, 2, 3, 3)
    assert (a.api_calls, a.reports_created, a.advanced_events, a.reporting_events, a.active_hours) == (2, 1, 2, 1, 3.0)
    assert (b.total_events, b.active_users, b.crm_core_events, b.api_calls) == (1, 1, 1, 0)
