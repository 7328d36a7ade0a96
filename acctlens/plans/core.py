"""Core layer (M6-M11): account, product and date dimensions; revenue, usage
and ticket facts, plus the per-account summaries they are built from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlens import config as C
from acctlens.config import Settings, Thresholds
from acctlens.functions import columns as X
from acctlens.functions.dates import as_date_lit, days_between, month_boundaries_between, whole_minutes_between
from acctlens.functions.numeric import MONEY, exact_score, mean_score, round_div, to_tenths
from acctlens.sources.generated import date_series_between, literal_values


# --- account dimension --------------------------------------------------------


def subscription_summary(stg_subscriptions: DataFrame) -> DataFrame:
    """Per-account subscription roll-up."""
    active = F.col("is_active")
    return stg_subscriptions.groupBy("account_id").agg(
        F.sum(F.when(active, F.col("mrr_amount")).otherwise(F.lit(0))).cast(MONEY).alias("current_mrr"),
        F.count_if(active).alias("active_subscription_count"),
        F.count(F.lit(1)).alias("total_subscription_count"),
        F.min("start_date").alias("first_subscription_date"),
        F.max(F.when(active, F.col("start_date"))).alias("latest_subscription_date"),
        F.count_if(active & (F.col("product_name") != C.PLATFORM_PRODUCT)).alias("active_addon_count"),
    )


def ticket_summary(stg_support_tickets: DataFrame) -> DataFrame:
    """Lifetime support roll-up per account.

    Means are kept as exact (sum, count) pairs and divided once, so the result
    does not depend on the order rows were summed in. Resolution hours are
    rounded to tenths by definition; scores keep all their digits.
    """
    return stg_support_tickets.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("lifetime_tickets"),
        F.count_if(X.is_open_ticket(F.col("status"))).alias("open_tickets"),
        F.sum(exact_score(F.col("satisfaction_score"))).alias("csat_sum"),
        F.count("satisfaction_score").alias("csat_n"),
        F.sum(to_tenths(F.col("resolution_hours"))).alias("hours_tenths"),
        F.count("resolution_hours").alias("hours_n"),
        F.sum(F.when(F.col("is_sla_breach"), 1).otherwise(0)).cast("bigint").alias("sla_breaches"),
    )


def _mean_tenths(sum_tenths: str, n: str, scale: int = 1):
    """round(coalesce(avg, 0), scale) from a (sum of tenths, count) pair."""
    return F.coalesce(round_div(F.col(sum_tenths), F.col(n) * F.lit(10), scale=scale), F.lit(0.0))


def dim_account(
    stg_accounts: DataFrame,
    stg_subscriptions: DataFrame,
    stg_support_tickets: DataFrame,
    settings: Settings,
) -> DataFrame:
    """M6: one row per account with tenure, segment, MRR, support history, lifecycle."""
    t = settings.thresholds
    as_of = as_date_lit(settings.as_of)
    s = subscription_summary(stg_subscriptions)
    tk = ticket_summary(stg_support_tickets)
    tenure_days = days_between(as_of, F.col("signup_date"))
    joined = stg_accounts.join(s, "account_id", "left").join(tk, "account_id", "left")
    current_mrr = F.coalesce(F.col("current_mrr"), F.lit(0)).cast(MONEY)
    return joined.select(
        "account_id", "company_name", "industry", "employee_count", "plan_tier",
        "account_owner", "region", "signup_date", "status",
        tenure_days.alias("tenure_days"),
        month_boundaries_between(as_of, F.col("signup_date")).alias("tenure_months"),
        X.classify_segment(F.col("employee_count"), F.col("plan_tier"), t).alias("account_segment"),
        current_mrr.alias("current_mrr"),
        X.annualize(current_mrr).cast(MONEY).alias("current_arr"),
        F.coalesce(F.col("active_subscription_count"), F.lit(0)).cast("bigint").alias("active_subscription_count"),
        F.coalesce(F.col("total_subscription_count"), F.lit(0)).cast("bigint").alias("total_subscription_count"),
        F.coalesce(F.col("active_addon_count"), F.lit(0)).cast("bigint").alias("active_addon_count"),
        "first_subscription_date",
        "latest_subscription_date",
        F.coalesce(F.col("lifetime_tickets"), F.lit(0)).cast("bigint").alias("lifetime_tickets"),
        F.coalesce(F.col("open_tickets"), F.lit(0)).cast("bigint").alias("open_tickets"),
        F.coalesce(mean_score(F.col("csat_sum"), F.col("csat_n"), 1), F.lit(0.0)).alias("avg_csat"),
        _mean_tenths("hours_tenths", "hours_n").alias("avg_resolution_hours"),
        F.coalesce(F.col("sla_breaches"), F.lit(0)).cast("bigint").alias("sla_breaches"),
        X.lifecycle_stage(F.col("status"), tenure_days, t).alias("lifecycle_stage"),
    )


# --- product dimension --------------------------------------------------------


def dim_product(stg_subscriptions: DataFrame) -> DataFrame:
    """M7: one row per product (add-ons) or product x tier (platform).

    The distinct product names are few, and the tier list is a fixed
    three-row literal, so the fan-out join is a broadcast.
    """
    spark = stg_subscriptions.sparkSession
    name = F.col("product_name")
    products = stg_subscriptions.select("product_name").distinct()
    display = X.lookup(name, C.PRODUCT_DISPLAY_NAMES)
    display = F.coalesce(display, F.initcap(F.replace(name, F.lit("_"), F.lit(" "))))
    list_price = F.when(name == C.PLATFORM_PRODUCT, F.lit(None).cast("bigint")).otherwise(
        F.coalesce(X.lookup(name, C.ADDON_LIST_PRICES), F.lit(0))
    )
    attributes = products.select(
        name,
        F.when(name == C.PLATFORM_PRODUCT, "platform").otherwise("addon").alias("product_type"),
        display.alias("product_display_name"),
        list_price.cast("bigint").alias("list_price_mrr"),
        F.coalesce(X.lookup(name, C.FEATURE_CATEGORIES), F.lit("other")).alias("feature_category"),
    )
    tiers = literal_values(spark, "tier", C.PLAN_TIERS).select(
        F.lit(C.PLATFORM_PRODUCT).alias("tier_product"),
        F.col("tier"),
        X.lookup(F.col("tier"), C.PLATFORM_TIER_PRICES).cast("bigint").alias("tier_price_mrr"),
    )
    joined = attributes.join(F.broadcast(tiers), attributes.product_name == tiers.tier_product, "left")
    plan_tier = F.coalesce(F.col("tier"), F.lit("all"))
    return joined.select(
        F.concat(name, F.lit("_"), plan_tier).alias("product_key"),
        name,
        "product_type",
        "product_display_name",
        plan_tier.alias("plan_tier"),
        F.coalesce(F.col("tier_price_mrr"), F.col("list_price_mrr")).alias("list_price_mrr"),
        "feature_category",
    )


# --- date dimension -----------------------------------------------------------


def calendar_attributes(spine: DataFrame, column: str = "date_day") -> DataFrame:
    """M8 body: calendar attributes for a one-column date spine."""
    d = F.col(column)
    dow = F.dayofweek(d)
    return spine.select(
        d.alias("date_day"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).cast("bigint").alias("week_number"),
        dow.cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        dow.isin(1, 7).alias("is_weekend"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.trunc(d, "year").alias("first_day_of_year"),
    )


def dim_date(spark, start: dt.date = C.DATE_SPINE_START, end: dt.date = C.DATE_SPINE_END) -> DataFrame:
    """M8: one row per day of a fixed calendar range."""
    from acctlens.sources.generated import date_series

    return calendar_attributes(date_series(spark, start, end))


def dim_date_for_activity(*dated: tuple[DataFrame, str]) -> DataFrame:
    """M8 over the span of dates present in the given relations.

    Each (frame, column) pair contributes a min/max by partial aggregation;
    the resulting calendar range is then exploded into days.
    """
    bounds = None
    for df, col in dated:
        b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
        bounds = b if bounds is None else bounds.unionByName(b)
    bounds = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return calendar_attributes(date_series_between(bounds, "lo", "hi"))


# --- revenue fact --------------------------------------------------------------


def monthly_revenue(stg_invoices: DataFrame) -> DataFrame:
    """Paid amount per account and invoice month."""
    return (
        stg_invoices.filter(F.col("is_paid"))
        .groupBy("account_id", F.col("invoice_month").alias("revenue_month"))
        .agg(F.sum("amount").cast(MONEY).alias("mrr"))
    )


def fct_revenue(stg_invoices: DataFrame, settings: Settings | None = None, with_next_month: bool = False) -> DataFrame:
    """M9: monthly MRR per account with movement class and amounts.

    ``lag``, ``lead`` and ``dense_rank`` share one window (one shuffle on
    ``account_id`` and one sort). ``with_next_month`` keeps the following paid
    month, which churn detection uses instead of a self-join.
    """
    include_new = True if settings is None else settings.include_new_in_expansion
    gap_aware = False if settings is None else settings.gap_aware_movements
    w = Window.partitionBy("account_id").orderBy("revenue_month")
    m = monthly_revenue(stg_invoices).select(
        "*",
        F.lag("mrr").over(w).alias("_prev"),
        F.lag("revenue_month").over(w).alias("previous_revenue_month"),
        F.lead("revenue_month").over(w).alias("next_revenue_month"),
        F.dense_rank().over(w).cast("bigint").alias("month_number"),
    )
    prev = F.col("_prev")
    if gap_aware:
        prev = F.when(F.col("previous_revenue_month") == F.add_months(F.col("revenue_month"), -1), prev)
    mrr = F.col("mrr")
    cols = [
        "account_id",
        "revenue_month",
        mrr.alias("mrr"),
        X.annualize(mrr).cast(MONEY).alias("arr"),
        F.coalesce(prev, F.lit(0)).cast(MONEY).alias("previous_mrr"),
        X.revenue_movement(mrr, prev).alias("revenue_movement"),
        X.expansion_amount(mrr, prev, include_new).cast(MONEY).alias("expansion_mrr"),
        X.contraction_amount(mrr, prev).cast(MONEY).alias("contraction_mrr"),
        (mrr - F.coalesce(prev, F.lit(0))).cast(MONEY).alias("net_mrr_change"),
        "month_number",
    ]
    if with_next_month:
        cols.append("next_revenue_month")
    return m.select(*cols)


# --- usage fact ------------------------------------------------------------------


def _null_safe_day(account_id, event_date) -> dict:
    """An account-day as non-null join keys, so that NULLs match each other."""
    return {
        "_account": F.coalesce(account_id, F.lit("")), "_no_account": account_id.isNull(),
        "_date": F.coalesce(event_date, F.lit("0001-01-01").cast("date")), "_no_date": event_date.isNull(),
    }


def fct_usage(stg_usage_events: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row per account and day.

    Events are first reduced to (account, day, user), with partial sums before
    the shuffle; the day's measures are sums over that frame and its users are
    its rows. Distinct event names are counted on their own reduced frame and
    joined to the day. That join is on a unique key, so consumers that do not
    ask for the names neither join nor read them.
    """
    ts = F.col("event_timestamp")
    cat, name = F.col("event_category"), F.col("event_name")
    counts = {f"{c}_events": F.count_if(cat == c) for c in C.EVENT_CATEGORIES} | {
        "api_calls": F.count_if(name == "api_call"),
        "reports_created": F.count_if(name == "report_created"),
        "workflows_created": F.count_if(name == "workflow_created"),
    }
    per_user = stg_usage_events.groupBy("account_id", "event_date", "user_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.bit_or(X.small_domain_bit(cat, C.EVENT_CATEGORY_NAMES)).alias("_categories"),
        *[c.alias(n) for n, c in counts.items()],
        F.min(ts).alias("_first"), F.max(ts).alias("_last"),
    )
    first, last = F.min("_first"), F.max("_last")
    daily = per_user.groupBy("account_id", "event_date").agg(
        F.sum("total_events").alias("total_events"),
        F.count("user_id").alias("active_users"),
        F.bit_count(F.bit_or("_categories")).cast("bigint").alias("distinct_categories_used"),
        *[F.sum(n).alias(n) for n in counts],
        first.alias("first_event_at"),
        last.alias("last_event_at"),
        X.resolution_hours(whole_minutes_between(last, first)).alias("active_hours"),
    )
    day = _null_safe_day(F.col("account_id"), F.col("event_date"))
    names = stg_usage_events.filter(name.isNotNull()).select(*[c.alias(k) for k, c in day.items()], name).distinct()
    features = names.groupBy(*day).agg(F.count(F.lit(1)).alias("_features"))
    own = _null_safe_day(daily["account_id"], daily["event_date"])
    same_day = [own[k] == features[k] for k in day]
    joined = daily.join(features, same_day, "left").withColumn("distinct_features_used", F.coalesce("_features", F.lit(0)).cast("bigint"))
    return joined.select(
        "account_id", "event_date", "total_events", "active_users", "distinct_features_used", "distinct_categories_used",
        *counts, "first_event_at", "last_event_at", "active_hours",
        X.feature_breadth_pct(F.col("distinct_categories_used"), t.scored_categories).alias("feature_breadth_pct"),
        X.is_power_usage_day(F.col("total_events"), F.col("distinct_features_used"), t).alias("is_power_usage_day"),
    )


# --- ticket fact -------------------------------------------------------------------


def fct_tickets(stg_support_tickets: DataFrame, stg_accounts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Tickets with SLA ratio, speed and CSAT tiers and account context.

    The account side grows with the data, so no broadcast is forced; AQE
    switches to a broadcast join when its runtime size is under the threshold.
    """
    ctx = stg_accounts.select(
        "account_id",
        F.col("plan_tier").alias("account_plan_tier"),
        "account_owner",
        F.col("region").alias("account_region"),
    )
    tickets = stg_support_tickets.join(ctx, "account_id", "left")
    hours, target = F.col("resolution_hours"), F.col("sla_target_hours")
    return tickets.select(
        "ticket_id", "account_id", "priority", "category", "status", "satisfaction_score",
        "created_at", "resolved_at", "created_date",
        F.month("created_at").cast("bigint").alias("created_month"),
        F.date_format("created_at", "yyyy-MM").alias("created_year_month"),
        "resolution_hours", "sla_target_hours", "is_sla_breach",
        X.sla_ratio(hours, target).alias("sla_ratio"),
        X.resolution_speed(F.col("status"), hours, target, t).alias("resolution_speed"),
        X.csat_tier(F.col("satisfaction_score"), t).alias("csat_tier"),
        "account_plan_tier", "account_owner", "account_region",
    )
