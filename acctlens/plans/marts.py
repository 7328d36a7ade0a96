"""Mart layer (M12-M16) and the signal builders they are made of.

Every signal is pre-aggregated to one row per ``account_id`` (or per month)
before it is joined, so the joins of M12/M13 are between account-grain
frames hash-partitioned on the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlens.config import Settings
from acctlens.functions import columns as X
from acctlens.functions.dates import month_boundaries_between, trailing_days_start, trailing_months_start
from acctlens.functions.numeric import MONEY, MONEY_SCALE, exact_score, mean_score, round_div, to_tenths
from acctlens.operators.ranking import global_ntile, global_row_number, latest_per_key


# --- customer health ------------------------------------------------------------


def usage_scores(fct_usage: DataFrame, settings: Settings) -> DataFrame:
    """Quartile (x25) of mean daily events over the trailing window."""
    t = settings.thresholds
    per_account = (
        fct_usage.filter(F.col("event_date") >= trailing_days_start(settings.as_of, t.usage_window_days))
        .groupBy("account_id")
        .agg(F.avg("total_events").alias("avg_daily_events"))
    )
    ranked = global_ntile(per_account, ["avg_daily_events", "account_id"], t.score_buckets, "_q")
    return ranked.select(
        "account_id", "avg_daily_events", (F.col("_q") * (100 // t.score_buckets)).cast("bigint").alias("usage_score")
    )


def support_scores(tickets: DataFrame, settings: Settings) -> DataFrame:
    """Open-ticket and CSAT ladder over the trailing window.

    ``tickets`` is any ticket-grain frame with the staged ticket columns
    (``stg_support_tickets`` or ``fct_tickets``); the staged one avoids the
    account-context join the fact carries.
    """
    t = settings.thresholds
    agg = (
        tickets.filter(F.col("created_date") >= trailing_days_start(settings.as_of, t.support_window_days))
        .groupBy("account_id")
        .agg(
            F.count_if(X.is_open_ticket(F.col("status"))).alias("recent_open_tickets"),
            F.sum(exact_score(F.col("satisfaction_score"))).alias("_csat_sum"),
            F.count("satisfaction_score").alias("_csat_n"),
        )
    )
    avg = F.when(F.col("_csat_n") > 0, F.col("_csat_sum").cast("double") / F.col("_csat_n"))
    return agg.select(
        "account_id",
        "recent_open_tickets",
        "_csat_sum",
        "_csat_n",
        avg.alias("recent_avg_csat"),
        X.support_score(F.col("recent_open_tickets"), F.col("_csat_sum"), F.col("_csat_n"), t).cast("bigint").alias("support_score"),
    )


def revenue_scores(fct_revenue: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Score of each account's latest revenue month."""
    latest = latest_per_key(fct_revenue, ["account_id"], "revenue_month", ["mrr", "net_mrr_change"])
    return latest.select("account_id", "mrr", "net_mrr_change", X.revenue_score(F.col("net_mrr_change"), *([settings.thresholds] if settings else [])).cast("bigint").alias("revenue_score"))


def engagement_scores(stg_usage_events: DataFrame, settings: Settings) -> DataFrame:
    """Quartile (x25) of distinct features used over the trailing window."""
    t = settings.thresholds
    per_account = (
        stg_usage_events.filter(F.col("event_date") >= trailing_days_start(settings.as_of, t.engagement_window_days))
        .groupBy("account_id")
        .agg(F.count_distinct("event_name").alias("features_used_30d"))
    )
    ranked = global_ntile(per_account, ["features_used_30d", "account_id"], t.score_buckets, "_q")
    return ranked.select(
        "account_id", "features_used_30d", (F.col("_q") * (100 // t.score_buckets)).cast("bigint").alias("engagement_score")
    )


def scored_accounts(
    dim_account: DataFrame,
    fct_usage: DataFrame,
    tickets: DataFrame,
    fct_revenue: DataFrame,
    stg_usage_events: DataFrame,
    settings: Settings,
) -> DataFrame:
    """M12 without its rank: weighted health score and tier per active account.

    ``tickets``: ticket-grain frame (``stg_support_tickets`` or ``fct_tickets``).
    """
    t = settings.thresholds
    base = dim_account.filter(F.col("status") == "active").select(
        "account_id", "company_name", "account_segment", "plan_tier", "tenure_months", "current_mrr",
        "current_arr", "account_owner", "lifecycle_stage", "region",
    )
    u = usage_scores(fct_usage, settings)
    s = support_scores(tickets, settings)
    r = revenue_scores(fct_revenue, settings)
    e = engagement_scores(stg_usage_events, settings)
    j = base.join(u, "account_id", "left").join(s, "account_id", "left").join(r, "account_id", "left").join(e, "account_id", "left")
    us = F.coalesce(F.col("usage_score"), F.lit(t.missing_usage_score)).cast("bigint")
    ss = F.coalesce(F.col("support_score"), F.lit(t.missing_support_score)).cast("bigint")
    rs = F.coalesce(F.col("revenue_score"), F.lit(t.missing_revenue_score)).cast("bigint")
    es = F.coalesce(F.col("engagement_score"), F.lit(t.missing_engagement_score)).cast("bigint")
    score = X.health_score(us, ss, rs, es, settings.weights)
    scored = j.select(
        "account_id", "company_name", "account_segment", "plan_tier", "tenure_months", "current_mrr",
        "current_arr", "account_owner", "lifecycle_stage", "region",
        us.alias("usage_score"), ss.alias("support_score"), rs.alias("revenue_score"), es.alias("engagement_score"),
        F.coalesce(F.col("avg_daily_events"), F.lit(0.0)).alias("avg_daily_events_30d"),
        F.coalesce(F.col("recent_open_tickets"), F.lit(0)).cast("bigint").alias("open_tickets_90d"),
        F.coalesce(mean_score(F.col("_csat_sum"), F.col("_csat_n"), 1), F.lit(0.0)).alias("avg_csat_90d"),
        F.coalesce(F.col("mrr"), F.lit(0)).cast(MONEY).alias("latest_mrr"),
        F.coalesce(F.col("net_mrr_change"), F.lit(0)).cast(MONEY).alias("latest_mrr_change"),
        F.coalesce(F.col("features_used_30d"), F.lit(0)).cast("bigint").alias("features_used_30d"),
        score.alias("health_score"),
    )
    return scored.withColumn("health_tier", X.health_tier(F.col("health_score"), t))


def customer_health_scores(scored: DataFrame, accounts: DataFrame, audit: bool = False) -> DataFrame:
    """``scored_accounts`` with the intervention priority.

    The scores are few whole numbers; ``accounts`` (any frame with the account ids) tells where to cut
    the ties, so the scored accounts are evaluated once.
    """
    out = global_row_number(
        scored, ["health_score", "account_id"], "intervention_priority", steps=["health_score"], sample=accounts.select("account_id")
    )
    return out.withColumn("scored_at", F.current_timestamp()) if audit else out


# --- churn risk -------------------------------------------------------------------


def usage_trend(fct_usage: DataFrame, settings: Settings) -> DataFrame:
    """Events in the last window vs the window before it."""
    n = settings.thresholds.trend_window_days
    recent = trailing_days_start(settings.as_of, n)
    earlier = trailing_days_start(settings.as_of, 2 * n)
    d = F.col("event_date")
    return (
        fct_usage.filter(d >= earlier)
        .groupBy("account_id")
        .agg(
            F.sum(F.when(d >= recent, F.col("total_events")).otherwise(0)).cast("bigint").alias("events_last_30d"),
            F.sum(F.when((d >= earlier) & (d < recent), F.col("total_events")).otherwise(0)).cast("bigint").alias("events_prev_30d"),
        )
    )


def escalation_signal(tickets: DataFrame, settings: Settings) -> DataFrame:
    """Escalated tickets (and the high-priority share) in the trailing window.

    ``tickets``: a ticket-grain frame, as for ``support_scores``.
    """
    start = trailing_days_start(settings.as_of, settings.thresholds.escalation_window_days)
    return (
        tickets.filter((F.col("created_date") >= start) & (F.col("status") == "escalated"))
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("escalated_tickets_90d"),
            F.count_if(F.col("priority").isin("p1", "p2")).alias("high_priority_tickets_90d"),
        )
    )


def revenue_trend(fct_revenue: DataFrame, settings: Settings, with_recent_values: bool = False) -> DataFrame:
    """Contraction months in the trailing months (and the last MRR values).

    One aggregation per account. The revenue fact has one row per (account,
    month), so an account's group in the trailing window holds at most one
    row per calendar month: collecting it to pick the latest values is bounded
    by the calendar, not by the data volume.
    """
    t = settings.thresholds
    recent = fct_revenue.filter(F.col("revenue_month") >= trailing_months_start(settings.as_of, t.revenue_trend_months))
    aggs = [F.count_if(F.col("revenue_movement") == "contraction").alias("contraction_months_6m")]
    if with_recent_values:
        by_month = F.sort_array(F.collect_list(F.struct(F.col("revenue_month"), F.col("mrr"))), asc=False)
        aggs.append(F.slice(F.transform(by_month, lambda s: s["mrr"]), 1, t.recent_mrr_values).alias("recent_mrr_values"))
    return recent.groupBy("account_id").agg(*aggs)


def churn_risk_view(
    scored: DataFrame,
    fct_usage: DataFrame,
    tickets: DataFrame,
    fct_revenue: DataFrame,
    settings: Settings,
    sort: bool = True,
    audit: bool = False,
) -> DataFrame:
    """Risk flags, level and signal count per active account.

    ``scored``: ``scored_accounts`` (no rank is read); ``tickets``: ticket-grain
    frame (``stg_support_tickets`` or ``fct_tickets``).
    """
    t = settings.thresholds
    h = scored.select(
        "account_id", "company_name", "account_segment", "plan_tier", "account_owner", "region",
        "current_mrr", "current_arr", "tenure_months", "health_score", "health_tier",
    )
    j = (
        h.join(usage_trend(fct_usage, settings), "account_id", "left")
        .join(escalation_signal(tickets, settings), "account_id", "left")
        .join(revenue_trend(fct_revenue, settings), "account_id", "left")
    )
    last = F.coalesce(F.col("events_last_30d"), F.lit(0)).cast("bigint")
    prev = F.coalesce(F.col("events_prev_30d"), F.lit(0)).cast("bigint")
    esc = F.coalesce(F.col("escalated_tickets_90d"), F.lit(0)).cast("bigint")
    contr = F.coalesce(F.col("contraction_months_6m"), F.lit(0)).cast("bigint")
    score = F.col("health_score")
    low = score < t.low_health_below
    declining = X.is_usage_declining(last, prev, t.usage_decline_ratio)
    escalating = esc >= t.min_escalations
    contracting = contr >= t.min_contraction_months
    out = j.select(
        "account_id", "company_name", "account_segment", "plan_tier", "account_owner", "region",
        "current_mrr", "current_arr", "tenure_months", "health_score", "health_tier",
        last.alias("events_last_30d"),
        prev.alias("events_prev_30d"),
        X.usage_change_pct(last, prev).alias("usage_change_pct"),
        esc.alias("escalated_tickets_90d"),
        F.coalesce(F.col("high_priority_tickets_90d"), F.lit(0)).cast("bigint").alias("high_priority_tickets_90d"),
        contr.alias("contraction_months_6m"),
        F.coalesce(low, F.lit(False)).alias("is_low_health"),
        declining.alias("is_usage_declining"),
        escalating.alias("has_escalations"),
        contracting.alias("has_revenue_contraction"),
        X.risk_level(score, declining, esc, contr, t).alias("risk_level"),
        X.count_true(low, declining, escalating, contracting).cast("bigint").alias("risk_signal_count"),
    )
    if audit:
        out = out.withColumn("assessed_at", F.current_timestamp())
    if sort:
        out = out.orderBy(F.col("risk_signal_count").desc(), F.col("health_score").asc(), F.col("account_id").asc())
    return out


# --- net revenue retention ----------------------------------------------------------


def monthly_movements(fct_revenue: DataFrame) -> DataFrame:
    """Per-month totals of MRR and its movements.

    ``fct_revenue`` has one row per (account, month), so counting rows counts
    distinct paying accounts without a distinct aggregate.
    """
    return fct_revenue.groupBy("revenue_month").agg(
        F.sum("mrr").cast(MONEY).alias("total_mrr"),
        F.sum(F.when(F.col("revenue_movement") == "new", F.col("mrr")).otherwise(F.lit(0))).cast(MONEY).alias("new_mrr"),
        F.sum("expansion_mrr").cast(MONEY).alias("expansion_mrr"),
        F.sum("contraction_mrr").cast(MONEY).alias("contraction_mrr"),
        F.count(F.lit(1)).alias("paying_accounts"),
    )


def churn_detection(fct_revenue_with_next: DataFrame) -> DataFrame:
    """MRR of accounts with no paid revenue in the following month.

    Uses ``next_revenue_month`` (a ``lead`` on the same window as the
    movement ``lag``), so no self-join and no extra shuffle of the fact.
    """
    nxt = F.add_months(F.col("revenue_month"), 1)
    gone = F.col("next_revenue_month").isNull() | (F.col("next_revenue_month") != nxt)
    return (
        fct_revenue_with_next.filter(gone)
        .groupBy(F.col("revenue_month").alias("last_active_month"))
        .agg(F.sum("mrr").cast(MONEY).alias("churned_mrr"), F.count(F.lit(1)).alias("churned_accounts"))
        .withColumn("churn_month", F.add_months(F.col("last_active_month"), 1))
        .select("last_active_month", "churn_month", "churned_mrr", "churned_accounts")
    )


def churn_detection_anti_join(fct_revenue: DataFrame) -> DataFrame:
    """B38 as written originally: anti self-join on (account, month + 1)."""
    r = fct_revenue.select("account_id", "revenue_month", "mrr").withColumn("_next", F.add_months("revenue_month", 1))
    nxt = fct_revenue.select(F.col("account_id").alias("_acc"), F.col("revenue_month").alias("_m"))
    gone = r.join(nxt, (r.account_id == nxt._acc) & (r._next == nxt._m), "left_anti")
    return (
        gone.groupBy(F.col("revenue_month").alias("last_active_month"), F.col("_next").alias("churn_month"))
        .agg(F.sum("mrr").cast(MONEY).alias("churned_mrr"), F.count_distinct("account_id").alias("churned_accounts"))
    )


def waterfall_movements(fct_revenue_with_next: DataFrame) -> DataFrame:
    """Monthly movements and churn in one aggregation pass.

    Each revenue row contributes twice: to its own month (MRR and movements)
    and, when the account has no paid revenue in the following month, to that
    following month as churn. One ``groupBy(month)`` then yields both sides of
    the waterfall, with no self-join and no second scan of the fact.
    """
    nxt = F.add_months(F.col("revenue_month"), 1)
    churned = F.col("next_revenue_month").isNull() | (F.col("next_revenue_month") != nxt)
    role = F.col("_role")
    current = role == 0
    rows = fct_revenue_with_next.select(
        "revenue_month", "mrr", "revenue_movement", "expansion_mrr", "contraction_mrr", "next_revenue_month",
        F.explode(F.array(F.lit(0), F.lit(1))).alias("_role"),
    ).filter(current | churned)
    month = F.when(current, F.col("revenue_month")).otherwise(nxt)
    money = lambda c: F.sum(c).cast(MONEY)
    return rows.groupBy(month.alias("revenue_month")).agg(
        money(F.when(current, F.col("mrr"))).alias("total_mrr"),
        money(F.when(current & (F.col("revenue_movement") == "new"), F.col("mrr")).otherwise(F.lit(0))).alias("new_mrr"),
        money(F.when(current, F.col("expansion_mrr"))).alias("expansion_mrr"),
        money(F.when(current, F.col("contraction_mrr"))).alias("contraction_mrr"),
        F.count_if(current).alias("paying_accounts"),
        money(F.when(~current, F.col("mrr"))).alias("_churned_mrr"),
        F.count_if(~current).alias("_churned_accounts"),
    )


def nrr_summary(fct_revenue_with_next: DataFrame, sort: bool = True) -> DataFrame:
    """Monthly MRR waterfall with NRR, GRR and growth.

    Churn into a month with no paying account (after the last month of data)
    is dropped, as the reproduced left join from the monthly movements does.
    The global ``lag`` runs over one row per month: a calendar-bounded size.
    """
    w = Window.orderBy("revenue_month")
    wf = waterfall_movements(fct_revenue_with_next).filter(F.col("paying_accounts") > 0).select(
        "revenue_month",
        F.col("total_mrr").alias("ending_mrr"),
        "new_mrr", "expansion_mrr", "contraction_mrr",
        F.coalesce(F.col("_churned_mrr"), F.lit(0)).cast(MONEY).alias("churned_mrr"),
        "paying_accounts",
        F.col("_churned_accounts").cast("bigint").alias("churned_accounts"),
        F.lag("total_mrr").over(w).alias("_start"),
    )
    start = F.coalesce(F.col("_start"), F.lit(0)).cast(MONEY)
    exp, contr, churn, end = (F.col(c) for c in ("expansion_mrr", "contraction_mrr", "churned_mrr", "ending_mrr"))
    out = wf.select(
        "revenue_month",
        start.alias("starting_mrr"),
        "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "ending_mrr",
        X.retention_pct(start + exp - contr - churn, start).alias("nrr_pct"),
        X.retention_pct(start - contr - churn, start).alias("grr_pct"),
        "paying_accounts", "churned_accounts",
        X.retention_pct(end - start, start).alias("mrr_growth_pct"),
        X.annualize(end).cast(MONEY).alias("ending_arr"),
    )
    return out.orderBy("revenue_month") if sort else out


# --- cohorts ------------------------------------------------------------------------


def revenue_with_cohort(dim_account: DataFrame, fct_revenue: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Revenue rows with the account's cohort month and month offset."""
    base = "signup_month" if settings is None else settings.cohort_base
    if base == "signup_month":
        cohorts = dim_account.select("account_id", F.trunc("signup_date", "month").alias("cohort_month"))
    elif base == "first_observed":
        cohorts = fct_revenue.groupBy("account_id").agg(F.min("revenue_month").alias("cohort_month"))
    else:
        raise ValueError(f"unknown cohort base {base!r}")
    r = fct_revenue.select("account_id", "revenue_month", "mrr", "month_number")
    return r.join(cohorts, "account_id", "inner").withColumn(
        "months_since_signup", month_boundaries_between(F.col("revenue_month"), F.col("cohort_month"))
    )


def cohort_metrics(revenue_with_cohort: DataFrame) -> DataFrame:
    """Accounts and MRR per cohort and month offset.

    ``(account, month)`` is unique in the revenue fact, so the row count per
    (cohort, offset) is the distinct account count.
    """
    return revenue_with_cohort.groupBy("cohort_month", "months_since_signup").agg(
        F.count(F.lit(1)).alias("active_accounts"),
        F.sum("mrr").cast(MONEY).alias("cohort_mrr"),
    )


def revenue_cohort_analysis(dim_account: DataFrame, fct_revenue: DataFrame, settings: Settings | None = None, sort: bool = True) -> DataFrame:
    """Cohort retention curves (cohorts without an offset-0 row drop out).

    The offset-0 base is read with a window over the aggregated
    (cohort, offset) rows, so the metrics are computed once instead of being
    re-derived for a self-join.
    """
    cm = cohort_metrics(revenue_with_cohort(dim_account, fct_revenue, settings))
    cohort = Window.partitionBy("cohort_month")
    at_zero = F.col("months_since_signup") == 0
    j = cm.select(
        "*",
        F.max(F.when(at_zero, F.col("active_accounts"))).over(cohort).alias("initial_accounts"),
        F.max(F.when(at_zero, F.col("cohort_mrr"))).over(cohort).alias("initial_mrr"),
    ).filter(F.col("initial_accounts").isNotNull())
    n, mrr = F.col("active_accounts"), F.col("cohort_mrr")
    n0, mrr0 = F.col("initial_accounts"), F.col("initial_mrr")
    # avg - initial_mrr / initial_accounts == (mrr*n0 - mrr0*n) / (n*n0), in the money's smallest unit.
    unit = F.lit(10**MONEY_SCALE)
    change = round_div(
        (mrr * unit).cast("decimal(38,0)") * n0 - (mrr0 * unit).cast("decimal(38,0)") * n,
        (n * n0).cast("decimal(20,0)") * unit,
        scale=2,
    )
    out = j.select(
        "cohort_month",
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"),
        "months_since_signup",
        "active_accounts",
        "cohort_mrr",
        (mrr.cast("double") / n).alias("avg_mrr_per_account"),
        "initial_accounts",
        "initial_mrr",
        round_div(n, n0, scale=1, factor=100).alias("account_retention_pct"),
        X.retention_pct(mrr, mrr0).alias("revenue_retention_pct"),
        change.alias("avg_mrr_change_per_account"),
    )
    return out.orderBy("cohort_month", "months_since_signup") if sort else out


# --- SLA adherence --------------------------------------------------------------------


_TICKET_SUMS = ("n", "n_resolved", "n_breach", "n_within", "n_open", "csat_sum", "csat_n")


def ticket_hours(tickets: DataFrame) -> DataFrame:
    """Tickets reduced to (account, month, priority, resolved hours in tenths), with counts and exact sums.

    ``tickets`` is any ticket-grain frame with the staged columns. An account that holds a third of all tickets
    is a few rows of each month and priority, one for each distinct duration, before it meets a join.
    """
    resolved = F.col("status") == "resolved"
    breach = F.col("is_sla_breach")
    return tickets.groupBy(
        "account_id", F.date_format("created_date", "yyyy-MM").alias("ticket_year_month"), "priority",
        to_tenths(F.when(resolved, F.col("resolution_hours"))).alias("tenths"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(resolved).alias("n_resolved"),
        F.count_if(breach).alias("n_breach"),
        F.count_if(~breach & resolved).alias("n_within"),
        F.count_if(X.is_open_ticket(F.col("status"))).alias("n_open"),
        F.sum(exact_score(F.col("satisfaction_score"))).alias("csat_sum"),
        F.count("satisfaction_score").alias("csat_n"),
    )


def tickets_enriched(reduced: DataFrame, dim_account: DataFrame) -> DataFrame:
    """``ticket_hours`` with the account segment; tickets of unknown accounts fall out."""
    return reduced.join(dim_account.select("account_id", "account_segment"), "account_id", "inner")


def _hours_frame(tickets: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Tickets by (month, priority, segment, tenths of hours).

    Every measure of the report, quantiles included, is a sum over this frame;
    its size follows the distinct hours, not the tickets.
    """
    enriched = tickets_enriched(ticket_hours(tickets), dim_account)
    return enriched.groupBy("ticket_year_month", "priority", "account_segment", "tenths").agg(*[F.sum(c).alias(c) for c in _TICKET_SUMS])


def _sla_half(frame: DataFrame, dimension: str, column: str) -> DataFrame:
    """Half of the report, from the reduced frame: sums, and exact quantiles by cumulative counts."""
    keys = ["ticket_year_month", "dimension_value"]
    per_hour = frame.groupBy("ticket_year_month", F.col(column).alias("dimension_value"), "tenths").agg(
        *[F.sum(c).alias(c) for c in _TICKET_SUMS]
    )
    known = F.when(F.col("tenths").isNotNull(), F.col("n")).otherwise(0)
    group = Window.partitionBy(*keys)
    counted = per_hour.select(
        "*", known.alias("hours_n"), F.sum(known).over(group).alias("all_n"),
        F.sum(known).over(group.orderBy(F.col("tenths").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )

    def quantile(percent: int):
        # the least value whose cumulative count reaches the share
        return F.min(F.when(F.col("upto") * 100 >= F.col("all_n") * percent, F.col("tenths"))) / F.lit(10.0)

    total = lambda c: F.sum(c).cast("bigint")
    out = counted.groupBy(*keys).agg(
        total("n").alias("total_tickets"), total("n_resolved").alias("resolved_tickets"), total("n_breach").alias("sla_breaches"),
        total("n_within").alias("within_sla"), total("n_open").alias("unresolved_tickets"),
        round_div(F.sum("n_within"), F.sum("n_resolved"), scale=1, factor=100).alias("sla_adherence_pct"),
        round_div(F.sum(F.col("tenths") * F.col("hours_n")), F.sum("hours_n") * 10, scale=1).alias("avg_resolution_hours"),
        quantile(50).alias("median_resolution_hours"), quantile(90).alias("p90_resolution_hours"),
        mean_score(F.sum("csat_sum"), F.sum("csat_n"), 2).alias("avg_csat"),
    )
    blank = {} if dimension == "priority" else {
        "resolved_tickets": "bigint", "within_sla": "bigint", "unresolved_tickets": "bigint",
        "median_resolution_hours": "double", "p90_resolution_hours": "double",
    }
    measures = [F.lit(None).cast(blank[c]).alias(c) if c in blank else F.col(c) for c in out.columns if c not in keys]
    return out.select("ticket_year_month", F.lit(dimension).alias("dimension_type"), "dimension_value", *measures)


def sla_by_priority(tickets: DataFrame, dim_account: DataFrame) -> DataFrame:
    """SLA summary per month and priority, with P50 and P90."""
    return _sla_half(_hours_frame(tickets, dim_account), "priority", "priority")


def sla_by_segment(tickets: DataFrame, dim_account: DataFrame) -> DataFrame:
    """SLA summary per month and account segment (fewer measures)."""
    return _sla_half(_hours_frame(tickets, dim_account), "segment", "account_segment")


def sla_adherence(tickets: DataFrame, dim_account: DataFrame, sort: bool = True) -> DataFrame:
    """Both halves stacked with a dimension label (U1/U2), from one reduced frame.

    The tickets are scanned and aggregated once, and only the aggregate is joined; Spark reuses
    that exchange for the second half.
    """
    frame = _hours_frame(tickets, dim_account)
    out = _sla_half(frame, "priority", "priority").unionByName(_sla_half(frame, "segment", "account_segment"))
    return out.orderBy("ticket_year_month", "dimension_type", "dimension_value") if sort else out
