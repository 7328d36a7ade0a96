"""Business-rule Column functions.

Each function maps input Columns to a Column, so every rule stays a
JVM-side expression inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from acctlens import config as C
from acctlens.config import Thresholds
from acctlens.functions.numeric import MONEY_SCALE, round_div

_DEFAULT = Thresholds()


# Unicode white space, a fixed set.
WHITE_SPACE = "\t\n\v\f\r \u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def clean_text(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def clean_code(c: Column) -> Column:
    """Lower-cased, trimmed code value (tiers, statuses, names)."""
    return F.lower(clean_text(c))


def lookup(key: Column, table: Mapping[str, object], default: object = None) -> Column:
    """CASE key WHEN k THEN v ... [ELSE default] from a small fixed mapping."""
    expr = None
    for k, v in table.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))


# --- accounts -------------------------------------------------------------


def classify_segment(employee_count: Column, plan_tier: Column, t: Thresholds = _DEFAULT) -> Column:
    """smb / mid_market / enterprise from tier and head count (first match wins)."""
    return (
        F.when((plan_tier == "enterprise") | (employee_count > t.enterprise_min_employees), "enterprise")
        .when((plan_tier == "growth") | (employee_count > t.mid_market_min_employees), "mid_market")
        .otherwise("smb")
    )


def lifecycle_stage(status: Column, tenure_days: Column, t: Thresholds = _DEFAULT) -> Column:
    return (
        F.when(status == "trial", "trial")
        .when(status == "churned", "churned")
        .when(tenure_days <= t.onboarding_max_days, "onboarding")
        .when(tenure_days <= t.growing_max_days, "growing")
        .otherwise("mature")
    )


def annualize(mrr: Column) -> Column:
    return mrr * F.lit(12)


# --- subscriptions / invoices --------------------------------------------


def flag_equals(c: Column, value: str) -> Column:
    """TRUE when ``c`` equals ``value``; FALSE otherwise, including NULL."""
    return F.coalesce(c == F.lit(value), F.lit(False))


# --- usage ----------------------------------------------------------------


def event_category(event_name: Column, taxonomy: Mapping[str, Sequence[str]] = C.EVENT_CATEGORIES) -> Column:
    expr = None
    for category, names in taxonomy.items():
        cond = event_name.isin(*names)
        expr = F.when(cond, category) if expr is None else expr.when(cond, category)
    return expr.otherwise(C.OTHER_CATEGORY)


def small_domain_bit(value: Column, domain: Sequence[str]) -> Column:
    """Bit ``1 << i`` for the i-th member of a closed domain (0 when absent)."""
    expr = F.lit(0).cast("bigint")
    for i in reversed(range(len(domain))):
        expr = F.when(value == F.lit(domain[i]), F.lit(1 << i).cast("bigint")).otherwise(expr)
    return expr


def feature_breadth_pct(distinct_categories: Column, scored_categories: int = 5) -> Column:
    return round_div(distinct_categories, F.lit(scored_categories), scale=0, factor=100)


def is_power_usage_day(total_events: Column, distinct_features: Column, t: Thresholds = _DEFAULT) -> Column:
    return F.coalesce(
        (total_events >= t.power_day_min_events) & (distinct_features >= t.power_day_min_features), F.lit(False)
    )


# --- support tickets -------------------------------------------------------


def sla_target_hours(priority: Column, targets: Mapping[str, int] = C.SLA_TARGET_HOURS) -> Column:
    """Target hours by priority; NULL for an unknown priority (no ELSE)."""
    return lookup(priority, targets).cast("int")


def resolution_hours(minutes: Column) -> Column:
    """Whole minutes / 60 rounded half-up to one decimal, NULL when open."""
    return round_div(minutes, F.lit(60), scale=1)


def is_sla_breach(minutes: Column, priority: Column, targets: Mapping[str, int] = C.SLA_TARGET_HOURS) -> Column:
    """NULL when unresolved; TRUE when the unrounded hours exceed the target.

    ``minutes / 60 > target`` is evaluated as ``minutes > target * 60`` (same
    truth value, no floating point). Unknown priority gives FALSE.
    """
    target_minutes = lookup(priority, {k: v * 60 for k, v in targets.items()})
    return F.when(minutes.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(minutes > target_minutes, F.lit(False))
    )


def sla_ratio(hours: Column, target_hours: Column) -> Column:
    """Rounded hours / target to two decimals (hours are exact tenths)."""
    tenths = F.round(hours * F.lit(10.0)).cast("bigint")
    return F.when(
        hours.isNotNull() & (target_hours > 0),
        round_div(tenths, target_hours.cast("bigint") * F.lit(10), scale=2),
    )


def resolution_speed(status: Column, hours: Column, target_hours: Column, t: Thresholds = _DEFAULT) -> Column:
    return (
        F.when(status.isin(*C.OPEN_TICKET_STATUSES), "unresolved")
        .when(hours <= target_hours * F.lit(t.fast_ratio), "fast")
        .when(hours <= target_hours, "on_time")
        .when(hours <= target_hours * F.lit(t.slow_ratio), "slow")
        .otherwise("critical_breach")
    )


def csat_tier(score: Column, t: Thresholds = _DEFAULT) -> Column:
    return (
        F.when(score.isNull(), "no_rating")
        .when(score >= t.satisfied_min, "satisfied")
        .when(score >= t.neutral_csat_min, "neutral")
        .otherwise("dissatisfied")
    )


def is_open_ticket(status: Column) -> Column:
    return status.isin(*C.OPEN_TICKET_STATUSES)


# --- revenue ---------------------------------------------------------------


def revenue_movement(mrr: Column, previous_mrr: Column) -> Column:
    return (
        F.when(previous_mrr.isNull(), "new")
        .when(mrr > previous_mrr, "expansion")
        .when(mrr < previous_mrr, "contraction")
        .otherwise("flat")
    )


def expansion_amount(mrr: Column, previous_mrr: Column, include_new: bool = True) -> Column:
    """New MRR counts as expansion by default (the reproduced behaviour)."""
    first = mrr if include_new else F.lit(0)
    return (
        F.when(previous_mrr.isNull(), first).when(mrr > previous_mrr, mrr - previous_mrr).otherwise(F.lit(0))
    )


def contraction_amount(mrr: Column, previous_mrr: Column) -> Column:
    return F.when(previous_mrr.isNotNull() & (mrr < previous_mrr), previous_mrr - mrr).otherwise(F.lit(0))


def retention_pct(numerator: Column, starting: Column) -> Column:
    """round(numerator / starting * 100, 1) on money; NULL when starting is 0 or NULL."""
    return round_div(numerator, starting, scale=1, factor=100, input_scale=MONEY_SCALE)


# --- health score ----------------------------------------------------------


def health_score(
    usage: Column,
    support: Column,
    revenue: Column,
    engagement: Column,
    weights: Sequence[float] = C.HEALTH_WEIGHTS,
) -> Column:
    wu, ws, wr, we = weights
    return F.round(usage * F.lit(wu) + support * F.lit(ws) + revenue * F.lit(wr) + engagement * F.lit(we), 1)


def health_tier(score: Column, t: Thresholds = _DEFAULT) -> Column:
    return (
        F.when(score >= t.champion_min, "champion")
        .when(score >= t.healthy_min, "healthy")
        .when(score >= t.neutral_min, "neutral")
        .when(score >= t.at_risk_min, "at_risk")
        .otherwise("critical")
    )


def support_score(open_tickets: Column, score_sum: Column, n_scores: Column, t: Thresholds = _DEFAULT) -> Column:
    """Ladder on open tickets and mean CSAT; a missing mean passes each test.

    ``mean >= x`` is tested as ``sum >= x * n`` on exact decimals.
    """

    def mean_at_least(x: float) -> Column:
        return (n_scores == 0) | (score_sum >= F.lit(str(x)).cast("decimal(10,4)") * n_scores)

    return (
        F.when((open_tickets == 0) & mean_at_least(t.satisfied_min), t.support_best)
        .when(open_tickets == 0, t.support_good)
        .when((open_tickets <= t.support_few_tickets) & mean_at_least(t.neutral_csat_min), t.support_fair)
        .when(open_tickets <= t.support_some_tickets, t.support_poor)
        .otherwise(t.support_worst)
    )


def revenue_score(net_mrr_change: Column, t: Thresholds = _DEFAULT) -> Column:
    return (
        F.when(net_mrr_change > 0, t.revenue_growing)
        .when(net_mrr_change == 0, t.revenue_flat)
        .when(net_mrr_change > -t.small_contraction, t.revenue_shrinking)
        .otherwise(t.revenue_falling)
    )


# --- churn risk --------------------------------------------------------------


def is_usage_declining(last_30d: Column, prev_30d: Column, ratio: float = 0.5) -> Column:
    return F.coalesce((prev_30d > 0) & (last_30d < prev_30d * F.lit(ratio)), F.lit(False))


def usage_change_pct(last_30d: Column, prev_30d: Column) -> Column:
    return F.when(prev_30d == 0, F.lit(0.0)).otherwise(round_div(last_30d - prev_30d, prev_30d, scale=1, factor=100))


def risk_level(
    score: Column, declining: Column, escalations: Column, contractions: Column, t: Thresholds = _DEFAULT
) -> Column:
    return (
        F.when(score < t.critical_health_below, "critical")
        .when((score < t.low_health_below) | declining | (escalations >= t.min_escalations), "high")
        .when((score < t.medium_health_below) | (contractions >= t.min_contraction_months), "medium")
        .otherwise("low")
    )


def count_true(*flags: Column) -> Column:
    total = F.lit(0)
    for f in flags:
        total = total + F.coalesce(f, F.lit(False)).cast("int")
    return total
