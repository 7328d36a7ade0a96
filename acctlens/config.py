"""Business constants and tunable thresholds.

Everything time-relative takes an explicit ``as_of`` date; nothing here reads
a clock. Thresholds are plain keyword defaults on :class:`Thresholds` so a
caller can override any of them without touching the operators.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the semantics being reproduced.
# ---------------------------------------------------------------------------

# Domains of the raw/staged columns.
PLAN_TIERS = ("starter", "growth", "enterprise")
REGIONS = ("north_america", "europe", "apac", "latam")
ACCOUNT_STATUSES = ("active", "churned", "trial", "suspended")
SUBSCRIPTION_STATUSES = ("active", "cancelled", "upgraded", "trial")
INVOICE_STATUSES = ("paid", "overdue", "void")
CURRENCIES = ("USD",)
TICKET_PRIORITIES = ("p1", "p2", "p3", "p4")
TICKET_CATEGORIES = ("bug", "feature_request", "billing", "onboarding", "how_to", "performance")
TICKET_STATUSES = ("open", "resolved", "escalated")
OPEN_TICKET_STATUSES = ("open", "escalated")

# Products and catalogue.
PLATFORM_PRODUCT = "novacrm_platform"
PRODUCTS = ("novacrm_platform", "api_access", "advanced_analytics", "priority_support")
PRODUCT_DISPLAY_NAMES = {
    "novacrm_platform": "NovaCRM Platform",
    "api_access": "API Access",
    "advanced_analytics": "Advanced Analytics",
    "priority_support": "Priority Support",
}
# Add-on list prices (MRR); the platform price depends on the tier.
ADDON_LIST_PRICES = {"api_access": 29, "advanced_analytics": 79, "priority_support": 59}
PLATFORM_TIER_PRICES = {"starter": 49, "growth": 149, "enterprise": 499}
FEATURE_CATEGORIES = {
    "novacrm_platform": "core",
    "api_access": "integration",
    "advanced_analytics": "analytics",
    "priority_support": "support",
}
PRODUCT_TYPES = ("platform", "addon")
PRODUCT_FEATURE_CATEGORIES = ("core", "integration", "analytics", "support")

# Usage-event taxonomy: 15 event names in 5 feature categories; anything else
# falls into "other".
EVENT_CATEGORIES = {
    "reporting": ("dashboard_viewed", "report_created", "export_generated"),
    "crm_core": ("contact_added", "deal_updated", "note_added"),
    "communication": ("email_sent", "meeting_logged", "task_completed"),
    "advanced": ("api_call", "integration_configured", "workflow_created"),
    "platform": ("search_performed", "filter_applied", "user_invited"),
}
OTHER_CATEGORY = "other"
EVENT_NAMES = tuple(n for names in EVENT_CATEGORIES.values() for n in names)
EVENT_CATEGORY_NAMES = tuple(EVENT_CATEGORIES) + (OTHER_CATEGORY,)

# SLA resolution targets in hours, by priority.
SLA_TARGET_HOURS = {"p1": 4, "p2": 12, "p3": 48, "p4": 120}

# Segment / lifecycle / tier / risk ladders.
SEGMENTS = ("smb", "mid_market", "enterprise")
LIFECYCLE_STAGES = ("trial", "onboarding", "growing", "mature", "churned")
HEALTH_TIERS = ("champion", "healthy", "neutral", "at_risk", "critical")
RISK_LEVELS = ("critical", "high", "medium", "low")
REVENUE_MOVEMENTS = ("new", "expansion", "contraction", "flat")
RESOLUTION_SPEEDS = ("fast", "on_time", "slow", "critical_breach", "unresolved")
CSAT_TIERS = ("satisfied", "neutral", "dissatisfied", "no_rating")

# Calendar span of the date dimension.
DATE_SPINE_START = dt.date(2023, 1, 1)
DATE_SPINE_END = dt.date(2025, 12, 31)

# Health-score weights (usage, support, revenue, engagement).
HEALTH_WEIGHTS = (0.30, 0.20, 0.25, 0.25)


@dataclass(frozen=True)
class Thresholds:
    """Tunable rule thresholds; defaults are the reproduced behaviour."""

    # Segment classification
    enterprise_min_employees: int = 500  # strictly greater than
    mid_market_min_employees: int = 50  # strictly greater than
    # Lifecycle
    onboarding_max_days: int = 90
    growing_max_days: int = 365
    # Usage
    power_day_min_events: int = 10
    power_day_min_features: int = 5
    scored_categories: int = 5
    # Health score windows (days)
    usage_window_days: int = 30
    support_window_days: int = 30
    engagement_window_days: int = 30
    score_buckets: int = 4
    # Health tiers: lower bounds
    champion_min: float = 80
    healthy_min: float = 60
    neutral_min: float = 40
    at_risk_min: float = 20
    # Resolution speed, as shares of the target; CSAT tiers: lower bounds
    fast_ratio: float = 0.5
    slow_ratio: float = 1.5
    satisfied_min: float = 4.0
    neutral_csat_min: float = 3.0
    # Support ladder: bounds on open tickets, and its scores
    support_few_tickets: int = 2
    support_some_tickets: int = 5
    support_best: int = 100
    support_good: int = 75
    support_fair: int = 50
    support_poor: int = 25
    support_worst: int = 10
    # Revenue ladder: bound of a small contraction, and its scores
    small_contraction: int = 50
    revenue_growing: int = 100
    revenue_flat: int = 60
    revenue_shrinking: int = 30
    revenue_falling: int = 10
    # Missing-signal defaults (usage, support, revenue, engagement)
    missing_usage_score: int = 0
    missing_support_score: int = 50
    missing_revenue_score: int = 50
    missing_engagement_score: int = 0
    # Churn risk
    trend_window_days: int = 30
    escalation_window_days: int = 90
    revenue_trend_months: int = 6
    recent_mrr_values: int = 3
    low_health_below: float = 40
    critical_health_below: float = 20
    medium_health_below: float = 60
    usage_decline_ratio: float = 0.5
    min_escalations: int = 2
    min_contraction_months: int = 2


@dataclass(frozen=True)
class Settings:
    """Everything an operator needs besides its input DataFrames."""

    as_of: dt.date
    thresholds: Thresholds = field(default_factory=Thresholds)
    weights: tuple[float, float, float, float] = HEALTH_WEIGHTS
    # Semantic options (defaults reproduce the original behaviour).
    include_new_in_expansion: bool = True
    gap_aware_movements: bool = False
    cohort_base: str = "signup_month"  # or "first_observed"
