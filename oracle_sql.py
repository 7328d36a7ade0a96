"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each relation is a named CTE over the pre-registered driver views
(``customer nation region orders events``). ``sql_for(final, *ctes)`` emits a
WITH clause holding the CTEs a query needs, in dependency order.

Written from the rules, not from the engine: domains are value tables that
are joined, flags are computed once and reused, churn is a look at the next
paid month. Rounding is half away from zero on the exact value; DuckDB turns
decimal division into DOUBLE, so exact ratios use HUGEINT division (``_ratio``).
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-31'"
AS_OF_TS = "TIMESTAMP '2024-01-31 00:00:00'"
SHIFT_DAYS = 8218
MONEY = "DECIMAL(27,9)"
_UNIT = 10**9  # of money and of scores

# Unicode white space, a fixed set.
_SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _text(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _code(x: str) -> str:
    return f"lower({_text(x)})"


def _ratio(num: str, den: str, scale: int = 1, factor: int = 1) -> str:
    """round(factor * num / den, scale), half away from zero, as DOUBLE; NULL when den is 0 or NULL."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"nullif(CAST(({den}) AS HUGEINT), 0)"
    size = f"(2 * {factor * 10**scale} * abs({n}) + abs({d})) // (2 * abs({d}))"
    return f"(sign({n}) * sign({d}) * CAST({size} AS DOUBLE) / {float(10**scale)})"


def _units(x: str) -> str:
    """Money or scores as whole numbers of their smallest unit."""
    return f"(({x}) * {_UNIT})"


def _mean_score(scale: int) -> str:
    return _ratio(f"sum(CAST(satisfaction_score AS DECIMAL(20,9))) * {_UNIT}", f"count(satisfaction_score) * {_UNIT}", scale)


def _table(name: str, columns: str, rows: list[tuple]) -> None:
    """A value table."""
    _cte(name, (), f"SELECT * FROM (VALUES {', '.join(map(str, rows))}) v({columns})")


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------- fixed values
_EVENTS = {
    "reporting": ("dashboard_viewed", "report_created", "export_generated"),
    "crm_core": ("contact_added", "deal_updated", "note_added"),
    "communication": ("email_sent", "meeting_logged", "task_completed"),
    "advanced": ("api_call", "integration_configured", "workflow_created"),
    "platform": ("search_performed", "filter_applied", "user_invited"),
}
_EVENT_TYPES = {"click": "reporting", "error": "advanced", "purchase": "crm_core", "signup": "platform", "view": "communication"}
_PRODUCTS = [  # number, name, kind, shown as, category, add-on price
    (0, "novacrm_platform", "platform", "NovaCRM Platform", "core", -1),
    (1, "api_access", "addon", "API Access", "integration", 29),
    (2, "advanced_analytics", "addon", "Advanced Analytics", "analytics", 79),
    (3, "priority_support", "addon", "Priority Support", "support", 59),
]
_table("event_names", "category, n, name", [(c, i, n) for c, names in _EVENTS.items() for i, n in enumerate(names)])
_table("event_types", "event_type, category", list(_EVENT_TYPES.items()))
_table("products", "n, name, kind, shown, category, price", _PRODUCTS)
_table("tiers", "tier, price, below", [("starter", 49, 9), ("growth", 149, 16), ("enterprise", 499, 20)])
_table("targets", "priority, hours", [("p1", 4), ("p2", 12), ("p3", 48), ("p4", 120)])
_table("ticket_kinds", "n, kind", list(enumerate(("bug", "feature_request", "billing", "onboarding", "how_to", "performance"))))

# ---------------------------------------------------------------- raw adapters
_TIER_OF = "(SELECT arg_min(tier, below) FROM tiers WHERE below > ({0} * 7) % 20)"

_cte("raw_orders", ("tiers",), f"""
SELECT o_orderkey AS k, o_custkey // 10 AS a, o_orderstatus, CAST(left(o_orderpriority, 1) AS INTEGER) AS digit,
       CAST(o_orderdate AS DATE) + {SHIFT_DAYS} AS order_date
FROM orders""")

_cte("raw_accounts", ("raw_orders",), f"""
WITH first_order AS (SELECT a, min(order_date) AS first_date FROM raw_orders GROUP BY a),
grouped AS (
    SELECT c_custkey // 10 AS a, count(*) AS customers, arg_min(c_name, c_custkey) AS c_name,
           arg_min(c_mktsegment, c_custkey) AS segment, arg_max(c_nationkey, (c_acctbal, c_custkey)) AS nation_key
    FROM customer GROUP BY 1
)
SELECT CAST(g.a AS VARCHAR) AS account_id, g.c_name AS company_name, chr(9) || g.segment || chr(160) AS industry,
       CAST(g.customers + (g.a * 37) % [60, 500, 2000][g.a % 3 + 1] AS BIGINT) AS employee_count,
       {_TIER_OF.format('g.a')} AS plan_tier, n.n_name AS account_owner, r.r_name AS region,
       if(g.a % 3 = 0, {AS_OF} - CAST((g.a * 53) % 400 AS INTEGER), coalesce(f.first_date, DATE '2023-01-01')) AS signup_date,
       coalesce(map {{3: 'churned', 7: 'churned', 11: 'trial', 13: 'suspended'}}[CAST(g.a % 15 AS INTEGER)], 'active') AS status
FROM grouped g
LEFT JOIN first_order f USING (a)
LEFT JOIN nation n ON n.n_nationkey = g.nation_key
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")

_cte("raw_subscriptions", ("raw_orders", "products"), f"""
SELECT CAST(k AS VARCHAR) AS subscription_id, CAST(a AS VARCHAR) AS account_id, p.name AS product_name,
       {_TIER_OF.format('a')} AS plan_tier,
       if(p.price < 0, (SELECT t.price FROM tiers t WHERE t.tier = {_TIER_OF.format('a')}), p.price) AS mrr_amount,
       order_date::VARCHAR || if(k % 5 = 0, 'T00:00:00', '') AS start_date,
       if(o_orderstatus = 'O', NULL, (order_date + CAST(k % 400 + 30 AS INTEGER))::VARCHAR) AS end_date,
       map {{'O': 'active', 'F': 'cancelled', 'P': 'upgraded'}}[o_orderstatus] AS status
FROM raw_orders JOIN products p ON p.n = k % 4""")

_cte("raw_invoices", ("raw_orders", "products"), """
SELECT CAST(k AS VARCHAR) AS invoice_id, CAST(a AS VARCHAR) AS account_id, order_date AS invoice_date,
       (k % 3 + 1) * 49.505 AS amount, chr(9) || 'usd' || chr(8195) AS currency,
       map {'F': 'paid', 'O': 'overdue', 'P': 'void'}[o_orderstatus] AS status, ' ' || p.name || ' ' AS line_items
FROM raw_orders JOIN products p ON p.n = k % 4""")

_cte("raw_usage_events", ("event_types", "event_names"), """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS account_id,
       CAST(user_id * 10 + event_id % 4 AS VARCHAR) AS user_id, n.name AS event_name,
       ts - to_days(CAST(if(event_id % 4 < user_id % 5, 31, 0) + day(ts) % 3 AS INTEGER)) AS event_timestamp
FROM events e
LEFT JOIN event_types t ON t.event_type = e.event_type
LEFT JOIN event_names n ON n.category = t.category AND n.n = e.event_id % 3""")

_cte("raw_support_tickets", ("raw_orders", "targets", "ticket_kinds"), f"""
WITH base AS (
    SELECT *, {AS_OF_TS} - to_days(CAST(k % 200 AS INTEGER)) + to_minutes(CAST((k * 13) % 1440 AS INTEGER)) AS created_at,
           'p' || least(digit, 4) AS level,
           if(k % 12 = 0 AND a % 2 = 0, 'open', if(k % 12 = 6 AND a % 4 = 0, 'escalated', 'resolved')) AS state
    FROM raw_orders
)
SELECT CAST(k AS VARCHAR) AS ticket_id, CAST(a AS VARCHAR) AS account_id, created_at,
       if(state = 'resolved', created_at + to_minutes(CAST(hours * 3 * ((k * 7919) % 40) AS INTEGER)), NULL) AS resolved_at,
       upper(level) || chr(9) AS priority, kind AS category, state AS status,
       if(state = 'resolved' AND k % 5 <> 0, CAST(200 + (a % 3) * 100 + (k % 23) * 5 AS DOUBLE) / 100.0, NULL) AS satisfaction_score
FROM base JOIN targets ON targets.priority = level JOIN ticket_kinds ON ticket_kinds.n = k % 6""")

# ---------------------------------------------------------------- staging
_cte("stg_accounts", ("raw_accounts",), f"""
SELECT account_id, {_text('company_name')} AS company_name, {_code('industry')} AS industry, employee_count,
       {_code('plan_tier')} AS plan_tier, {_text('account_owner')} AS account_owner, {_code('region')} AS region,
       CAST(signup_date AS DATE) AS signup_date, {_code('status')} AS status
FROM raw_accounts WHERE account_id IS NOT NULL""")

_cte("stg_subscriptions", ("raw_subscriptions",), f"""
SELECT *, status IS NOT DISTINCT FROM 'active' AS is_active, end_date - start_date AS duration_days
FROM (
    SELECT subscription_id, account_id, {_code('product_name')} AS product_name, {_code('plan_tier')} AS plan_tier,
           CAST(mrr_amount AS {MONEY}) AS mrr_amount, CAST(left(start_date, 10) AS DATE) AS start_date,
           CAST(left(end_date, 10) AS DATE) AS end_date, {_code('status')} AS status
    FROM raw_subscriptions WHERE subscription_id IS NOT NULL)""")

_cte("stg_invoices", ("raw_invoices",), f"""
SELECT *, CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month, status IS NOT DISTINCT FROM 'paid' AS is_paid
FROM (
    SELECT invoice_id, account_id, CAST(invoice_date AS DATE) AS invoice_date, CAST(amount AS {MONEY}) AS amount,
           upper({_text('currency')}) AS currency, {_code('status')} AS status, {_text('line_items')} AS line_items
    FROM raw_invoices WHERE invoice_id IS NOT NULL)""")

_cte("stg_usage_events", ("raw_usage_events",), f"""
SELECT e.event_id, e.account_id, e.user_id, {_code('e.event_name')} AS event_name, e.event_timestamp,
       CAST(e.event_timestamp AS DATE) AS event_date, hour(e.event_timestamp) AS event_hour,
       coalesce(n.category, 'other') AS event_category
FROM raw_usage_events e LEFT JOIN event_names n ON n.name = {_code('e.event_name')}
WHERE e.event_id IS NOT NULL""")

_cte("stg_support_tickets", ("raw_support_tickets",), f"""
SELECT r.ticket_id, r.account_id, r.created_at, r.resolved_at, {_code('r.priority')} AS priority, {_code('r.category')} AS category,
       {_code('r.status')} AS status, r.satisfaction_score,
       {_ratio("date_sub('minute', r.created_at, r.resolved_at)", '60', 1)} AS resolution_hours,
       g.hours AS sla_target_hours,
       if(r.resolved_at IS NULL, NULL, coalesce(date_sub('minute', r.created_at, r.resolved_at) > 60 * g.hours, false)) AS is_sla_breach,
       CAST(r.created_at AS DATE) AS created_date
FROM raw_support_tickets r LEFT JOIN targets g ON g.priority = {_code('r.priority')}
WHERE r.ticket_id IS NOT NULL""")

# ---------------------------------------------------------------- core
_cte("subscription_summary", ("stg_subscriptions",), f"""
SELECT account_id, CAST(coalesce(sum(mrr_amount) FILTER (is_active), 0) AS {MONEY}) AS current_mrr,
       count(*) FILTER (is_active) AS active_subscription_count, count(*) AS total_subscription_count,
       min(start_date) AS first_subscription_date, max(start_date) FILTER (is_active) AS latest_subscription_date,
       count(*) FILTER (is_active AND product_name <> (SELECT name FROM products WHERE kind = 'platform')) AS active_addon_count
FROM stg_subscriptions GROUP BY ALL""")

_cte("ticket_summary", ("stg_support_tickets",), f"""
SELECT account_id, count(*) AS lifetime_tickets, count(*) FILTER (status = 'open' OR status = 'escalated') AS open_tickets,
       {_mean_score(1)} AS avg_csat,
       {_ratio('sum(CAST(resolution_hours * 10 AS BIGINT))', '10 * count(resolution_hours)', 1)} AS avg_resolution_hours,
       count(*) FILTER (is_sla_breach) AS sla_breaches
FROM stg_support_tickets GROUP BY ALL""")

_cte("dim_account", ("stg_accounts", "subscription_summary", "ticket_summary"), f"""
SELECT account_id, company_name, industry, employee_count, plan_tier, account_owner, region, signup_date, status,
       {AS_OF} - signup_date AS tenure_days,
       (year({AS_OF}) * 12 + month({AS_OF})) - (year(signup_date) * 12 + month(signup_date)) AS tenure_months,
       ['smb', 'mid_market', 'enterprise'][1 + greatest(
            if(plan_tier = 'growth' OR employee_count > 50, 1, 0), if(plan_tier = 'enterprise' OR employee_count > 500, 2, 0))] AS account_segment,
       coalesce(current_mrr, 0::{MONEY}) AS current_mrr, CAST(12 * coalesce(current_mrr, 0::{MONEY}) AS {MONEY}) AS current_arr,
       coalesce(active_subscription_count, 0) AS active_subscription_count,
       coalesce(total_subscription_count, 0) AS total_subscription_count,
       coalesce(active_addon_count, 0) AS active_addon_count, first_subscription_date, latest_subscription_date,
       coalesce(lifetime_tickets, 0) AS lifetime_tickets, coalesce(open_tickets, 0) AS open_tickets,
       coalesce(avg_csat, 0.0) AS avg_csat, coalesce(avg_resolution_hours, 0.0) AS avg_resolution_hours,
       coalesce(sla_breaches, 0) AS sla_breaches,
       if(status IN ('trial', 'churned'), status,
          if({AS_OF} - signup_date > 365, 'mature', if({AS_OF} - signup_date > 90, 'growing', 'onboarding'))) AS lifecycle_stage
FROM stg_accounts LEFT JOIN subscription_summary USING (account_id) LEFT JOIN ticket_summary USING (account_id)""")

_cte("dim_product", ("stg_subscriptions", "products", "tiers"), """
WITH sold AS (SELECT DISTINCT product_name FROM stg_subscriptions),
offers AS (
    SELECT s.product_name, coalesce(p.kind, 'addon') AS product_type,
           coalesce(p.shown, list_reduce(list_transform(string_split(s.product_name, '_'), lambda w: upper(w[1]) || w[2:]), lambda x, y: x || ' ' || y))
             AS product_display_name,
           unnest(if(p.kind = 'platform', (SELECT list({'tier': tier, 'price': price}) FROM tiers), [{'tier': 'all', 'price': coalesce(p.price, 0)}])) AS offer,
           coalesce(p.category, 'other') AS feature_category
    FROM sold s LEFT JOIN products p ON p.name = s.product_name
)
SELECT concat_ws('_', product_name, offer.tier) AS product_key, product_name, product_type, product_display_name,
       offer.tier AS plan_tier, CAST(offer.price AS BIGINT) AS list_price_mrr, feature_category
FROM offers""")

_cte("subscriptions_unlisted", ("stg_subscriptions",), """
SELECT * REPLACE (if(CAST(subscription_id AS BIGINT) % 3 = 0, 'retired_' || product_name, product_name) AS product_name) FROM stg_subscriptions""")
_cte("dim_product_unlisted", ("subscriptions_unlisted", "products", "tiers"), CTES["dim_product"][1].replace("stg_subscriptions", "subscriptions_unlisted"))

_cte("dim_date", ("stg_invoices", "stg_usage_events", "stg_support_tickets"), """
WITH days AS (
    SELECT invoice_date AS d FROM stg_invoices UNION SELECT event_date FROM stg_usage_events UNION SELECT created_date FROM stg_support_tickets
),
spine AS (SELECT CAST(unnest(range(min(d)::TIMESTAMP, max(d)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day FROM days)
SELECT date_day, year(date_day) AS year, quarter(date_day) AS quarter, month(date_day) AS month_number,
       monthname(date_day) AS month_name, left(date_day::VARCHAR, 7) AS year_month, weekofyear(date_day) AS week_number,
       dayofweek(date_day) + 1 AS day_of_week, dayname(date_day) AS day_name, day(date_day) AS day_of_month,
       isodow(date_day) > 5 AS is_weekend, CAST(date_trunc('month', date_day) AS DATE) AS first_day_of_month,
       last_day(date_day) AS last_day_of_month, CAST(date_trunc('quarter', date_day) AS DATE) AS first_day_of_quarter,
       make_date(year(date_day), 1, 1) AS first_day_of_year
FROM spine""")

_cte("monthly_revenue", ("stg_invoices",), f"""
SELECT account_id, invoice_month AS revenue_month, CAST(sum(amount) AS {MONEY}) AS mrr
FROM stg_invoices WHERE is_paid GROUP BY ALL""")


def _revenue(before: str, new_is_expansion: bool = True) -> str:
    """The revenue fact, given the expression of the previous month's amount."""
    first = "mrr" if new_is_expansion else f"0::{MONEY}"
    return f"""
SELECT account_id, revenue_month, mrr, CAST(12 * mrr AS {MONEY}) AS arr, CAST(mrr - change AS {MONEY}) AS previous_mrr,
       if(is_new, 'new', if(change = 0, 'flat', if(change > 0, 'expansion', 'contraction'))) AS revenue_movement,
       CAST(if(is_new, {first}, greatest(change, 0)) AS {MONEY}) AS expansion_mrr,
       CAST(if(is_new, 0, greatest(-change, 0)) AS {MONEY}) AS contraction_mrr,
       CAST(change AS {MONEY}) AS net_mrr_change, month_number
FROM (
    SELECT *, mrr - coalesce({before}, 0) AS change, {before} IS NULL AS is_new
    FROM (SELECT *, lag(mrr) OVER w AS last_mrr, lag(revenue_month) OVER w AS last_month, row_number() OVER w AS month_number
          FROM monthly_revenue WINDOW w AS (PARTITION BY account_id ORDER BY revenue_month)))"""


_cte("fct_revenue", ("monthly_revenue",), _revenue("last_mrr"))
_cte("fct_revenue_new_excluded", ("monthly_revenue",), _revenue("last_mrr", new_is_expansion=False))
_cte("fct_revenue_gap_aware", ("monthly_revenue",), _revenue("if(last_month + INTERVAL 1 MONTH = revenue_month, last_mrr, NULL)"))

_cte("fct_usage", ("stg_usage_events",), f"""
WITH days AS (
    SELECT account_id, event_date, count(*) AS total_events, count(DISTINCT user_id) AS active_users,
           count(DISTINCT event_name) AS distinct_features_used, count(DISTINCT event_category) AS distinct_categories_used,
           {', '.join(f"count(*) FILTER (event_category = '{c}') AS {c}_events" for c in _EVENTS)},
           {', '.join(f"count(*) FILTER (event_name = '{n}') AS {c}" for n, c in (('api_call', 'api_calls'), ('report_created', 'reports_created'), ('workflow_created', 'workflows_created')))},
           min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at
    FROM stg_usage_events GROUP BY account_id, event_date
)
SELECT *, {_ratio("date_sub('minute', first_event_at, last_event_at)", '60', 1)} AS active_hours,
       {_ratio('distinct_categories_used', '5', 0, 100)} AS feature_breadth_pct,
       total_events >= 10 AND distinct_features_used >= 5 AS is_power_usage_day
FROM days""")


def _tickets(fast: str, slow: str, satisfied: str, neutral: str) -> str:
    return f"""
SELECT t.ticket_id, t.account_id, t.priority, t.category, t.status, t.satisfaction_score, t.created_at, t.resolved_at, t.created_date,
       month(t.created_at) AS created_month, left(t.created_date::VARCHAR, 7) AS created_year_month,
       t.resolution_hours, t.sla_target_hours, t.is_sla_breach,
       {_ratio('CAST(10 * t.resolution_hours AS BIGINT)', '10 * t.sla_target_hours', 2)} AS sla_ratio,
       if(t.status IN ('open', 'escalated'), 'unresolved', coalesce(
            (SELECT arg_min(speed, part) FROM (VALUES ('fast', {fast}), ('on_time', 1.0), ('slow', {slow})) v(speed, part)
             WHERE t.resolution_hours <= part * t.sla_target_hours), 'critical_breach')) AS resolution_speed,
       coalesce(['dissatisfied', 'neutral', 'satisfied'][1 + CAST(t.satisfaction_score >= {neutral} AS INTEGER)
                + CAST(t.satisfaction_score >= {satisfied} AS INTEGER)], 'no_rating') AS csat_tier,
       a.plan_tier AS account_plan_tier, a.account_owner, a.region AS account_region
FROM stg_support_tickets t LEFT JOIN stg_accounts a USING (account_id)"""


_cte("fct_tickets", ("stg_support_tickets", "stg_accounts"), _tickets("0.5", "1.5", "4.0", "3.0"))
_cte("fct_tickets_thresholds", ("stg_support_tickets", "stg_accounts"), _tickets("0.25", "2.0", "4.5", "2.5"))

# ---------------------------------------------------------------- health score signals
_cte("usage_scores", ("fct_usage",), f"""
SELECT *, 25 * ntile(4) OVER (ORDER BY avg_daily_events, account_id) AS usage_score
FROM (SELECT account_id, avg(total_events) AS avg_daily_events FROM fct_usage WHERE {AS_OF} - event_date <= 30 GROUP BY ALL)""")


def _support(good: str, fair: str, few: int, some: int, points: tuple[int, ...]) -> str:
    return f"""
WITH recent AS (
    SELECT account_id, count(*) FILTER (status IN ('open', 'escalated')) AS waiting, count(satisfaction_score) AS n,
           coalesce(sum(CAST(satisfaction_score AS DECIMAL(20,9))), 0) AS total, {_mean_score(1)} AS avg_csat_1dp
    FROM stg_support_tickets WHERE {AS_OF} - created_date <= 30 GROUP BY account_id
)
SELECT account_id, waiting AS recent_open_tickets, CAST(total AS DOUBLE) / nullif(n, 0) AS recent_avg_csat, avg_csat_1dp,
       CAST(if(waiting = 0, if(total >= {good} * n, {points[0]}, {points[1]}),
               if(waiting <= {few} AND total >= {fair} * n, {points[2]}, if(waiting <= {some}, {points[3]}, {points[4]}))) AS BIGINT) AS support_score
FROM recent"""


_cte("support_scores", ("stg_support_tickets",), _support("4.0", "3.0", 2, 5, (100, 75, 50, 25, 10)))
_cte("support_scores_thresholds", ("stg_support_tickets",), _support("4.5", "2.5", 1, 3, (90, 70, 40, 20, 5)))


def _revenue_points(points: tuple[int, ...], small: int) -> str:
    return f"""
SELECT account_id, last.mrr AS mrr, last.net_mrr_change AS net_mrr_change,
       CAST([{points[3]}, {points[2]}, {points[1]}, {points[0]}][1 + CAST(last.net_mrr_change > -{small} AS INTEGER)
            + CAST(last.net_mrr_change >= 0 AS INTEGER) + CAST(last.net_mrr_change > 0 AS INTEGER)] AS BIGINT) AS revenue_score
FROM (SELECT account_id, arg_max(f, revenue_month) AS last FROM fct_revenue f GROUP BY account_id)"""


_cte("revenue_scores", ("fct_revenue",), _revenue_points((100, 60, 30, 10), 50))
_cte("revenue_scores_thresholds", ("fct_revenue",), _revenue_points((80, 55, 35, 0), 60))

_cte("engagement_scores", ("stg_usage_events",), f"""
SELECT *, 25 * ntile(4) OVER (ORDER BY features_used_30d, account_id) AS engagement_score
FROM (SELECT account_id, count(DISTINCT event_name) AS features_used_30d FROM stg_usage_events WHERE {AS_OF} - event_date <= 30 GROUP BY ALL)""")

_cte("scored_accounts", ("dim_account", "usage_scores", "support_scores", "revenue_scores", "engagement_scores"), f"""
WITH parts AS (
    SELECT account_id, company_name, account_segment, plan_tier, tenure_months, current_mrr, current_arr, account_owner, lifecycle_stage, region,
           ifnull(usage_score, 0) AS usage_score, ifnull(support_score, 50) AS support_score,
           ifnull(revenue_score, 50) AS revenue_score, ifnull(engagement_score, 0) AS engagement_score,
           ifnull(avg_daily_events, 0.0) AS avg_daily_events_30d, ifnull(recent_open_tickets, 0) AS open_tickets_90d,
           ifnull(avg_csat_1dp, 0.0) AS avg_csat_90d, ifnull(mrr, 0::{MONEY}) AS latest_mrr,
           ifnull(net_mrr_change, 0::{MONEY}) AS latest_mrr_change, ifnull(features_used_30d, 0) AS features_used_30d
    FROM dim_account LEFT JOIN usage_scores USING (account_id) LEFT JOIN support_scores USING (account_id)
    LEFT JOIN revenue_scores USING (account_id) LEFT JOIN engagement_scores USING (account_id)
    WHERE status = 'active'
),
weighed AS (
    SELECT *, CAST(round((30 * usage_score + 20 * support_score + 25 * revenue_score + 25 * engagement_score) / 100.0, 1) AS DOUBLE) AS health_score
    FROM parts
)
SELECT *, ['critical', 'at_risk', 'neutral', 'healthy', 'champion', 'champion'][1 + CAST(floor(health_score / 20) AS INTEGER)] AS health_tier
FROM weighed""")

_cte("customer_health_scores", ("scored_accounts",), """
SELECT *, row_number() OVER (ORDER BY health_score, account_id) AS intervention_priority FROM scored_accounts""")

# ---------------------------------------------------------------- churn risk signals
_cte("usage_trend", ("fct_usage",), f"""
WITH aged AS (SELECT account_id, total_events, {AS_OF} - event_date AS age FROM fct_usage)
SELECT account_id, CAST(coalesce(sum(total_events) FILTER (age <= 30), 0) AS BIGINT) AS events_last_30d,
       CAST(coalesce(sum(total_events) FILTER (age > 30), 0) AS BIGINT) AS events_prev_30d
FROM aged WHERE age <= 60 GROUP BY account_id""")

_cte("escalation_signal", ("stg_support_tickets",), f"""
SELECT account_id, count(*) AS escalated_tickets_90d, count(*) FILTER (priority < 'p3') AS high_priority_tickets_90d
FROM stg_support_tickets WHERE status = 'escalated' AND {AS_OF} - created_date <= 90 GROUP BY account_id""")

_cte("revenue_trend", ("fct_revenue",), """
SELECT account_id, array_to_string(list(CAST(mrr AS VARCHAR) ORDER BY revenue_month DESC)[:3], ', ') AS recent_mrr_values,
       count(*) FILTER (revenue_movement = 'contraction') AS contraction_months_6m
FROM fct_revenue WHERE revenue_month >= DATE '2023-07-31' GROUP BY account_id""")

_cte("churn_risk_view", ("scored_accounts", "usage_trend", "escalation_signal", "revenue_trend"), f"""
WITH signals AS (
    SELECT account_id, company_name, account_segment, plan_tier, account_owner, region, current_mrr, current_arr, tenure_months,
           health_score, health_tier, ifnull(events_last_30d, 0) AS events_last_30d, ifnull(events_prev_30d, 0) AS events_prev_30d,
           ifnull(escalated_tickets_90d, 0) AS escalated_tickets_90d, ifnull(high_priority_tickets_90d, 0) AS high_priority_tickets_90d,
           ifnull(contraction_months_6m, 0) AS contraction_months_6m
    FROM scored_accounts LEFT JOIN usage_trend USING (account_id) LEFT JOIN escalation_signal USING (account_id)
    LEFT JOIN revenue_trend USING (account_id)
),
flagged AS (
    SELECT *, health_score < 40 AS is_low_health, 2 * events_last_30d < events_prev_30d AS is_usage_declining,
           escalated_tickets_90d > 1 AS has_escalations, contraction_months_6m > 1 AS has_revenue_contraction
    FROM signals
)
SELECT *, ifnull({_ratio('events_last_30d - events_prev_30d', 'events_prev_30d', 1, 100)}, 0.0) AS usage_change_pct,
       if(health_score < 20, 'critical', if(is_low_health OR is_usage_declining OR has_escalations, 'high',
          if(health_score < 60 OR has_revenue_contraction, 'medium', 'low'))) AS risk_level,
       len(list_filter([is_low_health, is_usage_declining, has_escalations, has_revenue_contraction], lambda f: f)) AS risk_signal_count
FROM flagged""")

# ---------------------------------------------------------------- net revenue retention
_cte("monthly_movements", ("fct_revenue",), f"""
SELECT revenue_month, {', '.join(f"CAST({x} AS {MONEY}) AS {n}" for x, n in (
    ('sum(mrr)', 'total_mrr'), ("coalesce(sum(mrr) FILTER (revenue_movement = 'new'), 0)", 'new_mrr'),
    ('sum(expansion_mrr)', 'expansion_mrr'), ('sum(contraction_mrr)', 'contraction_mrr')))}, count(*) AS paying_accounts
FROM fct_revenue GROUP BY revenue_month""")

_cte("churn_detection", ("fct_revenue",), f"""
WITH next_paid AS (
    SELECT *, CAST(revenue_month + INTERVAL 1 MONTH AS DATE) AS due, lead(revenue_month) OVER (PARTITION BY account_id ORDER BY revenue_month) AS paid
    FROM fct_revenue
)
SELECT revenue_month AS last_active_month, due AS churn_month, CAST(sum(mrr) AS {MONEY}) AS churned_mrr, count(*) AS churned_accounts
FROM next_paid WHERE paid IS DISTINCT FROM due GROUP BY revenue_month, due""")

_cte("waterfall_movements", ("monthly_movements", "churn_detection"), f"""
SELECT ifnull(revenue_month, churn_month) AS revenue_month, total_mrr, ifnull(new_mrr, 0::{MONEY}) AS new_mrr, expansion_mrr, contraction_mrr,
       ifnull(paying_accounts, 0) AS paying_accounts, ifnull(churned_mrr, 0::{MONEY}) AS churned_mrr, ifnull(churned_accounts, 0) AS churned_accounts
FROM monthly_movements FULL JOIN churn_detection ON revenue_month = churn_month""")


def _of_start(amount: str) -> str:
    return _ratio(_units(amount), _units("opening"), 1, 100)


_cte("nrr_summary", ("waterfall_movements",), f"""
WITH months AS (
    SELECT *, ifnull(lag(total_mrr) OVER (ORDER BY revenue_month), 0::{MONEY}) AS opening
    FROM waterfall_movements WHERE paying_accounts > 0
)
SELECT revenue_month, opening AS starting_mrr, new_mrr, expansion_mrr, contraction_mrr, churned_mrr, total_mrr AS ending_mrr,
       {_of_start('opening + expansion_mrr - contraction_mrr - churned_mrr')} AS nrr_pct,
       {_of_start('opening - contraction_mrr - churned_mrr')} AS grr_pct, paying_accounts, churned_accounts,
       {_of_start('total_mrr - opening')} AS mrr_growth_pct, CAST(12 * total_mrr AS {MONEY}) AS ending_arr
FROM months""")


# ---------------------------------------------------------------- cohorts
def _cohort(prefix: str, cohorts: str) -> None:
    _cte(f"{prefix}revenue_with_cohort", ("dim_account", "fct_revenue"), f"""
WITH cohorts AS ({cohorts})
SELECT account_id, cohort_month, revenue_month, mrr, month_number,
       12 * (year(revenue_month) - year(cohort_month)) + month(revenue_month) - month(cohort_month) AS months_since_signup
FROM cohorts JOIN fct_revenue USING (account_id)""")
    _cte(f"{prefix}cohort_metrics", (f"{prefix}revenue_with_cohort",), f"""
SELECT cohort_month, months_since_signup, count(DISTINCT account_id) AS active_accounts, CAST(sum(mrr) AS {MONEY}) AS cohort_mrr
FROM {prefix}revenue_with_cohort GROUP BY ALL""")
    _cte(f"{prefix}revenue_cohort_analysis", (f"{prefix}cohort_metrics",), f"""
WITH based AS (
    SELECT *, any_value(active_accounts) FILTER (months_since_signup = 0) OVER (PARTITION BY cohort_month) AS initial_accounts,
           any_value(cohort_mrr) FILTER (months_since_signup = 0) OVER (PARTITION BY cohort_month) AS initial_mrr
    FROM {prefix}cohort_metrics
)
SELECT cohort_month, left(cohort_month::VARCHAR, 7) AS cohort_label, months_since_signup, active_accounts, cohort_mrr,
       CAST(cohort_mrr AS DOUBLE) / active_accounts AS avg_mrr_per_account, initial_accounts, initial_mrr,
       {_ratio('active_accounts', 'initial_accounts', 1, 100)} AS account_retention_pct,
       {_ratio(_units('cohort_mrr'), _units('initial_mrr'), 1, 100)} AS revenue_retention_pct,
       {_ratio(f"CAST({_units('cohort_mrr')} AS HUGEINT) * initial_accounts - CAST({_units('initial_mrr')} AS HUGEINT) * active_accounts",
               f'active_accounts::HUGEINT * initial_accounts * {_UNIT}', 2)} AS avg_mrr_change_per_account
FROM based WHERE initial_accounts IS NOT NULL""")


_cohort("", "SELECT account_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month FROM dim_account")
_cohort("observed_", "SELECT account_id, min(revenue_month) AS cohort_month FROM fct_revenue GROUP BY account_id")

# ---------------------------------------------------------------- SLA adherence
_cte("sla_tickets", ("stg_support_tickets", "dim_account"), """
SELECT left(created_date::VARCHAR, 7) AS ticket_year_month, priority, account_segment, s.status = 'resolved' AS done, is_sla_breach AS late,
       s.status IN ('open', 'escalated') AS waiting, if(s.status = 'resolved', resolution_hours, NULL) AS hours, satisfaction_score
FROM stg_support_tickets s JOIN dim_account USING (account_id)""")


def _sla(dimension: str, column: str) -> str:
    def only(x: str, kind: str) -> str:
        return x if dimension == "priority" else f"NULL::{kind}"

    return f"""
SELECT ticket_year_month, '{dimension}' AS dimension_type, {column} AS dimension_value, count(*) AS total_tickets,
       {only('count(*) FILTER (done)', 'BIGINT')} AS resolved_tickets, count(*) FILTER (late) AS sla_breaches,
       {only('count(*) FILTER (done AND NOT late)', 'BIGINT')} AS within_sla, {only('count(*) FILTER (waiting)', 'BIGINT')} AS unresolved_tickets,
       {_ratio('count(*) FILTER (done AND NOT late)', 'count(*) FILTER (done)', 1, 100)} AS sla_adherence_pct,
       {_ratio('sum(CAST(10 * hours AS BIGINT))', '10 * count(hours)', 1)} AS avg_resolution_hours,
       {only('quantile_disc(hours, 0.5)', 'DOUBLE')} AS median_resolution_hours, {only('quantile_disc(hours, 0.9)', 'DOUBLE')} AS p90_resolution_hours,
       {_mean_score(2)} AS avg_csat
FROM sla_tickets GROUP BY ticket_year_month, {column}"""


_cte("sla_by_priority", ("sla_tickets",), _sla("priority", "priority"))
_cte("sla_by_segment", ("sla_tickets",), _sla("segment", "account_segment"))
_cte("sla_adherence", ("sla_by_priority", "sla_by_segment"), "FROM sla_by_priority UNION ALL FROM sla_by_segment")


# ---------------------------------------------------------------- tables with violations
_cte("order_lines", (), "SELECT l_orderkey, l_returnflag FROM lineitem")
_cte("order_states", (), "SELECT o_orderkey, o_custkey, o_totalprice, nullif(o_orderstatus, 'F') AS open_status FROM orders")
_cte("solvent_customers", (), "SELECT c_custkey FROM customer WHERE c_acctbal > 0")


def _closure(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def sql_for(final: str, *ctes: str) -> str:
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in _closure(ctes)]
    return "WITH " + ",\n".join(parts) + "\n" + final


def relation(name: str, order_by: str | None = None) -> str:
    tail = f" ORDER BY {order_by}" if order_by else ""
    return sql_for(f"SELECT * FROM {name}{tail}", name)


# ---------------------------------------------------------------- data-quality checks
def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def check_sql(check) -> str:
    """One report row (relation, column_name, check_name, violations) for a check."""
    col = check.column
    head = (
        f"SELECT {_q(check.relation)} AS relation, "
        f"{_q(col) if col else 'CAST(NULL AS VARCHAR)'} AS column_name, "
        f"{_q(check.check_name)} AS check_name, "
    )
    rel = check.relation
    if check.kind == "unique":
        body = f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
    elif check.kind == "not_null":
        body = f"CAST(count(*) AS BIGINT) AS violations FROM {rel} WHERE {col} IS NULL"
    elif check.kind == "accepted_values":
        values = ", ".join(_q(v) for v in check.values)
        body = f"CAST(count(*) AS BIGINT) AS violations FROM {rel} WHERE {col} IS NOT NULL AND {col} NOT IN ({values})"
    elif check.kind == "relationships":
        body = (
            f"CAST(count(*) AS BIGINT) AS violations FROM {rel} child LEFT JOIN {check.to} parent "
            f"ON child.{col} = parent.{check.field} WHERE child.{col} IS NOT NULL AND parent.{check.field} IS NULL"
        )
    else:
        body = f"CAST(count(*) AS BIGINT) AS violations FROM {rel} WHERE {check.predicate}"
    return head + body


def quality_report_sql(checks) -> str:
    rels: list[str] = []
    for c in checks:
        for r in (c.relation, c.to):
            if r and r not in rels:
                rels.append(r)
    union = "\nUNION ALL\n".join(check_sql(c) for c in checks)
    return sql_for(f"SELECT *, violations = 0 AS passed FROM (\n{union}\n)", *rels)


# Every fiftieth record of the raw files is written a second time without most of its columns.
_RAW_KEYS = {"raw_accounts": "DISTINCT c_custkey // 10 AS k FROM customer", "raw_usage_events": "event_id AS k FROM events"}
_RAW_KEYS |= {name: "o_orderkey AS k FROM orders" for name in ("raw_subscriptions", "raw_invoices", "raw_support_tickets")}
UNREADABLE_RECORDS = "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS relation, NULL::VARCHAR AS column_name, 'readable' AS check_name, count(*) AS violations FROM (SELECT {keys}) WHERE k % 50 = 0"
    for name, keys in _RAW_KEYS.items()
) + ")"
