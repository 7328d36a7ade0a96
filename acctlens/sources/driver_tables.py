"""Raw inputs derived from the TPC-H-style driver tables.

The engine's inputs are CRM/billing/product/support tables; the test data is
``customer``, ``nation``, ``region``, ``orders`` and ``events`` parquet. These
adapters derive the five raw relations from those tables with plain
DataFrame expressions, so their size grows with the data:

* account = ``custkey div 10`` (ten customers make an account; this lines up
  with ``events.user_id``): the first customer gives name and industry, the one
  of the highest balance the owner and region, and all are head count;
* one subscription, one invoice and one support ticket per order;
* one usage event per ``events`` row.

Some values come as messy as real exports: codes with tabs and no-break spaces
around them, ticket times as text with and without a zone offset, sub-cent
amounts, and scores of two decimals.

Order dates are shifted so that the last order date lands on the as-of date.
All rules below are deterministic functions of the keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlens import config as C
from acctlens.sources.raw import RawInputs

# ---------------------------------------------------------------------------
# Fixed values of the binding.
# ---------------------------------------------------------------------------
AS_OF = dt.date(2024, 1, 31)
ORDER_DATE_SHIFT_DAYS = 8218  # 2001-08-01 -> 2024-01-31
DEFAULT_SIGNUP = dt.date(2023, 1, 1)
CUSTOMERS_PER_ACCOUNT = 10
# Event type -> feature category whose three names stand in for it.
EVENT_TYPE_CATEGORY = {
    "click": "reporting",
    "error": "advanced",
    "purchase": "crm_core",
    "signup": "platform",
    "view": "communication",
}
# Order status -> subscription status / invoice status.
SUBSCRIPTION_STATUS_BY_ORDER = {"O": "active", "F": "cancelled", "P": "upgraded"}
INVOICE_STATUS_BY_ORDER = {"F": "paid", "O": "overdue", "P": "void"}
# First digit of o_orderpriority -> ticket priority.
TICKET_PRIORITY_BY_DIGIT = {"1": "P1", "2": "P2", "3": "P3", "4": "P4", "5": "P4"}
INVOICE_UNIT_AMOUNT = "49.505"


class DriverTables:
    """The driver's tables, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._opened = spark, sf_dir.rstrip("/"), {}

    def __call__(self, table: str) -> DataFrame:
        if table not in self._opened:
            self._opened[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._opened[table]


# Derived columns are written as SQL expression text: one JVM call per
# column instead of one per Column operation when the plan is built.


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _case(key: str, mapping: dict, default=None) -> str:
    whens = " ".join(f"WHEN {key} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    tail = f" ELSE {_q(default)}" if default is not None else ""
    return f"(CASE {whens}{tail} END)"


def _pick(index: str, values: tuple) -> str:
    """values[index] for a small fixed tuple."""
    return _case(index, dict(enumerate(values)))


ACCOUNT_NO = f"(o_custkey div {CUSTOMERS_PER_ACCOUNT})"
TIER = "(CASE WHEN (a * 7) % 20 < 9 THEN 'starter' WHEN (a * 7) % 20 < 16 THEN 'growth' ELSE 'enterprise' END)"


def _zoned_text(moment: str) -> str:
    """A UTC wall clock as text: by turns with an offset, with a Z, and plain."""
    return (
        f"CASE k % 3 WHEN 0 THEN concat(CAST(timestampadd(MINUTE, 330, {moment}) AS STRING), '+05:30')"
        f" WHEN 1 THEN concat(CAST({moment} AS STRING), 'Z') ELSE CAST({moment} AS STRING) END"
    )


def _orders(tables: DriverTables) -> DataFrame:
    return tables("orders").selectExpr(
        "o_orderkey AS k",
        f"{ACCOUNT_NO} AS a",
        "o_orderstatus",
        "o_orderpriority",
        f"date_add(to_date(o_orderdate), {ORDER_DATE_SHIFT_DAYS}) AS order_date",
    )


def raw_accounts(tables: DriverTables) -> DataFrame:
    cust = (
        tables("customer")
        .groupBy(F.expr(f"c_custkey div {CUSTOMERS_PER_ACCOUNT}").alias("a"))
        .agg(
            F.min_by("c_name", "c_custkey").alias("c_name"),
            F.min_by("c_mktsegment", "c_custkey").alias("c_mktsegment"),
            F.max_by("c_nationkey", F.struct("c_acctbal", "c_custkey")).alias("c_nationkey"),
            F.count(F.lit(1)).alias("customers"),
        )
    )
    # nation (25 rows) and region (5 rows) are fixed-size dimensions.
    nation = F.broadcast(tables("nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(tables("region").select("r_regionkey", "r_name"))
    first_order = _orders(tables).groupBy("a").agg(F.min("order_date").alias("first_order_date"))
    return (
        cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(first_order, "a", "left")
        .selectExpr(
            "CAST(a AS STRING) AS account_id",
            "c_name AS company_name",
            "concat('\\t', c_mktsegment, '\\u00a0') AS industry",
            "CAST(customers + (a * 37) % (CASE a % 3 WHEN 0 THEN 60 WHEN 1 THEN 500 ELSE 2000 END) AS BIGINT) AS employee_count",
            f"{TIER} AS plan_tier",
            "n_name AS account_owner",
            "r_name AS region",
            f"CASE WHEN a % 3 = 0 THEN date_sub(DATE'{AS_OF}', CAST((a * 53) % 400 AS INT))"
            f" ELSE coalesce(first_order_date, DATE'{DEFAULT_SIGNUP}') END AS signup_date",
            "CASE WHEN a % 15 IN (3, 7) THEN 'churned' WHEN a % 15 = 11 THEN 'trial'"
            " WHEN a % 15 = 13 THEN 'suspended' ELSE 'active' END AS status",
        )
    )


def raw_subscriptions(tables: DriverTables) -> DataFrame:
    product = _pick("k % 4", C.PRODUCTS)
    mrr = (
        f"CASE WHEN {product} = '{C.PLATFORM_PRODUCT}' THEN {_case(TIER, C.PLATFORM_TIER_PRICES)}"
        f" ELSE {_case(product, C.ADDON_LIST_PRICES)} END"
    )
    return _orders(tables).selectExpr(
        "CAST(k AS STRING) AS subscription_id",
        "CAST(a AS STRING) AS account_id",
        f"{product} AS product_name",
        f"{TIER} AS plan_tier",
        f"CAST({mrr} AS DECIMAL(18,2)) AS mrr_amount",
        "CASE WHEN k % 5 = 0 THEN date_format(order_date, \"yyyy-MM-dd'T'00:00:00\")"
        " ELSE date_format(order_date, 'yyyy-MM-dd') END AS start_date",
        "CASE WHEN o_orderstatus != 'O'"
        " THEN date_format(date_add(order_date, CAST(k % 400 + 30 AS INT)), 'yyyy-MM-dd') END AS end_date",
        f"{_case('o_orderstatus', SUBSCRIPTION_STATUS_BY_ORDER)} AS status",
    )


def raw_invoices(tables: DriverTables) -> DataFrame:
    return _orders(tables).selectExpr(
        "CAST(k AS STRING) AS invoice_id",
        "CAST(a AS STRING) AS account_id",
        "order_date AS invoice_date",
        f"CAST((k % 3 + 1) * CAST('{INVOICE_UNIT_AMOUNT}' AS DECIMAL(10,3)) AS DECIMAL(18,3)) AS amount",
        "'\\tusd\\u2003' AS currency",
        f"{_case('o_orderstatus', INVOICE_STATUS_BY_ORDER)} AS status",
        f"concat(' ', {_pick('k % 4', C.PRODUCTS)}, ' ') AS line_items",
    )


def raw_usage_events(tables: DriverTables) -> DataFrame:
    names = " ".join(
        f"WHEN event_type = '{etype}' THEN {_pick('event_id % 3', C.EVENT_CATEGORIES[category])}"
        for etype, category in EVENT_TYPE_CATEGORY.items()
    )
    back_days = "(CASE WHEN event_id % 4 < user_id % 5 THEN 31 ELSE 0 END + dayofmonth(ts) % 3)"
    moved = f"timestampadd(DAY, -{back_days}, ts)"
    return tables("events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(user_id AS STRING) AS account_id",
        "CAST(user_id * 10 + event_id % 4 AS STRING) AS user_id",
        f"CASE {names} END AS event_name",
        f"{moved} AS event_timestamp",
        "CAST(NULL AS STRING) AS properties",
    )


def raw_support_tickets(tables: DriverTables) -> DataFrame:
    priority = _case("substring(o_orderpriority, 1, 1)", TICKET_PRIORITY_BY_DIGIT)
    target = _case("priority", {k.upper(): v for k, v in C.SLA_TARGET_HOURS.items()})
    resolved = f"timestampadd(MINUTE, {target} * 3 * ((k * 7919) % 40), created_at)"
    base = _orders(tables).selectExpr(
        "k",
        "a",
        f"timestampadd(MINUTE, (k * 13) % 1440, timestampadd(DAY, -(k % 200), TIMESTAMP_NTZ'{AS_OF} 00:00:00'))"
        " AS created_at",
        "CASE WHEN k % 12 = 0 AND a % 2 = 0 THEN 'open' WHEN k % 12 = 6 AND a % 4 = 0 THEN 'escalated'"
        " ELSE 'resolved' END AS status",
        f"{priority} AS priority",
    )
    return base.selectExpr(
        "CAST(k AS STRING) AS ticket_id",
        "CAST(a AS STRING) AS account_id",
        f"{_zoned_text('created_at')} AS created_at",
        f"CASE WHEN status = 'resolved' THEN {_zoned_text(resolved)} END AS resolved_at",
        "concat(priority, '\\t') AS priority",
        f"{_pick('k % 6', C.TICKET_CATEGORIES)} AS category",
        "status",
        "CASE WHEN status = 'resolved' AND k % 5 != 0 THEN CAST(200 + (a % 3) * 100 + (k % 23) * 5 AS DOUBLE) / 100.0D END"
        " AS satisfaction_score",
    )


def load_raw_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    """The five raw relations, each built on first use."""
    tables = DriverTables(spark, sf_dir)
    return RawInputs(
        accounts=lambda: raw_accounts(tables),
        subscriptions=lambda: raw_subscriptions(tables),
        invoices=lambda: raw_invoices(tables),
        usage_events=lambda: raw_usage_events(tables),
        support_tickets=lambda: raw_support_tickets(tables),
        spark=spark,
    )
