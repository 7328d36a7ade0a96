"""Declarative data-quality checks (Q1-Q7).

Single checks return the violating rows (zero rows = pass). ``run_checks``
evaluates a whole list and returns one report row per check:
``relation, column_name, check_name, violations, passed``.

Cost model of ``run_checks``, per relation:

* all ``not_null`` / ``accepted_values`` / expression checks are counts of one
  aggregate over one scan: a task sends one row, whatever it has read;
* a ``unique`` check is a group-by of its own column, with partial counts, so a
  repeated value is collapsed before the shuffle;
* the ``relationships`` checks reduce each child to distinct (check, key)
  rows and anti-join them, in one join, with the parents' distinct keys: a
  key holding a third of the child rows is one row by the time it reaches
  the join.

``observed`` takes the row-wise counts of a relation while it is written, without a read of its
own; ``run_checks`` is then told the counts. ``narrowed`` cuts each relation down to the columns that
its checks name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlens import config as C


@dataclass(frozen=True)
class Check:
    relation: str
    column: str | None
    kind: str  # unique | not_null | accepted_values | relationships | expression
    values: tuple = ()
    to: str | None = None
    field: str | None = None
    predicate: str | None = None  # violating-row condition, for expression checks
    name: str | None = None  # report name of an expression check

    @property
    def check_name(self) -> str:
        return self.name or self.kind


# --- single checks (return violating rows) ------------------------------------------


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Q1: values of ``column`` that occur more than once (NULLs ignored)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q3: rows whose non-NULL ``column`` is outside ``values``."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships_violations(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Q4: child key values (with their row counts) absent from the parent."""
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    parent_keys = parent.select(F.col(field).alias("_parent_key")).distinct()
    return keys.join(parent_keys, keys[column] == parent_keys["_parent_key"], "left_anti")


def expression_violations(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Q5/Q6: rows matching a violating-row condition."""
    return df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)


def mrr_non_negative(fct_revenue: DataFrame) -> DataFrame:
    """Q5: revenue rows with negative MRR."""
    return expression_violations(fct_revenue, F.col("mrr") < 0).select("account_id", "revenue_month", "mrr")


def health_score_range(customer_health_scores: DataFrame) -> DataFrame:
    """Q6: health scores outside 0..100."""
    s = F.col("health_score")
    return expression_violations(customer_health_scores, (s < 0) | (s > 100)).select(
        "account_id", "company_name", "health_score"
    )


# --- suite -----------------------------------------------------------------------------


def _folded_predicate(c: Check) -> Column:
    if c.kind == "not_null":
        return F.col(c.column).isNull()
    if c.kind == "accepted_values":
        return F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values)
    return F.coalesce(F.expr(c.predicate), F.lit(False))


def _counts(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """``(i, n)``: violating rows of one relation's row-wise checks, by one aggregate."""
    row = df.agg(*[F.count_if(_folded_predicate(c)).alias(f"n{i}") for i, c in checks])
    return row.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n")) for i, _ in checks])))


def _repeated(df: DataFrame, i: int, c: Check) -> DataFrame:
    """``(i, n)``: how many values of the column occur more than once."""
    return unique_violations(df, c.column).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")


def _orphans(
    relations: Mapping[str, DataFrame], checks: Sequence[tuple[int, Check]]
) -> DataFrame:
    """All relationships checks in one anti-join on (check, key).

    Child keys are reduced to (check, key, rows) and parent keys to distinct
    (check, key) before the join, so a key holding a third of the child rows
    is one row when it reaches the join. The result is one failure per
    orphan child row.
    """
    child = reduce(DataFrame.unionByName, [
        relations[c.relation].filter(F.col(c.column).isNotNull())
        .select(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("k"))
        for i, c in checks
    ]).groupBy("i", "k").agg(F.count(F.lit(1)).alias("n"))
    parent = reduce(DataFrame.unionByName, [
        relations[c.to].select(F.lit(i).alias("i"), F.col(c.field).cast("string").alias("k"))
        for i, c in checks
    ]).distinct()
    return child.join(parent, ["i", "k"], "left_anti").groupBy("i").agg(F.sum("n").alias("n"))


def is_row_wise(c: Check) -> bool:
    return c.kind not in ("unique", "relationships")


def observed(checks: Sequence[Check], relation: str) -> list[Column]:
    """Counts of the violations of the relation's row-wise checks, each named by the check's place in ``checks``."""
    return [F.count_if(_folded_predicate(c)).alias(f"n{i}") for i, c in enumerate(checks) if c.relation == relation and is_row_wise(c)]


def checked_columns(checks: Sequence[Check], relation: str, columns: Sequence[str]) -> list[str]:
    """Those of the relation's ``columns`` that some check names, in their order."""
    named = {c.column for c in checks if c.relation == relation} | {c.field for c in checks if c.to == relation}
    for c in checks:
        if c.relation == relation and c.predicate:
            named |= set(re.findall(r"\w+", c.predicate))
    return [c for c in columns if c in named]


def narrowed(
    relations: Mapping[str, DataFrame], checks: Sequence[Check], cut: Callable[[DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The relations that the checks name, with the columns they name and no others.

    ``cut`` (a checkpoint, say) is applied to those that more than one part of the suite reads.
    """
    out = {}
    for name in dict.fromkeys(r for c in checks for r in (c.relation, c.to) if r):
        df = relations[name]
        out[name] = df.select(*checked_columns(checks, name, df.columns))
        parts = {("unique", c.column) if c.kind == "unique" else is_row_wise(c) for c in checks if c.relation == name}
        parts |= {"parent" for c in checks if c.to == name}
        if cut and len(parts) > 1:
            out[name] = cut(out[name])
    return out


def run_checks(relations: Mapping[str, DataFrame], checks: Sequence[Check], known: Mapping[int, int] | None = None) -> DataFrame:
    """Q7: evaluate ``checks`` over ``relations``; one report row per check.

    Only the relations that the checks name are read. ``known`` holds violations counted already,
    by the check's place in ``checks``.
    """
    known = dict(known or {})
    spark = next(iter(relations.values())).sparkSession
    row_wise: dict[str, list[tuple[int, Check]]] = {}
    pieces: list[DataFrame] = []
    for i, c in enumerate(checks):
        if i in known:
            continue
        if c.kind == "unique":
            pieces.append(_repeated(relations[c.relation], i, c))
        elif c.kind != "relationships":
            row_wise.setdefault(c.relation, []).append((i, c))
    pieces += [_counts(relations[r], cs) for r, cs in row_wise.items()]
    if links := [(i, c) for i, c in enumerate(checks) if c.kind == "relationships" and i not in known]:
        pieces.append(_orphans(relations, links))
    # one row per declared check (a fixed, small list), so checks without a violation report 0
    declared = spark.createDataFrame(
        [(i, c.relation, c.column, c.check_name, known.get(i)) for i, c in enumerate(checks)],
        "i int, relation string, column_name string, check_name string, known bigint",
    )
    counted = declared.join(F.broadcast(reduce(DataFrame.unionByName, pieces)), "i", "left") if pieces else declared.withColumn("n", F.lit(0))
    violations = F.coalesce("known", "n", F.lit(0)).cast("bigint")
    return counted.select("relation", "column_name", "check_name", violations.alias("violations"), (violations == 0).alias("passed"))


# ---------------------------------------------------------------------------
# The declared check suite (136 checks).
# ---------------------------------------------------------------------------


def _u(rel, col):
    return Check(rel, col, "unique")


def _nn(rel, *cols):
    return [Check(rel, c, "not_null") for c in cols]


def _acc(rel, col, values):
    return Check(rel, col, "accepted_values", tuple(values))


def _rel(rel, col, to, field):
    return Check(rel, col, "relationships", to=to, field=field)


STAGING_CHECKS: list[Check] = [
    _u("stg_accounts", "account_id"),
    *_nn("stg_accounts", "account_id", "company_name", "industry", "employee_count", "plan_tier",
         "account_owner", "signup_date", "status"),
    _acc("stg_accounts", "plan_tier", C.PLAN_TIERS),
    _acc("stg_accounts", "region", C.REGIONS),
    _acc("stg_accounts", "status", C.ACCOUNT_STATUSES),
    _u("stg_subscriptions", "subscription_id"),
    *_nn("stg_subscriptions", "subscription_id", "account_id", "product_name", "plan_tier", "mrr_amount",
         "start_date", "status", "is_active"),
    _rel("stg_subscriptions", "account_id", "stg_accounts", "account_id"),
    _acc("stg_subscriptions", "product_name", C.PRODUCTS),
    _acc("stg_subscriptions", "plan_tier", C.PLAN_TIERS),
    _acc("stg_subscriptions", "status", C.SUBSCRIPTION_STATUSES),
    _u("stg_invoices", "invoice_id"),
    *_nn("stg_invoices", "invoice_id", "account_id", "invoice_date", "amount", "currency", "status",
         "invoice_month", "is_paid"),
    _rel("stg_invoices", "account_id", "stg_accounts", "account_id"),
    _acc("stg_invoices", "currency", C.CURRENCIES),
    _acc("stg_invoices", "status", C.INVOICE_STATUSES),
    _u("stg_usage_events", "event_id"),
    *_nn("stg_usage_events", "event_id", "account_id", "user_id", "event_name", "event_timestamp",
         "event_date", "event_category"),
    _acc("stg_usage_events", "event_name", C.EVENT_NAMES),
    _acc("stg_usage_events", "event_category", C.EVENT_CATEGORY_NAMES),
    _u("stg_support_tickets", "ticket_id"),
    *_nn("stg_support_tickets", "ticket_id", "account_id", "created_at", "priority", "category", "status",
         "sla_target_hours", "created_date"),
    _rel("stg_support_tickets", "account_id", "stg_accounts", "account_id"),
    _acc("stg_support_tickets", "priority", C.TICKET_PRIORITIES),
    _acc("stg_support_tickets", "category", C.TICKET_CATEGORIES),
    _acc("stg_support_tickets", "status", C.TICKET_STATUSES),
]

CORE_CHECKS: list[Check] = [
    _u("dim_date", "date_day"),
    *_nn("dim_date", "date_day", "year", "month_number", "is_weekend"),
    _u("dim_product", "product_key"),
    *_nn("dim_product", "product_key", "product_name", "product_type", "feature_category"),
    _acc("dim_product", "product_type", C.PRODUCT_TYPES),
    _acc("dim_product", "feature_category", C.PRODUCT_FEATURE_CATEGORIES),
    _u("dim_account", "account_id"),
    *_nn("dim_account", "account_id", "company_name", "status", "account_segment", "lifecycle_stage",
         "current_mrr", "tenure_months"),
    _acc("dim_account", "status", C.ACCOUNT_STATUSES),
    _acc("dim_account", "account_segment", C.SEGMENTS),
    _acc("dim_account", "lifecycle_stage", C.LIFECYCLE_STAGES),
    *_nn("fct_revenue", "account_id", "revenue_month", "mrr", "revenue_movement", "month_number"),
    _rel("fct_revenue", "account_id", "dim_account", "account_id"),
    _acc("fct_revenue", "revenue_movement", C.REVENUE_MOVEMENTS),
    *_nn("fct_usage", "account_id", "event_date", "total_events", "active_users", "distinct_features_used"),
    _u("fct_tickets", "ticket_id"),
    *_nn("fct_tickets", "ticket_id", "account_id", "priority", "category", "status", "resolution_speed", "csat_tier"),
    _rel("fct_tickets", "account_id", "dim_account", "account_id"),
    _acc("fct_tickets", "priority", C.TICKET_PRIORITIES),
    _acc("fct_tickets", "category", C.TICKET_CATEGORIES),
    _acc("fct_tickets", "status", C.TICKET_STATUSES),
    _acc("fct_tickets", "resolution_speed", C.RESOLUTION_SPEEDS),
    _acc("fct_tickets", "csat_tier", C.CSAT_TIERS),
]

MART_CHECKS: list[Check] = [
    _u("customer_health_scores", "account_id"),
    *_nn("customer_health_scores", "account_id", "health_score", "health_tier", "account_segment",
         "intervention_priority"),
    _acc("customer_health_scores", "health_tier", C.HEALTH_TIERS),
    _u("customer_health_scores", "intervention_priority"),
    _u("churn_risk_view", "account_id"),
    *_nn("churn_risk_view", "account_id", "risk_level", "risk_signal_count", "health_score"),
    _acc("churn_risk_view", "risk_level", C.RISK_LEVELS),
    _u("nrr_summary", "revenue_month"),
    *_nn("nrr_summary", "revenue_month", "ending_mrr", "paying_accounts"),
    *_nn("revenue_cohort_analysis", "cohort_month", "months_since_signup"),
    *_nn("sla_adherence", "ticket_year_month", "dimension_type", "dimension_value", "total_tickets"),
    _acc("sla_adherence", "dimension_type", ("priority", "segment")),
]

SINGULAR_CHECKS: list[Check] = [
    Check("fct_revenue", None, "expression", predicate="mrr < 0", name="assert_mrr_non_negative"),
    Check("customer_health_scores", None, "expression", predicate="health_score < 0 OR health_score > 100",
          name="assert_health_score_range"),
]

ALL_CHECKS: list[Check] = STAGING_CHECKS + CORE_CHECKS + MART_CHECKS + SINGULAR_CHECKS
