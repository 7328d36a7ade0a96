"""

``entry(spark)`` runs the flagship mart on sf0.001; ``queries()`` maps each
implemented relation/operator to a ``(spark, sf_dir) -> DataFrame`` callable;
``oracle_sql()`` holds the matching DuckDB SQL over the same parquet tables.
Every query reads the driver tables through the adapters in
``acctlens.sources.driver_tables`` and runs over whole tables.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_sql as O  # noqa: E402
from acctlens.config import Settings, Thresholds  # noqa: E402
from acctlens.functions.numeric import MONEY, mean_score, round_div  # noqa: E402
from acctlens.operators import quality as Q  # noqa: E402
from acctlens.operators.ranking import global_ntile, global_row_number  # noqa: E402
from acctlens.plans import core, marts  # noqa: E402
from acctlens.plans.pipeline import Pipeline  # noqa: E402
from acctlens.session import cut_lineage, ensure_checkpoint_dir  # noqa: E402
from acctlens.sources.driver_tables import AS_OF, load_raw_inputs  # noqa: E402
from acctlens.sources.raw import (  # noqa: E402
    RAW_SCHEMAS, READABLE_CHECKS, RawInputs, read_raw_csv_dir, read_raw_tables, write_raw_csv_dir,
)
from acctlens.sources.sinks import register_views, replace_table  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(load_raw_inputs(spark, sf_dir), Settings(as_of=AS_OF))


def _scored_once(spark: SparkSession, sf_dir: str, **options) -> Pipeline:
    """A pipeline for queries that read both account marts: the scored accounts, which both are made of, are written once."""
    return Pipeline(load_raw_inputs(spark, sf_dir), Settings(as_of=AS_OF), materialize="checkpoint", shared=("scored_accounts",), **options)


def _rel(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(_pipeline(spark, sf_dir), name)


def _with(fn: Callable[[Pipeline], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_pipeline(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: churn risk per active account (needs every layer below it)."""
    return _pipeline(spark, SMOKE_DIR).churn_risk_view


def _dim_date(p: Pipeline) -> DataFrame:
    return core.dim_date_for_activity(
        (p.stg_invoices, "invoice_date"), (p.stg_usage_events, "event_date"), (p.stg_support_tickets, "created_date")
    )


def _ticket_summary(p: Pipeline) -> DataFrame:
    t = core.ticket_summary(p.stg_support_tickets)
    return t.select(
        "account_id", "lifetime_tickets", "open_tickets",
        mean_score(F.col("csat_sum"), F.col("csat_n"), 1).alias("avg_csat"),
        round_div(F.col("hours_tenths"), F.col("hours_n") * 10, 1).alias("avg_resolution_hours"),
        "sla_breaches",
    )


def _revenue_trend(p: Pipeline) -> DataFrame:
    """The three latest amounts in order, as text: the checker does not compare arrays of decimals."""
    t = marts.revenue_trend(p.fct_revenue, p.settings, with_recent_values=True)
    values = F.array_join(F.transform("recent_mrr_values", lambda v: v.cast("string")), ", ")
    return t.select("account_id", values.alias("recent_mrr_values"), "contraction_months_6m")


def _options(**changes) -> Callable[[Callable[[Pipeline], DataFrame]], Callable[[SparkSession, str], DataFrame]]:
    """Queries over a pipeline with other settings."""
    settings = Settings(as_of=AS_OF, **changes)
    return lambda fn: lambda spark, sf_dir: fn(Pipeline(load_raw_inputs(spark, sf_dir), settings))


_LADDERS = _options(thresholds=Thresholds(
    fast_ratio=0.25, slow_ratio=2.0, satisfied_min=4.5, neutral_csat_min=2.5, support_few_tickets=1, support_some_tickets=3,
    support_best=90, support_good=70, support_fair=40, support_poor=20, support_worst=5,
    small_contraction=60, revenue_growing=80, revenue_flat=55, revenue_shrinking=35, revenue_falling=0,
))


def _ranked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")


# --- the raw inputs by other ways in -------------------------------------------


def _through_csv(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """The raw relations written as CSV files, some with line breaks in a field, with a file of unreadable records beside each."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/raw-csv-{uuid.uuid4().hex}"
    raw = load_raw_inputs(spark, sf_dir)
    accounts = raw.accounts.withColumn("industry", F.concat(F.lit("\n"), F.col("industry"), F.lit("\r\n")))  # staging trims them
    changed = RawInputs(accounts, raw.subscriptions, raw.invoices, raw.usage_events, raw.support_tickets, spark)
    write_raw_csv_dir(changed, path, names)
    for name in names:
        short = getattr(changed, name.removeprefix("raw_")).select(*RAW_SCHEMAS[name].names[:2])
        keys = short.filter(F.col(short.columns[0]).cast("bigint") % 50 == 0).select(*[F.col(c).cast("string") for c in short.columns])
        keys.write.mode("append").options(header=True, quoteAll=True).csv(f"{path}/{name}.csv")
    return path


def _staged_from_csv(relation: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(
        Pipeline(read_raw_csv_dir(spark, _through_csv(spark, sf_dir, name)), Settings(as_of=AS_OF)), relation
    )


def _unreadable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_raw_csv_dir(spark, _through_csv(spark, sf_dir, *RAW_SCHEMAS))
    return Q.run_checks(raw.bad_records, READABLE_CHECKS)


def _staged_from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged relations of raw inputs that are known to the session by name only: their rows."""
    given = load_raw_inputs(spark, sf_dir).as_dict()
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in given}
    register_views({names[name]: df for name, df in given.items()})
    p = Pipeline(read_raw_tables(spark, names), Settings(as_of=AS_OF))
    counts = [getattr(p, r).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(r).alias("relation"), "n_rows") for r in p.STAGING]
    return reduce(DataFrame.unionByName, counts)


def _rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written, replaced as a whole by a second build, and read through the catalog."""
    p = _pipeline(spark, sf_dir)
    base, table = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rebuilt-{uuid.uuid4().hex}", f"nrr_{uuid.uuid4().hex}"
    replace_table(p.nrr_summary.limit(1), base, table)
    replace_table(p.nrr_summary, base, table)
    return spark.table(table)


def _bucketed(mart: str, *inputs: str) -> Callable[[SparkSession, str], DataFrame]:
    """A mart over inputs written as tables bucketed by account."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = f"b_{uuid.uuid4().hex}_"
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}tables"
        _pipeline(spark, sf_dir).write_bucketed(path, prefix, names=inputs)
        return getattr(Pipeline.from_bucketed(load_raw_inputs(spark, sf_dir), Settings(as_of=AS_OF), prefix, inputs), mart)

    return run


def _unlisted_products(p: Pipeline) -> DataFrame:
    """The product dimension of subscriptions to retired products, which no list names."""
    retired = F.col("subscription_id").cast("bigint") % 3 == 0
    name = F.when(retired, F.concat(F.lit("retired_"), "product_name")).otherwise(F.col("product_name"))
    return core.dim_product(p.stg_subscriptions.withColumn("product_name", name))


def _audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per account of the churn view: that it and its layers below bear their times."""
    p = _scored_once(spark, sf_dir, audit=True)
    loaded = p.stg_accounts.select("account_id", F.col("_loaded_at").isNotNull().alias("is_loaded"))
    scored = p.customer_health_scores.select("account_id", F.col("scored_at").isNotNull().alias("is_scored"))
    assessed = p.churn_risk_view.select("account_id", F.col("assessed_at").isNotNull().alias("is_assessed"))
    return loaded.join(scored, "account_id").join(assessed, "account_id")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # relations M1-M16
    "stg_accounts": _rel("stg_accounts"),
    "stg_subscriptions": _rel("stg_subscriptions"),
    "stg_invoices": _rel("stg_invoices"),
    "stg_usage_events": _rel("stg_usage_events"),
    "stg_support_tickets": _rel("stg_support_tickets"),
    "dim_account": _rel("dim_account"),
    "dim_product": _rel("dim_product"),
    "dim_date": _with(_dim_date),
    "fct_revenue": _rel("fct_revenue"),
    "fct_usage": _rel("fct_usage"),
    "fct_tickets": _rel("fct_tickets"),
    "customer_health_scores": _rel("customer_health_scores"),
    "churn_risk_view": _rel("churn_risk_view"),
    "nrr_summary": _rel("nrr_summary"),
    "revenue_cohort_analysis": _rel("revenue_cohort_analysis"),
    "sla_adherence": _rel("sla_adherence"),
    # signal builders and operator-level entries
    "subscription_summary": _with(lambda p: core.subscription_summary(p.stg_subscriptions)),
    "ticket_summary": _with(_ticket_summary),
    "monthly_revenue": _with(lambda p: core.monthly_revenue(p.stg_invoices)),
    "usage_scores": _with(lambda p: marts.usage_scores(p.fct_usage, p.settings)),
    "support_scores": _with(
        lambda p: marts.support_scores(p.stg_support_tickets, p.settings).select(
            "account_id", "recent_open_tickets", "recent_avg_csat", "support_score"
        )
    ),
    "revenue_scores": _with(lambda p: marts.revenue_scores(p.fct_revenue)),
    "engagement_scores": _with(lambda p: marts.engagement_scores(p.stg_usage_events, p.settings)),
    "usage_trend": _with(lambda p: marts.usage_trend(p.fct_usage, p.settings)),
    "escalation_signal": _with(lambda p: marts.escalation_signal(p.stg_support_tickets, p.settings)),
    "revenue_trend": _with(_revenue_trend),
    "monthly_movements": _with(lambda p: marts.monthly_movements(p.fct_revenue)),
    "churn_detection": _with(lambda p: marts.churn_detection(p.fct_revenue_with_next)),
    "churn_detection_anti_join": _with(lambda p: marts.churn_detection_anti_join(p.fct_revenue)),
    "revenue_with_cohort": _with(lambda p: marts.revenue_with_cohort(p.dim_account, p.fct_revenue)),
    "cohort_metrics": _with(lambda p: marts.cohort_metrics(marts.revenue_with_cohort(p.dim_account, p.fct_revenue))),
    "sla_by_priority": _with(lambda p: marts.sla_by_priority(p.stg_support_tickets, p.dim_account)),
    "sla_by_segment": _with(lambda p: marts.sla_by_segment(p.stg_support_tickets, p.dim_account)),
    # semantic options and other ladders
    "fct_revenue_new_excluded": _options(include_new_in_expansion=False)(lambda p: p.fct_revenue),
    "fct_revenue_gap_aware": _options(gap_aware_movements=True)(lambda p: p.fct_revenue),
    "revenue_cohort_first_observed": _options(cohort_base="first_observed")(lambda p: p.revenue_cohort_analysis),
    "fct_tickets_thresholds": _LADDERS(lambda p: p.fct_tickets),
    "support_scores_thresholds": _LADDERS(
        lambda p: marts.support_scores(p.stg_support_tickets, p.settings).select("account_id", "recent_open_tickets", "support_score")
    ),
    "revenue_scores_thresholds": _LADDERS(lambda p: marts.revenue_scores(p.fct_revenue, p.settings)),
    # the raw files, names and tables
    "csv_stg_accounts": _staged_from_csv("stg_accounts", "raw_accounts"),
    "csv_stg_subscriptions": _staged_from_csv("stg_subscriptions", "raw_subscriptions"),
    "csv_stg_invoices": _staged_from_csv("stg_invoices", "raw_invoices"),
    "csv_stg_usage_events": _staged_from_csv("stg_usage_events", "raw_usage_events"),
    "csv_stg_support_tickets": _staged_from_csv("stg_support_tickets", "raw_support_tickets"),
    "csv_unreadable_records": _unreadable_records,
    "named_staging_rows": _staged_from_views,
    "rebuilt_nrr_table": _rebuilt_table,
    "nrr_summary_bucketed": _bucketed("nrr_summary", "fct_revenue_with_next"),
    "churn_risk_view_bucketed": _bucketed("churn_risk_view", *Pipeline.BUCKETED),
    "dim_product_unlisted": _with(_unlisted_products),
    "audit_columns": _audit_columns,
    # global ranking over a whole table
    "global_row_number": lambda spark, sf_dir: global_row_number(
        _ranked_orders(spark, sf_dir), ["o_totalprice desc", "o_orderkey"], "price_rank"
    ),
    "global_ntile": lambda spark, sf_dir: global_ntile(_ranked_orders(spark, sf_dir), ["o_totalprice", "o_orderkey"], 7, "bucket"),
    "waterfall_movements": _with(
        lambda p: marts.waterfall_movements(p.fct_revenue_with_next).select(
            "revenue_month", "total_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "paying_accounts",
            F.coalesce(F.col("_churned_mrr"), F.lit(0)).cast(MONEY).alias("churned_mrr"),
            F.col("_churned_accounts").alias("churned_accounts"),
        )
    ),
}

_ORACLE: dict[str, str] = {
    "stg_accounts": O.relation("stg_accounts"),
    "stg_subscriptions": O.relation("stg_subscriptions"),
    "stg_invoices": O.relation("stg_invoices"),
    "stg_usage_events": O.relation("stg_usage_events"),
    "stg_support_tickets": O.relation("stg_support_tickets"),
    "dim_account": O.relation("dim_account"),
    "dim_product": O.relation("dim_product"),
    "dim_date": O.relation("dim_date"),
    "fct_revenue": O.relation("fct_revenue"),
    "fct_usage": O.relation("fct_usage"),
    "fct_tickets": O.relation("fct_tickets"),
    "customer_health_scores": O.relation("customer_health_scores"),
    "churn_risk_view": O.relation("churn_risk_view", "risk_signal_count DESC, health_score, account_id"),
    "nrr_summary": O.relation("nrr_summary", "revenue_month"),
    "revenue_cohort_analysis": O.relation("revenue_cohort_analysis", "cohort_month, months_since_signup"),
    "sla_adherence": O.relation("sla_adherence", "ticket_year_month, dimension_type, dimension_value"),
    "subscription_summary": O.relation("subscription_summary"),
    "ticket_summary": O.relation("ticket_summary"),
    "monthly_revenue": O.relation("monthly_revenue"),
    "usage_scores": O.relation("usage_scores"),
    "support_scores": O.sql_for(
        "SELECT account_id, recent_open_tickets, recent_avg_csat, support_score FROM support_scores", "support_scores"
    ),
    "revenue_scores": O.relation("revenue_scores"),
    "engagement_scores": O.relation("engagement_scores"),
    "usage_trend": O.relation("usage_trend"),
    "escalation_signal": O.relation("escalation_signal"),
    "revenue_trend": O.relation("revenue_trend"),
    "monthly_movements": O.relation("monthly_movements"),
    "churn_detection": O.relation("churn_detection"),
    "churn_detection_anti_join": O.relation("churn_detection"),
    "revenue_with_cohort": O.relation("revenue_with_cohort"),
    "cohort_metrics": O.relation("cohort_metrics"),
    "sla_by_priority": O.relation("sla_by_priority"),
    "sla_by_segment": O.relation("sla_by_segment"),
    "waterfall_movements": O.relation("waterfall_movements"),
    "fct_revenue_new_excluded": O.relation("fct_revenue_new_excluded"),
    "fct_revenue_gap_aware": O.relation("fct_revenue_gap_aware"),
    "revenue_cohort_first_observed": O.relation("observed_revenue_cohort_analysis", "cohort_month, months_since_signup"),
    "fct_tickets_thresholds": O.relation("fct_tickets_thresholds"),
    "support_scores_thresholds": O.sql_for(
        "SELECT account_id, recent_open_tickets, support_score FROM support_scores_thresholds", "support_scores_thresholds"
    ),
    "revenue_scores_thresholds": O.relation("revenue_scores_thresholds"),
    **{f"csv_stg_{n}": O.relation(f"stg_{n}") for n in ("accounts", "subscriptions", "invoices", "usage_events", "support_tickets")},
    "csv_unreadable_records": O.UNREADABLE_RECORDS,
    "named_staging_rows": O.sql_for(
        " UNION ALL ".join(f"SELECT '{r}' AS relation, count(*) AS n_rows FROM {r}" for r in Pipeline.STAGING), *Pipeline.STAGING
    ),
    "rebuilt_nrr_table": O.relation("nrr_summary"),
    "nrr_summary_bucketed": O.relation("nrr_summary", "revenue_month"),
    "churn_risk_view_bucketed": O.relation("churn_risk_view", "risk_signal_count DESC, health_score, account_id"),
    "dim_product_unlisted": O.relation("dim_product_unlisted"),
    "audit_columns": O.sql_for("SELECT account_id, true AS is_loaded, true AS is_scored, true AS is_assessed FROM churn_risk_view", "churn_risk_view"),
    "global_row_number": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank FROM orders",
    "global_ntile": "SELECT o_orderkey, o_totalprice, ntile(7) OVER (ORDER BY o_totalprice, o_orderkey) AS bucket FROM orders",
}


class _Relations(Mapping):
    """The pipeline's relations by name, each built when it is asked for."""

    def __init__(self, p: Pipeline):
        self.p = p

    def __getitem__(self, name: str) -> DataFrame:
        return _dim_date(self.p) if name == "dim_date" else getattr(self.p, name)

    def __iter__(self):
        return iter(Pipeline.STAGING + Pipeline.CORE + Pipeline.MARTS)

    def __len__(self) -> int:
        return len(list(iter(self)))


def _suite(checks: list[Q.Check]) -> Callable[[SparkSession, str], DataFrame]:
    """A relation that feeds several parts of the suite is written once, with the checked columns only."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Q.run_checks(Q.narrowed(_Relations(_scored_once(spark, sf_dir)), checks, cut_lineage), checks)

    return run


# Checks that the given tables do violate.
_TABLE_CHECKS = [
    Q.Check("order_lines", "l_orderkey", "unique"),
    Q.Check("order_lines", "l_returnflag", "accepted_values", ("A", "N")),
    Q.Check("order_states", "open_status", "not_null"),
    Q.Check("order_states", "o_orderkey", "unique"),
    Q.Check("order_states", "o_custkey", "relationships", to="solvent_customers", field="c_custkey"),
    Q.Check("order_states", None, "expression", predicate="o_totalprice > 200000", name="assert_price_ceiling"),
]


def _tables_to_check(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return {
        "order_lines": read("lineitem").select("l_orderkey", "l_returnflag"),
        "order_states": read("orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice", "nullif(o_orderstatus, 'F') AS open_status"),
        "solvent_customers": read("customer").filter("c_acctbal > 0").select("c_custkey"),
    }


_QUALITY_GROUPS = {
    "dq_unique": [c for c in Q.ALL_CHECKS if c.kind == "unique"],
    "dq_not_null": [c for c in Q.ALL_CHECKS if c.kind == "not_null"],
    "dq_accepted_values": [c for c in Q.ALL_CHECKS if c.kind == "accepted_values"],
    "dq_relationships": [c for c in Q.ALL_CHECKS if c.kind == "relationships"],
    "dq_suite": Q.ALL_CHECKS,
}
for _name, _checks in _QUALITY_GROUPS.items():
    _QUERIES[_name] = _suite(_checks)
    _ORACLE[_name] = O.quality_report_sql(_checks)

_QUERIES["dq_violated_checks"] = lambda spark, sf_dir: Q.run_checks(_tables_to_check(spark, sf_dir), _TABLE_CHECKS)
_ORACLE["dq_violated_checks"] = O.quality_report_sql(_TABLE_CHECKS)
_QUERIES["dq_repeated_order_keys"] = lambda spark, sf_dir: Q.unique_violations(_tables_to_check(spark, sf_dir)["order_lines"], "l_orderkey")
_ORACLE["dq_repeated_order_keys"] = "SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1"
_QUERIES["dq_orders_over_ceiling"] = lambda spark, sf_dir: Q.expression_violations(
    _tables_to_check(spark, sf_dir)["order_states"], "o_totalprice > 200000"
).select("o_orderkey", "o_totalprice")
_ORACLE["dq_orders_over_ceiling"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000"
_QUERIES["dq_assert_mrr_non_negative"] = _with(lambda p: Q.mrr_non_negative(p.fct_revenue))
_ORACLE["dq_assert_mrr_non_negative"] = O.sql_for(
    "SELECT account_id, revenue_month, mrr FROM fct_revenue WHERE mrr < 0", "fct_revenue"
)
_QUERIES["dq_assert_health_score_range"] = _with(lambda p: Q.health_score_range(p.scored_accounts))
_ORACLE["dq_assert_health_score_range"] = O.sql_for(
    "SELECT account_id, company_name, health_score FROM customer_health_scores "
    "WHERE health_score < 0 OR health_score > 100",
    "customer_health_scores",
)


# The training-data operators and their pipeline can be absent as a whole; a fault inside them is not hidden.
try:
    import corpus_pipeline as _pipeline_job
    from acctlens.llm import queries as _llm
except ModuleNotFoundError as e:
    if not (e.name or "").startswith(("acctlens.llm", "corpus_pipeline")):
        raise
else:
    _QUERIES.update(_llm.QUERIES)
    _ORACLE.update(_llm.ORACLE)
    _QUERIES["pipeline"] = _pipeline_job.run
    if _pipeline_job.ORACLE_SQL:
        _ORACLE["pipeline"] = _pipeline_job.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each key in ``queries()``."""
    return dict(_ORACLE)
