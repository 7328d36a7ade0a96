"""Semantic options (include_new, cohort base) and data properties on the driver tables."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from acctlens.config import Settings
from acctlens.plans import core, marts
from acctlens.plans.pipeline import Pipeline
from acctlens.sources.driver_tables import AS_OF, load_raw_inputs

D = dt.date
SF = "/root/testdata/sf0.001"


def _invoices(spark, rows):
    df = spark.createDataFrame(
        [(f"i{i}", a, d, Decimal(str(x)), "paid") for i, (a, d, x) in enumerate(rows)],
        "invoice_id string, account_id string, invoice_date date, amount decimal(18,2), status string",
    )
    return df.select("*", F.trunc("invoice_date", "month").alias("invoice_month"), F.lit(True).alias("is_paid"))


def test_include_new_option(spark):
    inv = _invoices(spark, [("a", D(2024, 1, 2), 100), ("a", D(2024, 2, 2), 130)])
    default = {r.revenue_month: r.expansion_mrr for r in core.fct_revenue(inv).collect()}
    strict = {r.revenue_month: r.expansion_mrr
              for r in core.fct_revenue(inv, Settings(as_of=D(2025, 1, 31), include_new_in_expansion=False)).collect()}
    assert default[D(2024, 1, 1)] == Decimal("100.00") and strict[D(2024, 1, 1)] == Decimal("0.00")
    assert default[D(2024, 2, 1)] == strict[D(2024, 2, 1)] == Decimal("30.00")


def test_first_observed_cohort_base_keeps_every_cohort(spark):
    accounts = spark.createDataFrame([("a", D(2024, 1, 15)), ("b", D(2024, 1, 20))], "account_id string, signup_date date")
    inv = _invoices(spark, [("a", D(2024, 2, 3), 10), ("b", D(2024, 3, 3), 20), ("b", D(2024, 4, 3), 20)])
    signup = marts.revenue_cohort_analysis(accounts, core.fct_revenue(inv)).collect()
    observed = marts.revenue_cohort_analysis(
        accounts, core.fct_revenue(inv), Settings(as_of=D(2025, 1, 31), cohort_base="first_observed")
    ).collect()
    assert signup == []  # nobody paid in the signup month
    assert {(r.cohort_label, r.months_since_signup) for r in observed} == {("2024-02", 0), ("2024-03", 0), ("2024-03", 1)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_usage_and_score_properties(spark):
    p = Pipeline(load_raw_inputs(spark, SF), Settings(as_of=AS_OF))
    cats = ["reporting_events", "crm_core_events", "communication_events", "advanced_events", "platform_events"]
    bad = p.fct_usage.filter(sum(F.col(c) for c in cats) > F.col("total_events")).count()
    assert bad == 0
    h = p.customer_health_scores
    assert h.filter((F.col("health_score") < 0) | (F.col("health_score") > 100)).count() == 0
    n = h.count()
    assert sorted(r.intervention_priority for r in h.select("intervention_priority").collect()) == list(range(1, n + 1))
    nrr = p.nrr_summary.filter(F.col("grr_pct").isNotNull())
    assert nrr.filter(F.col("grr_pct") > F.col("nrr_pct")).count() == 0
