"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus the driver's entry point."""

import os
import re

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck_connection

SF = "/root/testdata/sf0.001"
# the training-data queries have their own tests, in tests/llm
NAMES = sorted(n for n in E.queries() if not re.match(r"op[0-9]+_|pipeline$", n))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert res.get("ok"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "risk_level" in df.columns


@pytest.mark.parametrize("name", ["stg_usage_events", "fct_usage", "fct_tickets", "sla_adherence"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert res.get("ok"), res


@pytest.mark.parametrize("name", ["stg_subscriptions", "nrr_summary", "revenue_cohort_analysis"])
def test_results_do_not_depend_on_ansi_mode(spark, con, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        res = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert res.get("ok"), res
