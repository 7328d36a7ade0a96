"""The build command: every relation written, every check reported."""

import os
import tempfile

import pytest

from acctlens.build import build, main
from acctlens.config import Settings
from acctlens.operators.quality import ALL_CHECKS, run_checks
from acctlens.plans.pipeline import Pipeline
from acctlens.sources.driver_tables import AS_OF, load_raw_inputs
from acctlens.sources.raw import RAW_SCHEMAS, read_raw_csv_dir, write_raw_csv_dir
from acctlens.sources.sinks import read_current, versions

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_build_writes_relations_and_report(spark, capsys):
    out = tempfile.mkdtemp(prefix="acctlens-build-")
    code = main(["build", "--driver-tables", SF, "--as-of", "2024-01-31", "--out", out], spark=spark)
    printed = capsys.readouterr().out
    assert "built 16 relations; checks: 136" in printed
    report = read_current(spark, os.path.join(out, "_quality_report"))
    assert report.count() == 136
    failed = report.filter("NOT passed").count()
    assert code == (0 if failed == 0 else 1)
    # the adapters' region names are outside the accepted list: a real finding
    assert report.filter("relation = 'stg_accounts' AND column_name = 'region' AND NOT passed").count() == 1
    assert read_current(spark, os.path.join(out, "churn_risk_view")).count() > 0
    # staged relations are views, marts are tables, and the audit times are there
    assert {"_loaded_at", "account_id"} <= set(spark.table("stg_accounts").columns)
    mart = spark.table("customer_health_scores")
    assert mart.filter("scored_at IS NULL").count() == 0 and spark.catalog.tableExists("churn_risk_view")
    assert "assessed_at" in read_current(spark, os.path.join(out, "churn_risk_view")).columns
    for name in ("customer_health_scores", "churn_risk_view", "nrr_summary", "revenue_cohort_analysis", "sla_adherence"):
        spark.sql(f"DROP TABLE {name}")


MARTS = ("customer_health_scores", "churn_risk_view", "nrr_summary", "revenue_cohort_analysis", "sla_adherence")


def _violations(report):
    return {(r.relation, r.column_name, r.check_name): r.violations for r in report.collect()}


def test_observed_counts_equal_a_second_read(spark, monkeypatch):
    """Row-wise checks of written relations are counted while they are written, bad values included."""
    monkeypatch.setattr("acctlens.config.HEALTH_TIERS", ("none",))
    checks = [c if c.column != "health_tier" or c.kind != "accepted_values" else type(c)(c.relation, c.column, c.kind, ("none",)) for c in ALL_CHECKS]
    monkeypatch.setattr("acctlens.build.ALL_CHECKS", checks)
    out = tempfile.mkdtemp(prefix="acctlens-observe-")
    result = build(load_raw_inputs(spark, SF), Settings(as_of=AS_OF), out, "observed_")
    got = _violations(spark.read.parquet(result.report_path))
    relations = Pipeline(load_raw_inputs(spark, SF), Settings(as_of=AS_OF)).relations()
    assert got == _violations(run_checks(relations, checks))
    assert got["customer_health_scores", "health_tier", "accepted_values"] == relations["customer_health_scores"].count()
    for name in MARTS:
        spark.sql(f"DROP TABLE observed_{name}")


def test_csv_build_counts_unreadable_records(spark):
    out, raw_dir = tempfile.mkdtemp(prefix="acctlens-csvbuild-"), tempfile.mkdtemp(prefix="acctlens-csvraw-")
    write_raw_csv_dir(load_raw_inputs(spark, SF), raw_dir)
    with open(os.path.join(raw_dir, "raw_invoices.csv", "more.csv"), "w") as f:
        f.write(",".join(RAW_SCHEMAS["raw_invoices"].names) + '\n"inv-1","acc"\n"a","b","c","d","e","f","g","h"\n')
    result = build(read_raw_csv_dir(spark, raw_dir), Settings(as_of=AS_OF), out, "csv_")
    assert result.checks == 141
    got = _violations(spark.read.parquet(result.report_path))
    assert {k[0]: n for k, n in got.items() if k[2] == "readable"} == {n: 2 * (n == "raw_invoices") for n in RAW_SCHEMAS}
    plain = Pipeline(load_raw_inputs(spark, SF), Settings(as_of=AS_OF))
    assert spark.read.parquet(result.tables["fct_revenue"]).count() == plain.fct_revenue.count()
    for name in MARTS:
        spark.sql(f"DROP TABLE csv_{name}")


def test_rebuild_replaces_versions(spark):
    out = tempfile.mkdtemp(prefix="acctlens-rebuild-")
    for _ in range(3):
        result = build(load_raw_inputs(spark, SF), Settings(as_of=AS_OF), out, "again_")
    base = os.path.join(out, "nrr_summary")
    assert len(versions(spark, base)) == 2 and result.tables["nrr_summary"].rsplit("/", 1)[1] in versions(spark, base)[-1]
    assert spark.table("again_nrr_summary").count() == read_current(spark, base).count()
    for name in MARTS:
        spark.sql(f"DROP TABLE again_{name}")
