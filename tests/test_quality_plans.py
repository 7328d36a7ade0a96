"""Plans that the suite and the bucketed marts promise."""

import os

import pytest

import __spark_entry__ as E
from acctlens.operators import quality as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_suite_cuts_only_checked_columns(spark):
    cut = []
    relations = E._Relations(E._pipeline(spark, SF))
    named = Q.narrowed(relations, Q.ALL_CHECKS, lambda df: cut.append(df) or df)
    for name, df in named.items():
        checks = [c for c in Q.ALL_CHECKS if name in (c.relation, c.to)]
        wanted = {c.column for c in checks if c.relation == name} | {c.field for c in checks if c.to == name} | {"mrr", "health_score"}
        assert set(df.columns) <= wanted, name
    assert {"company_name", "current_arr"} & set(relations["churn_risk_view"].columns) and "current_arr" not in named["churn_risk_view"].columns
    # what only one part of the suite reads is not written at all
    assert len(cut) < len(named) and not any(df is named["fct_usage"] for df in cut)


def test_narrowed_suite_gives_the_same_report(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", -2, None), (None, 3, "y")], "k string, n int, unused string")
    parent = spark.createDataFrame([("b", 1)], "id string, more int")
    checks = [
        Q.Check("t", "k", "unique"), Q.Check("t", "k", "not_null"), Q.Check("t", "k", "relationships", to="p", field="id"),
        Q.Check("t", None, "expression", predicate="n < 0", name="not_negative"),
    ]
    whole = {"t": frame, "p": parent}
    report = [tuple(r) for r in Q.run_checks(Q.narrowed(whole, checks), checks).collect()]
    assert sorted(map(repr, report)) == sorted(map(repr, (tuple(r) for r in Q.run_checks(whole, checks).collect())))
    assert sorted(r[3] for r in report) == [1, 1, 1, 2]
    assert Q.checked_columns(checks, "t", frame.columns) == ["k", "n"]
    told = {r[2]: r[3] for r in Q.run_checks(whole, checks, known={0: 7, 3: 9}).collect()}
    assert told == {"unique": 7, "not_null": 1, "relationships": 2, "not_negative": 9}


def test_bucketed_mart_shuffles_no_fact_by_account(spark):
    df = E.queries()["nrr_summary_bucketed"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.lower()
    assert "hashpartitioning(account_id" not in plan


def test_unique_checks_read_scored_accounts_already_written(spark):
    plan = E.queries()["dq_unique"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # events: their own key, the calendar, and the usage trend of the churn view; none for its health scores
    assert plan.count("Relation [event_id") == 3


def test_audit_columns_read_scored_accounts_already_written(spark):
    df = E.queries()["audit_columns"](spark, SF)
    # events are read for the usage trend of the churn view only
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [event_id") == 1
    rows = df.collect()
    assert rows and all(r.is_loaded and r.is_scored and r.is_assessed for r in rows)
