"""Distributed global ranking equals the single-partition window functions."""

import pytest
from hypothesis import given
from hypothesis import settings as hsettings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from acctlens.operators import ranking
from acctlens.operators.ranking import (
    global_ntile,
    global_row_number,
    latest_per_key,
)


def _frame(spark, n, distinct_values):
    # many ties: value = id % distinct_values; a third of the rows share value 0
    return spark.range(n).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % distinct_values).cast("double").alias("v"),
    )


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10, 997])
@pytest.mark.parametrize("buckets", [4, 7])
def test_global_ntile_matches_window(spark, n, buckets):
    df = _frame(spark, n, 13)
    expected = {
        r.key: r.q for r in df.select("key", F.ntile(buckets).over(Window.orderBy("v", "key")).alias("q")).collect()
    }
    got = {r.key: r.q for r in global_ntile(df, ["v", "key"], buckets, "q", bins=5).collect()}
    assert got == expected


@pytest.mark.parametrize("n", [1, 2, 10, 1000])
def test_global_row_number_matches_window(spark, n):
    df = _frame(spark, n, 7)
    expected = {
        r.key: r.rn for r in df.select("key", F.row_number().over(Window.orderBy(F.col("v").desc(), "key")).alias("rn")).collect()
    }
    got = {r.key: r.rn for r in global_row_number(df, ["v desc", "key"], "rn", bins=6).collect()}
    assert got == expected


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = _frame(spark, 1003, 5)
    sizes = [r["count"] for r in global_ntile(df, ["v", "key"], 4, "q", bins=8).groupBy("q").count().collect()]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _jobs(spark, build):
    """How many jobs building a frame starts."""
    spark.sparkContext.setJobGroup("building", "building")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_value_is_cut_into_bins(spark):
    """A value held by a third of the rows does not land in one bin."""
    df = _frame(spark, 3000, 11)
    order = ranking._Order(["v", "key"])
    binned = order.places(df, ranking._cuts(df, order, 15), 15, "bin")
    sizes = [r["count"] for r in binned.groupBy("bin").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1000
    held = binned.filter("v = 0").groupBy("bin").count().count()
    assert held >= 4


def test_building_a_ranking_starts_no_job(spark):
    df = _frame(spark, 500, 7).groupBy("key").agg(F.max("v").alias("v"))
    assert _jobs(spark, lambda: global_ntile(df, ["v", "key"], 4, "q")) == 0
    assert _jobs(spark, lambda: global_row_number(df, ["v desc", "key"], "rn")) == 0


def test_ntile_shuffles_only_cut_bins(spark):
    df = _frame(spark, 20_000, 50)
    out = global_ntile(df, ["v", "key"], 4, "q", bins=63)
    out.collect()
    plan = _plan(out)
    assert "rangepartitioning" not in plan
    order = ranking._Order(["v", "key"])
    keys = order.places(df, ranking._cuts(df, order, 63), 63, "bin")
    sizes = sorted((r["count"] for r in keys.groupBy("bin").count().collect()), reverse=True)
    assert sum(sizes[:3]) < 20_000 / 3  # even the largest bins hold few rows


def test_row_number_evaluates_its_input_once(spark):
    df = _frame(spark, 2000, 9).groupBy("key").agg(F.max("v").alias("v"), F.count("*").alias("n"))
    out = global_row_number(df, ["v", "key"], "rn", bins=7, steps=["v"], sample=df.select("key"))
    rows = out.collect()
    expected = {r.key: r.rn for r in df.select("key", F.row_number().over(Window.orderBy("v", "key")).alias("rn")).collect()}
    assert {r.key: r.rn for r in rows} == expected
    # rows and counts read one exchange of the dealt rows
    assert any("ReusedExchange" in line and "REPARTITION_BY_COL" in line for line in _plan(out).splitlines())


def test_nulls_sort_as_in_spark(spark):
    df = spark.range(60).selectExpr("cast(id as string) AS key", "CASE WHEN id % 4 > 0 THEN cast(id % 5 as double) END AS v")
    for order, by in ((["v", "key"], [F.col("v").asc(), "key"]), (["v desc", "key desc"], [F.col("v").desc(), F.col("key").desc()])):
        w = Window.orderBy(*by)
        want = {r.key: (r.rn, r.q) for r in df.select("key", F.row_number().over(w).alias("rn"), F.ntile(7).over(w).alias("q")).collect()}
        numbers = {r.key: r.rn for r in global_row_number(df, order, "rn", bins=6).collect()}
        tiles = {r.key: r.q for r in global_ntile(df, order, 7, "q", bins=6).collect()}
        assert {k: (numbers[k], tiles[k]) for k in want} == want


def test_latest_per_key(spark):
    rows = [("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 5, 50)]
    df = spark.createDataFrame(rows, "k string, m long, x long")
    got = {r.k: r.x for r in latest_per_key(df, ["k"], "m", ["x"]).collect()}
    assert got == {"a": 30, "b": 50}


@hsettings(max_examples=8, deadline=None)
@given(
    n=st.integers(min_value=1, max_value=300),
    buckets=st.integers(min_value=1, max_value=9),
    parts=st.integers(min_value=1, max_value=9),
    distinct=st.integers(min_value=1, max_value=20),
)
def test_global_ntile_property(spark, n, buckets, parts, distinct):
    df = _frame(spark, n, distinct)
    expected = {
        r.key: r.q for r in df.select("key", F.ntile(buckets).over(Window.orderBy("v", "key")).alias("q")).collect()
    }
    got = {r.key: r.q for r in global_ntile(df, ["v", "key"], buckets, "q", bins=parts).collect()}
    assert got == expected
