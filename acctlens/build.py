"""Build every relation, write it, and run the data-quality suite.

The one-command equivalent of building all models and then running their
tests. Staged relations are views. Core relations and marts are written once as
parquet, in dependency order, and every later relation and check reads the
written files, with column pruning and pushed filters; the marts are tables of
the catalog too. Audit columns are filled in. The check report (one row per
check) is written next to them.

Each relation is a new version beside the one of the last build (``sinks.replace_table``): a
build that fails leaves the old rows readable. The row-wise checks of written relations are
counted by the tasks that write them; only views, uniqueness and relationships are read for.
Rows of the inputs that cannot be parsed are left out of the relations and counted by checks of their own.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from acctlens.config import Settings
from acctlens.operators.quality import ALL_CHECKS, observed, run_checks
from acctlens.plans.pipeline import MART_PARTITIONING, Pipeline
from acctlens.sources.raw import READABLE_CHECKS, RawInputs
from acctlens.sources.sinks import register_views, replace_table


@dataclass(frozen=True)
class BuildResult:
    tables: dict[str, str]
    report_path: str
    checks: int
    failed: int


#: Relations of the build that several others read, without a place in the model: written beside the rest.
INTERNAL = {"fct_revenue": "fct_revenue_with_next", "customer_health_scores": "scored_accounts"}


def build(raw: RawInputs, settings: Settings, out_dir: str, table_prefix: str = "") -> BuildResult:
    """Build and check everything. ``table_prefix`` (a database with its dot, say) goes before view and mart names."""
    spark = raw.spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    p = Pipeline(raw, settings, audit=True)
    register_views({f"{table_prefix}{n}".replace(".", "_"): getattr(p, n) for n in p.STAGING})
    places = {n: "view" for n in p.STAGING}
    bad_records = raw.bad_records
    checks = [*ALL_CHECKS, *(READABLE_CHECKS if bad_records else [])]
    known: dict[int, int] = {}

    def write(name: str, base: str, table: str | None = None) -> str:
        counts = observed(checks, name)
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        path = replace_table(
            getattr(p, name), base, table, partition_by=MART_PARTITIONING.get(name, ()),
            cluster_by=("account_id",) if name in MART_PARTITIONING else (), observe=(seen, counts) if counts else None,
        )
        if counts:
            known.update({int(k[1:]): n for k, n in seen.get.items()})
        setattr(p, name, spark.read.parquet(path))  # all that follows reads the files
        return path

    for name in p.CORE + p.MARTS:
        if name in INTERNAL:
            write(INTERNAL[name], os.path.join(out_dir, "_internal", INTERNAL[name]))
        places[name] = write(name, os.path.join(out_dir, name), f"{table_prefix}{name}" if name in p.MARTS else None)
    relations = p.relations() | bad_records
    report_path = replace_table(run_checks(relations, checks, known), os.path.join(out_dir, "_quality_report"))
    # The report has one row per declared check (136 rows), so summing it on
    # the driver reads a bounded summary, not data.
    summary = spark.read.parquet(report_path).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed")
    ).first()
    return BuildResult(places, report_path, summary["checks"], summary["failed"])


def _parse(argv: list[str] | None = None):
    import argparse

    ap = argparse.ArgumentParser(prog="acctlens", description=__doc__)
    sub = ap.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="build, write and check every relation")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv-dir", help="folder with raw_*.csv files")
    src.add_argument("--parquet-dir", help="folder with raw_* parquet tables")
    src.add_argument("--driver-tables", help="folder with the TPC-H-style driver parquet tables")
    b.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    b.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    b.add_argument("--table-prefix", default="", help="goes before view and mart names, e.g. a database and a dot")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from acctlens.sources.driver_tables import load_raw_inputs
    from acctlens.sources.raw import read_raw_csv_dir, read_raw_parquet_dir

    args = _parse(argv)
    spark = spark or SparkSession.builder.appName("acctlens-build").getOrCreate()
    if args.csv_dir:
        raw = read_raw_csv_dir(spark, args.csv_dir)
    elif args.parquet_dir:
        raw = read_raw_parquet_dir(spark, args.parquet_dir)
    else:
        raw = load_raw_inputs(spark, args.driver_tables)
    result = build(raw, Settings(as_of=args.as_of), args.out, args.table_prefix)
    print(f"built {len(result.tables)} relations; checks: {result.checks}, "
          f"passed: {result.checks - result.failed}, failed: {result.failed}; report: {result.report_path}")
    return 0 if result.failed == 0 else 1
