"""Benchmark: headline relations on the driver tables.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion into Spark's ``noop`` sink (the full plan
executes, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acctlens.config import Settings  # noqa: E402
from acctlens.plans.pipeline import Pipeline  # noqa: E402
from acctlens.session import build_session  # noqa: E402
from acctlens.sources.driver_tables import AS_OF, load_raw_inputs  # noqa: E402

HEADLINE = (
    "dim_account", "fct_revenue", "fct_usage", "fct_tickets",
    "customer_health_scores", "churn_risk_view", "nrr_summary", "revenue_cohort_analysis", "sla_adherence",
)


def _run(build) -> float:
    """Time plan construction (which may run eager checkpoints) plus execution."""
    t = time.perf_counter()
    df = build() if callable(build) else build
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    settings = Settings(as_of=AS_OF)

    def pipeline(materialize=None, shared="all"):
        return Pipeline(load_raw_inputs(spark, sf_dir), settings, materialize=materialize, shared=shared)

    _run(lambda: pipeline().stg_accounts)  # JVM / code-path warm-up, not timed

    timings: dict[str, float] = {}
    for name in HEADLINE:
        timings[name] = round(_run(lambda: getattr(pipeline(), name)), 3)

    # Whole build: every relation, each persisted once for its consumers.
    p = pipeline("persist")
    t = time.perf_counter()
    for name in p.STAGING + p.CORE + p.MARTS:
        _run(lambda: getattr(p, name))
    timings["pipeline_all_relations"] = round(time.perf_counter() - t, 3)
    p.release()

    from acctlens.operators.quality import ALL_CHECKS, run_checks

    p = pipeline("persist")
    timings["quality_suite_136"] = round(_run(lambda: run_checks(p.relations(), ALL_CHECKS)), 3)
    p.release()

    # Production-style: write the mart inputs bucketed by account_id once,
    # then build all marts on them.
    out = tempfile.mkdtemp(prefix="acctlens-bench-bkt-")
    t = time.perf_counter()
    pipeline().write_bucketed(out, prefix="bench_", buckets=cpus)
    timings["write_bucketed_inputs"] = round(time.perf_counter() - t, 3)
    p = Pipeline.from_bucketed(load_raw_inputs(spark, sf_dir), settings, prefix="bench_")
    t = time.perf_counter()
    for name in p.MARTS:
        _run(lambda: getattr(p, name))
    timings["marts_from_bucketed_inputs"] = round(time.perf_counter() - t, 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
