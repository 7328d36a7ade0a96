"""Pipeline: every relation built once from the raw inputs.

Relations are lazy DataFrames. Facts read by several marts (``fct_revenue``
by six consumers, ``fct_usage`` and ``dim_account`` by several) can be
materialized once:

* ``materialize=None``: fully lazy; each action recomputes what it needs.
* ``"persist"``: ``persist(MEMORY_AND_DISK)`` for the duration of a job.
* ``"checkpoint"``: reliable checkpoint into ``spark.checkpoint.dir`` (a
  shared folder on a cluster). This cuts lineage, so a lost executor costs a
  re-read of the checkpoint, not a recomputation from the raw tables.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from acctlens.config import Settings
from acctlens.plans import core, marts, staging
from acctlens.session import cut_lineage
from acctlens.sources.raw import RawInputs
from acctlens.sources.sinks import replace_table

SHARED = (
    "dim_account", "fct_revenue_with_next", "fct_usage", "fct_tickets", "stg_usage_events", "scored_accounts",
)

MART_PARTITIONING = {
    "fct_revenue": ("revenue_month",),
    "fct_usage": ("event_date",),
}


class Pipeline:
    def __init__(
        self,
        raw: RawInputs,
        settings: Settings,
        materialize: str | None = None,
        shared: tuple[str, ...] | str = SHARED,
        tables: dict[str, DataFrame] | None = None,
        audit: bool = False,
    ) -> None:
        """``shared`` names the relations to materialize (default: the
        multi-consumer facts), or ``"all"`` for every relation, e.g. before
        running the quality suite, where each relation feeds several checks.
        ``tables`` supplies relations already built (e.g. the bucketed tables
        of ``write_bucketed``); they are used instead of being recomputed.
        ``audit`` adds the load, scoring and assessment times."""
        if materialize not in (None, "persist", "checkpoint"):
            raise ValueError(f"unknown materialize mode {materialize!r}")
        self.raw = raw
        self.settings = settings
        self.materialize = materialize
        self.shared = shared
        self.tables = dict(tables or {})
        self.audit = audit
        self._held: list[DataFrame] = []

    @property
    def spark(self) -> SparkSession:
        return self.raw.spark

    def _share(self, name: str, build) -> DataFrame:
        """The relation ``name``: a supplied table, or ``build()``, materialized
        once when it is one of the shared relations."""
        if name in self.tables:
            return self.tables[name]
        df = build()
        if self.materialize is None or (self.shared != "all" and name not in self.shared):
            return df
        if self.materialize == "persist":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            df = cut_lineage(df)
        self._held.append(df)
        return df

    def release(self) -> None:
        for df in self._held:
            if self.materialize == "persist":
                df.unpersist()
        self._held.clear()

    # --- staging
    @cached_property
    def stg_accounts(self) -> DataFrame:
        return self._share("stg_accounts", lambda: staging.stg_accounts(self.raw.accounts, self.audit))

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return self._share("stg_subscriptions", lambda: staging.stg_subscriptions(self.raw.subscriptions, self.audit))

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return self._share("stg_invoices", lambda: staging.stg_invoices(self.raw.invoices, self.audit))

    @cached_property
    def stg_usage_events(self) -> DataFrame:
        return self._share("stg_usage_events", lambda: staging.stg_usage_events(self.raw.usage_events, self.audit))

    @cached_property
    def stg_support_tickets(self) -> DataFrame:
        return self._share("stg_support_tickets", lambda: staging.stg_support_tickets(self.raw.support_tickets, self.audit))

    # --- core
    @cached_property
    def dim_account(self) -> DataFrame:
        return self._share("dim_account", lambda:
            core.dim_account(self.stg_accounts, self.stg_subscriptions, self.stg_support_tickets, self.settings),
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._share("dim_product", lambda: core.dim_product(self.stg_subscriptions))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._share("dim_date", lambda: core.dim_date(self.spark))

    @cached_property
    def fct_revenue_with_next(self) -> DataFrame:
        return self._share("fct_revenue_with_next", lambda: core.fct_revenue(self.stg_invoices, self.settings, with_next_month=True))

    @cached_property
    def fct_revenue(self) -> DataFrame:
        return self.fct_revenue_with_next.drop("next_revenue_month")

    @cached_property
    def fct_usage(self) -> DataFrame:
        return self._share("fct_usage", lambda: core.fct_usage(self.stg_usage_events, self.settings.thresholds))

    @cached_property
    def fct_tickets(self) -> DataFrame:
        return self._share("fct_tickets", lambda: core.fct_tickets(self.stg_support_tickets, self.stg_accounts, self.settings.thresholds))

    # --- marts
    @cached_property
    def scored_accounts(self) -> DataFrame:
        return self._share("scored_accounts", lambda:
            marts.scored_accounts(
                self.dim_account, self.fct_usage, self.stg_support_tickets, self.fct_revenue, self.stg_usage_events,
                self.settings,
            ),
        )

    @cached_property
    def customer_health_scores(self) -> DataFrame:
        return self._share("customer_health_scores", lambda:
            marts.customer_health_scores(self.scored_accounts, self.stg_accounts, self.audit))

    @cached_property
    def churn_risk_view(self) -> DataFrame:
        return self._share("churn_risk_view", lambda: marts.churn_risk_view(
            self.scored_accounts, self.fct_usage, self.stg_support_tickets, self.fct_revenue, self.settings, audit=self.audit
        ))

    @cached_property
    def nrr_summary(self) -> DataFrame:
        return self._share("nrr_summary", lambda: marts.nrr_summary(self.fct_revenue_with_next))

    @cached_property
    def revenue_cohort_analysis(self) -> DataFrame:
        return self._share("revenue_cohort_analysis", lambda: marts.revenue_cohort_analysis(self.dim_account, self.fct_revenue, self.settings))

    @cached_property
    def sla_adherence(self) -> DataFrame:
        # The report reads only staged ticket columns, so the staged tickets
        # stand in for fct_tickets and skip its account-context join.
        return self._share("sla_adherence", lambda: marts.sla_adherence(self.stg_support_tickets, self.dim_account))

    # --- groups
    STAGING = ("stg_accounts", "stg_subscriptions", "stg_invoices", "stg_usage_events", "stg_support_tickets")
    CORE = ("dim_account", "dim_product", "dim_date", "fct_revenue", "fct_usage", "fct_tickets")
    MARTS = ("customer_health_scores", "churn_risk_view", "nrr_summary", "revenue_cohort_analysis", "sla_adherence")

    def relations(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.STAGING + self.CORE + self.MARTS}

    # Relations the marts read that are worth co-locating on account_id.
    BUCKETED = ("dim_account", "fct_revenue_with_next", "fct_usage", "stg_support_tickets", "stg_usage_events")

    def write_bucketed(
        self, out_dir: str, prefix: str = "acctlens_", buckets: int | None = None, names: tuple[str, ...] = BUCKETED
    ) -> dict[str, str]:
        """Write the mart inputs as tables bucketed and sorted by ``account_id``.

        Marts built on them (``Pipeline.from_bucketed``) aggregate and join on
        ``account_id`` without shuffling the facts again: bucketed scans
        already satisfy the ``account_id`` distribution. Use the same bucket
        count for all of them so their joins line up.
        """
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        written = {}
        for name in names:
            table = f"{prefix}{name}"
            path = os.path.join(out_dir, name)
            (
                getattr(self, name).write.mode("overwrite").format("parquet").option("path", path)
                .bucketBy(n, "account_id").sortBy("account_id").saveAsTable(table)
            )
            written[name] = table
        return written

    @classmethod
    def from_bucketed(
        cls, raw: RawInputs, settings: Settings, prefix: str = "acctlens_", names: tuple[str, ...] = BUCKETED, **kwargs
    ) -> "Pipeline":
        """A pipeline whose mart inputs are the tables of ``write_bucketed``."""
        tables = {name: raw.spark.table(f"{prefix}{name}") for name in names}
        return cls(raw, settings, tables=tables, **kwargs)

    def write(self, out_dir: str, names: tuple[str, ...] | None = None) -> dict[str, str]:
        """Write relations as parquet under ``out_dir``, each a new version beside its old ones; returns the versions' paths."""
        written = {}
        for name in names or (self.CORE + self.MARTS):
            written[name] = replace_table(
                getattr(self, name), os.path.join(out_dir, name), partition_by=MART_PARTITIONING.get(name, ()),
                cluster_by=("account_id",) if name in MART_PARTITIONING else (),
            )
        return written
