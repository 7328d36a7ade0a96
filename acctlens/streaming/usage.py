"""Incremental daily usage fact (M10) over a stream of raw usage events.

Each micro-batch (``foreachBatch``):

1. stages its events (``stg_usage_events``) into a parquet table partitioned
   by ``event_date`` and ``_batch``. Dynamic partition overwrite keyed on the
   batch id makes a retried batch replace its own files instead of appending
   them twice;
2. finds the days it touched (one row per day: calendar-bounded) and reads
   every staged event of those days, each event once. A semi-join on the partition column,
   with the day list broadcast, lets dynamic partition pruning skip the
   other days;
3. recomputes ``fct_usage`` for those days and overwrites only their
   partitions of the fact table (dynamic partition overwrite).

A late event only touches an older day, which is recomputed from all of that
day's events, so distinct users and features stay exact across batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acctlens.config import Thresholds
from acctlens.plans.core import fct_usage
from acctlens.plans.staging import stg_usage_events
from acctlens.sources.sinks import write_table


def refresh_daily_usage(batch: DataFrame, batch_id: int, staged_path: str, fact_path: str,
                        t: Thresholds = Thresholds()) -> None:
    """Apply one micro-batch of raw usage events to the staged table and the fact."""
    spark = batch.sparkSession
    staged = stg_usage_events(batch).withColumn("_batch", F.lit(batch_id).cast("bigint"))
    write_table(staged, path=staged_path, partition_by=("event_date", "_batch"), mode="overwrite",
                dynamic_overwrite=True)
    days = spark.read.parquet(staged_path).filter(F.col("_batch") == batch_id).select("event_date").distinct()
    # one row per touched day; a NULL day matches NULL
    days = F.broadcast(days.withColumnRenamed("event_date", "_day"))
    events = spark.read.parquet(staged_path).join(days, F.col("event_date").eqNullSafe(F.col("_day")), "left_semi")
    # an event delivered again in a later batch counts once
    events = events.drop("_batch").dropDuplicates(["event_id"])
    write_table(fct_usage(events, t), path=fact_path, partition_by=("event_date",), cluster_by=("account_id",),
                mode="overwrite", dynamic_overwrite=True)


def start_daily_usage_stream(
    raw_events: DataFrame,
    staged_path: str,
    fact_path: str,
    checkpoint_location: str,
    trigger: dict | None = None,
    t: Thresholds = Thresholds(),
) -> StreamingQuery:
    """Start the incremental fact job on a streaming DataFrame of raw usage events.

    ``checkpoint_location`` must be on shared storage (the stream's offsets
    and commit log live there). ``trigger`` is passed to ``.trigger(**trigger)``,
    e.g. ``{"processingTime": "1 minute"}`` or ``{"availableNow": True}``.
    """
    writer = raw_events.writeStream.foreachBatch(
        lambda df, batch_id: refresh_daily_usage(df, batch_id, staged_path, fact_path, t)
    ).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
