"""View and table sinks.

``write_table`` writes a path in place. ``replace_table`` rebuilds a table as a whole: the rows go to a new
version beside the old one, and only a complete version (Spark's committer marks it with ``_SUCCESS`` when all
tasks have committed) is switched to. Until then, and after a failed write, readers see the old rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Expose lazily evaluated relations by name (the staging/core "view" sink)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_table(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    dynamic_overwrite: bool = False,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Full-rebuild table sink (the mart materialization): a path, a table, or a table at a path.

    Facts that are filtered by date downstream should be partitioned by their
    month/date column so trailing-window filters prune files. With
    ``cluster_by`` the rows are range-partitioned on the partition columns
    plus the clustering key first: each task writes a contiguous slice, so a
    date gets a few files instead of one per task, and a hot date is still
    split over several tasks by the clustering key.

    ``observe`` names aggregates to take of the rows on their way to the files, by the tasks that write them
    (so after the clustering, whose sampling reads some rows twice).
    """
    if partition_by and cluster_by:
        df = df.repartitionByRange(*partition_by, *cluster_by)
    if observe:
        df = df.observe(observe[0], *observe[1])
    w = df.write.mode(mode).format(fmt)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        (w.option("path", path) if path is not None else w).saveAsTable(table)
    elif path is not None:
        w.save(path)
    else:
        raise ValueError("write_table needs a path or a table name")


# --- whole-table replacement ---------------------------------------------------


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, base: str, complete: bool = True) -> list[str]:
    """The versions under ``base``, the oldest first; ``complete``: those whose write has been committed."""
    fs, path = _folder(spark, base)
    found = fs.globStatus(path(f"{base}/v-*/_SUCCESS" if complete else f"{base}/v-*"))
    paths = [f.getPath() for f in found or []]
    return sorted((p.getParent() if complete else p).toString() for p in paths)


def current_version(spark: SparkSession, base: str) -> str | None:
    """The newest complete version under ``base``."""
    return next(iter(reversed(versions(spark, base))), None)


def read_current(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the newest complete version."""
    path = current_version(spark, base)
    if path is None:
        raise FileNotFoundError(f"no complete version under {base}")
    return spark.read.format(fmt).load(path)


def switch_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    """Let the catalog's ``table`` read ``path``.

    That is a change of its location; a table with partitions, of another schema or not there yet is made anew.
    """
    partitioned = lambda: any(c.isPartition for c in spark.catalog.listColumns(table))
    plain = lambda schema: [(f.name, f.dataType) for f in schema]
    new = plain(spark.read.format(fmt).load(path).schema)
    if spark.catalog.tableExists(table) and plain(spark.table(table).schema) == new and not partitioned():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: its files stay
        spark.catalog.createTable(table, path=path, source=fmt)
        if partitioned():
            spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def replace_table(
    df: DataFrame, base: str, table: str | None = None, fmt: str = "parquet", keep: int = 2, **options
) -> str:
    """Write ``df`` as a new version under ``base``, then switch ``table`` (if named) to it; returns the version's path.

    ``keep`` complete versions stay, for readers that have begun on an older one; older and failed ones are deleted.
    ``options`` are those of ``write_table``. One writer at a time.
    """
    spark = df.sparkSession
    base = base.rstrip("/")
    path = f"{base}/v-{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    write_table(df, path=path, fmt=fmt, mode="errorifexists", **options)
    if table:
        switch_table(spark, table, path, fmt)
    fs, to_path = _folder(spark, base)
    for old in set(versions(spark, base, complete=False)) - {v for v in versions(spark, base)[-keep:]}:
        fs.delete(to_path(old), True)
    return path
