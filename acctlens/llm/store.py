"""Tables written once into the shared folder and read back: the cut between two jobs of an operator.

The folder is the one the cluster names in ``spark.checkpoint.dir``. A written table survives lost
executors, and every reader of it sees the same rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acctlens.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path of its own in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tasks, and so files, for each core that ``written`` may use with ``few_files``.
WAVES = 4


def written(df: DataFrame, name: str, compression: str = "zstd", few_files: bool = False) -> DataFrame:
    """``df``, written to the shared folder as parquet and read back.

    With ``few_files`` a task writes several shuffle partitions one after the other, so that there are at
    most ``WAVES`` files a core. Every file costs child processes where Hadoop has no native library (it
    sets permissions by ``chmod``), and a table written again and again pays that each time.
    """
    path = shared_path(df.sparkSession, name)
    if few_files:
        df = df.coalesce(WAVES * df.sparkSession.sparkContext.defaultParallelism)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_code(job: Callable) -> Callable:
    """``job(spark, ...)`` with this package on the path of local Python workers.

    On a cluster it is installed there or sent along (``--py-files``); the path then adds nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    def run(spark: SparkSession, *args) -> DataFrame:
        known = spark.sparkContext.environment
        paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            known["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return job(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
