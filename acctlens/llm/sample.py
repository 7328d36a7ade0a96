"""A bounded sample of rows to fit a model on: those of the smallest id hash, whatever the partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_ids(ids: DataFrame, n: int, salt: int = 0) -> DataFrame:
    """At most ``n`` of the distinct ``ids(_id)``."""
    return ids.filter("_id IS NOT NULL").distinct().orderBy(F.xxhash64("_id", F.lit(salt)), "_id").limit(n)
