"""Whole-table replacement: a failed write leaves the old rows readable, by path and by name."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from acctlens.sources.sinks import current_version, read_current, replace_table, versions


@pytest.fixture
def base():
    return os.path.join(tempfile.mkdtemp(prefix="acctlens-replace-"), "t")


@pytest.fixture
def table(spark):
    name = f"replaced_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_failed_write_leaves_the_old_rows(spark, base, table):
    replace_table(spark.range(5), base, table)
    before = current_version(spark, base)
    # the last of several tasks fails, after others have written
    failing = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no more"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no more"):
        replace_table(failing, base, table)
    assert current_version(spark, base) == before
    assert _ids(read_current(spark, base)) == _ids(spark.table(table)) == list(range(5))
    # the next good build takes over and clears the failed version
    replace_table(spark.range(7), base, table)
    assert _ids(read_current(spark, base)) == _ids(spark.table(table)) == list(range(7))
    assert versions(spark, base, complete=False) == versions(spark, base)


def test_uncommitted_version_is_not_read(spark, base):
    replace_table(spark.range(3), base)
    spark.range(9).write.parquet(f"{base}/v-99990101T000000-torn")
    os.remove(f"{base}/v-99990101T000000-torn/_SUCCESS")
    assert _ids(read_current(spark, base)) == [0, 1, 2]


def test_readers_of_the_last_version_go_on(spark, base):
    replace_table(spark.range(3), base)
    reading = read_current(spark, base)
    replace_table(spark.range(4), base)
    assert _ids(reading) == [0, 1, 2]
    replace_table(spark.range(5), base)
    assert len(versions(spark, base)) == 2


def test_other_schema_and_partitions(spark, base, table):
    replace_table(spark.range(3), base, table)
    wide = spark.range(6).select("id", (F.col("id") % 2).alias("part"))
    replace_table(wide, base, table, partition_by=("part",), cluster_by=("id",))
    assert sorted(tuple(r) for r in spark.table(table).select("id", "part").collect()) == [(i, i % 2) for i in range(6)]
    replace_table(wide.filter("id < 2"), base, table, partition_by=("part",))
    assert _ids(spark.table(table)) == [0, 1]


def test_nothing_written_yet(spark, base):
    assert current_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, base)
