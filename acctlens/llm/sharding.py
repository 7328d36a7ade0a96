"""Sharding by a permutation-filled lookup table, in SQL functions alone.

Each shard prefers the slots of a table of prime size in its own order: the rank of slot s for a shard
is (a * s + b) modulo the size, with a and b hashed from the shard's name, which is a permutation as the
size is prime. The shards take turns; each claims the free slot it ranks first, until the table is full.
So every shard holds the same number of slots give or take one, and when a shard goes, nearly all slots
of the others stay where they are.

A row's place is its key's hash modulo the size, looked up in the table, which is broadcast: it has
``TABLE_SIZE`` rows of two numbers, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime, over a hundred times the number of shards: shares differ by under one per cent.
TABLE_SIZE = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _number(text: Column) -> Column:
    """The first 32 bits of the text's md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) with one row per slot.

    ``size`` must be a prime and not smaller than the number of shards; names must differ.
    """
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size {size} is not a prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct names, at least one, and no more than there are slots")
    names = F.array(*[F.lit(s) for s in shards])
    orders = F.transform(names, lambda s: F.struct(
        (F.pmod(_number(F.concat(s, F.lit("/step"))), F.lit(size - 1)) + 1).alias("a"), F.pmod(_number(F.concat(s, F.lit("/start"))), F.lit(size)).alias("b"),
    ))
    given = spark.range(1).select(names.alias("names"), orders.alias("orders"))
    # a turn: the shard whose turn it is claims its best free slot (the least of rank * size + slot)
    turns = f"""
        aggregate(
            sequence(0, {size - 1}),
            named_struct('free', sequence(0L, {size - 1}L), 'claims', cast(array() AS array<bigint>)),
            (table, turn) -> transform(
                array(array_min(transform(table.free, s -> pmod(orders[turn % {len(shards)}].a * s + orders[turn % {len(shards)}].b, {size}L) * {size}L + s)) % {size}L),
                claimed -> named_struct('free', array_remove(table.free, claimed), 'claims', array_append(table.claims, claimed))
            )[0],
            table -> table.claims
        )"""
    claims = given.select("names", F.posexplode(F.expr(turns)).alias("turn", "slot"))
    return claims.select(F.col("slot").cast("int").alias("slot"), F.expr(f"names[turn % {len(shards)}]").alias("shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key; a null key has the slot of the empty text."""
    return F.pmod(_number(F.coalesce(key.cast("string"), F.lit(""))), F.lit(size)).cast("int")


def assign_shards(rows: DataFrame, key: str, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` as last columns; a column so named before is replaced.

    ``key`` should tell rows apart (a document id): rows of one key share a shard. Repeated rows stay,
    null keys share the slot of the empty text, an empty table gives no rows.
    """
    columns = [c for c in rows.columns if c not in ("slot", "shard") or c == key]
    table = lookup_table(rows.sparkSession, shards, size).select(F.col("slot").alias("_sh_slot"), F.col("shard").alias("_sh_name"))
    placed = rows.withColumn("_sh_key", slot_of(F.col(f"`{key}`"), size))
    joined = placed.join(F.broadcast(table), F.col("_sh_key") == F.col("_sh_slot"))  # ``size`` rows
    kept = [F.col(f"`{c}`") for c in columns if c not in ("slot", "shard")]
    return joined.select(*kept, F.col("_sh_slot").alias("slot"), F.col("_sh_name").alias("shard"))
