"""Ranking operators.

A window with an ORDER BY but no PARTITION BY (``ntile(4) over (order by x)``,
``row_number() over (order by score)``) makes Spark move every row into one
task. The functions here give the same numbers by counting, as one lazy plan:
building it starts no job, and nothing is checkpointed or cached.

* A bounded sample of the order keys (those of the smallest hash) cuts the key
  space into bins. The keys end in a unique tie-break, so a value held by a
  third of the rows is cut like any other. The sample decides only how even
  the bins are, never a result.
* Exact row counts per bin, summed up, give the rows before each bin: a
  histogram of at most ``bins + 1`` rows, whatever the data.
* ``global_ntile`` needs the order of rows only where a bucket ends: the rows
  of the few bins that hold a bucket's last row are numbered, the ``buckets - 1``
  keys found there are the bounds, and every row is compared with
  those. No row but those of the cut bins is shuffled or sorted.
* ``global_row_number`` deals the rows over the bins once, numbers each bin by
  itself and adds the rows before it. The counts read the same exchange.

An order key is a column name, followed by `` desc`` for descending order. Nulls sort
as Spark sorts them: first ascending, last descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sample keys that cut the key space.
BINS = 255
_BIN = "_rank_bin"


class _Order:
    """The order keys of a ranking. Comparisons are SQL text: one call to the JVM for each, however many keys."""

    def __init__(self, keys: Sequence[str]):
        parts = [k.split() for k in keys]
        self.names = [p[0] for p in parts]
        self.ascending = [p[1:] != ["desc"] for p in parts]

    def sorted_by(self) -> list[Column]:
        return [F.col(n).asc() if up else F.col(n).desc() for n, up in zip(self.names, self.ascending)]

    def _before(self, a: Sequence[str], b: Sequence[str]) -> str:
        """Whether the key of fields ``a`` comes before that of fields ``b``."""
        out = "false"
        for x, y, up in reversed(list(zip(a, b, self.ascending))):
            first = f"coalesce({x} < {y}, {x} IS NULL AND {y} IS NOT NULL)" if up else f"coalesce({x} > {y}, {x} IS NOT NULL AND {y} IS NULL)"
            out = f"({first} OR ({x} <=> {y} AND {out}))"
        return out

    def _fields(self, of: str) -> list[str]:
        return [f"{of}.k{i}" for i in range(len(self.names))]

    def _columns(self) -> list[str]:
        return [f"`{n}`" for n in self.names]

    def array(self) -> Column:
        """All keys of a group as an array in this order."""
        key = ", ".join(f"{c} AS k{i}" for i, c in enumerate(self._columns()))
        less, more = self._before(self._fields("_a"), self._fields("_b")), self._before(self._fields("_b"), self._fields("_a"))
        return F.expr(f"array_sort(collect_list(struct({key})), (_a, _b) -> CASE WHEN {less} THEN -1 WHEN {more} THEN 1 ELSE 0 END)")

    def places(self, df: DataFrame, keys: DataFrame, most: int, output: str) -> DataFrame:
        """``df`` with the number of the ``keys`` that come before the row's, by binary search.

        ``keys`` is one row with an array of at most ``most`` keys in order, read as a scalar subquery. A row
        holds the array for the search only, before anything is shuffled.
        """
        steps = ", ".join(str(1 << b) for b in reversed(range(most.bit_length())))
        passed = f"_cut IS NOT NULL AND {self._before(self._fields('_cut'), self._columns())}"  # null past the end
        probe = f"exists(array(get(_rank_cuts, _at + _step - 1)), _cut -> {passed})"
        searched = f"coalesce(aggregate(array({steps}), 0, (_at, _step) -> CASE WHEN {probe} THEN _at + _step ELSE _at END), 0)"
        return df.withColumn("_rank_cuts", keys.scalar()).select(*df.columns, F.expr(searched).alias(output))


def _cuts(df: DataFrame, order: _Order, bins: int) -> DataFrame:
    """One row: at most ``bins`` sample keys in order. Each task keeps that many."""
    keys = df.select(*order.names)
    sample = keys.orderBy(F.xxhash64(*order.names), *order.names).limit(bins)
    return sample.agg(order.array().alias("cuts"))


def _running(counts: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """``counts(..., _n)`` with the rows before each line and all rows. ``counts`` is a histogram of bounded size."""
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_total": F.sum("_n").over(whole)})


def global_row_number(
    df: DataFrame,
    order: Sequence[str],
    output: str = "row_number",
    bins: int = BINS,
    steps: Sequence[str] = (),
    sample: DataFrame | None = None,
) -> DataFrame:
    """``row_number() over (order by <order>)`` without a single-task window.

    ``order`` must end in a unique key (the tie-break) for a deterministic result.
    ``steps`` names leading order keys of few distinct values (a score from 0 to 100), which are bins
    as they stand; the rest of the order is then cut by keys of ``sample``, a frame
    that holds them, so that ``df`` is evaluated once only.
    """
    rest = _Order(order[len(steps) :])
    whole = _Order(order)
    leading = whole.names[: len(steps)]
    binned = rest.places(df, _cuts(df if sample is None else sample, rest, bins), bins, _BIN)
    dealt = binned.repartition(*leading, _BIN)
    # The counts read every column, as the rows do: both then share one exchange, and ``df`` runs once.
    seen = F.max(F.xxhash64(*dealt.columns)).alias("_seen")
    counts = dealt.groupBy(*leading, _BIN).agg(F.count(F.lit(1)).alias("_n"), seen).filter(F.col("_seen").isNotNull())
    line = [c for c, _ in zip(whole.sorted_by(), leading)] + [F.col(_BIN)]
    offsets = _running(counts, line).select(*[F.col(c).alias(f"_step{i}") for i, c in enumerate(leading)], F.col(_BIN).alias("_bin"), "_before")
    in_bin = F.row_number().over(Window.partitionBy(*leading, _BIN).orderBy(*rest.sorted_by()))
    same = F.col(_BIN) == F.col("_bin")
    for i, c in enumerate(leading):
        same = same & F.col(c).eqNullSafe(F.col(f"_step{i}"))
    # at most a row for each bin and value of ``steps``
    numbered = dealt.withColumn("_in_bin", in_bin).join(F.broadcast(offsets), same)
    return numbered.select(*df.columns, (F.col("_before") + F.col("_in_bin")).cast("bigint").alias(output))


def _bounds(df: DataFrame, order: _Order, buckets: int, bins: int) -> DataFrame:
    """One row: the keys of the last rows of all buckets but the last, in order."""
    keys = order.places(df.select(*order.names), _cuts(df, order, bins), bins, _BIN)
    counts = _running(keys.groupBy(_BIN).agg(F.count(F.lit(1)).alias("_n")), [_BIN])
    # Buckets hold total // buckets rows each, and the first total % buckets of them one more.
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(buckets - 1)),
        lambda j: j * F.expr(f"_total div {buckets}") + F.least(j.cast("bigint"), F.col("_total") % buckets),
    )
    cut = counts.withColumn("_ends", F.filter(ends, lambda e: (e > F.col("_before")) & (e <= F.col("_before") + F.col("_n"))))
    cut = cut.filter(F.size("_ends") > 0).select(_BIN, "_before", "_ends")  # fewer rows than buckets
    number = F.col("_before") + F.row_number().over(Window.partitionBy(_BIN).orderBy(*order.sorted_by()))
    cut_rows = keys.join(F.broadcast(cut), _BIN).withColumn("_number", number)
    return cut_rows.filter(F.array_contains("_ends", F.col("_number"))).agg(order.array().alias("bounds"))


def global_ntile(df: DataFrame, order: Sequence[str], buckets: int, output: str = "ntile", bins: int = BINS) -> DataFrame:
    """``ntile(buckets) over (order by <order>)`` without a single-task window.

    ``order`` must end in a unique key. Rows stay where they are: each is compared with the buckets' bounds.
    """
    if buckets < 2:
        return df.withColumn(output, F.lit(1).cast("bigint"))
    ranked = _Order(order)
    placed = ranked.places(df, _bounds(df, ranked, buckets, bins), buckets - 1, output)
    return placed.withColumn(output, (F.col(output) + 1).cast("bigint"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str, values: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_col`` per key (``row_number() ... = 1``).

    A hash aggregation with map-side partial ``max_by``: each task forwards at
    most one row per key, so a key holding a third of all rows costs no more
    than any other.
    """
    picked = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(order_col)).alias("_latest")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values])
