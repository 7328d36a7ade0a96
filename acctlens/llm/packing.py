"""Best-fit packing of token pieces into sequences of a fixed capacity.

What is packed depends on lengths alone, so the plan is made on the histogram of lengths (at most
``capacity`` numbers, whatever the corpus) and each piece then finds its place by its rank among the
pieces of its length:

1. ``plan``: the lengths, longest first, look up their gap in an index of single lengths, then of sums
   of pairs, then of triples. A combination that fills the gap exactly is consumed as often as all its
   lengths are available. What is left is packed best-fit, longest first.
2. Ranks: a piece is numbered within (input partition, length) while it is cut; the counts of those
   groups are summed up over partitions. No group of equal lengths meets in one task.
3. Every planned slot is an interval of ranks of its length: pieces join the slots on the length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlens.llm.store import written
from acctlens.llm.tokens import END_ID, encoder, with_end

CAPACITY = 1024
CACHE_CHUNKS = 250_000  # of a task: in a pipeline its worker holds what earlier stages keep as well
PIECE_SCHEMA = "row_id bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def _pieces(tokenizer_path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, rows = encoder(tokenizer_path, CACHE_CHUNKS), TaskContext.get().partitionId(), 0
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, sizes = with_end(*enc.encode(batch.column("text")), end_id)
            ends = np.cumsum(sizes)
            begins = ends - sizes
            n_pieces = -(-sizes // capacity)
            first = sizes - (n_pieces - 1) * capacity
            of = np.repeat(np.arange(len(sizes)), n_pieces)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            length = np.where(piece == 0, first[of], capacity)
            start = np.where(piece == 0, 0, first[of] + (piece - 1) * capacity)
            at = begins[of] + start
            raw = memoryview(ids.tobytes())
            cuts = [raw[4 * a : 4 * b] for a, b in zip(at.tolist(), (at + length).tolist())]
            # place among the pieces of this length in this partition
            order = np.argsort(length, kind="stable")
            runs = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(of), np.int64)
            nth[order] = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(seen, runs)
            seen += runs
            columns = {
                "row_id": pa.array((part << 33) + rows + of), "doc_id": batch.column("doc_id").take(pa.array(of)), "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                "part": pa.array(np.full(len(of), part, np.int32)), "nth": pa.array(nth),
            }
            if keep_ids:
                columns["ids"] = pa.array([np.frombuffer(c, "<u4").astype(np.int64) for c in cuts], pa.list_(pa.int64()))
            rows += len(sizes)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def cut_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of ``docs(doc_id, text)``; only longer documents are cut.

    ``row_id`` tells repeated documents apart; ``part`` and ``nth`` number the pieces of a length.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = PIECE_SCHEMA + (", ids array<bigint>" if keep_ids else "")
    return texts.mapInArrow(_pieces(tokenizer_path, capacity, end_id, keep_ids), schema)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many such sequences), using every counted length exactly.

    Ends after a number of steps that the capacity bounds: each step uses up a length.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        left[length] += n
    made: list[tuple[tuple[int, ...], int]] = []

    def use(combination: tuple[int, ...]) -> bool:
        lengths, times = np.unique(combination, return_counts=True)
        n = int((left[lengths] // times).min())
        if n:
            left[lengths] -= n * times
            made.append((combination, n))
        return n > 0

    def pairs(gap: int, have: np.ndarray) -> list[tuple[int, int]]:
        a = np.arange(1, gap // 2 + 1)
        return [(int(gap - x), int(x)) for x in a[have[a] & have[gap - a]]]

    def complements(gap: int):
        """Combinations of lengths still there that sum to the gap: single ones, pairs, then triples."""
        have = left > 0
        if have[gap]:
            yield (gap,)
        yield from pairs(gap, have)
        sums = np.convolve(have, have)[: capacity + 1] > 0  # index of pair sums
        sums[0] = False
        a = np.arange(1, gap // 3 + 1)
        for x in a[have[a] & sums[gap - a]].tolist():
            yield from ((*p, x) for p in pairs(gap - x, have) if p[1] >= x)

    if left[capacity]:
        use((capacity,))
    for length in range(capacity - 1, 0, -1):
        if left[length]:
            for combination in complements(capacity - length):
                use((length, *combination))  # nothing happens if a length has been used up meanwhile
                if not left[length]:
                    break

    # best fit for the rest, longest first, over groups of equal sequences
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity - 1, 0, -1):
        n = int(left[length])
        while n:
            room = min((r for r in open_at if r >= length), default=None)
            if room is None:
                fit = capacity // length
                for combination, m in (((length,) * fit, n // fit), ((length,) * (n % fit), 1)):
                    if m and combination:
                        open_at.setdefault(capacity - length * len(combination), []).append((combination, m))
                break
            combination, m = open_at[room].pop()
            if not open_at[room]:
                del open_at[room]
            if m > n:
                open_at.setdefault(room, []).append((combination, m - n))
            k = min(m, n)
            open_at.setdefault(room - length, []).append(((*combination, length), k))
            n -= k
    return made + [g for groups in open_at.values() for g in groups]


def slots(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): which ranks of a length go where."""
    rows, used, sequence = [], {}, 0
    for lengths, n in planned:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, rank + n, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    return rows


SLOT_SCHEMA = "length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, offset bigint"


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (read from a written table) with ``sequence_id`` and ``offset``, gapless from 0 in each sequence."""
    spark = pieces.sparkSession
    groups = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = groups.select(
        "part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before")
    )
    # at most ``capacity`` rows come to the driver, and the plan made of them has at most a few times as many
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slot_table = spark.createDataFrame(slots(plan(counts, capacity)), SLOT_SCHEMA).withColumnRenamed("length", "_length")
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    here = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    placed = ranked.join(F.broadcast(slot_table), here)
    return placed.withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank")).drop(
        "part", "nth", "before", "rank", "_length", "first_rank", "end_rank", "first_sequence"
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Pack ``docs(doc_id, text)``: one row per piece with its sequence and place.

    Null text: empty (the end id alone). Null or repeated ``doc_id``: packed like any other; ``row_id``
    is one number per document row. An empty table gives no rows; other columns are ignored.
    """
    pieces = written(cut_pieces(docs, tokenizer_path, capacity, end_id, keep_ids), "pieces")
    return pack_pieces(pieces, capacity)
