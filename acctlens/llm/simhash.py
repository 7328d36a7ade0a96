"""SimHash near-duplicates: fingerprints, and links at a few differing bits.

The links come from a range join on bit counts. A fingerprint's 64 bits are cut into 32 segments of
two, and each segment keeps only how many of its bits are set. The Manhattan distance of two such
count vectors never exceeds the Hamming distance of the fingerprints, so vectors more than 3 apart
need no look. Written in unary (00, 01, 11 for 0, 1, 2) a vector is a 64-bit word, and the Manhattan
distance is the number of differing bits of two words.

Grid join: of two vectors at most 3 apart, one half (16 segments) is at most 1 apart. So every
fingerprint lies in the grid cell of each of its two halves, and looks into its own cell and the cells
one step away. Two cells one step apart differ in the parity of their sum: only cells of odd sum look
out, which halves the look-ups. What meets is held to the Manhattan bound, then to the exact distance.

Equal fingerprints are one row before the join, so exact copies meet nobody twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlens.llm.components import components
from acctlens.llm.store import written

SHINGLE = 3
MAX_BITS = 3
SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text; A-Z count as a-z, words are parted by ASCII white space."""
    words = text.lower().split()  # of bytes: ASCII only, both
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[shingle - 1 :].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends)], "<u8")
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_h, fp) for every row of ``docs(doc_id, text)``; null and blank texts get fingerprint zero.

    ``row_h``, a hash of the text, tells rows of one ``doc_id`` apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            columns = [batch.column("doc_id"), batch.column("row_h"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_h", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("row_h", F.xxhash64("text"))
    return rows.select("doc_id", "row_h", "text").mapInArrow(run, "doc_id bigint, row_h bigint, fp bigint")


_LOW_OF_PAIRS = 0x5555555555555555


def unary(fp: Column) -> Column:
    """The segment counts of a fingerprint in unary: each pair of bits with its set bits moved down."""
    low = F.lit(_LOW_OF_PAIRS)
    shifted = F.shiftrightunsigned(fp, 1)
    return (fp.bitwiseOR(shifted)).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(shifted).bitwiseAND(low), 1))


def _cells(fps: DataFrame) -> DataFrame:
    """(half, cell, fp): the cell of each half."""
    with_counts = fps.select("fp", unary(F.col("fp")).alias("u"))
    return with_counts.selectExpr(
        "fp", "inline(array(struct(0 AS half, u & 4294967295L AS cell), struct(1 AS half, shiftrightunsigned(u, 32) AS cell)))"
    )


def _looks(cells: DataFrame) -> DataFrame:
    """The cells one step away (one segment count more or less), for the cells of odd sum."""
    flipped = "transform(sequence(0, 31), i -> cell ^ shiftleft(1L, i))"
    real = f"filter({flipped}, v -> (shiftrightunsigned(v, 1) & ~v & {_LOW_OF_PAIRS & 0xFFFFFFFF}L) = 0)"
    return cells.filter("bit_count(cell) % 2 = 1").selectExpr("fp", "half", f"explode({real}) AS cell")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): every pair of the distinct fingerprints ``fps(fp)`` at most ``max_bits`` (up to 3) bits apart, once.

    A fingerprint has few others so near: the result is bounded by the geometry, not by any group's size.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the two halves find up to 3 differing bits")
    cells = _cells(fps)
    base = cells.select("half", "cell", F.col("fp").alias("a"))
    probes = cells.select("half", "cell", F.col("fp").alias("b"), F.lit(False).alias("out")).unionByName(
        _looks(cells).select("half", "cell", F.col("fp").alias("b"), F.lit(True).alias("out"))
    )
    apart = unary(F.col("a")).bitwiseXOR(unary(F.col("b")))
    met = base.join(
        probes,
        (base["half"] == probes["half"]) & (base["cell"] == probes["cell"])
        & (F.col("out") | (F.col("a") < F.col("b")))
        & (F.bit_count(apart) <= max_bits)  # Manhattan distance of the counts, a lower bound
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        # the second half reports what the first did not
        & ((base["half"] == 0) | (F.bit_count(apart.bitwiseAND(F.lit(0xFFFFFFFF))) > 1)),
    )
    return met.select("a", "b")


def _first_row():
    """The row with the smallest ``doc_id``, rows without one last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_h"))


def _groups(fps: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(fp, component) of every distinct fingerprint, and (component, first) with each component's first row."""
    nodes = written(fps.groupBy("fp").agg(_first_row().alias("first")), "distinct-fingerprints", few_files=True)
    linked = components(links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "component")
    grouped = nodes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return grouped.select("fp", "component"), grouped.groupBy("component").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the row's own included. Null and
    blank texts share fingerprint zero and are linked like any other. Rows with a null ``doc_id`` take
    part and get a component, which is null if all its rows have none. Repeated rows stay; an empty
    table gives no rows; other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    grouped, firsts = _groups(fps, max_bits)
    of_fp = grouped.join(firsts, "component").select("fp", F.col("first.doc_id").alias("component_id"))
    # A fingerprint's rows may be a third of all: one row meets them, so their side of the join can be split.
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: its smallest ``doc_id`` (the first text hash among equal ids).

    All columns pass through. Of rows equal in id and text one stays, whichever.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    _, firsts = _groups(fps, max_bits)
    rows = fps.groupBy("doc_id", "row_h").agg(F.count(F.lit(1)).alias("_sh_n"))
    chosen = firsts.select(F.col("first.doc_id").alias("_sh_id"), F.col("first.row_h").alias("_sh_h"))
    keepers = written(chosen.join(rows, F.col("_sh_id").eqNullSafe(rows["doc_id"]) & (F.col("_sh_h") == rows["row_h"])).select("_sh_id", "_sh_h", "_sh_n"), "keepers", few_files=True)
    own = docs.withColumn("_sh_row", F.xxhash64("text"))
    kept = own.join(keepers, F.col("_sh_id").eqNullSafe(F.col("doc_id").cast("bigint")) & (F.col("_sh_h") == F.col("_sh_row")))
    repeated = kept.filter("_sh_n > 1").dropDuplicates(["_sh_id", "_sh_h"])  # the few ids with equal rows
    return kept.filter("_sh_n = 1").unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
