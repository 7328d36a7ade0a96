"""Line dedup: lines that many documents share stay in one document only.

1. Every document gives its distinct line keys as 128-bit hashes, with the places of the lines.
2. Keys are counted (a partial sum per task, so a line that a third of all documents hold is one row
   per task), and the distinct keys are dealt over shards by hash. Each shard gets a minimal perfect
   hash (``MinimalPerfectHash``: levels of bitmaps) that numbers its keys 0..n-1 without storing them,
   and flat arrays in that order: fingerprint, document count, keeper.
3. Documents probe the arrays: a shard's arrays come first in a sorted partition, then the line hashes
   that fall into it stream past in Arrow batches. A shard that meets more rows than ``PROBE_ROWS``
   (a very common line) is probed by several tasks, each with a copy of its arrays.
4. The places to drop go back to their documents, which are put together again in SQL functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.store import written

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 19
PROBE_ROWS = 1 << 20
#: A null document id counts as smaller than any other.
NO_ID = -(1 << 63)
_GAMMA = 1.6  # bits per key of a level
_U = np.uint64


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + _U((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class MinimalPerfectHash:
    """Numbers n distinct 64-bit keys 0..n-1. A key that is alone in its slot of a level takes that slot;
    the others go to the next level. A number is the rank of the taken bit. Other keys get any number or -1."""

    LEVELS = 40

    def __init__(self, sizes: list[int], bits: list[np.ndarray]):
        self.sizes, self.bits = sizes, bits  # bits: packed
        self.open = [np.unpackbits(b, count=s).astype(bool) for b, s in zip(bits, sizes)]
        taken = [int(o.sum()) for o in self.open]
        self.base = np.concatenate([[0], np.cumsum(taken)]).astype(np.int64)
        self.ranks = [np.cumsum(o) - 1 for o in self.open]

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        sizes, bits, rest = [], [], keys
        while len(rest):
            if len(sizes) == cls.LEVELS:
                raise ValueError("two equal keys")
            size = int(len(rest) * _GAMMA) + 1
            slot = (_mix(rest, len(sizes)) % _U(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone))
            rest = rest[~alone[slot]]
        return cls(sizes, bits)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        at = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            slot = (_mix(keys[at], level) % _U(size)).astype(np.int64)
            hit = self.open[level][slot]
            out[at[hit]] = self.base[level] + self.ranks[level][slot[hit]]
            at = at[~hit]
            if not len(at):
                break
        return out

    def pack(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], "<i8").tobytes()
        return head + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def unpack(cls, data: bytes) -> MinimalPerfectHash:
        levels = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", levels, 8).tolist()
        at, bits = 8 + 8 * levels, []
        for size in sizes:
            bits.append(np.frombuffer(data, np.uint8, -(-size // 8), at))
            at += -(-size // 8)
        return cls(sizes, bits)


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z as a-z (bytes methods know ASCII only)."""
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)


_LINE_SCHEMA = "h1 bigint, h2 bigint, doc_id bigint, row_h bigint, places array<int>"
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("row_h", pa.int64()), ("places", pa.list_(pa.int32()))])


def _line_hashes(min_chars: int):
    digest = xxhash.xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary())
            hashes, per_key, places, owner = [], [], [], []
            for row, text in enumerate(texts):
                found: dict[bytes, list[int]] = {}
                for i, line in enumerate((text.as_py() or b"").split(b"\n")):
                    if len(line) >= min_chars:
                        found.setdefault(line_key(line), []).append(i)
                for key, at in found.items():
                    if _long_enough(key, min_chars):
                        hashes.append(digest(key))
                        per_key.append(len(at))
                        places += at
                        owner.append(row)
            h = np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
            offsets = np.concatenate([[0], np.cumsum(per_key, dtype=np.int64)]).astype(np.int32)
            of = pa.array(np.asarray(owner, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column("doc_id").take(of), batch.column("row_h").take(of),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.asarray(places, np.int32)))],
                schema=_LINES,
            )

    return run


def _one_key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return _mix(h1.view(np.uint64), 99) ^ h2.view(np.uint64)


_INDEX_SCHEMA = "shard int, n int, hash binary, fingerprints binary, counts binary, keepers binary"


def _build_shard(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = keys["h1"].to_numpy(np.int64), keys["h2"].to_numpy(np.int64)
    both = _one_key(h1, h2)
    numbered = MinimalPerfectHash.build(both)
    order = np.argsort(numbered(both))
    return pd.DataFrame({
        "shard": [int(key[0])], "n": [len(keys)], "hash": [numbered.pack()], "fingerprints": [h2[order].tobytes()],
        "counts": [np.minimum(keys["n_docs"].to_numpy()[order], 2**32 - 1).astype("<u4").tobytes()],
        "keepers": [keys["keeper"].to_numpy(np.int64)[order].tobytes()],
    })


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash of its distinct line keys and the arrays in its order."""
    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    dealt = counts.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(_build_shard, _INDEX_SCHEMA)


_DROP_SCHEMA = "doc_id bigint, row_h bigint, places array<int>"


def _probe(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, numbered, fingerprints, counts, keepers = -1, None, None, None, None
        for batch in batches:
            shards = np.asarray(batch.column("shard"))
            is_index = np.asarray(batch.column("n").is_valid())
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(shards) != 0) | is_index[1:] | is_index[:-1]])).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(shards)]):
                if is_index[a]:
                    row = {c: batch.column(c)[a].as_py() for c in ("hash", "fingerprints", "counts", "keepers")}
                    shard, numbered = int(shards[a]), MinimalPerfectHash.unpack(row["hash"])
                    fingerprints = np.frombuffer(row["fingerprints"], np.int64)
                    counts, keepers = np.frombuffer(row["counts"], "<u4"), np.frombuffer(row["keepers"], np.int64)
                    continue
                if shards[a] != shard:
                    raise ValueError(f"lines of shard {shards[a]} came without its arrays")
                h1, h2, docs = (np.asarray(batch.column(c).slice(a, b - a)) for c in ("h1", "h2", "doc_id"))
                at = numbered(_one_key(h1, h2))
                gone = np.flatnonzero((fingerprints[at] == h2) & (counts[at] >= min_docs) & (keepers[at] != docs) & (at >= 0))
                if len(gone):
                    rows = pa.array(gone + a)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(rows) for c in ("doc_id", "row_h", "places")], names=["doc_id", "row_h", "places"]
                    )

    return run


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(doc_id, row_h, places): the line numbers each of ``docs(doc_id, text, row_h)`` loses, if any."""
    hashed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", "row_h")
    lines = written(hashed.mapInArrow(_line_hashes(min_chars), _LINE_SCHEMA), "line-hashes")
    shards = max(1, -(-lines.count() // shard_keys))
    index = written(build_index(lines, shards), "line-index", "uncompressed")
    # a written row's number: rows equal in id and text spread over a shard's tasks as all others do
    probes = lines.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).withColumn("number", F.monotonically_increasing_id())
    # tasks per shard by the rows that meet it; one row per shard
    tasks = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(PROBE_ROWS)).cast("int").alias("tasks"))
    salted = probes.join(tasks, "shard").withColumn("salt", F.pmod("number", "tasks").cast("int")).drop("tasks", "number")
    copies = index.join(tasks, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).drop("tasks")
    together = copies.unionByName(salted, allowMissingColumns=True)
    sorted_rows = together.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("n").isNull())
    found = sorted_rows.mapInArrow(_probe(min_docs), _DROP_SCHEMA)
    # a key's places are one set member however many rows repeat it, so a group is no larger than its text
    return found.groupBy("doc_id", "row_h").agg(F.flatten(F.collect_set("places")).alias("places"))


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, counts: bool = False, length_column: str | None = None
) -> DataFrame:
    """``docs`` with ``text`` without its dropped lines; with ``counts``, ``n_lines`` and ``n_dropped`` come last.

    ``length_column`` names a column with the text's length, which is set anew where lines went.

    Keys of at least ``min_chars`` code points held by at least ``min_docs`` rows lose all their lines
    except in the rows of the largest ``doc_id`` holding it. A null text is one empty line and becomes
    the empty text; a text that loses all its lines becomes empty too. A null ``doc_id`` is smaller than
    any other. Repeated rows count each and are treated alike. Other columns pass through.
    """
    columns = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.withColumn("text", text).withColumn("_ld_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)))
    own = own.withColumn("_ld_row", F.xxhash64("text"))
    narrow = own.select(F.col("_ld_id").alias("doc_id"), "text", F.col("_ld_row").alias("row_h"))
    drops = dropped_lines(narrow, min_chars, min_docs)
    drops = drops.select(F.col("doc_id").alias("_ld_id"), F.col("row_h").alias("_ld_row"), F.col("places").alias("_ld_places"))
    joined = own.join(drops, ["_ld_id", "_ld_row"], "left")
    all_lines = F.split("text", "\n")
    kept = F.filter(all_lines, lambda line, i: ~F.array_contains(F.col("_ld_places"), i))
    after = F.when(F.col("_ld_places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    new = {"text": after.alias("text")}
    if length_column in columns:
        length = F.when(F.col("_ld_places").isNull(), F.col(f"`{length_column}`")).otherwise(F.length(after))
        new[length_column] = length.cast(docs.schema[length_column].dataType).alias(length_column)
    out = [new.get(c, F.col(f"`{c}`")) for c in columns]
    if counts:
        out += [F.size(all_lines).cast("bigint").alias("n_lines"), F.coalesce(F.size("_ld_places"), F.lit(0)).cast("bigint").alias("n_dropped")]
    return joined.select(*out)
