"""Token-id files: whole texts to ids, written in ascending id order as entropy-coded segments.

``write_token_files`` sorts the documents by range partitions of ``doc_id``, encodes each text, and
gathers documents into segments of about ``SEGMENT_TOKENS`` ids (``rans.encode_segment``). A segment
is one row of a parquet table: file part, place in it, documents with their sizes, and the bytes. A
document never crosses segments, so every segment is read alone; one larger than a segment makes its
own larger one. ``read_token_files`` decodes segments in parallel and returns one row per document.

Cases: a null text is empty (only the end id); a null ``doc_id`` sorts first; repeated ids and rows
are kept, in the order of their texts; an empty table gives an empty file; other columns are ignored.
Memory per task: one Arrow batch and one segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctlens.llm import rans
from acctlens.llm.tokens import END_ID, encoder, with_end

SEGMENT_TOKENS = 1 << 21
FILE_SCHEMA = "part int, seq int, part_start bigint, n_tokens bigint, doc_ids array<bigint>, sizes array<bigint>, segment binary"
_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("segment", pa.binary()),
])


def _segments(tokenizer_path: str, segment_tokens: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq, part_start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0, 0
        held, ids_of, sizes_of, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, ids_of, sizes_of, n, seq, part_start
            ids, sizes = np.concatenate(ids_of), np.concatenate(sizes_of)
            row = [part, seq, part_start, len(ids), pa.concat_arrays(held).to_pylist(), sizes.tolist(), rans.encode_segment(ids)]
            seq, part_start = seq + 1, part_start + len(ids)
            held, ids_of, sizes_of, n = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            ids, sizes = with_end(*enc.encode(batch.column("text")), end_id)
            doc_ids, ends, at = batch.column("doc_id").cast(pa.int64()), np.cumsum(sizes), 0
            while at < len(sizes):
                before = int(ends[at - 1]) if at else 0
                # documents up to the one that fills the segment
                upto = min(len(sizes), int(np.searchsorted(ends, before + segment_tokens - n)) + 1)
                held.append(doc_ids.slice(at, upto - at))
                ids_of.append(ids[before : int(ends[upto - 1])])
                sizes_of.append(sizes[at:upto])
                n += len(ids_of[-1])
                at = upto
                if n >= segment_tokens:
                    yield flush()
        if held:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, segment_tokens: int = SEGMENT_TOKENS, end_id: int = END_ID
) -> None:
    """Encode ``docs(doc_id, text)`` and write the token table to ``path``."""
    # Equal ids are split by text, equal rows by place in the input: no key fills a partition.
    ordered = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_tie"),
    )
    keys = ["doc_id", "_h", "_tie"]
    sorted_docs = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    rows = sorted_docs.mapInArrow(_segments(tokenizer_path, segment_tokens, end_id), FILE_SCHEMA)
    rows.write.option("compression", "uncompressed").option("parquet.block.size", 8 << 20).parquet(path)


_DOC_SCHEMA = "part int, part_start bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def _decoded(keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, start, sizes = (batch.column(c)[row].as_py() for c in ("part", "part_start", "sizes"))
                ids = rans.decode_segment(batch.column("segment")[row].as_py())
                sizes = np.asarray(sizes, np.int64)
                ends = np.cumsum(sizes)
                raw = memoryview(ids.tobytes())
                pieces = [raw[4 * int(e - s) : 4 * int(e)] for s, e in zip(sizes, ends)]
                columns = [
                    pa.array(np.full(len(sizes), part, np.int32)), pa.array(start + ends - sizes), batch.column("doc_ids")[row].values,
                    pa.array(sizes), pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                ]
                names = ["part", "part_start", "doc_id", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in pieces], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, and the ids if asked for.

    Starts are a running total over the file parts (one row per written partition) plus the place in the part.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # one row per written partition: bounded by the number of partitions, whatever their size
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    schema = _DOC_SCHEMA + (", ids array<bigint>" if keep_ids else "")
    docs = files.mapInArrow(_decoded(keep_ids), schema)
    columns = ["doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])]
    return docs.join(F.broadcast(before), "part").select(*columns)
