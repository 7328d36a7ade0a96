"""Corpus preparation: toxicity, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the rows that the
next stage works on, all but the last with the columns of ``documents``. ``run`` applies them in order,
each result written as parquet to the shared folder and read back.

Nulls, empty texts, repeated rows, empty tables and extra columns are treated as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctlens.llm.decontaminate import decontaminate
from acctlens.llm.lines import dedup_lines
from acctlens.llm.packing import pack_documents
from acctlens.llm.queries import TOKENIZER
from acctlens.llm.simhash import keep_one
from acctlens.llm.store import table, with_code, written
from acctlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``labels`` and the documents themselves."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; ``n_chars`` follows the text."""
    return dedup_lines(docs, length_column="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences."""
    packed = pack_documents(docs, TOKENIZER)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    (f.__name__, with_code(f))
    for f in (toxicity, line_dedup, near_dedup, decontamination, packing)
]

#: SQL cannot express the training of the first stage, the fingerprints or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
