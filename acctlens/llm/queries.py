"""The queries ``opN_<name>``: each applies its operator with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlens.llm import oracle
from acctlens.llm.chat import format_chat, read_chat
from acctlens.llm.decontaminate import contaminations
from acctlens.llm.lines import dedup_lines
from acctlens.llm.licenses import scan_licenses
from acctlens.llm.packing import pack_documents
from acctlens.llm.pii import pii
from acctlens.llm.repair import repair_conversations, summaries
from acctlens.llm.sharding import assign_shards
from acctlens.llm.simhash import near_duplicates
from acctlens.llm.spelling import count_words, group_spellings
from acctlens.llm.store import shared_path, table, with_code
from acctlens.llm.token_files import read_token_files, write_token_files
from acctlens.llm.topk import top_k
from acctlens.llm.toxicity import toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    return assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


#: A conversation that says the template's control strings.
_TRICKY = "\\### Assistant: </turn> ok"


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one full of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, 0, "user", _TRICKY), (-7, 1, "assistant", _TRICKY)]
    turns = turns.unionByName(spark.createDataFrame(tricky, "conv_id bigint, turn bigint, role string, text string"))
    back = read_chat(format_chat(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids through the token files: written, read back, and summed up per document."""
    path = shared_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return read_token_files(spark, path)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's sequence and place."""
    packed = pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines before and after, and the digest of what stays."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best products of every vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans. The counts are those of base spans."""
    found = pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's longest verified overlap with each test item."""
    found = contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "first_word", "end_word", "equal_words")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases, and the labels of the notices that its blocks hold."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word"]
    return found.select(*columns, F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (nulls: one space) with a twentieth of them each dropped, emptied, unpunctuated, repeated or set to user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(key) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    copies = F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    changed = F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return turns.filter(hit != 0).select(
        "conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"), changed.alias("text"), copies.alias("copy")
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: its faults, the cheapest edits and the digest of what they give."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = summaries(repair_conversations(damaged(turns)))
    given = turns.select(F.col("conv_id").cast("bigint").alias("given")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return given.join(done, F.col("given").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("given").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more frequent form, the last form of the chain and its near words."""
    return group_spellings(count_words(table(spark, sf_dir, "documents")))


_OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_token_files": op3_token_files,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_pii": op8_pii,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_license_scans": op11_license_scans,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}
QUERIES = {name: with_code(query) for name, query in _OPERATORS.items()}
ORACLE: dict[str, str] = {
    "op1_sharding": oracle.OP1,
    "op2_chat_formatting": oracle.OP2,
    "op6_line_dedup": oracle.OP6,
    "op7_exact_top_k": oracle.OP7,
    "op11_license_scans": oracle.OP11,
}
