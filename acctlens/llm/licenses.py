"""License scans: an exact set-similarity join of text blocks with license notices.

A template is the set of a notice's words, a block the set of words in a window of a text. A block
meets a template of ``n`` words if it holds at least ``ceil(threshold * n)`` of them. Windows come in
sizes: a template whose notice has at most ``c`` words (``c`` a power of two) is sought in windows of
``2 c`` words that begin every ``c`` words, so any stretch of ``c`` words lies whole in one of them.

1. The templates' words are counted over all texts and numbered, the rarest first: the global order.
2. One pass over the texts finds the phrases and writes each document's windows as ordered lists of
   the templates' words in them. Words of no template meet none and take no place in the order; a
   window shorter than every template of its size asks for is left out (length filter).
3. Two sets that share ``a`` words share one among the first ``n - a + 1`` of either (prefix filter).
   The prefixes of the windows are joined with those of the templates by Spark. A pair counts at its first
   common word, if enough words follow that place on both sides (positional filter), and is then counted whole.

The templates are a parameter of at most ``MAX_TEMPLATE_WORDS`` words in all, so their prefixes are
broadcast; nothing else is. A document's windows number in proportion to its length.

Cases: a null text is empty (no words, no label, score 0); null and repeated ids and repeated rows
each give a row of their own; an empty table gives no rows; other columns, whatever their names, are
ignored; without templates only the phrases count. A text of any length is scanned whole, in time in
proportion to it. Ties: labels are distinct and sorted, blocks in order of (first word, size, label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.license_texts import PHRASES, TEMPLATES
from acctlens.llm.store import written

THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 200_000
LEAST_WINDOW = 16

_SCHEMA = (
    "row bigint, doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
    "windows array<struct<size:int,first:bigint,ranks:array<int>>>"
)
_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
    ("windows", pa.list_(pa.struct([("size", pa.int32()), ("first", pa.int64()), ("ranks", pa.list_(pa.int32()))]))),
])

# UTF-8 bytes of words stay, A-Z turn into a-z, all others into spaces.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    """The lower-cased words of a text, as UTF-8."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_WORD_BYTES).split()


def _need(size: int, threshold: float) -> int:
    """The least number of a template's words that meets the threshold."""
    return max(1, math.ceil(threshold * size - 1e-9))


def _templates(templates: Sequence[tuple[str, str]], threshold: float) -> list[tuple[str, int, frozenset[bytes], int]]:
    """(label, window size, words, words needed) of every template that has words."""
    out = []
    for label, notice in templates:
        words = words_of(notice)
        if words:
            size = max(LEAST_WINDOW, 2 << (len(words) - 1).bit_length())
            out.append((label, size, frozenset(words), _need(len(set(words)), threshold)))
    if sum(len(t[2]) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates hold more than {MAX_TEMPLATE_WORDS} words")
    return out


def _global_order(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """The vocabulary numbered by its words' counts over all texts, the rarest first, then by the word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(sorted(vocabulary))}
        total = np.zeros(len(place) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                codes = np.fromiter((place.get(w, -1) for w in words_of(text.as_py())), np.int64)
                total += np.bincount(codes + 1, minlength=len(total))
        seen = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[1:][seen])], names=["place", "n"])

    counts = docs.select("text").mapInArrow(counted, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    by_place = {r.place: r.n for r in counts.toLocalIterator()}  # at most a row for each template word
    ordered = sorted((by_place.get(i, 0), w) for i, w in enumerate(sorted(vocabulary)))
    return {w: i for i, (_, w) in enumerate(ordered)}


def _scan(order: dict[bytes, int], sizes: dict[int, int], phrases: Sequence[tuple[str, str]]):
    """Per document: phrases found, and its windows of each size that hold at least ``sizes[size]`` ordered words."""
    known = dict(order)
    for phrase, _ in phrases:
        for w in words_of(phrase):
            known.setdefault(w, len(known))
    sought = [([known[w] for w in words_of(p)], label) for p, label in phrases if words_of(p)]

    def windows_of(codes: np.ndarray) -> list[dict]:
        at = np.flatnonzero((codes >= 0) & (codes < len(order)))
        out = []
        for size, least in sorted(sizes.items()):
            if len(at) < least:
                continue
            step = size // 2
            k = at // step  # a word stands in the window that begins in its step and in the one before
            both = np.concatenate([np.stack([k, codes[at]], 1), np.stack([k - 1, codes[at]], 1)[k > 0]])
            both = np.unique(both, axis=0)
            starts = np.flatnonzero(np.diff(both[:, 0], prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(both)]):
                if b - a >= least:
                    out.append({"size": size, "first": int(both[a, 0]) * step, "ranks": both[a:b, 1].tolist()})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.large_binary())
            for text in texts:
                words = words_of(text.as_py())
                codes = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
                n, places, labels = len(codes), [], set()
                for phrase, label in sought:
                    if n >= (k := len(phrase)):
                        hit = codes[: n - k + 1] == phrase[0]
                        for i in range(1, k):
                            hit &= codes[i : n - k + 1 + i] == phrase[i]
                        if hit.any():
                            places.append(np.flatnonzero(hit))
                            labels.add(label)
                found = np.concatenate(places) if places else None
                first, last = (int(found.min()), int(found.max())) if places else (None, None)
                rows.append((n, len(found) if places else 0, first, last, sorted(labels), windows_of(codes)))
            columns = [batch.column("row"), batch.column("doc_id")]
            columns += [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(_ARROW)[2:])]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return run


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: words, phrases and the blocks that meet a template.

    ``blocks`` lists (first_word, end_word, label, containment); ``labels`` joins the phrases' labels and the
    blocks'; ``score`` is 1 for a phrase, else the greatest containment of a found block, else 0.
    """
    spark = docs.sparkSession
    known = _templates(templates, threshold)
    order = _global_order(docs, {w for t in known for w in t[2]}) if known else {}
    sizes: dict[int, int] = {}
    for _, size, _, need in known:
        sizes[size] = min(need, sizes.get(size, need))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scanned = written(source.mapInArrow(_scan(order, sizes, phrases), _SCHEMA), "licenses")

    index = []  # one row per template and word of its prefix
    for label, size, words, need in known:
        ranks = sorted(order[w] for w in words)
        index += [(size, ranks[i], i, label, need, ranks) for i in range(len(ranks) - need + 1)]
    prefixes = spark.createDataFrame(index, "size int, rank int, i int, label string, need int, words array<int>")

    windows = scanned.select("row", "n_words", F.explode("windows").alias("w")).select("row", "n_words", "w.*")
    least = F.element_at(F.create_map(*[F.lit(v) for kv in sizes.items() for v in kv]), F.col("size")) if sizes else F.lit(1)
    window_prefix = F.slice("ranks", F.lit(1), F.size("ranks") - least + 1)
    tokens = windows.select("*", F.posexplode(window_prefix).alias("j", "rank"))
    pairs = tokens.join(F.broadcast(prefixes), ["size", "rank"]).filter(F.size("ranks") >= F.col("need"))
    common = F.array_intersect("ranks", "words")  # in the order of ``ranks``
    enough = F.least(F.size("words") - F.col("i"), F.size("ranks") - F.col("j")) >= F.col("need")
    met = (
        pairs.filter(enough).withColumn("common", common)
        .filter((F.element_at("common", 1) == F.col("rank")) & (F.size("common") >= F.col("need")))
    )
    end = F.least(F.col("first") + F.col("size"), F.col("n_words"))
    block = F.struct(F.col("first").alias("first_word"), end.alias("end_word"), "label", (F.size("common") / F.size("words")).alias("containment"))
    by_row = met.groupBy("row").agg(F.array_sort(F.collect_list(block)).alias("blocks"))  # as many as the text has windows

    out = scanned.drop("windows").join(by_row, "row", "left")
    blocks = F.coalesce("blocks", F.array().cast("array<struct<first_word:bigint,end_word:bigint,label:string,containment:double>>"))
    best = F.aggregate(blocks, F.lit(0.0), lambda a, b: F.greatest(a, b["containment"]))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", blocks.alias("blocks"),
        F.array_sort(F.array_union("base_labels", F.transform(blocks, lambda b: b["label"]))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"),
    )
