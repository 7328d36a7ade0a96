"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask looks at some and ignores the others, so a
substituted word that falls on ignored places leaves the seed's hash as it is. The seeds of the test
items and of the documents are joined by hash. At every alignment that a shared seed gives, document and
item are laid side by side, and the overlap is the longest run of places, from an equal word to an equal
word, that keeps ``MIN_SHARE`` of its words equal.

No such run of ``SPAN`` words or more is missed: every way to replace 2 of 12, 3 of 15 or 4 of 20 words
leaves a window of ``MASKS`` as it is. A run of 12 to 23 words holds one of these cases, and a longer one
falls into pieces of 12 to 23 words, of which one has its share of equal words.

An overlap counts if it spans ``MIN_WORDS`` words, or the whole item if that is shorter. Items under
``SPAN`` words are looked for whole, by masks of their own length that pass every substitution the share
allows between their first and last word. Items under ``SHORTEST`` words are no evidence by themselves;
``shortest=1`` looks for them too, as exactly as for the others.

Items, seeds, hits and alignments are tables that Spark writes, shuffles and joins; neither side passes
through the driver. The documents are read once. A bit filter of the items' seeds, ``FILTER_BITS`` bits at
most whatever the items, goes to the tasks, so that few seeds without a partner are shuffled; one that
passes by chance finds nothing in the join. Keys that hold more than a ``HOT_SHARE`` of the rows of a
join are salted. One document's alignments are one row of a task, like its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.store import written

#: Fixed masks: 1 looks at the word, 0 ignores it. Lossless at MIN_SHARE for SPAN words or more.
MASKS = ("1101010011", "1000101111", "1111000101", "1101011001", "1111100001", "1010011101")
SPAN = 12
MIN_WORDS = 12
MIN_SHARE = 0.8
SHORTEST = 6
FILTER_BITS = 1 << 27
_FILTER_STEPS = (0, 18, 37)
_PART_BITS = 1 << 15  # of one bitmap of Spark's bitmap_construct_agg
#: A key with more than this share of a join's rows is salted, so at most its inverse of keys are.
HOT_SHARE = 1 / 1024
_CHUNK_WORDS = 200_000
_U = np.uint64
_MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) & (2**64 - 1) | 1 for i in range(4096)], np.uint64)


class _Words(dict):
    """word -> 64-bit hash of the word without punctuation at its ends, filled as words are met; starts again when it is full."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word.strip(_EDGES))
        return found


_EDGES = b"\"'`.,;:!?()[]{}<>*_"
_WORDS = _Words()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words: split at ASCII white space, A-Z as a-z, without punctuation at their ends."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def whole_masks(n: int, min_share: float) -> list[str]:
    """Masks of ``n`` words, of which one ignores all unequal words, first and last equal, that the share allows."""
    unequal = max(0, min(int(n * (1 - min_share) + 1e-9), n - 2))
    groups = np.array_split(np.arange(1, n - 1), max(1, min(unequal + 2, n - 2)))
    masks = []
    for ignored in combinations(groups, unequal):
        places = set(np.concatenate([[], *ignored]).tolist())
        masks.append("".join("0" if i in places else "1" for i in range(n)))
    return masks


def _seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window of ``h`` under the mask."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, _U(len(mask)))
    mixed = h ^ (h >> _U(29))
    for i, bit in enumerate(mask):
        if bit == "1":
            out += mixed[i : i + n] * _MULTIPLIERS[i]
    return out ^ (out >> _U(32))


def _longest(equal: np.ndarray, min_share: float) -> tuple[int, int]:
    """The longest [x, y), the first of these, from an equal word to an equal word, with ``min_share`` equal."""
    score = np.concatenate([[0.0], np.cumsum(equal - min_share)])  # a stretch fits if score[y] >= score[x]
    xs = np.flatnonzero(equal)
    if not len(xs):
        return 0, 0
    # best end for a start: the last y with score[y] >= score[x], by the running maximum from the right
    right_max = np.maximum.accumulate(score[::-1])[::-1]
    ends = np.searchsorted(-right_max, -(score[xs] - 1e-9), side="right") - 1
    ends = xs[np.searchsorted(xs, ends) - 1] + 1  # the last equal word before it
    k = int(np.argmax(ends - xs))
    return int(xs[k]), int(ends[k])


def _batches(rows: Iterator[pa.RecordBatch], schema: pa.Schema, make) -> Iterator[pa.RecordBatch]:
    """The rows that ``make`` gives for each input row, in batches."""
    for batch in rows:
        made = [r for row in zip(*batch.columns) for r in make(*row)]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)


def _item_tables(benchmark: DataFrame, masks: tuple[str, ...], shortest: int, min_share: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(item_id, item_key) of every item row, (item_key, words) of every different word sequence, and its seeds."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({"item_id": pa.int64(), "words": pa.binary()})
        yield from _batches(rows, schema, lambda i, t: [(i.as_py(), word_hashes(t.as_py()).tobytes())])

    def seeds_of(key: pa.Scalar, words: pa.Scalar) -> Iterator[tuple[int, int, int, int]]:
        h = np.frombuffer(words.as_py(), np.uint64)
        for mask in masks if len(h) >= SPAN else whole_masks(len(h), min_share):
            for place, seed in enumerate(_seeds(h, mask).view(np.int64).tolist()):
                yield seed, key.as_py(), place, len(h)

    def seeded(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({"seed": pa.int64(), "item_key": pa.int64(), "item_place": pa.int64(), "n_words": pa.int64()})
        yield from _batches(rows, schema, seeds_of)

    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.mapInArrow(hashed, "item_id bigint, words binary").filter(F.length("words") >= 8 * max(shortest, 1))
    items = written(items, "decon-items")
    texts = items.select("words").distinct().select(F.monotonically_increasing_id().alias("item_key"), "words")
    texts = written(texts, "decon-texts")
    seeds = written(texts.mapInArrow(seeded, "seed bigint, item_key bigint, item_place bigint, n_words bigint"), "decon-seeds")
    return items.join(texts, "words").select("item_id", "item_key"), texts, seeds


def _bit_filter(seeds: DataFrame, filter_bits: int) -> np.ndarray:
    """Bits set by Spark for the items' seeds, 32 a seed and ``filter_bits`` at most: that many come to the driver at most."""
    bits = min(max(filter_bits, _PART_BITS), max(_PART_BITS, 1 << (32 * seeds.count()).bit_length()))
    places = [F.shiftrightunsigned("seed", n).bitwiseAND(F.lit(bits - 1)) + 1 for n in _FILTER_STEPS]  # buckets count from 1
    places = seeds.select(F.explode(F.array(*places)).alias("place"))
    parts = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for part in parts.toLocalIterator():
        first = (part["bucket"] - 1) * _PART_BITS // 8
        out[first : first + _PART_BITS // 8] = np.frombuffer(bytes(part["bits"]), np.uint8)
    return out


def _flat_hits(words: list[np.ndarray], masks: list[str], bit_filter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, seed) of the seeds that pass the filter, by document; the words of many documents in one array."""
    flat = np.concatenate(words)
    ends = np.cumsum([len(w) for w in words])
    found = []
    for mask in masks:
        seeds = _seeds(flat, mask)
        at = np.arange(len(seeds))
        for n in _FILTER_STEPS:
            p = (seeds[at] >> _U(n)) & _U(8 * len(bit_filter) - 1)
            at = at[(bit_filter[(p >> _U(3)).astype(np.int64)] >> (p & _U(7)).astype(np.uint8)) & 1 > 0]
        doc = np.searchsorted(ends, at, side="right")
        inside = at + len(mask) <= ends[doc]  # a window over two documents is none
        found.append(np.stack([doc[inside], at[inside], seeds[at[inside]].view(np.int64)]))
    doc, at, seed = np.concatenate(found, axis=1)
    order = np.argsort(doc, kind="stable")
    return doc[order], (at - np.concatenate([[0], ends])[doc])[order], seed[order]


_FLAGGED = pa.schema({
    "doc_id": pa.int64(), "row_h": pa.int64(), "words": pa.binary(),
    "hits": pa.list_(pa.struct({"place": pa.int64(), "seed": pa.int64()})),
})


def _flagged(docs: DataFrame, seeds: DataFrame, masks: tuple[str, ...], min_share: float, filter_bits: int) -> DataFrame:
    """The document rows with a seed that passes the filter, their words and these seeds; each has its own ``doc_key``."""
    lengths = [r["n_words"] for r in seeds.filter(F.col("n_words") < SPAN).select("n_words").distinct().collect()]  # SPAN at most
    used = [*masks, *(m for n in sorted(lengths) for m in whole_masks(n, min_share))]
    shared = docs.sparkSession.sparkContext.broadcast(_bit_filter(seeds, filter_bits))

    def flag(ids: list, row_hs: list, words: list[np.ndarray]) -> pa.RecordBatch:
        doc, place, seed = _flat_hits(words, used, shared.value)
        n = np.bincount(doc, minlength=len(words))
        kept = np.flatnonzero(n).tolist()
        hits = pa.StructArray.from_arrays([pa.array(place), pa.array(seed)], names=["place", "seed"])
        hits = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n[kept])]).astype(np.int32), hits)
        columns = [pa.array([ids[i] for i in kept], pa.int64()), pa.array([row_hs[i] for i in kept], pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([words[i].tobytes() for i in kept], pa.binary()), hits], schema=_FLAGGED)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, row_hs = batch.column("doc_id").to_pylist(), batch.column("row_h").to_pylist()
            first, n, words = 0, 0, []
            for i, text in enumerate(batch.column("text"), 1):
                words.append(word_hashes(text.as_py()))
                n += len(words[-1])
                if n >= _CHUNK_WORDS or i == batch.num_rows:
                    yield flag(ids[first:i], row_hs[first:i], words)
                    first, n, words = i, 0, []

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row_h"), "text")
    found = texts.mapInArrow(run, "doc_id bigint, row_h bigint, words binary, hits array<struct<place: bigint, seed: bigint>>")
    return written(found.withColumn("doc_key", F.monotonically_increasing_id()), "decon-flagged")


def _salted_join(many: DataFrame, few: DataFrame, key: str, spread: str, hot_share: float) -> DataFrame:
    """``many`` joined with ``few`` by ``key``; a key with over ``hot_share`` of the rows of ``many`` is dealt by ``spread``."""
    total = many.count()
    least = max(1, int(total * hot_share))
    hot = many.groupBy(key).count().filter(F.col("count") > least)
    hot = F.broadcast(hot.select(key, F.ceil(F.col("count") / least).alias("salts")))  # 1 / hot_share keys at most
    salts = F.coalesce("salts", F.lit(1))
    dealt = many.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64(spread), salts)).drop("salts")
    copied = few.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("salts")
    return dealt.join(copied, [key, "salt"]).drop("salt")


_ALIGNED = "doc_key bigint, doc_id bigint, row_h bigint, item_key bigint, shift bigint, words binary"


def _alignments(flagged: DataFrame, seeds: DataFrame, hot_share: float) -> DataFrame:
    """For every alignment that a shared seed gives: the document's words beside the item."""

    def cut(key, doc_id, row_h, words, aligned) -> Iterator[tuple]:
        own = memoryview(words.as_py())
        for at in aligned.as_py():
            lo, hi = max(0, at["shift"]), at["shift"] + at["n_words"]
            yield key.as_py(), doc_id.as_py(), row_h.as_py(), at["item_key"], at["shift"], bytes(own[8 * lo : 8 * hi])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ALIGNED.split(", ")]
        schema = pa.schema({n: pa.binary() if n == "words" else pa.int64() for n in names})
        for row in rows:  # a document at a time: its cuts are one batch
            for i in range(row.num_rows):
                yield from _batches(iter([row.slice(i, 1)]), schema, cut)

    hits = written(flagged.select("doc_key", F.explode("hits").alias("hit")).select("doc_key", "hit.place", "hit.seed"), "decon-hits")
    met = _salted_join(hits, seeds, "seed", "doc_key", hot_share)
    met = met.select("doc_key", F.struct("item_key", "n_words", (F.col("place") - F.col("item_place")).alias("shift")).alias("at")).distinct()
    aligned = met.groupBy("doc_key").agg(F.collect_list("at").alias("aligned"))
    both = flagged.join(aligned, "doc_key").select("doc_key", "doc_id", "row_h", "words", "aligned")
    return written(both.mapInArrow(run, _ALIGNED), "decon-aligned")


_VERIFIED = "doc_key bigint, doc_id bigint, row_h bigint, item_key bigint, shift bigint, first_word bigint, end_word bigint, equal_words bigint"


def _verified(aligned: DataFrame, texts: DataFrame, min_words: int, min_share: float, hot_share: float) -> DataFrame:
    """The longest overlap of each document row with each different item text; of equally long ones the first."""

    def verify(key, doc_id, row_h, item_key, shift, words, item) -> Iterator[tuple]:
        shift, item = shift.as_py(), np.frombuffer(item.as_py(), np.uint64)
        here = np.frombuffer(words.as_py(), np.uint64)
        lo = max(0, shift)
        equal = here == item[lo - shift : lo - shift + len(here)]
        x, y = _longest(equal, min_share)
        if y - x >= max(1, min(min_words, len(item))):
            yield key.as_py(), doc_id.as_py(), row_h.as_py(), item_key.as_py(), shift, lo + x, lo + y, int(equal[x:y].sum())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({c.split()[0]: pa.int64() for c in _VERIFIED.split(", ")})
        yield from _batches(rows, schema, verify)

    beside = _salted_join(aligned, texts.withColumnRenamed("words", "item"), "item_key", "doc_key", hot_share)
    order = ["doc_key", "doc_id", "row_h", "item_key", "shift", "words", "item"]
    found = beside.select(order).mapInArrow(run, _VERIFIED)
    best = F.struct((F.col("end_word") - F.col("first_word")).alias("n"), (-F.col("shift")).alias("s"), "first_word", "end_word", "equal_words")
    found = found.groupBy("doc_key", "doc_id", "row_h", "item_key").agg(F.max(best).alias("best"))
    return written(found.select("doc_key", "doc_id", "row_h", "item_key", "best.first_word", "best.end_word", "best.equal_words"), "decon-found")


def contaminations(
    docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE, shortest: int = SHORTEST, filter_bits: int = FILTER_BITS, hot_share: float = HOT_SHARE,
) -> DataFrame:
    """The verified overlaps of ``docs(doc_id, text)`` with ``benchmark(item_id, text)``.

    One row per document row and item: the words [first_word, end_word) of the document's longest overlap
    with the item, and how many of them are equal. ``row_h`` is the hash of the document's text. Null
    texts have no words and overlap nothing; null ids are kept as they are; repeated documents and items
    are reported each; with an empty table on either side there are no rows; other columns are ignored.
    Texts of any length are read whole. ``filter_bits`` is a power of two; whatever it is, the rows are the same.
    """
    found, members = _found(docs, benchmark, masks, min_words, min_share, shortest, filter_bits, hot_share)
    columns = ["doc_id", "row_h", "item_id", "first_word", "end_word", "equal_words"]
    return _salted_join(found, members, "item_key", "doc_key", hot_share).select(columns)


def _found(
    docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE, shortest: int = SHORTEST, filter_bits: int = FILTER_BITS, hot_share: float = HOT_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """The overlaps with different item texts, and the items that have them."""
    if any(len(m) > SPAN for m in masks):
        raise ValueError(f"masks of at most {SPAN} words are needed")
    members, texts, seeds = _item_tables(benchmark, masks, shortest, min_share)
    flagged = _flagged(docs, seeds, masks, min_share, filter_bits)
    aligned = _alignments(flagged, seeds, hot_share)
    return _verified(aligned, texts, min_words, min_share, hot_share), members


def decontaminate(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the rows that overlap a test item; all columns, whatever their names, and repeated clean rows stay."""
    found, _ = _found(docs, benchmark, **parameters)
    bad = found.select("doc_id", "row_h").distinct()
    same = bad["doc_id"].eqNullSafe(docs["doc_id"].cast("bigint")) & (bad["row_h"] == F.xxhash64(docs["text"]))
    return docs.join(bad, same, "left_anti")
