"""Spelling variant grouping: exact neighbours at one edit by a dictionary of trie-node pairs.

The words stand in two tries, one read forwards and one backwards; each prefix and each suffix of a word is a
node with a number. Two words that differ in one replaced letter share a pair (prefix node, suffix node) around
that letter; if a word has one letter more, its pair around that letter is a pair around a gap of the other.
So the join of integer pairs finds exactly the words at one edit, and no strings are compared.

* Numbers: a node of up to ``PACKED`` letters is numbered by its letters (``LETTERS`` digits from 1), a deeper
  one by a counter, in one pass over the sorted words that holds one word's path. Words that share their first
  ``PACKED + 1`` letters are numbered by one task. The backward trie is numbered by the same pass over the
  reversed words.
* Pairs: a word of ``L`` letters gives ``L`` pairs around a letter and ``L + 1`` around a gap. A pair's entries are
  the words with one letter at one place, at most one per letter of the alphabet, and one word with none: at
  most ``len(LETTERS) + 1``, whatever the data. Each entry gets its number of neighbours and the best of
  them; pairs of words are never written out. A letter between equal ones counts at the first of them, so no two
  words meet twice.
* Roots: forms grow at least twofold in count, so chains are short; they are followed by doubling.

Words are counted over all texts with partial sums. Word numbers follow the code-point order of the words, which breaks ties.

Cases: a null text has no words; a null ``doc_id`` reads as an empty text in ``<doc_id>:<run>``; repeated rows and
ids count as they stand; texts and words of any length are taken whole; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlens.llm.store import written

MIN_CHARS = 5
MIN_COUNT = 3
MIN_RATIO = 2
SLIP = 97
LETTERS = string.ascii_lowercase + "".join(map(chr, range(0xC0, 0x100)))
PACKED = 9  # (len(LETTERS) + 1) ** PACKED stays below 2**63


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, one letter dropped where ``slip`` divides the run's crc32."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("lead"),
        F.explode(F.split(lowered, "[^a-zÀ-ÿ]+")).alias("run"),
    ).filter((F.length("run") >= min_chars))  # a shorter run cannot become a word
    h = F.crc32(F.concat("lead", "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % slip == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _numbered(backward: bool):
    """Adds the numbers of the trie nodes on each word's path, the root first; input is sorted by the word as read."""
    digit = {c: i + 1 for i, c in enumerate(LETTERS)}
    base = len(LETTERS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, given = TaskContext.get().partitionId(), 0
        last, path = "", [0]
        for batch in batches:
            flat, sizes = [], []
            for word in batch.column("word").to_pylist():
                read = word[::-1] if backward else word
                same = 0
                for a, b in zip(last, read):
                    if a != b:
                        break
                    same += 1
                del path[same + 1 :]
                for i in range(same, len(read)):
                    if i < PACKED:
                        path.append(path[-1] * base + digit[read[i]])
                    else:
                        given += 1
                        path.append(-((task << 40) + given))
                flat.append(np.array(path[::-1] if backward else path, np.int64))
                sizes.append(len(path))
                last = read
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            nodes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], names=[*batch.schema.names, "suffixes" if backward else "prefixes"])

    return run


def trie_nodes(words: DataFrame) -> DataFrame:
    """``words(id, n, word)`` with ``prefixes`` and ``suffixes``: the nodes of ``word[:i]`` and of ``word[i:]``, i from 0."""
    # Spark's order of strings is that of their code points; a batch boundary needs no care, as the path is kept.
    forward = words.repartition(F.substring("word", 1, PACKED + 1)).sortWithinPartitions("word")
    numbered = forward.mapInArrow(_numbered(False), "id bigint, n bigint, word string, prefixes array<bigint>")
    back = numbered.withColumn("read", F.reverse("word"))
    back = back.repartition(F.substring("read", 1, PACKED + 1)).sortWithinPartitions("read").drop("read")
    return back.mapInArrow(_numbered(True), "id bigint, n bigint, word string, prefixes array<bigint>, suffixes array<bigint>")


def _entries(nodes: DataFrame) -> DataFrame:
    """(p, s, id, n, skips, leads): a pair around a letter (``skips``; ``leads``: unlike the letter before it) or around a gap."""
    size = F.length("word")
    places = F.sequence(F.lit(1), size)
    leads = F.transform(places, lambda i: (i == 1) | (F.substring("word", i, F.lit(1)) != F.substring("word", i - 1, F.lit(1))))
    around = F.arrays_zip(F.slice("prefixes", F.lit(1), size).alias("p"), F.slice("suffixes", F.lit(2), size).alias("s"), leads.alias("leads"))
    letters = nodes.select("id", "n", F.explode(around).alias("e")).select("e.p", "e.s", "id", "n", F.lit(True).alias("skips"), "e.leads")
    between = F.arrays_zip(F.col("prefixes").alias("p"), F.col("suffixes").alias("s"))
    gaps = nodes.select("id", "n", F.explode(between).alias("e")).select("e.p", "e.s", "id", "n", F.lit(False).alias("skips"), F.lit(False).alias("leads"))
    return letters.unionByName(gaps)


def _meet(a: Column, b: Column) -> Column:
    """Whether two entries of a pair are words at one edit."""
    return (a["id"] != b["id"]) & ((a["skips"] & b["skips"]) | (a["leads"] & ~b["skips"]) | (b["leads"] & ~a["skips"]))


def neighbours(nodes: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are at one edit, and (n, -id) of the one of largest n, then smallest id."""
    grouped = _entries(nodes).groupBy("p", "s").agg(F.collect_list(F.struct("id", "n", "skips", "leads")).alias("all")).filter(F.size("all") > 1)

    def around(a: Column) -> Column:
        near = F.filter("all", lambda b: _meet(a, b))
        best = F.array_max(F.transform(near, lambda b: F.struct(b["n"].alias("n"), (-b["id"]).alias("rank"))))
        return F.struct(a["id"].alias("id"), F.size(near).alias("near"), best.alias("best"))

    met = grouped.select(F.explode(F.transform("all", around)).alias("e")).select("e.*").filter("near > 0")
    return met.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) from (id, to): each round every link jumps to where its target points."""
    now = written(links.select("id", F.col("to").alias("root")), "roots")
    while True:
        step = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = written(now.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return now


def group_spellings(words: DataFrame, min_ratio: int = MIN_RATIO) -> DataFrame:
    """One row per row of ``words(word, n)``: form, root, n_near and form_n.

    Words are distinct and made of ``LETTERS``. The form is the near word of largest n if that is at least
    ``min_ratio`` (2 or more) times the word's n.
    """
    counted = written(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    ordered = counted.repartitionByRange("word").sortWithinPartitions("word")
    numbered = written(ordered.select(F.monotonically_increasing_id().alias("id"), "n", "word"), "words")
    nodes = written(trie_nodes(numbered), "trie-nodes")
    near = written(neighbours(nodes), "neighbours")
    known = numbered.join(near, "id", "left").select("id", "n", "word", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "best")
    has_form = F.col("best.n") >= min_ratio * F.col("n")
    links = known.filter(has_form).select("id", (-F.col("best.rank")).alias("to"), F.col("best.n").alias("form_n"))
    name = numbered.select(F.col("id").alias("at"), F.col("word").alias("name"))
    forms = links.join(name, F.col("to") == F.col("at")).select("id", "form_n", F.col("name").alias("form"))
    roots = _roots(links).join(name, F.col("root") == F.col("at")).select("id", F.col("name").alias("root"))
    out = known.join(forms, "id", "left").join(roots, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
