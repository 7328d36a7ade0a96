"""Fingerprints, links, components and line dedup against brute force."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from acctlens.llm import lines, simhash
from acctlens.llm.components import components
from acctlens.llm.store import WAVES, shared_path


def _slow_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = ["", None, " \t\n", "One", "one two", "One TWO three", "É é word x y z", "a b c d " * 50, "q\x0bw\x0ce r\x1ct"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == _slow_fingerprint(text)


def test_hash_is_that_of_the_sql_function(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] == np.uint64(xxhash.xxh64_intdigest(b"a b c", 42)).astype(np.int64)


def test_links_find_every_pair(spark):
    r = random.Random(3)
    fps = {0, 2**64 - 1}
    for _ in range(60):
        x = r.getrandbits(64)
        fps.add(x)
        for _ in range(6):
            y = x
            for b in r.sample(range(64), r.randint(1, 4)):
                y ^= 1 << b
            fps.add(y)
    signed = {int(np.uint64(x).astype(np.int64)): x for x in fps}
    frame = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    for bits in (0, 1, 3):
        found = collections.Counter((min(a, b), max(a, b)) for a, b in simhash.links(frame, bits).collect())
        items = sorted(signed)
        true = {(a, b) for i, a in enumerate(items) for b in items[i + 1 :] if (signed[a] ^ signed[b]).bit_count() <= bits}
        assert set(found) == true and set(found.values()) <= {1}


def test_unary_distance_is_a_lower_bound(spark):
    r = np.random.default_rng(0)
    a, b = (r.integers(-(2**63), 2**63, 500) for _ in range(2))
    frame = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a bigint, b bigint")
    rows = frame.select("a", "b", F.bit_count(simhash.unary(F.col("a")).bitwiseXOR(simhash.unary(F.col("b"))))).collect()
    for x, y, got in rows:
        x, y = int(x) % 2**64, int(y) % 2**64
        counts = [(x >> s & 3).bit_count() - (y >> s & 3).bit_count() for s in range(0, 64, 2)]
        assert got == sum(map(abs, counts)) <= (x ^ y).bit_count()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(-60, 60), r.randint(-60, 60)) for _ in range(70)] + [(i, i + 1) for i in range(100, 140)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {n: c for n, c in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_components_write_few_files(spark):
    """Many shuffle partitions do not make as many files in every round."""
    folder = os.path.dirname(shared_path(spark, "x")).removeprefix("file:")
    known = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    before = set(os.listdir(folder))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "120")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = spark.range(600).selectExpr("id * 2 AS a", "id * 2 + 1 AS b")
        assert components(edges).filter("component = node - node % 2").count() == 1200
    finally:
        for k, v in known.items():
            spark.conf.set(k, v)
    made = [os.listdir(f"{folder}/{d}") for d in set(os.listdir(folder)) - before if d.startswith("edges-")]
    assert len(made) >= 2
    assert all(sum(f.endswith(".parquet") for f in files) <= WAVES * spark.sparkContext.defaultParallelism for files in made)


BASE = " ".join(f"w{i}" for i in range(400))


def _near_rows():
    near = BASE.replace("w200 ", "other ")
    return [(10, BASE), (4, BASE), (7, near), (None, BASE), (30, "something else entirely here"), (31, ""), (32, None), (33, "  "), (31, ""), (4, BASE), (None, "nobody knows this one")]


def test_near_duplicates(make_docs):
    rows = _near_rows()
    fp = {t: _slow_fingerprint(t) for _, t in rows}
    got = collections.Counter((r.doc_id, np.int64(r.fp).astype(np.uint64).item(), r.component_id) for r in simhash.near_duplicates(make_docs(rows)).collect())
    want = collections.Counter()
    for i, t in rows:
        reach = {t}
        while True:
            more = {u for _, u in rows if any((fp[u] ^ fp[v]).bit_count() <= 3 for v in reach)}
            if more == reach:
                break
            reach = more
        ids = [j for j, u in rows if u in reach and j is not None]
        want[i, fp[t], min(ids, default=None)] += 1
    assert got == want


def test_keep_one_of_each_group(make_docs):
    docs = make_docs(_near_rows())
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    assert [i for i, _ in got] == [-1, 4, 30, 31]


def test_near_duplicates_of_an_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.keep_one(make_docs([])).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_minimal_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    h = lines.MinimalPerfectHash.unpack(lines.MinimalPerfectHash.build(keys).pack())
    assert sorted(h(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        lines.MinimalPerfectHash.build(np.zeros(2, np.uint64))


COMMON = "This line is in the header of every single page"


def _line_rows():
    spaced = f"\t{COMMON.upper()} \x0b"
    rows = [(i, f"own line {i}\n{COMMON if i % 2 else spaced}\n\nshort") for i in range(8)]
    rows += [(20, f"{COMMON}\n{COMMON}\nlast"), (3, "a repeated row"), (3, "a repeated row"), (40, ""), (41, None), (None, f"{COMMON}\nnull id")]
    rows += [(50 + i, "é" * 39) for i in range(6)] + [(60 + i, "é" * 40) for i in range(6)] + [(70 + i, "four documents only have this one line, no more") for i in range(4)]
    rows += [(90, "x\n" * 5000 + "y" * 200_000)]
    return rows


def _slow_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = collections.defaultdict(list)
    for n, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            holders[k].append(i)
    out = collections.Counter()
    for i, t in rows:
        all_lines = (t or "").split("\n")
        gone = [
            len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and i != max((j for j in holders[key(x)] if j is not None), default=None)
            for x in all_lines
        ]
        kept = "\n".join(x for x, g in zip(all_lines, gone) if not g)
        out[i, len(all_lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_line_dedup(make_docs):
    rows = _line_rows()
    docs = make_docs(rows)
    got = lines.dedup_lines(docs.select("doc_id", "text"), counts=True)
    assert collections.Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()) == _slow_lines(rows)


def test_line_dedup_probes_in_many_shards_and_tasks(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "PROBE_ROWS", 3)
    rows = _line_rows()
    hashed = make_docs(rows).select("doc_id", "text").withColumn("row_h", F.xxhash64("text"))
    gone = {(r.doc_id, p) for r in lines.dropped_lines(hashed, shard_keys=2).collect() for p in r.places}
    assert (0, 1) in gone and (20, 0) not in gone and (lines.NO_ID, 0) in gone and (60, 0) in gone and (65, 0) not in gone and (50, 0) not in gone


def test_line_dedup_of_rows_that_are_a_third_of_the_table(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "PROBE_ROWS", 50)
    shared = [f"{COMMON}, part {k}" for k in range(6)]
    rows = [(5, "\n".join([*shared, f"{COMMON}, part 0"]))] * 300 + [(None, shared[1])] * 100 + [(10 + i, f"own {i}\n{shared[i % 6]}") for i in range(500)]
    docs = make_docs(rows)
    got = lines.dedup_lines(docs.select("doc_id", "text"), counts=True)
    assert collections.Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()) == _slow_lines(rows)
    places = [r.places for r in lines.dropped_lines(docs.select("doc_id", "text", F.xxhash64("text").alias("row_h"))).collect() if r.doc_id == 5]
    assert [sorted(p) for p in places] == [list(range(7))]


def test_line_dedup_passes_columns_through(make_docs):
    docs = make_docs(_line_rows())
    out = lines.dedup_lines(docs, length_column="n_chars")
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("n_chars <> length(text)").count() == 0


def test_line_dedup_of_an_empty_table(make_docs):
    assert lines.dedup_lines(make_docs([]), counts=False).collect() == []
