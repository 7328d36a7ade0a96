"""The pipeline's stages, each held against a brute-force version on its own input."""

import collections
import hashlib

import numpy as np
import pytest
from test_dedup import COMMON, _slow_fingerprint, _slow_lines
from test_search_pii_toxic import WORDS, _toxic_rows

import corpus_pipeline
from acctlens.llm import toxicity
from acctlens.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels, _ = _toxic_rows(500)
    passage = " ".join(WORDS[500:540])
    rows = [(i, f"{t}\n{COMMON}" if i % 9 == 0 else t) for i, t in rows]
    rows += [(1000 + i, rows[10][1]) for i in range(30)] + [(2000, f"begin {passage} end"), (2001, passage.upper())]
    rows += [(3000, None), (3001, ""), (None, "a row without an id"), (3002, "w " * 5000), (3003, "twice"), (3003, "twice")]
    docs = [(i, t, "en", "hot" if i and i % 3 else "s", len(t or ""), "x", 1.0) for i, t in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint, row_h string, score double").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def _rows(frame):
    return collections.Counter((r.doc_id, r.text) for r in frame.collect())


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, tables).cache()
        seen[name] = (before, docs)
        assert docs.columns == before.columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]

    before, after = seen["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{tables}/labels.parquet"))
    assert _rows(after) == collections.Counter((r.doc_id, r.text) for r in before.collect() if model.score(r.text) < 0.5)
    assert before.count() - after.count() > 20

    before, after = seen["line_dedup"]
    want = _slow_lines([(r.doc_id, r.text) for r in before.collect()])
    assert collections.Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in after.collect()) == collections.Counter({(i, h): n for (i, _, _, h), n in want.items()})
    assert after.filter("n_chars <> length(text)").count() == 0

    before, after = seen["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    fps = np.array([_slow_fingerprint(t) for _, t in rows], np.uint64)
    group = np.arange(len(rows))
    while True:
        new = np.array([group[np.bitwise_count(fps ^ f) <= 3].min() for f in fps])
        if (new == group).all():
            break
        group = new
    want = {min((i for (i, _), g in zip(rows, group) if g == k and i is not None), default=None) for k in set(group.tolist())}
    kept = [r.doc_id for r in after.collect()]
    assert len(kept) == len(set(group.tolist())) and set(kept) == want

    before, after = seen["decontamination"]
    gone = _rows(before) - _rows(after)
    assert {i for i, _ in gone} <= {2000, 2001} and gone and not _rows(after) - _rows(before)

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()
    assert {p.doc_id for p in packed} == {r.doc_id for r in docs.collect()}
    assert sum(p.piece == 0 for p in packed) == docs.count()


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    fill = collections.Counter()
    for r in out.collect():
        fill[r.sequence_id] += r.length
    assert fill and max(fill.values()) <= 1024


def test_pipeline_of_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    from oracle_harness import compare, duck_connection

    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), duck_connection(folder), ORACLE[name])["ok"]
