"""License scans against a plain search of every window, and against SQL."""

import math
import random
import re

import pytest
from oracle_harness import compare, duck_connection

from acctlens.llm import licenses, oracle, queries
from acctlens.llm.license_texts import PHRASES, TEMPLATES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(text, templates=TEMPLATES, phrases=PHRASES, threshold=0.8):
    words = _words(text)
    places = [
        (i, label) for phrase, label in phrases for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    blocks = []
    for label, notice in templates:
        notice = _words(notice)
        if not notice:
            continue
        least = 8
        while least < len(notice):
            least *= 2
        for at in range(0, len(words), least):
            share = len(set(notice) & set(words[at : at + 2 * least])) / len(set(notice))
            if share >= threshold - 1e-9:
                blocks.append((at, min(at + 2 * least, len(words)), label, share))
    base = sorted({label for _, label in places})
    return {
        "n_words": len(words), "n_base": len(places),
        "first_word": min((i for i, _ in places), default=None), "last_word": max((i for i, _ in places), default=None),
        "base_labels": base, "blocks": sorted(blocks), "labels": sorted({*base, *(b[2] for b in blocks)}),
        "score": 1.0 if places else max((b[3] for b in blocks), default=0.0),
    }


def _check(got, text, **options):
    want = _brute(text, **options)
    assert {c: getattr(got, c) for c in want if c != "blocks"} == {c: v for c, v in want.items() if c != "blocks"}
    assert [(b.first_word, b.end_word, b.label) for b in got.blocks] == [b[:3] for b in want["blocks"]]
    assert all(math.isclose(b.containment, w[3]) for b, w in zip(got.blocks, want["blocks"]))


def _texts():
    r = random.Random(3)
    filler = "lorem ipsum dolor the of software license and to is für über".split()
    texts = [None, "", " \n", "MIT License", "mit  license, MIT-LICENSE cc by", "gnu general public", "cc\nby cc by", "ÀPACHE license Apache\x00License"]
    for _, notice in TEMPLATES:
        words = notice.split()
        for share in (0.0, 0.1, 0.2, 0.3):
            some = [w if r.random() >= share else r.choice(filler) for w in words]
            before = [r.choice(filler) for _ in range(r.randrange(120))]
            texts.append(" ".join([*before, *some, *[r.choice(filler) for _ in range(r.randrange(80))]]))
    texts.append(" ".join(r.choice(filler) for _ in range(60_000)) + " " + TEMPLATES[0][1])
    return texts


def test_scan_equals_every_window(spark, make_docs):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(_texts())] + [(3, "MIT License"), (3, "MIT License")]
    docs = make_docs(rows)
    got = licenses.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    want = sorted(rows, key=repr)
    by_key = {}
    for g in got:
        by_key.setdefault((g.doc_id, g.n_words, g.n_base), []).append(g)
    for doc_id, text in want:
        b = _brute(text)
        group = by_key[doc_id, b["n_words"], b["n_base"]]
        match = [g for g in group if g.labels == b["labels"] and [(x.first_word, x.label) for x in g.blocks] == [(x[0], x[2]) for x in b["blocks"]]]
        _check(match[0], text)
        group.remove(match[0])
    assert any(len(g.labels) > len(g.base_labels) for g in got)


@pytest.mark.parametrize("threshold", [0.5, 1.0])
def test_other_templates_and_thresholds(spark, make_docs, threshold):
    templates = [("a", "one two three four five"), ("b", "one one one two"), ("c", ""), ("d", " ".join(f"w{i}" for i in range(40)))]
    phrases = [("two two", "pair"), ("zebra", "z"), ("", "none")]
    r = random.Random(5)
    texts = [" ".join(r.choice(["one", "two", "three", "four", "x", *[f"w{i}" for i in range(30)]]) for _ in range(r.randrange(200))) for _ in range(60)]
    docs = make_docs(list(enumerate(texts)))
    got = {g.doc_id: g for g in licenses.scan_licenses(docs, templates, phrases, threshold).collect()}
    for i, text in enumerate(texts):
        _check(got[i], text, templates=templates, phrases=[p for p in phrases if p[0]], threshold=threshold)


def test_no_documents_and_no_templates(spark, make_docs):
    assert licenses.scan_licenses(make_docs([(1, "x")]).limit(0)).count() == 0
    only = licenses.scan_licenses(make_docs([(1, "the MIT License")]), templates=[]).first()
    assert (only.labels, only.blocks, only.score) == (["mit"], [], 1.0)


def test_templates_have_a_bound(spark, make_docs):
    with pytest.raises(ValueError):
        licenses.scan_licenses(make_docs([(1, "x")]), [("big", " ".join(f"w{i}" for i in range(licenses.MAX_TEMPLATE_WORDS + 1)))])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    res = compare(queries.QUERIES["op11_license_scans"](spark, sf), duck_connection(sf), oracle.OP11)
    assert res["columns_match"] and not res["type_diffs"] and len(set(res["rows"])) == 1 and not res["value_diffs"], res
