"""Spelling variants against all pairs of words, and trie nodes against the sets of prefixes and suffixes."""

import collections
import random
import re
import zlib

import duckdb
import pytest

from acctlens.llm import queries, spelling


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _counts(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _want(n):
    words = sorted(n)
    near = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and _near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def _check(got, want):
    assert len(got) == len(want)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want


def _words():
    r = random.Random(4)
    n = {}
    for _ in range(150):
        word = "".join(r.choice("abcÿé") for _ in range(r.randrange(5, 14)))
        for _ in range(8):
            n[word] = r.randrange(3, 400)
            i = r.randrange(len(word) + 1)
            kind = r.random()
            word = word[:i] + r.choice("abc") + word[i + (kind < 0.4) :] if kind < 0.7 else word[:i] + word[i + 1 :]
            if len(word) < 5:
                break
    n |= {"aaaaa": 5, "aaaaaa": 10, "aaaaaaa": 20, "aaaaaaaa": 40, "abaaaaaa": 80, "abcaaaaa": 160}  # a chain, and letters between equal ones
    n |= {"hotwordlong" + c: 3 + i for i, c in enumerate(spelling.LETTERS)} | {"hotwordlong": 1000}  # a full pair
    n |= {"x" * 3000 + e: 3 * 3**i for i, e in enumerate(("", "y", "yz", "z"))}
    return n


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(w, n, "clash", "clash") for w, n in _words().items()]
    return spark.createDataFrame(rows, "word string, n bigint, id string, form string").repartition(5)


def test_groups_equal_all_pairs(spark, frame):
    got = spelling.group_spellings(frame).collect()
    want = _want(_words())
    _check(got, want)
    assert sum(w[1] != k for k, w in want.items()) > 100  # roots
    assert want["aaaaa"][1] == "abcaaaaa"


def test_ties_take_the_smallest_word(spark):
    frame = spark.createDataFrame([("brown", 3), ("crown", 9), ("grown", 9), ("zrown", 9), ("brownÿ", 9)], "word string, n bigint")
    got = {r.word: r.form for r in spelling.group_spellings(frame).collect()}
    assert got["brown"] == "brownÿ" and got["crown"] is None


def test_trie_nodes_are_the_prefixes_and_suffixes(spark, frame):
    numbered = frame.selectExpr("monotonically_increasing_id() AS id", "n", "word")
    forward, backward = {}, {}
    for r in spelling.trie_nodes(numbered).collect():
        assert len(r.prefixes) == len(r.suffixes) == len(r.word) + 1
        for i in range(len(r.word) + 1):
            assert forward.setdefault(r.prefixes[i], r.word[:i]) == r.word[:i]
            assert backward.setdefault(r.suffixes[i], r.word[i:]) == r.word[i:]
    assert len(set(forward.values())) == len(forward) and len(set(backward.values())) == len(backward)


def test_words_of_texts(spark, make_docs):
    r = random.Random(6)
    some = ["Straße", "strasse", "Apple", "apples", "éclair", "abc", "naïve", "x" * 40, "don't", "ĀBCDE", "a×b÷cde"]
    rows = [(i if i % 5 else None, " ".join(r.choice(some) for _ in range(r.randrange(60)))) for i in range(300)]
    rows += [(1, None), (2, ""), (3, "12 . -"), (4, "long" * 60_000 + " apple"), (5, "apple\nAPPLE\tapple")] + [(7, "apple pear peach")] * 5
    want = _counts(rows)
    got = {w.word: w.n for w in spelling.count_words(make_docs(rows)).collect()}
    assert got == want
    assert any(w not in map(_lower, " ".join(some).split()) and len(w) > 4 for w in got)  # a letter dropped


def test_no_words(spark, make_docs):
    assert spelling.group_spellings(spelling.count_words(make_docs([(1, None), (2, "a b c")]))).count() == 0
    assert spelling.group_spellings(spelling.count_words(make_docs([(1, "x")]).limit(0))).count() == 0


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    _check(queries.QUERIES["op13_spelling_variants"](spark, sf).collect(), _want(_counts(rows)))
