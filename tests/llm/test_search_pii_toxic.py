"""Vector search by brute force, personal data by plain patterns, decontamination by planted passages, toxicity by held-out rows."""

import itertools
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acctlens.llm import decontaminate as dc
from acctlens.llm import oracle, pii, topk, toxicity
from acctlens.llm.bilstm_crf import BiLstmCrf


def _slow_top_k(rows, k):
    vecs = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        vecs.append((i, [int(np.floor(256.0 * x)) for x in v]))
    found = {}
    for i, q in vecs:
        if i % 50 == 0:
            found.setdefault(i, []).extend((-sum(a * b for a, b in zip(q, x)), j) for j, x in vecs if j != i)
    return sorted((i, n + 1, j, -s) for i, scores in found.items() for n, (s, j) in enumerate(sorted(scores)[:k]))


@pytest.mark.parametrize("kind", ["clusters", "copies", "odd", "few", "repeats"])
def test_top_k(spark, kind, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(topk, "CHUNK", 40)
    monkeypatch.setattr(topk, "BLOCK", 3)
    centers = rng.normal(0, 0.2, (6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(0, 0.03, 8)).tolist()) for i in range(600)]
    if kind == "copies":
        rows = [(i, rows[0][1] if i % 3 else v) for i, v in rows]
    elif kind == "odd":
        rows = rows[:150] + [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (1150, [float("inf")]), (None, [1.0] * 8), (1200, []), (1250, [0.0] * 8),
                             (1300, [3.0]), (1350, [1e12] * 8), (1400, [-1e12] * 8), (7, rows[7][1]), (7, [0.5] * 8), (50, rows[50][1])]
    elif kind == "few":
        rows = rows[:3]
    elif kind == "repeats":  # one id holds a third of the rows, some of them equal, and some query ids have several vectors
        rows = [(50 if i % 3 == 0 else i % 120, v) for i, v in rows] + [(50, rows[3][1])] * 20 + [(100, rows[3][1])] * 8 + [(7, rows[3][1])] * 3
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, score int")
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, k=5, pivots=5, annuli=3)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == _slow_top_k(rows, 5)


def test_repeated_ids_equal_sql(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.9, 0.0]), (2, [0.1, 0.1]), (2, [0.1, 0.1]), (0, [0.0, 3.0]), (50, [0.9, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, k=5).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(con.sql(oracle.OP7).fetchall())
    assert (0, 1, 1, 98304) in [tuple(r) for r in got]


def test_top_k_of_nothing(spark):
    for rows in ([], [(1, [1.0])], [(50, None)]):
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        assert topk.top_k(frame, F.col("vec_id") % 50 == 0).collect() == []


def _plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    r = random.Random(0)
    parts = ["a", "b.c", "@", "@x.y", "1", "12", "255", "256", ".", "..", "+", "+1 ", "(", ")", "-", " ", "é", "\n", "4111 1111 1111 1111", "192.168.0.1", "me@x-y.org", "+1 (974) 555-3436", "%", "_"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(text) == _plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" * 100_000, "@" * 200_000):
        pii.base_spans(text)


def test_many_spans_take_linear_time():
    text = " ".join(f"+1 974 555 {i % 10_000:04d} me{i}@mail.example.com (at) 12" for i in range(20_000))  # a megabyte
    base = pii.base_spans(text)
    assert len(base) == 40_000
    begun = time.monotonic()
    covered = pii._Covered(base)
    inside = [covered.meets(m.start(), m.start() + 1) for m in pii._TRIGGER.finditer(text)]
    assert sum(not x for x in inside) == 3 * 20_000  # the "(at)" and the two digits
    found = {(i, 0, i + 8): 1.0 + i % 3 for i in range(0, len(text), 5)}
    assert all(not covered.meets(a, b) for a, _, b in pii.reconcile(found, base))
    pii.training_windows(text)
    assert time.monotonic() - begun < 30


def test_covered_equals_a_plain_search():
    r = random.Random(2)
    for _ in range(200):
        spans = sorted((a, 0, a + r.randrange(1, 9)) for a in (r.randrange(60) for _ in range(r.randrange(8))))
        for a in range(62):
            for b in (a + 1, a + 4):
                assert pii._Covered(spans).meets(a, b) == any(a < y and x < b for x, _, y in spans)


def test_lstm_crf_gradient():
    rng = np.random.default_rng(0)
    model = BiLstmCrf(2, hidden=3, seed=1)
    x, y = rng.integers(0, 40, (4, 6)), np.array([[0, 1, 2, 0, 3, 4], [0] * 6, [1, 2, 2, 2, 0, 3], [3, 0, 1, 1, 2, 0]])
    _, grads = model.loss(x, y)
    for name in model.p:
        flat, g = model.p[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False).tolist():
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = model.loss(x, y)[0]
            flat[i] = old - eps
            down = model.loss(x, y)[0]
            flat[i] = old
            assert abs((up - down) / (2 * eps) - g[i]) < 1e-6, name


def test_reconcile_takes_the_heaviest_set():
    found = {(0, 0, 5): 2.0, (4, 1, 9): 3.5, (9, 2, 12): 1.0, (5, 3, 9): 2.0, (20, 0, 25): 1.0}
    assert pii.reconcile(found, [(22, 1, 30)]) == [(0, 0, 5), (5, 3, 9), (9, 2, 12)]
    assert pii.reconcile({}, []) == []


def _pii_rows():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdelmnorst") for _ in range(r.randint(2, 8)))
    rows = []
    for i in range(240):
        words = [word() for _ in range(30)]
        span = [
            f"{word()}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com", ".".join(str(r.randint(1, 255)) for _ in range(4)),
            "4111111111111111", f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", "Version 2.0", "",
        ][i % 6]
        words[r.randint(3, 26)] = span
        rows.append((i, " ".join(words)))
    return rows


def test_pii_adds_spans_and_keeps_base_ones(spark, make_docs):
    extra = [(900, "please call 555-321-4567 this week"), (901, "write to anna.7 (at) mail3.example.com now"), (902, None), (903, ""), (904, "no personal data at all"),
             (None, "me@x.org"), (0, "me@x.org"), (0, "me@x.org"), (905, "x " * 30_000 + "+1 (974) 555-3436")]
    rows = _pii_rows() + extra
    model = pii.train(make_docs(rows))
    assert model.losses[-1] < model.losses[0] / 10
    got = pii.find_pii(make_docs(rows), model).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in got:
        base = pii.spans_text(_plain_spans(texts[r.doc_id] or "")) if r.doc_id != 0 else r.base
        assert r.base == base
        assert set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))
        assert sum((r.n_email, r.n_ip, r.n_card, r.n_phone)) == len(list(filter(None, r.base.split(","))))
    by = {r.doc_id: r.spans for r in got}
    assert by[904] == by[902] == by[903] == ""
    assert "phone:12:24" in by[900] or "email:9:38" in by[901]  # at least one form that the patterns do not know


class _Marked:
    """A tagger without errors: all that is not a blank or a full stop belongs to a mail address."""

    def emissions(self, x):
        e = np.zeros((x.shape[1], len(x), 9))
        blank = pii.classes(" ")[0]
        inside = (x != blank) & (x != pii.classes(".")[0]) & (x != 0)
        first = inside & ~np.pad(inside, ((0, 0), (1, 0)))[:, :-1]
        e[:, :, 1], e[:, :, 2] = np.where(first, 9.0, -9.0).T, np.where(inside & ~first, 9.0, -9.0).T
        e[:, :, 3:] = -9.0
        return e

    best_path = BiLstmCrf.best_path
    decode = BiLstmCrf.decode

    def _transitions(self):
        return np.zeros((9, 9)), np.zeros(9)


@pytest.mark.parametrize("size", [10, 31, 40, 56, 63, 90, 110])
def test_long_spans_are_found_at_every_place(size):
    span = "j" * size + "(at)" + "d" * size
    for before in range(0, 130, 7):
        text = ". " * 40 + " " * before + span + " ." * 80
        found = pii.added_spans([text], [[]], _Marked())
        assert found == [[(80 + before, 0, 80 + before + len(span))]], before


def test_regions_beyond_a_piece_keep_their_spans():
    text = " ".join(["j" * 40 + "(at)" + "d" * 40] * 60)
    assert [s[2] - s[0] for s in pii.added_spans([text], [[]], _Marked())[0]] == [84] * 60


def test_training_keeps_variants_longer_than_a_window(monkeypatch):
    seen = []
    monkeypatch.setattr(BiLstmCrf, "train", lambda self, x, y, epochs: seen.append((x, y)) or [1.0])
    text = "write to " + "j" * 25 + "@" + "d" * 20 + ".com"
    pii.fit([(text, pii.base_spans(text))])
    assert len(seen[0][0]) == 16 and (seen[0][1] > 0).any(axis=1).all()


def test_pii_without_labels(spark, make_docs):
    assert pii.pii(make_docs([])).collect() == []
    assert [r.spans for r in pii.pii(make_docs([(1, "nothing 1 here")])).collect()] == [""]


WORDS = [f"word{i}" for i in range(3000)]


def _decon_tables(spark, make_docs):
    r = random.Random(2)
    items = {n: [r.choice(WORDS) for _ in range(size)] for n, size in enumerate([40, 15, 12, 8, 6, 3, 0])}
    pad = lambda n: [r.choice(WORDS) for _ in range(n)]
    subst = lambda ws, at: [f"sub{i}" if i in at else w for i, w in enumerate(ws)]
    docs = [
        (0, pad(50) + items[0] + pad(50)), (1, items[0]), (2, pad(9) + subst(items[0], {5, 17, 29})), (3, items[0][:11]), (4, items[0][10:24] + pad(5)),
        (5, pad(300)), (6, pad(4) + items[1]), (7, items[2]), (8, pad(3) + items[3] + pad(3)), (9, items[4]), (10, pad(10) + items[5] + pad(10)), (11, []),
        (12, [w.upper() + "," for w in items[1]]), (13, subst(items[0], set(range(0, 40, 2)))), (1, items[0]), (None, items[2]),
    ]
    bench = spark.createDataFrame([(n, " ".join(w), "x") for n, w in items.items()] + [(None, None, "x")], "item_id bigint, text string, doc_id string")
    return make_docs([(i, " ".join(w)) for i, w in docs] + [(14, None)]), bench


@pytest.mark.parametrize("settings", [{}, {"filter_bits": 1, "hot_share": 0.5}, {"hot_share": 1e-9}])
def test_decontamination(spark, make_docs, settings):
    docs, bench = _decon_tables(spark, make_docs)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.first_word, r.end_word, r.equal_words) for r in dc.contaminations(docs, bench, **settings).collect())
    assert got == [(-1, 2, 0, 12, 12), (0, 0, 50, 90, 40), (1, 0, 0, 40, 40), (1, 0, 0, 40, 40), (2, 0, 9, 49, 37), (4, 0, 0, 14, 14), (6, 1, 4, 19, 15), (7, 2, 0, 12, 12),
                   (8, 3, 3, 11, 8), (9, 4, 0, 6, 6), (12, 1, 0, 15, 15)]
    clean = dc.decontaminate(docs, bench, **settings)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 5, 10, 11, 13, 14]


def _rows_found(spark, make_docs, items, docs, **settings):
    """Per document: (item, first word, end word, equal words), sorted; words are numbers."""
    text = lambda ws: " ".join(f"w{w}" for w in ws)
    bench = spark.createDataFrame([(i, text(ws)) for i, ws in enumerate(items)], "item_id bigint, text string")
    found = {i: [] for i in range(len(docs))}
    for r in dc.contaminations(make_docs([(i, text(ws)) for i, ws in enumerate(docs)]), bench, **settings).collect():
        found[r.doc_id].append((r.item_id, r.first_word, r.end_word, r.equal_words))
    return [sorted(found[i]) for i in range(len(docs))]


def _numbers(r, size):
    return np.array([r.getrandbits(63) for _ in range(size)], np.uint64)


def test_seeds_tolerate_substitutions(spark, make_docs):
    item = _numbers(random.Random(9), 30)
    docs = [_substituted(item, range(3, 30, gap)) for gap in (7, 9, 12)]
    assert [[o[0] for o in found] for found in _rows_found(spark, make_docs, [item], docs)] == [[0]] * 3


def _substituted(item, at):
    other = item.copy()
    other[list(at)] = 5
    return other


def test_every_allowed_substitution_is_found(spark, make_docs):
    items, docs, expected = [], [], []
    for k, (size, n) in enumerate([(12, 2), (15, 3), (20, 4), (25, 5), (6, 1), (7, 1), (8, 1), (9, 1), (10, 2), (11, 2), (5, 1), (4, 0), (2, 0), (1, 0)]):
        items.append(_numbers(random.Random(size), size))
        for at in itertools.islice(itertools.combinations(range(1, size - 1), n), 0, None, 1 if size < 20 else 37):
            docs.append(_substituted(items[-1], at))
            expected.append([(k, 0, size, size - n)])
    assert _rows_found(spark, make_docs, items, docs, shortest=1) == expected
    short = [len(items[e[0][0]]) < dc.SHORTEST for e in expected]
    assert _rows_found(spark, make_docs, items, docs) == [[] if s else e for s, e in zip(short, expected)]


def _longest_by_force(equal, share=0.8):
    places = np.flatnonzero(equal).tolist()
    sums = np.concatenate([[0], np.cumsum(equal)])
    return max((y + 1 - x for x in places for y in places if y >= x and sums[y + 1] - sums[x] >= share * (y + 1 - x) - 1e-9), default=0)


def test_every_fifth_word_replaced_at_any_length(spark, make_docs):
    r = random.Random(3)
    items = [_numbers(r, size) for size in range(13, 200, 9)]
    cases = [(k, item, _substituted(item, range(start, len(item), 5))) for k, item in enumerate(items) for start in range(5)]
    found = _rows_found(spark, make_docs, items, [other for _, _, other in cases])
    assert [[o[0] for o in f] for f in found] == [[k] * (_longest_by_force(other == item) >= 12) for k, item, other in cases]


def test_overlap_is_the_longest_of_its_alignment(spark, make_docs):
    r = random.Random(8)
    item = _numbers(r, 30)
    shapes = ["011011011110110111100111111111", "0" * 30, "1" * 30]
    shapes += ["".join(r.choice("11110") for _ in range(30)) for _ in range(800)]
    docs = [_substituted(item, [i for i, c in enumerate(shape) if c == "0"]) for shape in shapes]
    longest = [_longest_by_force(other == item) for other in docs]
    found = _rows_found(spark, make_docs, [item], docs)
    assert [[o[2] - o[1] for o in f] for f in found] == [[n] * (n >= 12) for n in longest]


def test_overlaps_equal_all_alignments(spark, make_docs):
    """Few words, so that seeds meet by chance, items share passages, and a third of documents and items are equal."""
    r = random.Random(12)
    passage = [r.randrange(8) for _ in range(14)]
    some = lambda n: [r.randrange(8) for _ in range(n)]
    items = [some(r.choice([12, 18, 25])) + passage * (i % 3 == 0) for i in range(12)]
    items += [items[0]] * 6
    docs = [some(r.randrange(60)) + (passage + items[i % 12]) * (i % 2) + some(r.randrange(9)) for i in range(40)]
    docs += [docs[1]] * 20
    expected = []
    for doc in map(np.array, docs):
        rows = []
        for k, item in enumerate(map(np.array, items)):
            best = None
            for shift in range(1 - len(item), len(doc)):
                lo, hi = max(0, shift), min(len(doc), shift + len(item))
                x, y = dc._longest(doc[lo:hi] == item[lo - shift : hi - shift], 0.8)
                if y - x >= 12 and (best is None or y - x > best[2] - best[1]):
                    best = (k, lo + x, lo + y, int((doc[lo + x : lo + y] == item[lo - shift + x : lo - shift + y]).sum()))
            rows += [best] if best else []
        expected.append(rows)
    assert _rows_found(spark, make_docs, items, docs) == expected
    assert _rows_found(spark, make_docs, items, docs, filter_bits=1, hot_share=0.01) == expected


def test_very_long_texts_are_searched_whole(spark, make_docs):
    r = random.Random(4)
    item, pad = _numbers(r, 30).tolist(), [r.randrange(5000) for _ in range(300_000)]
    found = _rows_found(spark, make_docs, [item, pad[:50_000]], [pad + item, pad[:-1], item[::-1]])
    assert found == [[(0, 300_000, 300_030, 30), (1, 0, 50_000, 50_000)], [(1, 0, 50_000, 50_000)], []]


def test_decontamination_of_nothing(spark, make_docs):
    docs, bench = _decon_tables(spark, make_docs)
    assert dc.contaminations(make_docs([]), bench).collect() == []
    assert dc.contaminations(docs, bench.limit(0)).collect() == []
    assert dc.decontaminate(docs, bench.limit(0)).count() == docs.count()


def _toxic_rows(n=1500):
    r = random.Random(7)
    bad = ["vile", "scumbag", "trashy", "moronic", "loser"]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(WORDS[:400]) for _ in range(r.randint(5, 120))]
        toxic = r.random() < 0.12
        if toxic:
            for _ in range(r.randint(2, 4)):
                words[r.randrange(len(words))] = r.choice(bad) + r.choice(["", ",", "!"])
        rows.append((i, " ".join(words).title() if i % 3 else " ".join(words)))
        if r.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return rows, labels, {d: t for d, _, t in labels}


def test_toxicity_on_held_out_rows(spark, make_docs):
    rows, labels, truth = _toxic_rows()
    rows += [(9000, None), (9001, ""), (None, "moronic loser"), (3, rows[3][1]), (9002, "calm words " * 40_000)]
    labels += [(None, 1, 1), (9000, None, None), (77_777, 0, 1)]
    docs, frame = make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, frame).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.95 and np.mean([s >= 0.5 for s in pos]) > 0.7 and np.mean([s >= 0.5 for s in neg]) < 0.03
    empty = {r.score for r in got if r.doc_id in (9000, 9001)}
    assert len(empty) == 1 and empty.pop() < 0.5
    kept = toxicity.drop_toxic(docs, frame)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in got)


@pytest.mark.parametrize("kind", ["all", "hot"])
def test_repeated_ids_leave_the_positives_in_the_sample(spark, make_docs, kind):
    rows, labels, _ = _toxic_rows(300)
    repeats = rows * 9 if kind == "all" else rows + [rows[0]] * 2000
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    once, many = (toxicity.train(make_docs(x), frame, max_positives=50, max_unlabelled=300) for x in (rows, repeats))
    assert np.abs(once.weights).max() > 0
    assert (once.weights == many.weights).all() and once.bias == many.bias


def test_toxicity_sample_bounds():
    assert (toxicity.MAX_POSITIVES, toxicity.MAX_UNLABELLED) == (6_000, 12_000)


def test_rows_at_the_driver_are_bits_of_the_telling_buckets(spark, make_docs):
    rows, labels, _ = _toxic_rows(300)
    docs, frame = make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, frame, max_buckets=4)
    assert 0 < np.count_nonzero(model.weights) <= 4
    sets = [(i % 2 == 0, [1, 2 + i % 2, 4] if i < 20 else [1, 5]) for i in range(40)] + [(True, [6])]
    kept = toxicity._telling_buckets(spark.createDataFrame(sets, "positive boolean, buckets array<int>"), 21, 20, 2, 3)
    assert kept.tolist() == [1, 2, 3]  # 1: all but the last row; 6: one row
    batch = pa.RecordBatch.from_pydict({"positive": [True, False], "buckets": pa.array([[1, 3, 9], []], pa.list_(pa.int32()))})
    (out,) = toxicity._as_bits(kept)([batch])
    assert out.column("bits").to_pylist() == [b"\xa0", b"\x00"]


def test_held_out_labels_are_never_read(spark, make_docs):
    rows, labels, _ = _toxic_rows(300)
    docs = make_docs(rows)
    flip = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")) for x in (labels, flip))
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_negative_risk_is_turned_back():
    pos, unl = [np.array([1])] * 20, [np.array([1])] * 2 + [np.array([2])] * 60
    model = toxicity.fit(pos, unl, prior=0.5, min_rows=1, steps=200)
    assert np.isfinite(model.weights).all() and model.weights[1] > model.weights[2]


def test_toxicity_without_positives(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.predicted for r in toxicity.toxicity(make_docs([(1, "a"), (2, None)]), labels).collect()] == [0, 0]
    assert toxicity.toxicity(make_docs([]), labels).collect() == []
