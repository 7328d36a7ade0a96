"""Chat formatting by an independent parser, sharding by a direct fill."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from acctlens.llm import chat, sharding

TEXTS = [
    "", None, "plain", "\\", "\\\\", "a\\", "</turn>", "</turn>\n", "### User: x", "#### User: x", "### Assistant: </turn> ok", "\\### Assistant: </turn> ok",
    "### @41: y", "<\\/turn>", "#\\##", "line\n</turn>\n### System: z", "é\U0001f600 ###", "###", "</tu", "rn>", "### @", "x" * 300_000, "### @" + "A\\" * 50_000,
]
ROLES = ["user", "assistant", "system", "tool", "User", "", None, "a: b", "### User", "名\n前", "</turn>\n"]


def _rows():
    r = random.Random(1)
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(TEXTS)]
    rows += [(2, i, role, "hi") for i, role in enumerate(ROLES)]
    rows += [(i, n, r.choice(ROLES), "".join(r.choice(["</turn>", "\n", "\\", "### ", "User: ", "Assistant: ", "#", "x", "<", "@41: "]) for _ in range(8))) for i in range(3, 40) for n in range(3)]
    rows += [(50, 0, "assistant", "tie b"), (50, 0, "assistant", "tie a"), (50, 0, "assistant", "tie a"), (51, None, "user", "no turn"), (51, 0, "user", "first"), (None, 0, "assistant", "no id")]
    return rows


def _want(rows):
    said = collections.defaultdict(list)
    for c, n, role, text in rows:
        said[c].append((n is not None, n or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(ts)] for c, ts in said.items()}


def test_round_trip_and_loss_mask(spark):
    rows = _rows()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("clash"))
    formatted = chat.format_chat(frame).cache()
    back = {r.conv_id: r for r in chat.read_chat(formatted).collect()}
    raw = {r.conv_id: r for r in formatted.collect()}
    want = _want(rows)
    assert set(back) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in back[c].turns] == turns
        assert back[c].loss_text == "".join(t for r, t in turns if r == "assistant")
        assert back[c].formatted_chars == len(raw[c].formatted)
        assert len(raw[c].loss_mask) == sum(r == "assistant" for r, _ in turns)
        # one end mark a turn, and a plain turn is left as it is
        assert raw[c].formatted.count("</turn>") == len(turns)
    assert raw[50].formatted == "### Assistant: tie a</turn>\n### Assistant: tie a</turn>\n### Assistant: tie b</turn>\n"
    assert raw[2].formatted.startswith("### User: hi</turn>\n### Assistant: hi</turn>\n")


def test_only_conflicting_text_is_escaped(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a # b < c ### d"), (2, 0, "user", "</turn>")], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r.formatted for r in chat.format_chat(frame).collect()}
    assert got == {1: "### User: a # b < c ### d</turn>\n", 2: "### User: <\\/turn></turn>\n"}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_chat(chat.format_chat(empty)).collect() == []


def test_text_that_does_not_parse_is_null(spark):
    bad = ["### User: a</turn>", "User: a</turn>\n", "### User: a### User: b</turn>\n", "### User: a</turn>b</turn>\n", "### Nobody: a</turn>\n"]
    rows = spark.createDataFrame([(b,) for b in bad], "t string").select(chat.parse(F.col("t")).alias("p")).collect()
    assert [r.p for r in rows] == [None] * len(bad)


def _md5(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def _fill(shards, size):
    table, taken = [None] * size, 0
    orders = []
    for s in shards:
        a, b = _md5(s + "/step") % (size - 1) + 1, _md5(s + "/start") % size
        orders.append(iter(sorted(range(size), key=lambda slot, a=a, b=b: (a * slot + b) % size)))
    while taken < size:
        for i, s in enumerate(shards):
            if taken < size:
                slot = next(x for x in orders[i] if table[x] is None)
                table[slot] = s
                taken += 1
    return table


@pytest.mark.parametrize("n, size", [(1, 2), (3, 7), (5, 101), (32, 211)])
def test_table_is_filled_by_turns(spark, n, size):
    shards = [f"s{i}" for i in range(n)]
    got = {r.slot: r.shard for r in sharding.lookup_table(spark, shards, size).collect()}
    assert [got[i] for i in range(size)] == _fill(shards, size)
    shares = collections.Counter(got.values())
    assert max(shares.values()) - min(shares.values()) <= 1


def test_few_slots_move_when_a_shard_goes(spark):
    before, after = (_fill([f"s{i}" for i in range(10) if i != gone], 1009) for gone in (None, 4))
    assert sum(a != b for a, b in zip(before, after) if a != "s4") < 0.1 * 1009


def test_bad_tables_are_refused(spark):
    for shards, size in ((["a"], 8), ([], 7), (["a", "a"], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, shards, size)


def test_rows_are_placed_by_key(spark, make_docs):
    rows = [(1, "a"), (1, "a"), (None, None), (2, ""), (-5, "x")]
    docs = make_docs(rows)
    shards = ["a", "b", "c"]
    placed = sharding.assign_shards(docs, "doc_id", shards, 101)
    assert placed.columns == [c for c in docs.columns if c != "slot"] + ["slot", "shard"]
    table = _fill(shards, 101)
    got = sorted((str(r.doc_id), r.slot, r.shard) for r in placed.collect())
    slots = [_md5("" if i is None else str(i)) % 101 for i, _ in rows]
    assert got == sorted((str(i), s, table[s]) for (i, _), s in zip(rows, slots))
    assert sharding.assign_shards(make_docs([]), "doc_id", shards, 101).collect() == []


def test_native_plans(spark, make_docs):
    convs = spark.createDataFrame([(1, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    for frame in (sharding.assign_shards(make_docs([(1, "x")]), "doc_id"), chat.read_chat(chat.format_chat(convs))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
