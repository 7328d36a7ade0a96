"""Conversation repair against a search of all cheapest paths that knows nothing of bounds or segments."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from acctlens.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, costs string, part string"
LEGAL = re.compile("(s?(ua)+)?")


def _best(initials, faults):
    """(cost, audit) by dynamic programming over the rows from the end, comparing whole strings."""
    nxt = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    to = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, ""), 3: (0, ""), 2: (2, "I"), 1: (4, "II")}
    for initial, fault in zip(reversed(initials), reversed(faults)):
        more = 1 if fault == repair.TRUNCATED else 0
        here = {}
        for s in range(4):
            ways = [(3 + best[s][0], "D" + best[s][1])]
            if fault in (repair.OK, repair.TRUNCATED):
                ways.append((2 + more + best[to[s]][0], "R" + best[to[s]][1]))
                if initial in nxt[s]:
                    e = nxt[s][initial]
                    ways.append((more + best[e][0], "K" + best[e][1]))
            here[s] = min(ways)
        for _ in range(4):  # inserts before the row
            here = {s: min(here[s], (2 + here[to[s]][0], "I" + here[to[s]][1])) for s in range(4)}
        best = here
    return best[0]


@functools.cache
def _exhaustive(initials, faults):
    """(cost, audit) by trying every edit string of limited inserts: for few rows only."""
    found = []
    for kinds in itertools.product("DKR", repeat=len(initials)):
        for inserts in itertools.product(range(3), repeat=len(initials) + 1):
            letters = "".join("I" * n + k for n, k in zip(inserts, (*kinds, "")))
            cost, state, ok, i = 0, 0, True, 0
            for e in letters:
                if e == "D":
                    cost += 3
                else:
                    if e != "I" and faults[i] in (repair.BLANK, repair.DUPLICATE):
                        ok = False
                        break
                    role = initials[i] if e == "K" else repair._NEXT[state][1][0]
                    if (state, role) not in repair._STEP:
                        ok = False
                        break
                    state = repair._STEP[state, role]
                    cost += (0 if e == "K" else 2) + (e != "I" and faults[i] == repair.TRUNCATED)
                i += e != "I"
            if ok and state in (0, 3):
                found.append((cost, letters))
    return min(found)


def test_search_equals_every_edit_string():
    for n in range(4):
        for initials in itertools.product("suax", repeat=n):
            for faults in itertools.product((repair.OK, repair.BLANK, repair.TRUNCATED), repeat=n) if n < 3 else [(0, 3, 0), (3, 1, 0), (0, 0, 0)]:
                want = _exhaustive(initials, faults)
                assert _best(initials, faults) == want
                assert repair._Search(list(initials), list(faults)).run(0) == want


def test_search_of_longer_conversations():
    r = random.Random(1)
    for _ in range(300):
        n = r.randrange(70)
        initials = [r.choice("uauauast ") for _ in range(n)]
        faults = [r.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        got = repair._Search(initials, faults).run(0)
        assert got == _best(initials, faults)
        rows = [(i, "x") for i in initials]
        assert LEGAL.fullmatch("".join(role[:1] for role, _ in repair.apply_edits(rows, got[1])[0]))


def _key(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, text)


def _want(rows):
    """Digest columns of conversations of (conv_id, turn, role, text) rows."""
    by_conv = {}
    for c, turn, role, text in rows:
        by_conv.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, group in by_conv.items():
        group.sort(key=_key)
        seen, faults = set(), []
        for _, role, text in group:
            faults.append(repair.fault_of(text, (role, text) in seen))
            seen.add((role, text))
        initials = tuple(g[1][:1] for g in group)
        cost, audit = _best(initials, faults)
        state, lines, i = 0, [], 0
        for e in audit:
            if e != "D":
                role = group[i][1] if e == "K" else {0: "user", 1: "user", 2: "assistant", 3: "user"}[state]
                lines.append(f"{role}:{'' if e == 'I' else group[i][2]}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            i += e != "I"
        turns = [g[0] for g in group if g[0] is not None]
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def _rows():
    r = random.Random(2)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "Yes. \n", "Yes. ", "é.", "a:b.", "two\nlines."]
    roles = ["user", "assistant", "system", "tool", "User", "", None, "user", "assistant"]
    rows = [(c, r.choice([n, n, None, n + 3, 0]), r.choice(roles), r.choice(texts) if r.random() < 0.4 else f"text {r.random()}.") for c in range(60) for n in range(r.randrange(1, 12))]
    rows += [(None, n, "user" if n % 2 else "assistant", f"no id {n}.") for n in range(5)]
    rows += [(100, 7, "user", "same.")] * 50 + [(101, None, "user", "same.")] * 3
    rows += [(102, n, "user" if n % 2 == 0 else "assistant", "z" * 400_000 + f"{n}.") for n in range(30)]  # long texts
    # a conversation that holds most rows, many of them equal
    rows += [(103, n // 2, r.choice(roles), "often." if n % 3 == 0 else f"t{n}" + r.choice([".", ""])) for n in range(1500)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


def _got(spark, rows, parts, segment_rows=repair.SEGMENT_ROWS):
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA).repartition(parts)
    return repair.repair_conversations(frame, segment_rows)


@pytest.mark.parametrize("segment_rows,partitions", [(64, "4"), (5, "13")])
def test_conversations_equal_brute_force(spark, rows, segment_rows, partitions):
    # small segments and many partitions: most conversations are cut
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = repair.summaries(_got(spark, rows, 3, segment_rows)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = _want(rows)
    assert len(got) == len(want)
    for g in got:
        assert (g.gaps, g.blank, g.duplicate, g.truncated, g.illegal, g.cost, g.audit, g.repaired_sha256) == want[g.conv_id]


def test_repaired_turns_alternate(spark, rows):
    segments = _got(spark, rows, 2).cache()
    said = {}
    for t in repair.repaired_turns(segments).orderBy("conv_id", "part", "seg", "place").collect():
        said.setdefault(t.conv_id, []).append(t.role[:1])
    assert all(LEGAL.fullmatch("".join(roles)) for roles in said.values())
    assert max(r["rows"] for r in segments.select("rows").collect()) <= repair.SEGMENT_ROWS


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.summaries(repair.repair_conversations(empty)).count() == 0


def _damaged(rows):
    for c, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            yield from [(c, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)


def test_query_equals_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    given = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    given += [(9_000_000 + n, 0, "user", "alone.") for n in range(40)] + [(None, 1, None, None), (None, 2, "user", None)]
    spark.createDataFrame(given, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    want = _want(_damaged(given))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(got) == {r[0] for r in given} and set(got) > set(want)
    for c, g in got.items():
        assert tuple(g)[1:] == want.get(c, nothing)
