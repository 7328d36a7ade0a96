"""Conversation structure repair: the cheapest edits that give role initials ``(s?(ua)+)?``.

Rows of a conversation are taken by turn (nulls first), then role and text. A row is faulty if it is blank, a
duplicate (role and text seen earlier) or truncated (does not end in ``.!?``). Edits: Keep a row (0), Rerole
it to user or assistant (2), Delete it (3, required for blank and duplicate rows), Insert an empty user or
assistant turn (2); a truncated row that stays costs 1 more. Of the cheapest edit strings the least in ASCII wins.

* Iterative-deepening A*: ``_Search`` goes depth first through the edits in ASCII order (D, I, K, R) under a
  cost bound and raises the bound to the least cost that went over it. The transposition table keeps, for each
  (row, state) that failed, the least cost that is still possible there. The first accepting path is the answer.
* Duplicates: each row has an id of its own in a written table; the first row of each (conversation, hash of
  role and text) is found by a partial minimum, and its id is joined back, a key that no two rows share.
* Rows are sorted by range partitions, so no conversation has to fit into one task. One that lies whole in a
  partition and has at most ``SEGMENT_ROWS`` rows is searched as it is. Any other is cut into segments, each
  searched once for every pair of states at its ends. Two passes over a conversation's segments, each holding one
  segment at a time, join them: backwards the least cost to the end, forwards the least string of that cost. A
  segment's strings end in an edit of its last row, so none begins another and the parts can be compared one by one.

The digest of a whole conversation (``summaries``) reads its segments in order, one at a time.

Cases: a null role or text is one space (so a null text is blank); null turns sort first and count for no
gap; a null ``conv_id`` is a conversation of its own; equal rows are duplicates after the first; rows of one turn
follow each other by role and text; texts may have any length; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.store import written

SEGMENT_ROWS = 64
SEGMENT_CHARS = 8 << 20
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 2, 3, 2, 1
_SPACE = " \t\n\v\f\r"

# States: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))  # state and role that a Rerole or Insert gives
_ENDS = (0, 3)
_REACH = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
_NEVER = 1 << 60


class _Search:
    """Cheapest edits of some rows to ``end``, or, without one, to a state that a conversation may end in."""

    def __init__(self, initials: list[str], faults: list[int], end: int | None = None):
        self.initials, self.faults, self.end, self.n = initials, faults, end, len(initials)
        least = [0]  # of each row by itself, summed from the end: never more than the true cost
        for initial, fault in zip(reversed(initials), reversed(faults)):
            stays = (KEEP if initial in ("s", "u", "a") else REROLE) + (STAYS_TRUNCATED if fault == TRUNCATED else 0)
            least.append(least[-1] + (DELETE if fault in (BLANK, DUPLICATE) else min(DELETE, stays)))
        self.least = least[::-1]
        self.failed: dict[tuple[int, int], int] = {}

    def _edits(self, i: int, state: int) -> list[tuple[str, int, int, int]]:
        """(letter, cost, next row, next state) in ASCII order."""
        out = []
        if i < self.n:
            out.append(("D", DELETE, i + 1, state))
        if i < self.n or self.end is None:
            out.append(("I", INSERT, i, _NEXT[state][0]))
        if i < self.n and self.faults[i] in (OK, TRUNCATED):
            more = STAYS_TRUNCATED if self.faults[i] == TRUNCATED else 0
            if (kept := _STEP.get((state, self.initials[i]))) is not None:
                out.append(("K", KEEP + more, i + 1, kept))
            out.append(("R", REROLE + more, i + 1, _NEXT[state][0]))
        return out if self.end is None else [e for e in out if self.end in _REACH[e[3]]]

    def _bound(self, i: int, state: int) -> int:
        return self.failed.get((i, state), self.least[i])

    def _deepen(self, i: int, state: int, budget: int, path: list[str]) -> bool:
        if i == self.n and (state in _ENDS if self.end is None else state == self.end):
            return True
        over = _NEVER
        for letter, cost, j, to in self._edits(i, state):
            if cost + self._bound(j, to) <= budget:
                path.append(letter)
                if self._deepen(j, to, budget - cost, path):
                    return True
                path.pop()
            over = min(over, cost + self._bound(j, to))
        self.failed[i, state] = max(over, self._bound(i, state))
        return False

    def run(self, start: int) -> tuple[int, str] | None:
        """(cost, edits' letters), or None if the end cannot be reached."""
        if self.end is not None and self.end not in _REACH[start]:
            return None
        bound = self._bound(0, start)
        while bound < _NEVER:
            path: list[str] = []
            if self._deepen(0, start, bound, path):
                return bound, "".join(path)
            bound = self._bound(0, start)
        return None


def apply_edits(rows: list[tuple[str, str]], edits: str, state: int = 0) -> tuple[list[tuple[str, str]], int]:
    """The repaired rows and the state after them."""
    out, i = [], 0
    for letter in edits:
        if letter != "D":
            to, role = _NEXT[state]
            if letter == "K":
                role = rows[i][0]
                to = _STEP[state, role[:1]]
            out.append((role, "" if letter == "I" else rows[i][1]))
            state = to
        i += letter != "I"
    return out, state


def fault_of(text: str, duplicate: bool) -> int:
    seen = text.rstrip(_SPACE)
    return BLANK if not seen else DUPLICATE if duplicate else OK if seen[-1] in ".!?" else TRUNCATED


_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("whole", pa.bool_()), *((c, pa.int64()) for c in _COUNTS),
    ("least_turn", pa.int64()), ("greatest_turn", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string())), ("texts", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
])
_SEGMENTS_SQL = (
    f"conv_id bigint, part int, seg bigint, whole boolean, {', '.join(f'{c} bigint' for c in _COUNTS)}, least_turn bigint, greatest_turn bigint, "
    "first_initial string, last_initial string, costs array<bigint>, edits array<string>, texts array<struct<role:string,text:string>>"
)


def _segment(conv_id, part: int, seg: int, whole: bool, rows: list[tuple]) -> dict:
    """One segment's counts and searches; ``rows`` holds (turn, role, text, duplicate)."""
    initials = [r[1][:1] for r in rows]
    faults = [fault_of(r[2], r[3]) for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    if whole:
        found = [_Search(initials, faults).run(0)]
    else:
        by_end = [_Search(initials, faults, end) for end in range(4)]
        found = [by_end[end].run(start) for start in range(4) for end in range(4)]
    return {
        "conv_id": conv_id, "part": part, "seg": seg, "whole": whole, "rows": len(rows),
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "turns": len(set(turns)), "least_turn": turns[0] if turns else None, "greatest_turn": turns[-1] if turns else None,
        "first_initial": initials[0], "last_initial": initials[-1],
        "costs": [f and f[0] for f in found], "edits": [f and f[1] for f in found], "texts": [{"role": r[1], "text": r[2]} for r in rows],
    }


def _cut(batches: Iterator[pa.RecordBatch], segment_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows to segments. The first and the last conversation of a partition may go on in its neighbours."""
    part, seg, out, chars = TaskContext.get().partitionId(), 0, [], 0
    held: list[tuple] = []
    held_chars, conv, begun, cut = 0, None, False, True  # cut: the conversation does not lie whole in ``held``

    def close(whole: bool) -> None:
        nonlocal seg, held, held_chars, chars
        out.append(_segment(conv, part, seg, whole, held))
        seg, chars, held, held_chars = seg + 1, chars + held_chars, [], 0

    for batch in batches:
        for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "duplicate"))):
            if not begun or conv_id != conv:
                if held:
                    close(not cut)
                cut, conv, begun = not begun, conv_id, True
            elif len(held) >= segment_rows or held_chars >= SEGMENT_CHARS:
                cut = True
                close(False)
            held.append(tuple(row))
            held_chars += len(row[2])
            if len(out) >= 1024 or chars >= 2 * SEGMENT_CHARS:
                yield pa.RecordBatch.from_pylist(out, _SEGMENTS)
                out, chars = [], 0
    if held:
        close(False)
    if out:
        yield pa.RecordBatch.from_pylist(out, _SEGMENTS)


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            some = batch.slice(i, 64)
            yield from zip(*(some.column(c).to_pylist() for c in columns))


#: Least cost from each state to the end of a conversation, after its last row, and the letters.
_CLOSE = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def _to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation from the last: the least cost from each state after the segment to the end."""
    conv, begun, after, out = None, False, [], []
    schema = pa.schema([("part", pa.int32()), ("seg", pa.int64()), ("to_go", pa.list_(pa.int64())), ("is_last", pa.bool_())])
    for conv_id, part, seg, costs in _rows(batches, ["conv_id", "part", "seg", "costs"]):
        new = not begun or conv_id != conv
        if new:
            conv, begun, after = conv_id, True, [c for c, _ in _CLOSE]
        out.append({"part": part, "seg": seg, "to_go": after, "is_last": new})
        cost = [_NEVER if c is None else c for c in costs]
        after = [min(_NEVER, min(cost[4 * s + e] + after[e] for e in range(4))) for s in range(4)]
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


_CHOSEN = pa.schema([("part", pa.int32()), ("seg", pa.int64()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation from the first: the least edits among those on a cheapest path."""
    conv, begun, state, out = None, False, 0, []
    for conv_id, part, seg, costs, edits, to_go, is_last in _rows(batches, ["conv_id", "part", "seg", "costs", "edits", "to_go", "is_last"]):
        if not begun or conv_id != conv:
            conv, begun, state = conv_id, True, 0
        ways = [(costs[4 * state + e] + to_go[e], edits[4 * state + e], e) for e in range(4) if costs[4 * state + e] is not None]
        _, audit, end = min(ways)
        cost, more = (costs[4 * state + end], "") if not is_last else (costs[4 * state + end] + _CLOSE[end][0], _CLOSE[end][1])
        out.append({"part": part, "seg": seg, "state": state, "cost": cost, "audit": audit + more})
        state = end
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, _CHOSEN)
            out = []
    yield pa.RecordBatch.from_pylist(out, _CHOSEN)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            texts, audits, states = (some.column(c).to_pylist() for c in ("texts", "audit", "state"))
            done = [apply_edits([(t["role"], t["text"]) for t in ts], a, s)[0] for ts, a, s in zip(texts, audits, states)]
            columns = [some.column(c) for c in some.schema.names if c != "texts"]
            columns.append(pa.array([[{"role": r, "text": t} for r, t in rows] for rows in done], kind))
            yield pa.RecordBatch.from_arrays(columns, names=[*(c for c in some.schema.names if c != "texts"), "repaired"])


def repair_conversations(turns: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Segments of the repaired conversations of ``turns(conv_id, turn, role, text)``, in order of (part, seg).

    Each holds its counts, its edits' letters (``audit``) and ``cost``, and the ``repaired`` (role, text) rows.
    ``whole`` marks a conversation that is one segment.
    """
    rows = written(turns.select(
        F.monotonically_increasing_id().alias("id"), F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    ), "turns")
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    order = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn", "id")
    firsts = rows.select("conv_id", same.alias("same"), order.alias("order")).groupBy("conv_id", "same").agg(F.min("order").alias("order"))
    firsts = firsts.select(F.col("order.id").alias("id"), F.lit(True).alias("is_first"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("id")]
    marked = rows.join(firsts, "id", "left").withColumn("duplicate", F.col("is_first").isNull()).drop("is_first")
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("id")
    segments = written(ordered.mapInArrow(partial(_cut, segment_rows=segment_rows), _SEGMENTS_SQL), "segments")

    whole = segments.filter("whole").withColumns({"state": F.lit(0), "cost": F.col("costs")[0], "audit": F.col("edits")[0]})
    parts = segments.filter("NOT whole")
    narrow = parts.select("conv_id", "part", "seg", "costs", "edits")
    latest = narrow.select("conv_id", "part", "seg", "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seg"))
    to_go = latest.mapInArrow(_to_go, "part int, seg bigint, to_go array<bigint>, is_last boolean")
    chosen = (
        narrow.join(to_go, ["part", "seg"]).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
        .mapInArrow(_choose, "part int, seg bigint, state int, cost bigint, audit string")
    )
    columns = ["conv_id", "part", "seg", "whole", *_COUNTS, "least_turn", "greatest_turn", "first_initial", "last_initial", "state", "cost", "audit"]
    done = whole.select(*columns, "texts").unionByName(parts.join(chosen, ["part", "seg"]).select(*columns, "texts"))
    kinds = {f.name: f.dataType.simpleString() for f in done.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", repaired array<struct<role:string,text:string>>"
    return done.mapInArrow(_repaired, schema)


def repaired_turns(segments: DataFrame) -> DataFrame:
    """One row per repaired turn: conv_id, part, seg, place (their order), role, text."""
    return segments.select("conv_id", "part", "seg", F.posexplode("repaired").alias("place", "r")).select("conv_id", "part", "seg", "place", "r.role", "r.text")


_SUMMARY = pa.schema([
    ("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation in order to one row: one segment, the audit's letters and a running digest are held."""
    names = ["conv_id", *_COUNTS, "least_turn", "greatest_turn", "first_initial", "last_initial", "cost", "audit", "repaired"]
    now = None

    def close() -> pa.RecordBatch:
        gaps = now["high"] - now["low"] + 1 - now["turns"] if now["low"] is not None else 0
        row = {"gaps": gaps, "audit": "".join(now["audits"]), "repaired_sha256": now["digest"].hexdigest()}
        return pa.RecordBatch.from_pylist([row | {c: now[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}], _SUMMARY)

    for values in _rows(batches, names):
        s = dict(zip(names, values))
        if now is None or now["conv_id"] != s["conv_id"]:
            if now is not None:
                yield close()
            now = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns", "cost"), 0)
            now |= {"conv_id": s["conv_id"], "low": None, "high": None, "last": None, "audits": [], "digest": hashlib.sha256(), "any": False}
        for c in ("blank", "duplicate", "truncated", "illegal", "turns", "cost"):
            now[c] += s[c]
        if now["last"] is not None:
            now["illegal"] += now["last"] + s["first_initial"] not in ("su", "ua", "au")
        now["last"] = s["last_initial"]
        if s["least_turn"] is not None:
            now["turns"] -= now["high"] == s["least_turn"]  # a turn on both sides of the cut
            now["low"] = s["least_turn"] if now["low"] is None else now["low"]
            now["high"] = s["greatest_turn"]
        now["audits"].append(s["audit"])
        for t in s["repaired"]:
            now["digest"].update(("\n" * now["any"] + f"{t['role']}:{t['text']}").encode())
            now["any"] = True
    if now is not None:
        yield close()


def summaries(segments: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, audit and the digest of the repaired rows."""
    segments = written(segments, "repaired")
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    gaps = F.coalesce(F.col("greatest_turn") - F.col("least_turn") + 1 - F.col("turns"), F.lit(0))
    whole = segments.filter("whole").select(
        "conv_id", gaps.cast("bigint").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256")
    )
    parts = segments.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    schema = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return whole.unionByName(parts.mapInArrow(_fold, schema))
