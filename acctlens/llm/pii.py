"""Personal data: base patterns, and spans added by a character-level BiLSTM with CRF transitions.

Base spans come from fixed patterns and checks (``base_spans``) and always stay. They also label the
training data: windows of a bounded sample of documents (``MAX_DOCS`` rows, ``MAX_WINDOWS`` windows, around at
most ``PLACES_PER_TEXT`` places of a text, drawn by hash),
with the spans rewritten into forms the patterns do not know (a phone number without its country code, a
mail address with "(at)" and "(dot)"). The tagger (``bilstm_crf``) is trained in numpy from these.

Tagging: a span of any kind holds a digit, an @ or a bracketed "at", so the surroundings (``REACH``
characters to both sides, merged where they meet) of every such place of the whole text are decoded, each
by one Viterbi path; elsewhere nothing can be found. The emissions of a region longer than ``PIECE`` come
from overlapping pieces that are joined in the middle of their overlaps. So no edge cuts a span that ends
within ``REACH`` of its digit, @ or "at". Of all spans of a document the set without overlaps of the
greatest total is taken. Added spans touch no base span and pass their kind's check. Beside the sorting of its
spans, a text takes time in proportion to its length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.bilstm_crf import BiLstmCrf, classes
from acctlens.llm.sample import sample_ids

KINDS = ("email", "ip", "card", "phone")
#: REACH is beyond the 64 characters of a mail address's local part, however far its domain's dots are spelled out.
WINDOW, REACH = 64, 128
PIECE, PIECE_STRIDE = 512, 256
MAX_DOCS, MAX_WINDOWS = 8_000, 1_200
PLACES_PER_TEXT = 64
MIN_MARGIN = 3.0
BATCH_PLACES = 1 << 18

Span = tuple[int, int, int]  # start, kind, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits that fails from its first digit fails from all: the look-behind skips the others
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[] ?at ?[)\]]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and without overlap per kind, by start and kind; failing matches are dropped."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _is_ip(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def plausible(kind: int, text: str) -> bool:
    """The check of an added span's text."""
    if kind == 0:
        return bool(re.search(r"@|[(\[] ?at ?[)\]]", text, re.IGNORECASE)) and text[0].isalnum() and text[-1].isalnum() and "\n" not in text
    if kind == 1:
        return bool(re.fullmatch(_IP.pattern, text)) and _is_ip(text)
    if kind == 2:
        return bool(re.fullmatch(_CARD.pattern, text)) and 12 <= len(d := _digits(text)) <= 19 and luhn(d)
    return bool(re.fullmatch(r"[+(0-9][\x20().0-9-]+[0-9]", text)) and 10 <= len(_digits(text)) <= 15


def _regions(text: str) -> list[tuple[int, int]]:
    """The surroundings of all places that can belong to a span, merged."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


class _Covered:
    """The places that some of the sorted ``spans`` cover, as stretches that can be searched."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, _, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        """Whether a place of [a, b) is covered."""
        i = bisect_left(self.starts, b) - 1
        return i >= 0 and self.ends[i] > a


def _pieces(a: int, b: int) -> list[tuple[int, int, int, int]]:
    """(start, end, first and end place to keep) of the pieces of a region: each place is kept from one of them."""
    starts = [a] if b - a <= PIECE else [*range(a, b - PIECE, PIECE_STRIDE), b - PIECE]
    ends = [min(x + PIECE, b) for x in starts]
    joints = [a, *((x + y) // 2 for x, y in zip(starts[1:], ends)), b]
    return list(zip(starts, ends, joints, joints[1:]))


def _batches(lengths: list[int]) -> Iterator[list[int]]:
    """Numbers of rows of like length, together of at most BATCH_PLACES places when padded (one row at least)."""
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if batch and ((len(batch) + 1) * lengths[i] > BATCH_PLACES or lengths[i] > 1.25 * lengths[batch[0]] + 16):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def _decoded(codes: list[np.ndarray], model: BiLstmCrf) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, tags, margins) of each region, one place longer than it."""
    pieces = [(i, *p) for i, code in enumerate(codes) for p in _pieces(0, len(code))]
    merged: list[np.ndarray | None] = [None] * len(codes)
    for batch in _batches([y - x for _, x, y, _, _ in pieces]):
        rows = [pieces[n] for n in batch]
        window = np.zeros((len(rows), rows[-1][2] - rows[-1][1]), np.int64)
        for n, (i, x, y, _, _) in enumerate(rows):
            window[n, : y - x] = codes[i][x:y]
        e = model.emissions(window)
        for n, (i, x, _, first, end) in enumerate(rows):
            if merged[i] is None:
                merged[i] = np.zeros((len(codes[i]), e.shape[2]), e.dtype)
            merged[i][first:end] = e[first - x : end - x, n]
    for batch in _batches([len(c) for c in codes]):
        e = np.full((len(codes[batch[-1]]) + 1, len(batch), merged[batch[0]].shape[1]), -1e4, merged[batch[0]].dtype)
        e[:, :, 0] = 0  # beyond its end a region is outside
        for n, i in enumerate(batch):
            e[: len(codes[i]), n] = merged[i]
        tags, margins = model.best_path(e)
        for n, i in enumerate(batch):
            yield i, tags[n, : len(codes[i]) + 1], margins[n, : len(codes[i]) + 1]


def reconcile(found: dict[Span, float], base: list[Span]) -> list[Span]:
    """The set of ``found`` spans without overlaps, with each other or with ``base``, of the greatest total weight."""
    taken = _Covered(base)
    spans = sorted((s for s in found if not taken.meets(s[0], s[2])), key=lambda s: (s[2], s))
    ends = [s[2] for s in spans]
    best: list[tuple[float, int]] = [(0.0, -1)]  # total, last span taken
    came = [0]
    for i, s in enumerate(spans):
        before = bisect_right(ends, s[0], 0, i)
        total = best[before][0] + found[s]
        if total > best[-1][0]:
            best.append((total, i))
            came.append(before)
        else:
            best.append(best[-1])
            came.append(len(came) - 1 if best[-1][1] < 0 else came[-1])
    out, at = [], len(spans)
    while at and best[at][1] >= 0:
        i = best[at][1]
        out.append(spans[i])
        at = bisect_right(ends, spans[i][0], 0, i)
    return sorted(out)


def added_spans(texts: list[str], base: list[list[Span]], model: BiLstmCrf | None) -> list[list[Span]]:
    """Spans the tagger adds to each text."""
    found: list[dict[Span, float]] = [{} for _ in texts]
    where: list[tuple[int, int]] = []  # text, start of the region
    held: list[np.ndarray] = []

    def flush() -> None:
        for n, tags, margins in _decoded(held, model):
            of, start = where[n]
            text = texts[of]
            for t in np.flatnonzero(tags % 2 == 1).tolist():
                tag, end = int(tags[t]), t + 1
                while tags[end] == tag + 1:
                    end += 1
                x, y, kind = start + t, start + end, (tag - 1) // 2
                margin = float(margins[t : end + 1].sum())  # the step out of the span too
                apart = not (x and text[x - 1].isalnum()) and not (y < len(text) and text[y].isalnum())
                if margin >= MIN_MARGIN and apart and plausible(kind, text[x:y]):
                    found[of][(x, kind, y)] = margin
        where.clear(), held.clear()

    places = 0
    for i, text in enumerate(texts if model else []):
        covered = _Covered(base[i])
        for a, b in _regions(text):
            if all(covered.meets(m.start(), m.start() + 1) for m in _TRIGGER.finditer(text, a, b)):
                continue  # base spans hold all of its triggers, and an added span would need one of its own
            where.append((i, a))
            held.append(classes(text[a:b]))
            places += b - a
            if places >= BATCH_PLACES:
                flush()
                places = 0
    if held:
        flush()
    return [reconcile(f, b) if f else [] for f, b in zip(found, base)]


def _variants(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The labelled window, and its spans rewritten one by one."""
    yield text, spans
    for n, (a, kind, b) in enumerate(spans):
        old, new = text[a:b], []
        if kind == 3:
            new = [re.sub(r"^\+[0-9]{1,3}[\x20.-]?", "", old)]
            new = [v for v in new if plausible(3, v)]
            if new:
                d = _digits(new[0])[-10:]
                new += [f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
        elif kind == 0:
            user, host = old.split("@", 1)
            new = [f"{user}{at}{host if dot == '.' else host.replace('.', dot)}" for at in (" (at) ", "(at)", " [at] ", "[at]", " @ ") for dot in (".", " (dot) ", "[dot]")]
        for v in new:
            shift = len(v) - (b - a)
            moved = [(x, k, y) if m < n else ((a, kind, b + shift) if m == n else (x + shift, k, y + shift)) for m, (x, k, y) in enumerate(spans)]
            yield text[:a] + v + text[b:], moved


def training_windows(text: str) -> list[tuple[str, list[Span]]]:
    """Labelled windows of a text: one around each base span, and one around each other trigger, around at most
    ``PLACES_PER_TEXT`` of them, chosen by hash from the whole text."""
    base = base_spans(text)
    out, seen = [], set()
    centers = [(a + b) // 2 for a, _, b in base]
    covered = _Covered(base)
    centers += [m.start() for m in _TRIGGER.finditer(text) if not covered.meets(m.start(), m.start() + 1)]
    for center in sorted(centers, key=lambda c: zlib.crc32(str(c).encode()))[:PLACES_PER_TEXT]:
        start = max(0, center - 20 - center % 23)
        if start // 16 in seen:
            continue
        seen.add(start // 16)
        window = text[start : start + WINDOW]
        inside = [(a - start, k, b - start) for a, k, b in base if a < start + WINDOW and b > start]
        cut = any(a < 0 or b > len(window) for a, _, b in inside) or any(x[2] > y[0] for x, y in zip(inside, inside[1:]))
        unsure = any(12 <= len(_digits(m.group())) and not any(a <= m.start() < b for a, _, b in inside) for m in _CARD.finditer(window))
        if not cut and not unsure:
            out.append((window, inside))
    return out


def fit(windows: list[tuple[str, list[Span]]], epochs: int = 8, hidden: int = 16) -> BiLstmCrf | None:
    """Train on labelled windows and their variants; None without any span."""
    labelled = [v for w in windows for v in _variants(*w)]  # a variant can be longer than its window
    if not any(s for _, s in labelled):
        return None
    x, y = (np.zeros((len(labelled), max(len(t) for t, _ in labelled)), np.int64) for _ in range(2))
    for i, (text, spans) in enumerate(labelled):
        x[i, : len(text)] = classes(text)
        for a, kind, b in spans:
            y[i, a:b] = 2 + 2 * kind
            y[i, a] = 1 + 2 * kind
    model = BiLstmCrf(len(KINDS), hidden)
    model.losses = model.train(x, y, epochs)
    return model.as_float32()


def train(docs: DataFrame, max_docs: int = MAX_DOCS, max_windows: int = MAX_WINDOWS) -> BiLstmCrf | None:
    """Fit on the windows of at most ``max_docs`` of ``docs(doc_id, text)``, at most ``max_windows`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, ";".join(f"{a},{k},{b}" for a, k, b in s)) for text in batch.column("text") for t, s in training_windows(text.as_py() or "")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["text", "spans"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    sample = texts.join(F.broadcast(sample_ids(texts.select("_id"), max_docs, 8)), "_id").select("text")  # max_docs ids
    windows = sample.mapInArrow(run, "text string, spans string").distinct()
    half = max_windows // 2
    parts = [windows.filter(c).orderBy(F.xxhash64("text"), "text", "spans").limit(half).collect() for c in ("spans <> ''", "spans = ''")]
    return fit([(r[0], [tuple(map(int, s.split(","))) for s in r[1].split(";") if s]) for part in parts for r in part])


SPAN_SCHEMA = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string"


def find_pii(docs: DataFrame, model: BiLstmCrf | None = None) -> DataFrame:
    """Counts of the base spans of each kind, the base spans, and all spans, for every row of ``docs(doc_id, text)``.

    Spans are written kind:start:end (code points, end exclusive), by start and kind, joined by commas. A
    null text is empty and has none; repeated rows and null ids stay; an empty table gives no rows; other
    columns are ignored. Without a model all spans are the base ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, shared.value)
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            written = [pa.array([spans_text(s) for s in spans], pa.string()) for spans in (base, [sorted(b + m) for b, m in zip(base, more)])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, *written], names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SPAN_SCHEMA)


def pii(docs: DataFrame) -> DataFrame:
    """``find_pii`` with a tagger trained on ``docs`` themselves."""
    return find_pii(docs, train(docs))
