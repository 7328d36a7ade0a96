"""Static range asymmetric numeral system over token ids, in numpy.

A segment holds one frequency table shared by several independent blocks. A block's tokens lie in
rows of ``LANES`` interleaved lanes, each with a 64-bit state that gives off 32-bit words. Every
``CHECKPOINT_STEPS`` rows the states of all lanes and the place in the word stream are kept, so each
part of a block between two checkpoints can be decoded by itself: the decoder runs all parts of all
blocks at once. A crc32 of each block's ids guards the result.

Layout, little-endian: magic, then uint64 n, blocks, rows per block, symbols, size of the packed
table; the zlib-packed table (uint32 symbols as differences, uint32 frequencies); uint32 words of each
block; uint32 crc32 of each block; per block and checkpoint uint32 word place, then uint64 states; the words.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"RANS1\0\0\0"
SCALE = 18  # frequencies of a table sum to 2**SCALE
LANES = 128
BLOCK_TOKENS = 1 << 17
CHECKPOINT_STEPS = 256
_LOW = np.uint64(1 << 31)  # a state stays in [2**31, 2**63)
_U32 = np.uint64(32)
_SCALE = np.uint64(SCALE)
_MASK = np.uint64((1 << SCALE) - 1)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and their frequencies, each at least 1, scaled to sum to 2**SCALE."""
    symbols, counts = np.unique(ids, return_counts=True)
    if len(symbols) > 1 << (SCALE - 1):
        raise ValueError(f"{len(symbols)} distinct ids in a segment; a table holds {1 << (SCALE - 1)}")
    room = (1 << SCALE) - len(symbols)
    freqs = 1 + counts.astype(np.int64) * room // max(1, int(counts.sum()))
    freqs[np.argmax(counts)] += (1 << SCALE) - int(freqs.sum())
    return symbols.astype(np.uint32), freqs.astype(np.uint32)


def encode_segment(ids: np.ndarray) -> bytes:
    n = len(ids)
    if not n:
        return MAGIC + np.zeros(5, "<u8").tobytes()
    symbols, freqs = frequency_table(ids)
    blocks = -(-n // BLOCK_TOKENS)
    rows = -(-n // (blocks * LANES))
    padded = np.full(blocks * rows * LANES, ids[0], "<u4")
    padded[:n] = ids
    index = np.searchsorted(symbols, padded).reshape(blocks, rows, LANES)
    f_of = freqs.astype(np.uint64)
    c_of = np.cumsum(f_of) - f_of
    x = np.full((blocks, LANES), _LOW)
    marks, words, of_block = [], [], []
    given = np.zeros(blocks, np.int64)
    top = np.uint64(63 - SCALE)
    lane_of = np.repeat(np.arange(blocks, dtype=np.uint16), LANES).reshape(blocks, LANES)
    for row in range(rows - 1, -1, -1):
        s = index[:, row, :]
        f = f_of[s]
        full = x >= (f << top)
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        of_block.append(lane_of[full])
        given += full.sum(1)
        x = np.where(full, x >> _U32, x)
        q = x // f
        x = (q << _SCALE) + (x - q * f) + c_of[s]
        if row % CHECKPOINT_STEPS == 0:
            marks.append((given.copy(), x.copy()))
    stream = np.concatenate(words[::-1])
    stream = stream[np.argsort(np.concatenate(of_block[::-1]), kind="stable")]
    marks.reverse()
    packed = zlib.compress(np.concatenate([np.diff(symbols, prepend=np.uint32(0)), freqs]).astype("<u4").tobytes(), 6)
    head = np.array([n, blocks, rows, len(symbols), len(packed)], "<u8").tobytes()
    crcs = np.array([_crc(padded[i * rows * LANES : min(n, (i + 1) * rows * LANES)]) for i in range(blocks)], "<u4")
    places = np.stack([given - g for g, _ in marks], 1).astype("<u4")
    states = np.stack([s for _, s in marks], 1).astype("<u8")
    return b"".join((MAGIC, head, packed, given.astype("<u4").tobytes(), crcs.tobytes(), places.tobytes(), states.tobytes(), stream.tobytes()))


def decode_segment(data: bytes) -> np.ndarray:
    """The ids; raises ValueError if a block's checksum does not hold."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token segment")
    at = len(MAGIC)
    n, blocks, rows, n_symbols, packed = np.frombuffer(data, "<u8", 5, at).astype(np.int64).tolist()
    if not n:
        return np.zeros(0, "<u4")
    at += 40
    table = np.frombuffer(zlib.decompress(data[at : at + packed]), "<u4")
    symbols, freqs = np.cumsum(table[:n_symbols], dtype=np.uint32), table[n_symbols:].astype(np.uint64)
    cums = np.cumsum(freqs) - freqs
    symbol_at = np.repeat(np.arange(n_symbols, dtype=np.uint32), freqs.astype(np.int64))
    at += packed
    given = np.frombuffer(data, "<u4", blocks, at).astype(np.int64)
    crcs = np.frombuffer(data, "<u4", blocks, at + 4 * blocks)
    at += 8 * blocks
    parts = -(-rows // CHECKPOINT_STEPS)
    places = np.frombuffer(data, "<u4", blocks * parts, at).astype(np.int64).reshape(blocks, parts)
    at += 4 * blocks * parts
    x = np.frombuffer(data, "<u8", blocks * parts * LANES, at).astype(np.uint64).reshape(blocks * parts, LANES)
    at += 8 * blocks * parts * LANES
    words = np.append(np.frombuffer(data, "<u4", int(given.sum()), at), np.uint32(0)).astype(np.uint64)
    place = (places + (np.cumsum(given) - given)[:, None]).reshape(-1)
    steps = np.tile(np.minimum(CHECKPOINT_STEPS, rows - CHECKPOINT_STEPS * np.arange(parts)), blocks)
    out = np.zeros((blocks * parts, CHECKPOINT_STEPS, LANES), np.uint32)
    on = np.arange(blocks * parts)
    for step in range(int(steps.max())):
        if (keep := steps[on] > step).sum() < len(on):
            on, x, place = on[keep], x[keep], place[keep]
        slot = x & _MASK
        s = symbol_at[slot]
        out[on, step] = s
        x = freqs[s] * (x >> _SCALE) + slot - cums[s]
        low = x < _LOW
        taken = np.cumsum(low, 1)
        x = np.where(low, (x << _U32) | words[np.where(low, place[:, None] + taken - 1, 0)], x)
        place = place + taken[:, -1]
    ids = symbols[out.reshape(blocks, parts * CHECKPOINT_STEPS, LANES)[:, :rows]].reshape(-1)[:n].astype("<u4")
    for i in range(blocks):
        if _crc(ids[i * rows * LANES : (i + 1) * rows * LANES]) != crcs[i]:
            raise ValueError(f"block {i} of a token segment is damaged")
    return ids
