"""Encoding, token files and packing against the library on whole texts."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from acctlens.llm import packing, rans
from acctlens.llm.store import shared_path
from acctlens.llm.token_files import read_token_files, write_token_files
from acctlens.llm.tokens import ChunkEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, " ", "  ", "a  b", " lead", "trail ", "x \n y", "it's we'll", "<|endoftext|> ok", "é z q", "1 2,3 .", "日本 語", "word " * 3000]


def _library():
    return Tokenizer.from_file(PATH)


def _ids(text):
    return [*_library().encode(text or "", add_special_tokens=False).ids, 2]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_stops_and_joined_chunks_equal_the_library():
    r = random.Random(8)
    some = ["word", "Wörter", "日本", "can't", "3.14", "a.b", "x", "…", "(so)", "e\u0301", "\u00a0y", "don't,", "tab\tin", "line\nin", "<|endoftext|>", "Ġ", "\u0120a"]
    texts = [" ".join(r.choice(some) + r.choice(["", ".", ",", "...", "?!", "!" * 50, ";:"]) for _ in range(r.randrange(400))) for _ in range(60)]
    enc = ChunkEncoder(PATH, 300)
    for _ in range(2):  # the second time from a cache that has turned
        ids, sizes = enc.encode(pa.array(texts))
        whole = [e.ids for e in _library().encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in whole]
        assert ids.tolist() == [i for w in whole for i in w]


def test_lines_and_marks_reach_the_library_as_words():
    """Chunks of two lines, and words with any ASCII marks after them, are put together from words that are encoded once."""
    letters = "abcdefghijklmnop"
    words = [a + b + c for a in letters for b in letters for c in "xy"]
    marks = [".", "&&&", "", "$", "%%", "'", '"', ")"]
    chunks = [f"{words[i % 512]}{marks[i // 512]}\n{words[(i + 37 * (i // 512)) % 512]}" for i in range(4096)]
    texts = [" ".join(["a", *chunks[i : i + 64]]) for i in range(0, 4096, 64)]
    enc, given = ChunkEncoder(PATH), 0
    whole = enc._whole

    def counted(some):
        nonlocal given
        given += sum(map(len, some))
        return whole(some)

    enc._whole = counted
    ids, sizes = enc.encode(pa.array(texts))
    plain = [e.ids for e in _library().encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in plain] and ids.tolist() == [i for w in plain for i in w]
    assert given < 5 * (2 * len(words)) < sum(map(len, texts)) / 4


def test_line_breaks_beside_white_space_and_marks():
    r = random.Random(9)
    some = ["a", "Wörter", "日本", "'s", "don't", "x'", "(", "9", "\n", "\n\n", "\r", "\t", "\x1c", "\x85", "\u2028", "\u00a0", "é", "<|endoftext|>", "<|", "&", "."]
    texts = [" ".join("".join(r.choice(some) for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 12))) for _ in range(3000)]
    enc = ChunkEncoder(PATH, 500)
    ids, sizes = enc.encode(pa.array(texts))
    plain = [e.ids for e in _library().encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in plain] and ids.tolist() == [i for w in plain for i in w]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab 'st\n\t.,1é語  <|>"), max_size=40), min_size=1, max_size=6))
def test_chunked_encoding_equals_whole_encoding(texts):
    enc = test_chunked_encoding_equals_whole_encoding.__dict__.setdefault("enc", ChunkEncoder(PATH, 50))
    ids, sizes = enc.encode(pa.array(texts))
    whole = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in whole]
    assert ids.tolist() == [i for w in whole for i in w]


def test_added_tokens_in_a_text_get_their_ids():
    plain = Tokenizer.from_file(PATH)
    texts = ["end <|endoftext|> of", "<|endoftext|>", "a<|endoftext|>b c", "x <|endoftext|>", "<|endoftext| >", "no token here", "", None, "end <|endoftext|> of"]
    ids, sizes = ChunkEncoder(PATH).encode(pa.array(texts))
    whole = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert whole[0] == [437, 220, 50256, 286]
    assert sizes.tolist() == [len(w) for w in whole] and ids.tolist() == [i for w in whole for i in w]


def test_encoder_rejects_other_vocabularies():
    with pytest.raises(ValueError):
        ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 40_000, rans.BLOCK_TOKENS + 5])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50257).astype("<u4")
    assert (rans.decode_segment(rans.encode_segment(ids)) == ids).all()


def test_rans_takes_any_32_bit_ids_and_one_symbol():
    for ids in (np.full(5000, 2**32 - 1, "<u4"), np.array([0, 2**32 - 1, 7] * 99, "<u4")):
        assert (rans.decode_segment(rans.encode_segment(ids)) == ids).all()


def test_rans_notices_damage():
    data = bytearray(rans.encode_segment(np.arange(5000, dtype="<u4")))
    data[-7] ^= 16
    with pytest.raises((ValueError, IndexError)):
        rans.decode_segment(bytes(data))


def test_token_files_round_trip(spark, make_docs):
    rows = [(i * 7 % 40 if i % 9 else None, t) for i, t in enumerate(TEXTS * 3)] + [(5, "same row"), (5, "same row")]
    path = shared_path(spark, "t")
    write_token_files(make_docs(rows), path, PATH, segment_tokens=2000)
    back = sorted(read_token_files(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    start = 0
    for r in back:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), _crc(r.ids))
        start += r.n_tokens
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in back) == collections.Counter((i, tuple(_ids(t))) for i, t in rows)
    assert spark.read.parquet(path).count() > 3


def test_token_files_of_an_empty_table(spark, make_docs):
    path = shared_path(spark, "t")
    write_token_files(make_docs([]), path, PATH)
    assert read_token_files(spark, path).collect() == []


def _bfd(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_length_and_few_sequences(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, r.choice([30, 400, 1024])) for _ in range(r.choice([1, 40, 700]))]
    counts, used = collections.Counter(lengths), collections.Counter()
    planned = packing.plan(counts)
    for sequence, n in planned:
        assert n > 0 and sum(sequence) <= 1024
        for x in sequence:
            used[x] += n
    assert used == counts
    assert sum(n for _, n in planned) <= 1.02 * _bfd(lengths, 1024) + 1


def test_plan_consumes_exact_complements_first():
    assert sorted(packing.plan({1000: 2, 24: 1, 14: 1, 10: 1})) == [((1000, 14, 10), 1), ((1000, 24), 1)]
    assert packing.plan({900: 1, 100: 1, 20: 1, 4: 1}) == [((900, 100, 20, 4), 1)] or sum(n for _, n in packing.plan({900: 1, 100: 1, 20: 1, 4: 1})) == 1
    assert packing.plan({512: 4}) == [((512, 512), 2)]
    assert packing.plan({}) == []


def test_packed_documents_are_gapless(spark, make_docs):
    rows = [(i if i % 6 else None, t) for i, t in enumerate(TEXTS * 4)]
    got = packing.pack_documents(make_docs(rows), PATH, keep_ids=True).collect()
    by_row = collections.defaultdict(list)
    for p in got:
        by_row[p.row_id].append(p)
    whole = collections.Counter()
    for pieces in by_row.values():
        pieces.sort(key=lambda p: p.piece)
        ids = [i for p in pieces for i in p.ids]
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert all(p.length == 1024 for p in pieces[1:]) and len(pieces) == -(-len(ids) // 1024)
        assert all(p.ids_crc32 == _crc(p.ids) for p in pieces)
        whole[pieces[0].doc_id, tuple(ids)] += 1
    assert whole == collections.Counter((i, tuple(_ids(t))) for i, t in rows)
    sequences = collections.defaultdict(list)
    for p in got:
        sequences[p.sequence_id].append((p.offset, p.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(p.length for p in got) // 1024) + 2


def test_packing_an_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), PATH).collect() == []
