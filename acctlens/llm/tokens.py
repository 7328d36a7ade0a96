"""Byte-level BPE encoding of whole texts inside Arrow tasks.

The ids are those of the ``tokenizers`` library on the whole text with
``add_special_tokens=False``. A byte-level BPE never merges across the pieces
its pre-tokenizer cuts, and the pre-tokenizer always cuts before a single
space that stands between two characters that are not white space. So a text
is the sequence of its space-separated chunks, each encoded with its leading
space, and every distinct chunk of a batch is encoded once by the library, thousands of
them in one call.
A chunk of lines is parted at its line breaks, and ASCII marks after a word are a piece of their own, so that
mostly words are looked up and encoded, whatever stands around them.
A text with white space beside one of its spaces (two spaces, a space before
a line break, ...) has no such cuts there and is encoded whole, and so is a text that
holds the string of one of the vocabulary's added tokens: the library gives it that token's id.

``ChunkEncoder`` keeps the chunks it has seen in a bounded cache; the cache
changes speed only.
"""

from __future__ import annotations

import functools
import os
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks in each of a worker's two generations, about 160 MB.
CACHE_CHUNKS = 800_000
#: Texts of a batch are encoded in slices of about this many bytes, which bounds the arrays made for them.
SLICE_BYTES = 4 << 20
END_ID = 2


#: New chunks are handed to the library in texts of about this many characters.
JOINED_CHARS = 1 << 12
#: What may follow a word in its chunk and is then a piece of its own.
STOPS = string.punctuation
#: The letter that stands for a space in byte-level vocabularies, a fixed value.
SPACE = "\u0120"
_PROBE = "It's 12 o'clock,\tdéjà vu:\n\n3.14 «ça» we'll\u00a0see... 100,000 \U0001f600x end"


class _Cache:
    """Two generations of a dict: a full young one becomes the old one, and what is still used comes back."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get_all(self, keys: list) -> list:
        """Values of ``keys``, None where unknown."""
        found = list(map(self.young.get, keys))
        if self.old:
            old = self.old.get
            for i in [i for i, v in enumerate(found) if v is None]:
                if (v := old(keys[i])) is not None:
                    found[i] = self.young[keys[i]] = v
        return found

    def turn(self, new: int) -> None:
        """Called before ``new`` entries come in."""
        if len(self.young) + new > self.size:
            self.old, self.young = self.young, {}


class ChunkEncoder:
    def __init__(self, tokenizer_path: str, cache_chunks: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(names.values()) + 1, bool)  # ids that begin with a space
        self.spaced[[i for name, i in names.items() if name.startswith(SPACE)]] = True
        self.tails: dict[str, bytes] = {}  # runs of stops
        self.heads = _Cache(cache_chunks // 8)  # what follows a line break, without a space before it -> ids
        self.chunks = _Cache(cache_chunks)  # chunk without its leading space -> ids; empty: needs its neighbours
        spaces = int(self.spaced[self._whole([_PROBE])[0]].sum())
        if spaces != _PROBE.count(" ") or self.encode(pa.array([_PROBE]))[0].tolist() != self._whole([_PROBE])[0].tolist():
            raise ValueError(f"{tokenizer_path} is not a byte-level BPE with the usual pre-tokenizer")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _stands_alone(self, word: str) -> bool:
        return bool(word) and not word[0].isspace() and not word[-1].isspace() and not any(token in word for token in self.added)

    def _alone(self, words: list[str]) -> list[bytes]:
        """Ids of chunks that stand alone, many at a time: joined by spaces, each begins at the next id that begins with a space."""
        out: list[bytes] = []
        at = 0
        while at < len(words):
            upto, size = at, 0
            while upto < len(words) and size < JOINED_CHARS:
                size += len(words[upto]) + 1
                upto += 1
            ids = self._whole([" " + " ".join(words[at:upto])])[0]
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == upto - at and starts[0] == 0:
                raw, cuts = ids.tobytes(), (4 * starts).tolist()
                out += [raw[x:y] for x, y in zip(cuts, [*cuts[1:], len(raw)])]
            else:  # an added token that spans chunks, say
                out += [ids.tobytes() for ids in self._whole([" " + w for w in words[at:upto]])]
            at = upto
        return out

    def _stops(self, tails: set[str]) -> None:
        """Sees to it that ``tails`` has these runs."""
        if len(self.tails) > 10_000:
            self.tails.clear()
        new = list(tails - self.tails.keys())
        self.tails.update(zip(new, (ids.tobytes() for ids in self._whole(new))))

    def _heads(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that begin a line: no space stands before them."""
        keys = list(words)
        found = self.heads.get_all(keys)
        if missing := [k for k, v in zip(keys, found) if v is None]:
            self.heads.turn(len(missing))
            self.heads.young.update(zip(missing, (ids.tobytes() for ids in self._whole(missing))))
            found = [self.heads.young[k] if v is None else v for k, v in zip(keys, found)]
        return dict(zip(keys, found))

    def _encode_missing(self, words: list[str], at: list[int], blobs: list) -> None:
        """New chunks: a word with stops after it is the word and the stops, lines are parted at their break, others go to the library whole.

        A single line break between two characters that are not white space is a piece of its own.
        """
        self.chunks.turn(2 * len(at))
        young, old = self.chunks.young, self.chunks.old
        new: dict[str, None] = {}
        stopped: list[tuple[str, str, str]] = []
        lined: list[tuple[int, list[str]]] = []
        todo: list[str] = []
        for i in at:
            word = words[i]
            if "\n" in word and (lines := word.split("\n")) == word.split():  # line breaks are its only white space
                lined.append((i, lines))
                continue
            todo.append(word)
        firsts = list({lines[0] for _, lines in lined} - set(todo))
        todo += [word for word, known in zip(firsts, self.chunks.get_all(firsts)) if known is None]
        for word in todo:
            if word.isalnum():
                new[word] = None
            elif (core := word.rstrip(STOPS)).isalpha():
                stopped.append((word, core, word[len(core) :]))
                if core not in young:
                    if (known := old.get(core)) is not None:
                        young[core] = known
                    else:
                        new[core] = None
            elif self._stands_alone(word):
                new[word] = None
            else:
                young[word] = b""
        young.update(zip(new, self._alone(list(new))))
        later = [[(line[: len(core)], line[len(core) :]) if (core := line.rstrip(STOPS)).isalpha() else (line, "") for line in lines[1:]] for _, lines in lined]
        self._stops({tail for _, _, tail in stopped} | {tail for parts in later for _, tail in parts} | {"\n"})
        tails, heads = self.tails, self._heads({head for parts in later for head, _ in parts})
        for word, core, tail in stopped:
            young[word] = young[core] + tails[tail]
        for i in at:
            blobs[i] = young.get(words[i])
        for (i, lines), parts in zip(lined, later):
            blobs[i] = young[lines[0]] + b"".join([tails["\n"] + heads[head] + tails[tail] for head, tail in parts])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (uint32), and the number of ids of each; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(np.asarray(pc.binary_length(texts)))
        ids, sizes, at = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            some_ids, some_sizes = self._encode_slice(texts.slice(at, upto - at))
            ids.append(some_ids)
            sizes.append(some_sizes)
            at = upto
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        chunks = pc.split_pattern(texts, " ")
        per_text = np.asarray(pc.list_value_length(chunks)).astype(np.int64)
        flat = chunks.flatten().dictionary_encode()
        codes = np.asarray(flat.indices)
        words = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        blobs = self.chunks.get_all(words)
        missing = [i for i, b in enumerate(blobs) if b is None]
        if missing:
            self._encode_missing(words, missing, blobs)
        lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        ids = np.frombuffer(b"".join(blobs), "<u4")
        starts = np.cumsum(lengths) - lengths
        first = np.cumsum(per_text) - per_text  # position of each text's first chunk
        counts = lengths[codes]
        # texts to encode whole: those with a chunk that needs its neighbours (the empty text among them, with no ids)
        bad = np.minimum.reduceat(counts, first) == 0
        for token in self.added:
            bad |= np.asarray(pc.match_substring(texts, token))
        counts[np.repeat(bad, per_text)] = 0
        # the first chunk of a text has no leading space, and is encoded by itself
        counts[first] = 0
        heads = np.flatnonzero(~bad).tolist()
        fronts = flat.dictionary.take(pa.array(codes[first[heads]])).to_pylist() if heads else []
        alone = dict(zip(heads, self._whole(fronts)))
        again = np.flatnonzero(bad).tolist()
        alone.update(zip(again, self._whole(texts.take(pa.array(again, pa.int64())).to_pylist())))
        ends = np.cumsum(counts)
        take = np.repeat(starts[codes] - (ends - counts), counts) + np.arange(int(ends[-1]))
        tail = ids[take]
        tail_ends = np.cumsum(np.add.reduceat(counts, first))
        out, at = [], 0
        for i, end in enumerate(tail_ends.tolist()):
            out += (alone[i], tail[at:end])
            at = end
        sizes = np.diff(tail_ends, prepend=0) + np.fromiter((len(alone[i]) for i in range(n)), np.int64, n)
        return np.concatenate(out), sizes


@functools.lru_cache(maxsize=2)
def encoder(tokenizer_path: str, cache_chunks: int = CACHE_CHUNKS) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary file. A task has one core: the library's own threads would only wait for each other."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(tokenizer_path, cache_chunks)


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same documents, each with ``end_id`` appended."""
    ends = np.cumsum(sizes)
    return np.insert(ids, ends, end_id).astype("<u4"), sizes + 1
