"""Merge tables of byte-pair vocabularies, and the splitting of texts into parts that merges never cross.

Both byte-level tokenizers split a text by the same pattern before they merge. A single space or line feed between other
characters always begins a match, and marks behind a run of letters are a match by themselves. So Arrow cuts texts there
and numbers the distinct parts; a worker remembers what became of each part. Texts with other white space go through the
pattern whole.
"""

from __future__ import annotations

import base64
import json
import string
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Rank of a pair that doesn't merge.
NEVER = np.int64(1 << 40)
#: Words that a worker remembers in each of two generations (about 200 bytes each), and that are learned at a time.
MEMORY, CALL = 250_000, 16_384
#: Marks that may stand behind a run of letters and are never merged with it; an apostrophe may be.
MARKS = string.punctuation.replace("'", "")
#: White space except line feeds.
_W = r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairTable:
    """(left id, right id) -> rank and merged id, by open addressing in flat arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(len(left) * 3).bit_length())
        size = 1 << self.bits
        self.keys, self.rank, self.merged = np.full(size, _EMPTY), np.full(size, NEVER), np.zeros(size, np.int64)
        keys = self._key(left, right)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = keys[todo[free]]  # of several that want a slot, the last gets it
            won = self.keys[at] == keys[todo]
            self.rank[at[won]], self.merged[at[won]] = rank[todo[won]], merged[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & (size - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; rank[slot] is NEVER where the pair doesn't merge."""
        keys = self._key(left, right)
        at, size = self._slot(keys), len(self.keys)
        todo = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != _EMPTY))
        while len(todo):
            at[todo] = (at[todo] + 1) & (size - 1)
            todo = todo[(self.keys[at[todo]] != keys[todo]) & (self.keys[at[todo]] != _EMPTY)]
        return at


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    for b in range(256):
        if chr(b) not in letters or letters[chr(b)] != b:
            letters[chr(256 + len(letters) - len(plain))] = b
    return letters


@lru_cache(maxsize=2)
def merge_list(path: str) -> tuple[PairTable, np.ndarray, list[str]]:
    """Of a byte-level tokenizer file: its merges by their order in the list, the id of each byte, its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ids = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in pairs], np.int64).reshape(-1, 3)
    of_byte = np.zeros(256, np.int64)
    for letter, b in byte_letters().items():
        of_byte[b] = vocab[letter]
    return PairTable(ids[:, 0], ids[:, 1], np.arange(len(ids)), ids[:, 2]), of_byte, [t["content"] for t in spec["added_tokens"]]


@lru_cache(maxsize=2)
def rank_file(path: str) -> tuple[PairTable, np.ndarray, dict[bytes, int], list[bytes]]:
    """Of a rank file: every pair of tokens whose bytes joined are a token, by its rank; byte ids, ranks, tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    ids = np.array(pairs, np.int64).reshape(-1, 3)
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    return PairTable(ids[:, 0], ids[:, 1], ids[:, 2], ids[:, 2]), np.array([ranks[bytes([b])] for b in range(256)], np.int64), ranks, tokens


@lru_cache(maxsize=4)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


class Known:
    """Words and their ids, end to end in one array."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.first, self.many, self.flat, self.size = array("q"), array("q"), [], 0

    def put(self, words: list[str], ids: np.ndarray, many: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.first), len(self.first) + len(words)), strict=True))
        self.first.extend((self.size + np.cumsum(many) - many).tolist())
        self.many.extend(many.tolist())
        self.flat.append(ids)
        self.size += len(ids)

    def places(self, words: list[str]) -> np.ndarray:
        """The number of each word, -1 for an unknown one."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where those of the words at these places begin and how many they are."""
        self.flat = [np.concatenate([np.zeros(0, "<u4"), *self.flat])]
        # Copies: an array that a view of it has exported can't grow.
        return self.flat[0], np.array(self.first, np.int64)[places], np.array(self.many, np.int64)[places]


def gather(flat: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of flat end to end, and the places where each begins and the last ends."""
    ends = np.append(0, np.cumsum(many))
    return flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], many)], ends


class Memory:
    """The ids of words, kept between the batches of a Python worker in two generations: what is asked for again moves
    to the younger one. learn(words, plain) gives the ids of new words, end to end, and their numbers."""

    def __init__(self, learn: Callable[[list[str], bool], tuple[np.ndarray, np.ndarray]], call: int = CALL):
        self.learn, self.call, self.now, self.before = learn, call, Known(), Known()

    def of(self, words: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words, and which of them are plain: as Known.at gives it."""
        places = self.now.places(words)
        if (places < 0).sum() + len(self.now.place) > MEMORY and self.now.place:
            self.now, self.before, places = Known(), self.now, np.full(len(words), -1)
        new = np.flatnonzero(places < 0)
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            old = self.before.places(fresh)
            if (old >= 0).any():
                ids, ends = gather(*self.before.at(old[old >= 0]))
                self.now.put([fresh[k] for k in np.flatnonzero(old >= 0).tolist()], ids, np.diff(ends))
            for kind in (True, False):
                todo = [fresh[k] for k in np.flatnonzero((old < 0) & (plain[new] == kind)).tolist()]
                for i in range(0, len(todo), self.call):
                    part = todo[i : i + self.call]
                    self.now.put(part, *self.learn(part, kind))
            places[new] = self.now.places(fresh)
        return self.now.at(places)


def without_marks(words: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Words without the marks behind them, whether that is a run of letters, and the marks (empty behind others)."""
    core = pc.utf8_rtrim(words, characters=MARKS)
    letters = pc.utf8_is_alpha(core).to_numpy(zero_copy_only=False)
    n = np.where(letters, pc.subtract(pc.binary_length(words), pc.binary_length(core)).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    offsets = np.frombuffer(words.buffers()[1], "<i4")[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data, ends = gather(np.frombuffer(words.buffers()[2] or b"", np.uint8), offsets[1:] - n, n)
    return core, letters, pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])


def byte_level_parts(texts: pa.Array, find: Callable[[str], list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of texts, none null: distinct parts; which of them are surely one match of the pattern; the parts of all texts by
    number, end to end; and where each text begins in that and the last ends."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    words, offsets = lists.flatten().dictionary_encode(), lists.offsets.to_numpy().astype(np.int64)
    offsets, which, distinct = offsets - offsets[0], words.indices.to_numpy(), words.dictionary
    odd = pc.match_substring_regex(distinct, f"^$|^\\n[\\n{_W}]|^[{_W}]|[\\n{_W}]$").to_numpy(zero_copy_only=False)
    whole = np.logical_or.reduceat(odd[which], offsets[:-1]) if len(texts) else np.zeros(0, bool)
    # The first word of a text has no space before it, and a word behind a line feed neither.
    lead, at = np.unique(which[offsets[:-1]], return_inverse=True)
    feed = pc.starts_with(distinct, "\n").to_numpy(zero_copy_only=False)
    base = pa.concat_arrays([pc.if_else(pa.array(feed), pc.utf8_slice_codeunits(distinct, 1), distinct), distinct.take(pa.array(lead))])
    which = which.astype(np.int64)
    which[offsets[:-1]] = len(distinct) + at
    spaced, feed = np.append(~feed, np.zeros(len(lead), bool)), np.append(feed, np.zeros(len(lead), bool))
    core, letters, marks = without_marks(base)
    first = pc.if_else(pa.array(letters), core, base)
    first = pc.if_else(pa.array(spaced), pc.binary_join_element_wise(" ", first, ""), first)
    split = {int(k): find(texts[k].as_py()) for k in np.flatnonzero(whole)}
    pieces = [x for s in split.values() for x in s]
    every = pa.concat_arrays([first, marks, pa.array(["\n", *pieces], pa.string())]).dictionary_encode()
    number, n = every.indices.to_numpy().astype(np.int64), len(base)
    plain = np.zeros(len(every.dictionary), bool)
    plain[number[:n][letters]], plain[number[n:]] = True, True
    three = np.stack([np.where(feed, number[2 * n], -1), number[:n], np.where(pc.binary_length(marks).to_numpy(zero_copy_only=False) > 0, number[n : 2 * n], -1)], 1)
    keep = np.repeat(~whole, np.diff(offsets))
    placed = three[np.where(keep, which, 0)]
    placed[~keep] = -1
    if not split:
        ends = np.append(0, np.cumsum((placed >= 0).sum(axis=1)))[offsets]
        return every.dictionary.to_pylist(), plain, placed[placed >= 0], ends
    sizes = np.add.reduceat((placed >= 0).sum(axis=1), offsets[:-1])
    sizes[list(split)] = [len(s) for s in split.values()]
    ends = np.append(0, np.cumsum(sizes))
    out, own = np.empty(ends[-1], np.int64), np.repeat(whole, sizes)
    out[~own], out[own] = placed[placed >= 0], number[2 * n + 1 :]
    return every.dictionary.to_pylist(), plain, out, ends


def arrow_slices(texts: pa.Array, chars: int = 8_000_000):
    """texts, none null, in consecutive slices of about that many bytes."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = int(sizes[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + chars)))
        yield texts[start:stop]
        start = stop
