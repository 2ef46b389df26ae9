"""Language-model scores from a log-frequency Bloom filter.

Training counts single tokens and pairs of neighbours. A count c is quantised to q = 1 + floor(log_b c), with a fine base
for single tokens and a coarse one for pairs, and the n-gram is put into a Bloom filter once for each level 1 ... q. A
lookup probes level after level until one is missing: the last level found gives the count back.

    p1(w)   = (c(w) + 1) / Z           Z sums c(v) + 1 over the vocabulary, plus 1 for words never seen
    p(w|u)  = (1 - weight) p1(w) + weight min(1, c(u, w) / c(u))      p1(w) where u was never seen before a token

with c as the filter gives it. The filter is made of shards of bounded size, one per group of hashes, each built by one
task, and it grows with the corpus: no n-gram is left out. Up to `broadcast_bytes` the shards are broadcast to the
workers. A larger filter stays in its table: texts are put into blocks, each block sends its distinct n-grams to their
shards, and gets the levels back; the scores are the same. No shard is copied: a block asks for an n-gram once, so none
is hot.

Exact counts for the base score reach the texts in two ways: words that make up a 2**-22 part of all tokens or more are
broadcast; all others are joined, and none of their keys can be hot. The part is doubled until the words to broadcast are
at most `HEAVY_WORDS` with `HEAVY_BYTES`.

Cases: a null or empty text is its end token alone. Rows that repeat are trained on and scored row by row; a null
identifier is in no held-out fold. Without training tokens, counts are zero: a token costs log10(1/1) and the model's
score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.llm.merges import arrow_slices
from codexloom.session import written

#: Quantisation bases of single tokens and of pairs.
BASES = (1.2, math.sqrt(2))
#: Bits of the filter per entry. An entry sets four bits in each of two 64-bit words of its shard: about five wrong
#: answers in a thousand, at two memory accesses.
BITS = 12
#: N-grams in a shard, on average.
SHARD = 1_000_000
#: A word with this share of all tokens is broadcast, if these words are no more than so many with so many bytes.
HEAVY_SHARE, HEAVY_WORDS, HEAVY_BYTES = 1 / (1 << 22), 200_000, 4 << 20
#: Words of the filter in a broadcast piece.
PIECE = 1 << 20
#: Bytes of text handled at a time; n-grams that a task keeps before it hands them on. Larger slices are no faster, and a
#: worker needs some 50 MB more for each 1,000,000 bytes.
SLICE, HELD = 1_000_000, 2_000_000
#: The hash that stands before the first token of a text.
START = np.array(0x9AE16A3B2F90404F, np.uint64)[()]
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: The bits of a filter's word that twelve bits of a hash set: one for each six of them.
_BITS = np.array([(1 << (i & 63)) | (1 << (i >> 6)) for i in range(1 << 12)], np.uint64)
#: Hashes whose levels a filter remembers, and groups of shards that blocks ask.
KNOWN, GROUPS = 1 << 20, 1024


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(u + _GOLD) ^ (w * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)))


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of texts, none null: their distinct tokens (binary), the tokens of all texts by number, end to end, and how many
    each text has. White space and letters are ASCII's; the token that ends a text is empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    words = lists.flatten().dictionary_encode()
    distinct, which = words.dictionary, words.indices.to_numpy().astype(np.int64)
    end = pc.index(distinct, "").as_py()
    if end < 0:
        end, distinct = len(distinct), pa.concat_arrays([distinct, pa.array([""], pa.string())])
    # A text without words is one empty token already.
    ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).astype(np.int64)[1:]
    ends = ends[which[ends - 1] != end] if len(ends) else ends
    lens = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = np.insert(which, ends, end)
    return distinct.cast(pa.binary()), flat, lens + (which[np.cumsum(lens) - 1] != end if len(lens) else 0)


def listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(7)), np.uint64, len(words))


def planes(h: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Ascending hashes as differences, anew from each of firsts on: numbers whose high bytes are mostly nothing."""
    out = h.copy()
    out[1:] -= h[:-1]
    out[firsts] = h[firsts]
    return out.astype("<u8").view(np.uint8).reshape(-1, 8)


def from_planes(data: bytes) -> np.ndarray:
    """Ascending hashes from the bytes of their planes, one plane after the other."""
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8")[:, 0], dtype=np.uint64)


def before(flat: np.ndarray, lens: np.ndarray, start: np.ndarray) -> np.ndarray:
    """What stands before each token: the token before it, or start."""
    out = np.empty_like(flat)
    out[1:] = flat[:-1]
    out[np.cumsum(lens) - lens] = start
    return out


def top_level(count: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(count, 1)) / math.log(base) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of the counts with that level; 0 for level 0."""
    low, high = np.ceil(base ** (level - 1.0) - 1e-6), np.ceil(base**level - 1e-6) - 1
    return np.where(level > 0, np.where(high > low, (low + high) / 2, low), 0.0)


def place(x: np.ndarray, base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word of each scrambled hash, in a shard of so many words that begins at base, and its bits."""
    bits = _BITS[x & np.uint64(0xFFF)] | _BITS[(x >> np.uint64(12)) & np.uint64(0xFFF)]
    return base + (((x >> np.uint64(32)) * size) >> np.uint64(32)).astype(np.int64), bits


def second(x: np.ndarray) -> np.ndarray:
    """The scrambled hashes for the second word."""
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def build_shard(h: np.ndarray, levels: np.ndarray) -> bytes:
    """The words of one shard for hashes with their top levels."""
    size = np.array([max(2, int(levels.sum()) * BITS // 64 + 1)], np.uint64)
    words, zero = np.zeros(int(size[0]), "<u8"), np.zeros(1, np.int64)
    for i in range(0, len(h), 200_000):
        hh, n = h[i : i + 200_000], levels[i : i + 200_000]
        level = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        x = mix(np.repeat(hh, n) + level.astype(np.uint64) * _GOLD)
        for y in (x, second(x)):
            np.bitwise_or.at(words, *place(y, zero, size))
    return words.tobytes()


class Filter:
    """The words of shards end to end, and where each shard begins: all shards, or some of n_shards from `first` on."""

    def __init__(self, words: np.ndarray, ends: np.ndarray, first: int = 0, n_shards: int | None = None):
        self.words, self.first, self.n_shards = words, first, n_shards or len(ends)
        self.base = np.append(0, ends[:-1]).astype(np.int64)
        self.size = (ends - self.base).astype(np.uint64)
        self.known, self.known_levels = np.zeros(KNOWN, np.uint64), np.zeros(KNOWN, np.uint8)
        self.known[0] = 1  # not yet anything: 1 has another slot

    @classmethod
    def joined(cls, shards: Iterator[tuple[int, bytes]], n_shards: int, n_bytes: int, first: int = 0, of: int | None = None) -> Filter:
        """From (shard, bytes) in the order of shards, numbered from `first`; one that is missing holds nothing."""
        words, ends, at, last = np.zeros(n_bytes // 8 + 2 * n_shards, "<u8"), np.zeros(n_shards, np.int64), 0, -1
        for s, data in shards:
            for k in range(last + 1, s):
                at += 2
                ends[k] = at
            words[at : at + len(data) // 8] = np.frombuffer(data, "<u8")
            at += len(data) // 8
            ends[s], last = at, s
        for k in range(last + 1, n_shards):
            at += 2
            ends[k] = at
        return cls(words[:at], ends, first, of)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The top level found of each hash, 0 for none. What was found before is remembered, high levels first: those
        of n-grams that come again take most steps."""
        slot = (h & np.uint64(KNOWN - 1)).astype(np.int64)
        out = self.known_levels[slot].astype(np.int64)
        ask = np.flatnonzero(self.known[slot] != h)
        held, slot = out[ask], slot[ask]
        out[ask] = told = self._asked(h[ask])
        keep = np.flatnonzero((told >= held) & (told < 256))
        self.known[slot[keep]] = h[ask[keep]]
        self.known_levels[slot[keep]] = told[keep]
        return out

    def _asked(self, h: np.ndarray) -> np.ndarray:
        out, todo, level = np.zeros(len(h), np.int64), np.arange(len(h)), 1
        shard = shard_of(h, self.n_shards) - self.first
        base, size = self.base[shard], self.size[shard]
        while len(todo):
            x = mix(h + np.array([level], np.uint64) * _GOLD)
            for step in (lambda y: y, second):
                x = step(x)
                at, bits = place(x, base, size)
                found = np.flatnonzero(self.words[at] & bits == bits)
                if len(found) < len(x):
                    x, todo, h, base, size = x[found], todo[found], h[found], base[found], size[found]
            out[todo] = level
            level += 1
        return out


def shard_of(h: np.ndarray, n_shards: int) -> np.ndarray:
    """Shards are consecutive ranges of hashes, so sorted hashes are sorted by shard."""
    return (((h >> np.uint64(32)) * np.uint64(n_shards)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Batch:
    """Texts as token numbers, with the distinct tokens and pairs."""

    words: pa.Array
    listed: list[bytes]
    flat: np.ndarray  # token numbers of all texts, end to end
    lens: np.ndarray
    hashes: np.ndarray  # per distinct token, the last for the start
    pairs: np.ndarray  # distinct pairs as (before * n + token)
    which: np.ndarray  # per place, its pair

    @classmethod
    def of(cls, texts: pa.Array) -> Batch:
        words, flat, lens = tokens(texts)
        n, each = len(words) + 1, listed(words)
        pairs = pa.array(before(flat, lens, n - 1) * n + flat).dictionary_encode()
        return cls(words, each, flat, lens, np.append(word_hashes(each), START), pairs.dictionary.to_numpy(), pairs.indices.to_numpy())

    def pair_hashes(self) -> np.ndarray:
        n = len(self.words) + 1
        return pair_hash(self.hashes[self.pairs // n], self.hashes[self.pairs % n])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """Consecutive slices of texts, with nothing for null: first row, row after the last, texts."""
    start, texts = 0, pc.fill_null(texts, "")
    for part in arrow_slices(texts, SLICE):
        yield start, start + len(part), part
        start += len(part)


def count_words(texts: DataFrame) -> DataFrame:
    """Of one text column: word (binary; the end token is empty) and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, part in _slices(b.column(0)):
                words, flat, _ = tokens(part)
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(flat, minlength=len(words)))], ["word", "c"])

    return texts.mapInArrow(run, "word binary, c long").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


def _runs(h: np.ndarray, n_shards: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Sorted hashes (as planes) and what belongs to them (as little-endian arrays), a row per shard."""
    shard = shard_of(h, n_shards)
    firsts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(h) else np.zeros(0, np.int64)
    ends = [*firsts[1:].tolist(), len(h)][: len(firsts)]
    cut = [pa.array([x[a:b].T.tobytes() for a, b in zip(firsts.tolist(), ends, strict=True)], pa.binary()) for x in (planes(h, firsts), *columns)]
    return pa.RecordBatch.from_arrays([pa.array(shard[firsts], pa.int32()), *cut], ["shard", "h", "c"])


def count_pairs(texts: DataFrame, n_shards: int) -> DataFrame:
    """Of one text column: shard, and runs of pair hashes with their counts, pre-summed per task, as `_runs` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _runs(h, n_shards, c.astype("<u4"))

        for b in batches:
            for _, _, part in _slices(b.column(0)):
                words, flat, lens = tokens(part)
                h = word_hashes(listed(words))[flat]
                held.append(pair_hash(before(h, lens, START), h))
                if sum(map(len, held)) >= HELD:
                    yield out()
        if held:
            yield out()

    return texts.mapInArrow(run, "shard int, h binary, c binary")


def build_filter(words: DataFrame, pairs: DataFrame, starts: int, n_shards: int) -> DataFrame:
    """shard, bits and mass (of its single tokens: sum of given-back counts) from exact word counts and pair counts."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = word_hashes(listed(b.column(0)))
            order = np.argsort(h)
            yield _runs(h[order], n_shards, b.column(1).to_numpy()[order].astype("<u8"))

    single = words.select("word", "c").mapInArrow(hashed, "shard int, h binary, c binary").withColumn("pair", F.lit(False))
    grams = single.unionByName(pairs.withColumn("pair", F.lit(True)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = None, {True: ([], []), False: ([], [])}
        for b in batches:
            for s, h, c, pair in zip(*(b.column(k).to_pylist() for k in ("shard", "h", "c", "pair")), strict=True):
                shard = s
                found[pair][0].append(from_planes(h))
                found[pair][1].append(np.frombuffer(c, "<u4" if pair else "<u8").astype(np.int64))
        hashes, levels, mass = [], [], 0.0
        for pair, (h, c) in found.items():
            if h:
                distinct, at = np.unique(np.concatenate(h), return_inverse=True)
                total = np.bincount(at, np.concatenate(c), len(distinct)).astype(np.int64)
                hashes.append(distinct)
                levels.append(top_level(total, BASES[pair]))
                mass += 0.0 if pair else float(count_of(levels[-1], BASES[0]).sum())
        if starts and shard == shard_of(START[None], n_shards)[0]:
            hashes.append(START[None])
            levels.append(top_level(np.array([starts]), BASES[0]))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([build_shard(np.concatenate(hashes), np.concatenate(levels))], pa.binary()), pa.array([mass])], ["shard", "bits", "mass"])

    return grams.groupBy("shard").applyInArrow(build, "shard int, bits binary, mass double")


@dataclass
class Model:
    """A trained model; what it holds is in tables of the scratch folder, except for sizes and sums."""

    words: DataFrame  # word, c
    shards: DataFrame  # shard, bits, mass
    n_shards: int
    n_tokens: int  # N
    n_words: int  # V
    mass: float
    bits_bytes: int
    weight: float = 0.5


def train(texts: DataFrame, *, weight: float = 0.5) -> Model:
    """A model of the one text column of texts."""
    words = written(count_words(texts), "words")
    total, distinct, starts = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("c"))), F.lit(0))).first()
    n_shards = max(1, -(-int(total) // SHARD))
    shards = written(build_filter(words, count_pairs(texts, n_shards), int(starts), n_shards), "shards")
    mass, size = shards.agg(F.coalesce(F.sum("mass"), F.lit(0.0)), F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()
    return Model(words, shards, n_shards, int(total), int(distinct), float(mass), int(size), weight)


def heavy_count(model: Model) -> float:
    """The least count of a word that is broadcast."""
    steps = [max(1.0, model.n_tokens * HEAVY_SHARE * 2**k) for k in range(24)]
    sizes = model.words.agg(*[x.alias(f"{n}{k}") for k, c in enumerate(steps) for n, x in (("n", F.count_if(F.col("c") >= c)), ("b", F.coalesce(F.sum(F.when(F.col("c") >= c, F.octet_length("word"))), F.lit(0))))]).first()
    return next((c for k, c in enumerate(steps) if sizes[f"n{k}"] <= HEAVY_WORDS and sizes[f"b{k}"] <= HEAVY_BYTES), math.inf)


def _log_probabilities(model: dict, batch: Batch, unigram: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Per place, from the levels of the distinct tokens (the start last) and the distinct pairs."""
    n = len(batch.words) + 1
    count = count_of(unigram, BASES[0])
    p1 = (count + 1) / (model["mass"] + model["n_words"] + 1)
    before, token = batch.pairs // n, batch.pairs % n
    seen = count[before]
    ratio = np.minimum(1.0, count_of(pair, BASES[1]) / np.maximum(seen, 1))
    weight = np.where(seen > 0, model["weight"], 0.0)
    p = (1 - weight) * p1[token] + weight * ratio
    return np.log10(p)[batch.which]


def _rows(rows: pa.Array, ids: pa.Array, batch: Batch, logs: np.ndarray, heavy: dict[bytes, int], total: int, distinct: int) -> pa.RecordBatch:
    """One row per text with what heavy words give to it, and one per text and other word."""
    starts = np.cumsum(batch.lens) - batch.lens
    c = np.fromiter(map(heavy.get, batch.listed, repeat(-1)), np.int64, len(batch.words))
    at = c[batch.flat]
    known = np.add.reduceat((at > 0).astype(np.int64), starts)
    base = np.add.reduceat(np.where(at >= 0, np.log10((np.maximum(at, 0) + 1) / (total + distinct + 1)), 0.0), starts)
    score = np.add.reduceat(logs, starts)
    doc = np.repeat(np.arange(len(batch.lens)), batch.lens)[at < 0]
    rare, times = np.unique(doc * len(batch.words) + batch.flat[at < 0], return_counts=True)
    of, word = rare // len(batch.words), rare % len(batch.words)
    n, m = len(batch.lens), len(rare)
    none = lambda k, t: pa.nulls(k, t)
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([rows, rows.take(pa.array(of))]),
            pa.concat_arrays([ids, none(m, pa.string())]),
            pa.concat_arrays([none(n, pa.binary()), batch.words.take(pa.array(word))]),
            pa.concat_arrays([none(n, pa.int64()), pa.array(times, pa.int64())]),
            pa.concat_arrays([pa.array(batch.lens), none(m, pa.int64())]),
            pa.concat_arrays([pa.array(known), none(m, pa.int64())]),
            pa.concat_arrays([pa.array(base), none(m, pa.float64())]),
            pa.concat_arrays([pa.array(score), none(m, pa.float64())]),
        ],
        ["_row", "_id", "word", "times", "n_tokens", "known", "base", "score"],
    )


_OUT = "_row long, _id string, word binary, times long, n_tokens long, known long, base double, score double"


def _unpacked(pieces: list, size: int) -> np.ndarray:
    """The broadcast pieces end to end; a piece that has been copied is let go."""
    words, at = np.empty(size, "<u8"), 0
    for piece in pieces:
        part = piece.value
        words[at : at + len(part)] = part
        at += len(part)
        vars(piece).pop("_value", None)
    return words


def _fetched(shards: DataFrame, n_shards: int, group: int = 16) -> Iterator[tuple[int, bytes]]:
    """(shard, bits) in order, a few shards on their way to the driver at a time."""
    for first in range(0, n_shards, group):
        held = shards.where(F.col("shard").between(first, first + group - 1)).select("shard", "bits").toArrow()
        for i in np.argsort(held["shard"].to_numpy()).tolist():
            yield held["shard"][i].as_py(), held["bits"][i].as_buffer()


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = 256 << 20) -> DataFrame:
    """Per row of docs: `_id`, n_tokens, n_known, base_score, score. Rows are told apart even if their identifier repeats."""
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
    least = heavy_count(model)
    heavy_rows = model.words.where(F.col("c") >= least).select("word", "c").toArrow()
    heavy = spark.sparkContext.broadcast(dict(zip(heavy_rows["word"].to_pylist(), heavy_rows["c"].to_pylist(), strict=True)))
    known = {"mass": model.mass, "n_words": model.n_words, "weight": model.weight}
    total, distinct, n_shards = model.n_tokens, model.n_words, model.n_shards
    if model.bits_bytes <= broadcast_bytes:
        joined = Filter.joined(_fetched(model.shards, n_shards), n_shards, model.bits_bytes)
        ends = np.append(joined.base[1:], len(joined.words))
        # In pieces, so that no process holds the filter twice while it unpacks it.
        pieces = [spark.sparkContext.broadcast(joined.words[i : i + PIECE]) for i in range(0, len(joined.words), PIECE)]
        del joined

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            probe, common = Filter(_unpacked(pieces, int(ends[-1])), ends), heavy.value
            for b in batches:
                for i, j, part in _slices(b.column(2)):
                    batch = Batch.of(part)
                    logs = _log_probabilities(known, batch, probe.levels(batch.hashes), probe.levels(batch.pair_hashes()))
                    yield _rows(b.column(0)[i:j], b.column(1)[i:j], batch, logs, common, total, distinct)

        parts = rows.mapInArrow(run, _OUT)
    else:
        parts = _routed(rows, model, known, heavy, total, distinct, n_shards)
    # One row of a text stands for itself; the others take their word's count. A text's own row has a key of its own.
    keyed = parts.withColumn("key", F.coalesce("word", F.concat(F.lit("\x00own\x00"), F.col("_row").cast("string")).cast("binary")))
    words = model.words.where(F.col("c") < least).select(F.col("word").alias("key"), "c")
    joined = keyed.join(words, "key", "left")
    c = F.coalesce("c", F.lit(0))
    out = joined.groupBy("_row").agg(
        F.max("_id").cast(kind).alias("_id"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("known") + F.coalesce(F.sum(F.when(c > 0, F.col("times"))), F.lit(0))).alias("n_known"),
        (F.max("base") + F.coalesce(F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(total + distinct + 1)))), F.lit(0.0))).alias("base_score"),
        F.max("score").alias("score"),
    )
    return out.drop("_row")


def _routed(rows: DataFrame, model: Model, known: dict, heavy, total: int, distinct: int, n_shards: int) -> DataFrame:
    """The rows that the broadcast filter gives, for a filter that is too large to broadcast."""
    per = -(-n_shards // GROUPS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, part in _slices(b.column(2)):
                yield pa.RecordBatch.from_arrays([b.column(0)[i : i + 1], *[pa.array([x.to_pylist()], t) for x, t in ((b.column(0)[i:j], pa.list_(pa.int64())), (b.column(1)[i:j], pa.list_(pa.string())), (part, pa.list_(pa.string())))]], ["_block", "_rows", "_ids", "_texts"])

    blocks = written(rows.mapInArrow(pack, "_block long, _rows array<long>, _ids array<string>, _texts array<string>"), "texts", compression="zstd")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                batch = Batch.of(b.column(1)[k].values)
                h = np.sort(np.concatenate([batch.hashes, batch.pair_hashes()]))
                group = shard_of(h, n_shards) // per
                firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                ends, all_ = [*firsts[1:].tolist(), len(h)], planes(h, firsts)
                asked = [all_[x:y].T.tobytes() for x, y in zip(firsts.tolist(), ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[k].as_py()] * len(firsts), pa.int64()), pa.array(group[firsts], pa.int32()), pa.array(asked, pa.binary())], ["_block", "group", "asked"])

    def answer(asked: pa.Table, shards: pa.Table) -> pa.Table:
        told = []
        if asked.num_rows:
            first, held = asked["group"][0].as_py() * per, shards.sort_by("shard")
            found = ((s - first, data) for s, data in zip(held["shard"].to_pylist(), held["bits"].to_pylist(), strict=True))
            probe = Filter.joined(found, per, pc.sum(pc.binary_length(held["bits"])).as_py() or 0, first, n_shards)
            told = [probe.levels(from_planes(a.as_py())).astype(np.uint8).tobytes() for a in asked["asked"]]
        return pa.table({"_block": asked["_block"], "group": asked["group"], "told": pa.array(told, pa.binary())})

    asked = blocks.select("_block", "_texts").mapInArrow(ask, "_block long, group int, asked binary")
    shards = model.shards.select((F.col("shard") / per).cast("int").alias("group"), "shard", "bits")
    # Written, so that the questions are gone from the disk before texts and answers meet.
    told = written(asked.groupBy("group").cogroup(shards.groupBy("group")).applyInArrow(answer, "_block long, group int, told binary"), "told", compression="zstd")
    told = told.groupBy("_block").agg(F.array_sort(F.collect_list(F.struct("group", "told"))).alias("told"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = heavy.value
        for b in batches:
            for k in range(b.num_rows):
                batch = Batch.of(b.column(2)[k].values)
                h = np.concatenate([batch.hashes, batch.pair_hashes()])
                levels = np.empty(len(h), np.int64)
                levels[np.argsort(h)] = np.frombuffer(b"".join(x["told"] for x in b.column(3)[k].as_py()), np.uint8)
                logs = _log_probabilities(known, batch, levels[: len(batch.hashes)], levels[len(batch.hashes) :])
                yield _rows(b.column(0)[k].values, b.column(1)[k].values, batch, logs, common, total, distinct)

    return blocks.hint("merge").join(told, "_block").select("_rows", "_ids", "_texts", "told").mapInArrow(finish, _OUT)


def held_out(id_col: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()).select("text"))
    out = score(docs, model)
    return out.select(F.col("_id").alias("doc_id"), held_out("_id").alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
