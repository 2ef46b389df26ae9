"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A leaf per byte position holds the rank of the pair that starts there (with the next live position); inner nodes hold
the smallest rank below them with its leftmost position. The root names the next merge. A merge changes three leaves:
the merged pair's, its right neighbour's, which dies, and its left neighbour's; each update climbs the tree. Pre-tokens
of similar length are encoded together, one tree per row of an array; long ones by themselves.

Cases: a null or empty text has no ids. Special strings are ordinary text. Any length is encoded whole, each match of
the pattern by itself. Decoding gives the bytes back; an id that isn't in the vocabulary is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.llm.merges import NEVER, Memory, PairTable, arrow_slices, byte_level_parts, gather, rank_file, splitter

#: Pre-tokens up to this many bytes share arrays; leaves of such an array at a time.
BATCHED, LEAVES = 256, 1 << 18


def encode_rows(ids: np.ndarray, lens: np.ndarray, table: PairTable, width: int) -> tuple[np.ndarray, np.ndarray]:
    """ids (rows, width), live up to lens: the ids left, end to end, and their number per row."""
    n = len(ids)
    column = np.arange(width)
    after = np.where(column[None, :] + 1 < lens[:, None], column[None, :] + 1, width).astype(np.int64)
    before = np.broadcast_to(column - 1, (n, width)).copy()
    live = column[None, :] < lens[:, None]
    tree = np.full((n, 2 * width), NEVER * width)
    pairs = live[:, :-1] & live[:, 1:]
    rank = table.rank[table.find(ids[:, :-1][pairs], ids[:, 1:][pairs])]
    leaves = np.full((n, width), NEVER)
    leaves[:, :-1][pairs] = rank
    tree[:, width:] = np.where(leaves < NEVER, leaves * width + column, NEVER * width)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    rows = np.flatnonzero(tree[:, 1] < NEVER * width)
    while len(rows):
        at, merged = tree[rows, 1] % width, tree[rows, 1] // width
        gone = after[rows, at]
        then = after[rows, gone]
        ids[rows, at], live[rows, gone], after[rows, at] = merged, False, then
        more = then < width
        before[rows[more], then[more]] = at[more]
        tree[rows, width + gone] = NEVER * width
        tree[rows, width + at] = NEVER * width
        left = before[rows, at]
        has = left >= 0
        changed = [(rows[more], at[more], then[more]), (rows[has], left[has], at[has])]
        for r, i, j in changed:
            found = table.rank[table.find(ids[r, i], ids[r, j])]
            tree[r, width + i] = np.where(found < NEVER, found * width + i, NEVER * width)
        r, node = np.concatenate([rows, rows, rows[has]]), np.concatenate([at, gone, left[has]]) + width
        while node[0] > 1:
            node >>= 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
        rows = rows[tree[rows, 1] < NEVER * width]
    return ids[live], live.sum(axis=1)


def encode_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One pre-token of any length, by the same tree in Python lists; live positions keep the bytes they stand for."""
    n = len(data)
    width = 1 << max(1, (n - 1).bit_length())
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    none = (1 << 60, 0)

    def leaf(i: int) -> tuple[int, int]:
        j = after[i]
        r = ranks.get(data[i : end[j]]) if j < n else None
        return none if r is None else (r, i)

    tree = [none] * width + [leaf(i) for i in range(n)] + [none] * (width - n)
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        k = width + i
        tree[k] = value
        while k > 1:
            k >>= 1
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

    while tree[1] != none:
        i = tree[1][1]
        j = after[i]
        end[i], after[i] = end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
        put(j, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i : end[i]]])
        i = after[i]
    return out


def encode_pieces(pieces: list[bytes], table: PairTable, of_byte: np.ndarray, ranks: dict[bytes, int]) -> list[bytes]:
    """The ids of each pre-token as little-endian unsigned 32-bit integers. One that is a token is that token."""
    out: list[bytes] = [b""] * len(pieces)
    by_width: dict[int, list[int]] = {}
    for k, p in enumerate(pieces):
        if (r := ranks.get(p)) is not None:
            out[k] = r.to_bytes(4, "little")
        elif len(p) > BATCHED:
            out[k] = np.array(encode_long(p, ranks), "<u4").tobytes()
        elif p:
            by_width.setdefault(1 << (len(p) - 1).bit_length(), []).append(k)
    for width, members in by_width.items():
        step = max(1, LEAVES // width)
        for i in range(0, len(members), step):
            part = members[i : i + step]
            lens = np.array([len(pieces[k]) for k in part], np.int64)
            ids = np.zeros((len(part), width), np.int64)
            ids[np.arange(width)[None, :] < lens[:, None]] = of_byte[np.frombuffer(b"".join(pieces[k] for k in part), np.uint8)]
            flat, n = encode_rows(ids, lens, table, width)
            flat, ends = flat.astype("<u4").tobytes(), (np.cumsum(n) * 4).tolist()
            for k, a, b in zip(part, [0, *ends], ends, strict=False):
                out[k] = flat[a:b]
    return out


@lru_cache(maxsize=2)
def _memory(path: str, pattern: str) -> Memory:
    table, of_byte, ranks, _ = rank_file(path)
    find = splitter(pattern).findall

    def learn(words: list[str], single: bool) -> tuple[np.ndarray, np.ndarray]:
        split = [[w] for w in words] if single else [find(w) for w in words]
        number = {t: k for k, t in enumerate(dict.fromkeys(t for s in split for t in s))}
        ids = encode_pieces([t.encode("utf-8", "surrogatepass") for t in number], table, of_byte, ranks)
        found = ids if single else [b"".join(ids[number[t]] for t in s) for s in split]
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    return Memory(learn)


def encode_texts(texts: pa.Array, path: str, pattern: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of texts, none null, slice by slice: all ids, and where each text's begin and the last one's end."""
    known, find = _memory(path, pattern), splitter(pattern).findall
    for part in arrow_slices(texts):
        words, single, which, ends = byte_level_parts(part, find)
        flat, first, many = known.of(words, single)
        ids, places = gather(flat, first[which], many[which])
        yield ids, places[ends]


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens end to end, and where each begins and the last ends."""
    tokens = rank_file(path)[3]
    return np.frombuffer(b"".join(tokens), np.uint8), np.append(0, np.cumsum([len(t) for t in tokens]))


def decode_texts(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids end to end, and where those of each begin and the last one's end."""
    data, ends = token_bytes(path)
    return gather(data, ends[ids], ends[ids + np.int64(1)] - ends[ids])


def _paths(path: str | None, pattern: str | None) -> tuple[str, str]:
    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(text: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The ids of a text column as array<int>."""
    path, pattern = _paths(path, pattern)

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        flat, size, offsets = [np.zeros(0, "<u4")], 0, [np.zeros(1, np.int64)]
        for ids, ends in encode_texts(pc.fill_null(texts, ""), path, pattern):
            flat.append(ids)
            offsets.append(size + ends[1:])
            size += len(ids)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(np.concatenate(flat).view("<i4")))

    return run(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes of an array<int> column of ids."""
    path, _ = _paths(path, None)

    @F.arrow_udf("binary")
    def run(rows: pa.Array) -> pa.Array:
        tokens = rank_file(path)[3]
        return pa.array([b"".join(map(tokens.__getitem__, r.as_py() or ())) for r in rows], pa.binary())

    return run(ids)


def digests(text: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """n_tokens, and the SHA-256 of the encoded ids and of the bytes decoded from them, without moving the ids to the JVM."""
    path, pattern = _paths(path, pattern)

    @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def run(texts: pa.Array) -> pa.Array:
        sha, n, encoded, decoded = hashlib.sha256, [], [], []
        for ids, ends in encode_texts(pc.fill_null(texts, ""), path, pattern):
            n.append(np.diff(ends))
            raw, places = decode_texts(ids, path)
            for out, data, cuts in ((encoded, memoryview(ids).cast("B"), 4 * ends), (decoded, memoryview(raw), places[ends])):
                out += [sha(data[a:b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        columns = [pa.array(np.concatenate(n) if n else [], pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(text)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", digests(F.col("text")).alias("d")).select("doc_id", "d.*")
