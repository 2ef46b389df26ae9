"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie end to end in one flat array of symbols with the number of the pre-token each
belongs to. In each round every pre-token applies its own lowest-ranked pair, at all its places at once (from the left
where places overlap); a pre-token without a pair that merges leaves the array and its symbols are counted. A pair made
by a merge never ranks below it, so applying all places at once gives what merging them one after another gives.

Cases: a null or empty text has 0 bytes and 0 tokens. Special strings inside a text are one token each, as the
library's default has it. Any length is counted whole. Repeated rows get equal counts.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.llm.merges import NEVER, Memory, PairTable, arrow_slices, byte_level_parts, merge_list, splitter

#: Symbols in a flat array at a time; a longer pre-token is an array by itself.
FLAT = 2_000_000


def merge_counts(pre_tokens: list[bytes], table: PairTable, of_byte: np.ndarray) -> np.ndarray:
    """Symbols that are left of each pre-token when nothing merges any more."""
    out, lens = np.zeros(len(pre_tokens), np.int64), np.array([len(t) for t in pre_tokens], np.int64)
    ids = of_byte[np.frombuffer(b"".join(pre_tokens), np.uint8)]
    who = np.flatnonzero(lens)
    lens = lens[who]
    while len(who):
        starts = np.cumsum(lens) - lens
        last = np.zeros(len(ids), bool)
        last[starts + lens - 1] = True
        slot = table.find(ids[:-1], ids[1:])
        rank = np.append(table.rank[slot], NEVER)
        rank[last] = NEVER
        least = np.minimum.reduceat(rank, starts)
        going = least < NEVER
        out[who[~going]] = lens[~going]
        hit = (rank == np.repeat(least, lens)) & (rank < NEVER)
        run = hit & ~np.append(False, hit[:-1])
        place = np.arange(len(ids))
        hit &= ((place - np.maximum.accumulate(np.where(run, place, 0))) & 1) == 0
        ids[:-1] = np.where(hit[:-1], table.merged[slot], ids[:-1])
        live = ~np.append(False, hit[:-1])
        lens, stay = lens - np.add.reduceat(hit, starts), np.repeat(going, lens)
        ids, who, lens = ids[live & stay], who[going], lens[going]
    return out


def _counts(pre_tokens: list[str], table: PairTable, of_byte: np.ndarray) -> np.ndarray:
    """merge_counts of any number of pre-tokens, in arrays of bounded size."""
    raw, out, i = [t.encode("utf-8", "surrogatepass") for t in pre_tokens], [np.zeros(0, np.int64)], 0
    while i < len(raw):
        j, n = i, 0
        while j < len(raw) and (j == i or n + len(raw[j]) <= FLAT):
            n += len(raw[j])
            j += 1
        out.append(merge_counts(raw[i:j], table, of_byte))
        i = j
    return np.concatenate(out)


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str):
    table, of_byte, special = merge_list(path)
    find = splitter(pattern).findall

    def learn(words: list[str], single: bool) -> tuple[np.ndarray, np.ndarray]:
        if single:
            n = _counts(words, table, of_byte)
        else:
            split = [find(w) for w in words]
            number = {t: k for k, t in enumerate(dict.fromkeys(t for s in split for t in s))}
            each = _counts(list(number), table, of_byte)
            n = np.add.reduceat(each[[number[t] for s in split for t in s]], np.cumsum([0, *[len(s) for s in split[:-1]]]))
        return n.astype("<u4"), np.ones(len(n), np.int64)

    known = Memory(learn)

    def count(texts: pa.Array) -> np.ndarray:
        """Of texts, none null."""
        out = [np.zeros(0, np.int64)]
        for part in arrow_slices(texts):
            words, single, which, ends = byte_level_parts(part, find)
            flat, first, _ = known.of(words, single)
            out.append(np.diff(np.append(0, np.cumsum(flat[first].astype(np.int64)[which]))[ends]))
        return np.concatenate(out)

    def run(texts: pa.Array) -> np.ndarray:
        if not special:
            return count(texts)
        # Texts with special strings are cut at these, each of which is a token.
        held = np.flatnonzero(pc.match_substring_regex(texts, "|".join(map(re.escape, special))).to_numpy(zero_copy_only=False))
        cut = [re.split("|".join(map(re.escape, sorted(special, key=len, reverse=True))), texts[k].as_py()) for k in held.tolist()]
        if cut:
            mask = np.ones(len(texts), bool)
            mask[held] = False
            texts = pc.replace_with_mask(texts, pa.array(~mask), pa.array([""] * len(held), pa.string()))
        n = count(texts)
        for k, bits in zip(held.tolist(), cut, strict=True):
            n[k] = len(bits) - 1 + count(pa.array(bits, pa.string())).sum()
        return n

    return run


def token_counts(text: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """Tokens of a text column by the byte-level tokenizer file at path (the same path on every machine)."""
    path, pattern = path or public_tokenizers.path("byte_bpe_50k.json"), pattern or public_tokenizers.PATTERN

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(_counter(path, pattern)(pc.fill_null(texts, "")), pa.int64())

    return run(text)


def op1_token_counts(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), token_counts(F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
