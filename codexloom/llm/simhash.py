"""SimHash near duplicates by pigeonhole blocks.

A fingerprint has 64 bits, one per bit of the XXH64 hashes of the text's word shingles: set if it is set in over half
of them. Fingerprints that differ in at most `distance` bits are linked. The bits are cut into `blocks` blocks; two
linked fingerprints agree in at least blocks - distance of them, so there is a table per choice of that many blocks,
keyed by their bits, and linked fingerprints meet in a table. For four bits, six blocks give 15 tables with keys of 20 to
22 bits, seven give 35 with 27 to 30 and eight 70 with 32. Unless `blocks` is given, there are as many as keep the
buckets of the distinct fingerprints small. The result is the same for any choice.

Copies share a fingerprint and are folded into it before the join, whatever their number. A pair is verified in the join
condition and emitted only in the first table in which it meets, so each link appears once.

Cases: a null or wordless text has fingerprint zero, linked like any other. Texts with fewer words than a shingle are
one shingle. Rows that repeat count as copies; a null identifier has a fingerprint, and its component is the smallest
identifier reachable that is not null (null if there is none). Rows that share an identifier but not their text have
fingerprints of their own; `drop_near` judges each by its own. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.llm.components import components
from codexloom.session import written

#: Shingles whose bits are counted at a time (64 bytes each).
SLICE = 65_536
#: Dropped rows are broadcast up to this many (under 100 bytes each), else joined by shuffle.
BROADCAST_ROWS = 500_000
#: Distinct fingerprints up to which so many blocks do, for a distance of four bits.
BLOCKS = ((6, 1 << 25), (7, 1 << 31), (8, 1 << 62))


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text as an unsigned integer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined, h = b" ".join(tokens), xxhash.xxh64_intdigest
    ends = np.cumsum([len(t) + 1 for t in tokens])
    width = min(words, len(tokens))
    stops, starts = (ends[width - 1 :] - 1).tolist(), [0, *ends[: len(ends) - width].tolist()]
    total, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, SLICE):
        hashes = np.array([h(joined[a:b], seed) for a, b in zip(starts[i : i + SLICE], stops[i : i + SLICE], strict=True)], dtype=">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(text: Column, words: int = 4, seed: int = 42) -> Column:
    """The fingerprint as a signed long column."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t.as_py(), words, seed) for t in texts), dtype=np.uint64, count=len(texts))
        return pa.array(out.view(np.int64))

    return run(text)


def cuts(blocks: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each block, from the low end."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(chosen: tuple[int, ...], at: list[tuple[int, int]]) -> int:
    bits = sum(((1 << n) - 1) << a for a, n in (at[i] for i in chosen))
    return bits - (1 << 64) if bits >> 63 else bits


def links(prints: DataFrame, *, distance: int = 4, blocks: int = 6) -> DataFrame:
    """Of prints (fp, distinct longs): pairs (a, b), a < b, that differ in 1 to `distance` bits, each once."""
    at = cuts(blocks)
    tables = list(combinations(range(blocks), blocks - distance))
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(c, at)).cast("long")) for c in tables])).alias("tab", "key"))
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    # The first table in which the pair meets: its blocks are the first that agree. A table is left out if a block that
    # comes before its last one and isn't its own agrees too.
    apart = lambda i: x.bitwiseAND(F.lit(_mask((i,), at)).cast("long")) != 0
    first = F.lit(False)
    for t, chosen in enumerate(tables):
        rule = F.col("a.tab") == t
        for i in set(range(chosen[-1])) - set(chosen):
            rule = rule & apart(i)
        first = first | rule
    on = (F.col("a.tab") == F.col("b.tab")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(x) <= distance) & first
    return keyed.alias("a").join(keyed.alias("b"), on).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4, blocks: int | None = None, seed: int = 42) -> DataFrame:
    """Per row of docs: `_id`, `_fp` (long) and `_component`, the smallest identifier that links reach."""
    rows = written(docs.select(F.col(id_col).alias("_id"), fingerprints(F.col(text_col), words, seed).alias("_fp")), "prints")
    return rows.join(_roots(rows, distance, blocks), "_fp", "left").select("_id", "_fp", "_component")


def _roots(rows: DataFrame, distance: int, blocks: int | None) -> DataFrame:
    """Of rows (_id, _fp): `_fp` and `_component` for every fingerprint."""
    prints = written(rows.groupBy("_fp").agg(F.min("_id").alias("least")), "distinct")
    if blocks is None:
        n = prints.count()
        blocks = distance - 4 + next(b for b, most in BLOCKS if n <= most)
    pairs = links(prints.select(F.col("_fp").alias("fp")), distance=distance, blocks=blocks)
    roots = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = prints.join(roots, prints["_fp"] == roots["node"], "left").select("_fp", "least", F.coalesce("root", "_fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("_component"))
    return named.join(least, "root").select("_fp", "_component")


def drop_near(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """The rows of docs that stay: of each component the row with the smallest identifier. Rows of a component that share
    that identifier are one document and stay together; rows of a component without any identifier all stay. A row is
    known by its identifier and two hashes of its text, so one that goes takes no other text with it."""
    kept = [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_h1"), F.hash(F.col(text_col)).alias("_h2")]
    rows = written(docs.select(*kept, fingerprints(F.col(text_col), words).alias("_fp")), "prints")
    groups = rows.join(_roots(rows, distance, blocks), "_fp", "left")
    dropped = written(groups.where(~F.col("_id").eqNullSafe(F.col("_component"))).select("_id", "_h1", "_h2").distinct(), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    same = docs[id_col].eqNullSafe(dropped["_id"]) & (F.xxhash64(docs[text_col]) == dropped["_h1"]) & (F.hash(docs[text_col]) == dropped["_h2"])
    return docs.join(dropped, same, "left_anti")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("_id").alias("doc_id"), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))
