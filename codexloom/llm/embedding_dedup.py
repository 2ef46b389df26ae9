"""Near duplicates of embeddings: spherical k-means cells, blocked cosine products inside cells.

*Cells.* Centres are fitted by spherical k-means on a sample of at most `sample_rows` vectors, the first by hash of the
identifier. Every vector belongs to the cell of its nearest centre and also visits each cell whose border is near: with
own centre c and other centre d, a partner at chord r = sqrt(2 - 2 threshold) can lie beyond the border only if
(c - d).x <= r |c - d|. Of two such partners on either side of the border one is within r / 2 of it, and one visit is
enough to meet; so by default a vector visits at (c - d).x <= r |c - d| / 2, and no link is lost. There is no limit on
the cells that a vector visits.

*Pairs.* In a cell its own vectors meet each other and the visitors, in blocks of bounded size; each pair is counted in
one cell only. A block pair hands on the number of links of each vector and, per group of linked vectors, an edge from
each to the first, never the pairs themselves.

*Groups.* Connected components of these edges; the smallest identifier of a component is its representative.

Identical vectors are folded into one before any of this and get their links back by their number. Vectors of several
dimensions are separate collections, each with its own centres.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, not even with equal
ones. Rows that repeat an identifier are separate vectors that may link to each other, and share a component. A null
identifier is never a representative while its component has another. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexloom.llm.components import components
from codexloom.session import written

#: Vectors of a cell of its own, on average; cells at most, which bounds what is broadcast to 8 bytes a component.
CELL, MOST_CELLS = 1_000, 4_096
#: Vectors in a block: own ones, and those they are compared with.
OWN_BLOCK, OTHER_BLOCK = 1_024, 4_096


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Unit centres by spherical k-means on unit vectors; an empty cell is refilled with the vector worst served."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest, best = np.empty(len(sample), np.int64), np.empty(len(sample))
        for i in range(0, len(sample), 8_192):
            dots = sample[i : i + 8_192] @ centres.T
            nearest[i : i + 8_192], best[i : i + 8_192] = dots.argmax(axis=1), dots.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        empty = np.flatnonzero(np.bincount(nearest, minlength=len(centres)) == 0)
        if len(empty):
            sums[empty] = sample[np.argsort(best)[: len(empty)]]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def visits(x: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Of unit vectors: the own cell, and a matrix of the cells that each visits (its own included)."""
    dots = x @ centres.T
    own = dots.argmax(axis=1)
    # |c - d| of unit vectors from their products.
    gap = np.sqrt(np.maximum(0.0, 2 - 2 * centres[own] @ centres.T))
    near = dots[np.arange(len(x)), own][:, None] - dots <= reach * gap
    near[np.arange(len(x)), own] = True
    return own, near


def _unit(rows: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    x = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _deal(vectors: DataFrame, index: dict[int, np.ndarray], reach_of) -> DataFrame:
    """A row per vector and visited cell: dim, cell, home, node, copies, cells (visited), vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)
    schema = "dim int, cell int, home int, node long, copies long, cells array<int>, vector " + vectors.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                for at in np.array_split(np.flatnonzero(dims == d), max(1, -(-int((dims == d).sum()) // 2_048))):
                    part = b.take(pa.array(at))
                    own, near = visits(_unit(part.column("vector")), shared.value[d], reach_of(d))
                    who, cell = np.nonzero(near)
                    lists = np.split(cell, np.cumsum(near.sum(axis=1))[:-1])
                    take = pa.array(who)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("dim").take(take),
                            pa.array(cell, pa.int32()),
                            pa.array(own[who], pa.int32()),
                            part.column("node").take(take),
                            part.column("copies").take(take),
                            pa.array([x.tolist() for x in lists], pa.list_(pa.int32())).take(take),
                            part.column("vector").take(take),
                        ],
                        ["dim", "cell", "home", "node", "copies", "cells", "vector"],
                    )

    return vectors.select("dim", "node", "copies", "vector").mapInArrow(run, schema)


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of n nodes with links (a, b) the smallest node of each one's group, by hooking and pointer jumping."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _compare(threshold: float):
    """For one block pair of a cell: link counts per node, and a forest of the links."""

    def run(table: pa.Table) -> pa.Table:
        node, copies, home = (table[k].to_numpy() for k in ("node", "copies", "home"))
        cell, role = table["cell"][0].as_py(), table["own"].to_numpy(zero_copy_only=False)
        x = _unit(table["vector"].combine_chunks())
        left, right = np.flatnonzero(role), np.flatnonzero(~role)
        linked: list[np.ndarray] = []
        for i in range(0, len(left), 512):
            dots = x[left[i : i + 512]] @ x[right].T
            a, b = np.nonzero(dots >= threshold)
            linked.append(np.stack([left[i : i + 512][a], right[b]]))
        a, b = np.concatenate(linked, axis=1) if linked else np.zeros((2, 0), np.int64)
        # Two of the cell's own meet twice, in either order; one order counts. An own one and a visitor also meet in the
        # visitor's cell if the own one visits there; the cell with the smaller number counts.
        both = home[b] == cell
        keep = np.where(both, node[a] < node[b], True)
        lists = table["cells"].combine_chunks()
        visited = np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy())) * (MOST_CELLS + 1) + lists.flatten().to_numpy()
        keep &= both | (home[b] > cell) | ~np.isin(a * (MOST_CELLS + 1) + home[b], visited)
        a, b = a[keep], b[keep]
        n = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
        met = np.flatnonzero(n)
        root = _least(len(node), a, b)
        far = np.flatnonzero(root != np.arange(len(node)))
        u, v = node[far], node[root[far]]
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.table({"node": pa.concat_arrays([pa.array(node[met]), none(len(u))]), "n": pa.concat_arrays([pa.array(n[met].astype(np.int64)), none(len(u))]), "u": pa.concat_arrays([none(len(met)), pa.array(u)]), "v": pa.concat_arrays([none(len(met)), pa.array(v)])})

    return run


def near_dedup(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, sample_rows: int = 20_000, exact: bool = False) -> DataFrame:
    """Per row of vectors: `_id`, n_links, component_id, kept. exact: visit every cell that could hold a partner."""
    spark = vectors.sparkSession
    kind = vectors.select(vector_col).schema[0].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)  # kept as it is: half the bytes
    value = F.col(vector_col).cast("array<float>" if single else "array<double>")
    good = F.coalesce((F.size(value) > 0) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(value, lambda v: v != 0), F.lit(False))
    rows = written(vectors.select(F.col(id_col).alias("_id"), F.when(good, value).alias("_v")).withColumn("_key", F.sha2(F.to_json(F.struct("_v")), 256)), "vectors")
    # Equal vectors are one node, named by a number of its own; the identifiers come back at the end.
    nodes = rows.where("_v IS NOT NULL").groupBy("_key").agg(F.first("_v").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("_id").alias("least"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")), "nodes")
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    index = {}
    for d, n in sorted(sizes.items()):
        sample = nodes.where(F.col("dim") == d).orderBy(F.xxhash64("_key"), "_key").limit(sample_rows).select("vector").toArrow()["vector"].combine_chunks()
        index[d] = fit_centres(_unit(sample), int(min(MOST_CELLS, max(1, n // CELL), max(1, len(sample) // 8))))
    chord = math.sqrt(max(0.0, 2 - 2 * threshold))
    dealt = _deal(nodes, index, (lambda d: chord) if exact else (lambda d: chord / 2 + 1e-9))
    dealt = written(dealt, "dealt")
    blocks = dealt.groupBy("dim", "cell").agg(F.sum((F.col("home") == F.col("cell")).cast("long")).alias("owned"), F.count(F.lit(1)).alias("all"))
    blocks = blocks.select("dim", "cell", F.ceil(F.col("owned") / OWN_BLOCK).cast("int").alias("nown"), F.ceil(F.col("all") / OTHER_BLOCK).cast("int").alias("nall"))
    many = dealt.join(F.broadcast(blocks) if len(index) * MOST_CELLS < 1_000_000 else blocks, ["dim", "cell"]).where("nown > 0")
    block = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    own = many.where("home = cell").select("*", F.lit(True).alias("own"), block(1, "nown").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nall") - 1)).alias("j"))
    other = many.select("*", F.lit(False).alias("own"), F.explode(F.sequence(F.lit(0), F.col("nown") - 1)).alias("i"), block(2, "nall").alias("j"))
    met = own.unionByName(other).groupBy("dim", "cell", "i", "j").applyInArrow(_compare(threshold), "node long, n long, u long, v long")
    met = written(met, "met")
    roots = components(met.where("u IS NOT NULL").select("u", "v"))
    counts = met.where("node IS NOT NULL").groupBy("node").agg(F.sum("n").alias("n"))
    named = nodes.select("_key", "node", "copies", "least").join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("_key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    alone, linked = rows.where("_v IS NULL"), rows.where("_v IS NOT NULL").join(named, "_key")
    out = linked.select("_id", "n_links", "component_id").unionByName(alone.select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")))
    return out.withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id")))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("_id", "vec_id")


OP7_SQL = """
WITH RECURSIVE good AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, min(r.b) AS component_id, e.vec_id = min(r.b) AS kept FROM embeddings e JOIN reach r ON r.a = e.vec_id GROUP BY e.vec_id
"""
