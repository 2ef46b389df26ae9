"""Connected components of an edge table by alternating stars, all in DataFrames.

Large star: every node links its larger neighbours to the smallest node it knows. Small star: every node links its
smaller neighbours to the smallest of them. Alternating, edges turn into stars whose centre is the smallest node of the
component. Minima are aggregated before they are joined back, so a hub costs one row per task; the join that hands the
minimum to a hub's edges is an ordinary shuffle join that adaptive execution splits. Every round is a table in the
shared scratch folder: lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexloom.session import written

MAX_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v), any order, no null: `node`, `root` for every node that isn't itself the smallest of its component."""
    state, now = None, written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, now = mark, written(_small(_large(now)), "edges")
    raise RuntimeError(f"components: no fixed point after {MAX_ROUNDS} rounds")
