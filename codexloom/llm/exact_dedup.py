"""Exact duplicates by a log-structured merge index of digests (DataFrame functions only).

Life of a batch of documents:

* *memtable*: each group of input partitions is one memtable. Its digests are combined before any row moves, so a
  text that a third of all rows share is one entry per task.
* *flush*: every memtable becomes a run in the index folder, sorted by digest, with a Bloom filter and min/max
  statistics per Parquet row group. Lookups of single digests skip what the filters rule out.
* *compaction*: runs are merged into one sorted run that keeps the smallest (or largest) identifier per digest.
* *filter*: a digest with more than one row is a hit. The compacted run gets a Bloom filter of its hits, one 64-bit word
  with three bits per digest, in blocks of 1,024 words. Every document probes it first, and what it rules out is known to
  be alone: its text never moves. It takes ten bits a hit and is broadcast up to `FILTER_HITS`, built and probed by
  DataFrame functions; with more hits all documents go on to the join.
* *verification*: the rows of hits are regrouped by digest AND text, so two texts are only ever called equal after Spark
  compared their bytes. Digests that prove to hold several texts are resolved by text.

Cases: a null text counts as empty; empty texts are equal to each other. Rows with the same identifier and text are one
document that is counted once per row and stays or goes as a whole. A null identifier never becomes the survivor unless
all of its group are null; then `keep_id` is null and every row of the group is kept. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.session import scratch_path, written

#: A table of hits is broadcast up to this many rows (about 100 bytes each); beyond it the join is by shuffle.
BROADCAST_ROWS = 500_000
#: Hits up to which their filter is broadcast: ten bits each, so 50 MB at most.
FILTER_HITS = 40_000_000
#: Words of a filter block, and bits of a filter per hit.
BLOCK_WORDS, BITS_PER_HIT = 1_024, 10


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class HitFilter:
    """A Bloom filter of digests as a table of blocks (block, words), of a size that `hits` settles."""

    def __init__(self, digests: DataFrame, hits: int):
        spark = digests.sparkSession
        self.words = BLOCK_WORDS * max(1, -(-hits * BITS_PER_HIT // (64 * BLOCK_WORDS)))
        word, mask = self._place()
        empty = spark.range(self.words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
        filled = digests.select(word.alias("word"), mask.alias("bits")).unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        blocks = filled.groupBy(F.floor(F.col("word") / BLOCK_WORDS).alias("block")).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("at"))
        self.blocks = written(blocks.select("block", F.transform("at", lambda x: x["bits"]).alias("words")), "filter")

    def _place(self) -> tuple[Column, Column]:
        """The word of a column `digest`, and its bits there."""
        h = F.xxhash64("digest", F.lit(1))
        bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        return F.pmod(F.xxhash64("digest"), F.lit(self.words)), bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))

    def probe(self, rows: DataFrame, *, passing: bool = True) -> DataFrame:
        """The rows whose digest the filter lets pass, or else those that it rules out."""
        word, mask = self._place()
        here = F.element_at("words", (word % BLOCK_WORDS + 1).cast("int"))
        met = (F.floor(word / BLOCK_WORDS) == F.col("block")) & (here.bitwiseAND(mask) == mask)
        return rows.join(F.broadcast(self.blocks), met, "left_semi" if passing else "left_anti")


class DigestIndex:
    """Sorted digest runs in one folder of the shared file system."""

    def __init__(self, spark: SparkSession, path: str | None = None, *, keep: str = "min", digest_bytes: int = 32, memtables: int = 8):
        if keep not in ("min", "max"):
            raise ValueError("keep is 'min' or 'max'")
        self.spark, self.path, self.keep, self.digest_bytes, self.memtables = spark, path or scratch_path(spark, "digests"), keep, digest_bytes, memtables
        self.runs: list[str] = []
        self.schema = ""

    def digest(self, text: Column) -> Column:
        return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, self.digest_bytes)

    def _pick(self, c: str) -> Column:
        return (F.max if self.keep == "max" else F.min)(c)

    def _store(self, entries: DataFrame, name: str, *by: str) -> None:
        path = f"{self.path}/{name}"
        self.schema = f"digest binary, keep_id {dict(entries.dtypes)['keep_id']}, n long"
        (
            entries.sortWithinPartitions(*by, "digest")
            .write.option("parquet.bloom.filter.enabled#digest", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy(*by)
            .parquet(path)
        )
        self.runs.append(path)

    def flush(self, docs: DataFrame) -> None:
        """Adds a batch (columns `_id`, `_text`) as sorted level-0 runs, one per memtable."""
        entries = (
            docs.select(F.pmod(F.spark_partition_id(), F.lit(self.memtables)).alias("memtable"), self.digest(F.col("_text")).alias("digest"), "_id")
            .groupBy("memtable", "digest")
            .agg(self._pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        )
        self._store(entries, f"level0-{len(self.runs)}", "memtable")

    def _all(self) -> DataFrame:
        tables = [self.spark.read.schema(self.schema).parquet(p) for p in self.runs]  # a run without rows has no files
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    def compact(self) -> None:
        """Merges all runs into one, keeping one identifier per digest."""
        merged = self._all().groupBy("digest").agg(self._pick("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        name = f"level1-{len(self.runs)}"
        self._store(merged, name)
        self.runs = [f"{self.path}/{name}"]

    def lookup(self, digests: list[bytes]) -> DataFrame:
        """Entries of the given digests; the filters of the runs spare the row groups without them."""
        return self._all().where(F.col("digest").isin([F.lit(d) for d in digests])).groupBy("digest").agg(self._pick("keep_id").alias("keep_id"), F.sum("n").alias("n"))

    def hits(self) -> DataFrame:
        return self._all().groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest") if len(self.runs) != 1 else self._all().where("n > 1").select("digest")

    def resolve(self, docs: DataFrame) -> DataFrame:
        """docs (`_id`, `_text`) with keep_id, group_size; only byte-verified rows share a group."""
        rows = docs.withColumn("digest", self.digest(F.col("_text")))
        hits = self.hits()
        n_hits = hits.count()
        held = HitFilter(hits, n_hits) if n_hits <= FILTER_HITS else None
        classes = written(
            (held.probe(rows) if held else rows)
            .join(_small(hits, n_hits), "digest", "left_semi")
            .groupBy("digest", "_text")
            .agg(self._pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", "keep_id", "group_size"),
            "classes",
        )
        groups = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
        mixed = written(groups.where("texts > 1").select("digest"), "mixed")
        n_mixed = mixed.count()
        if held and n_hits > BROADCAST_ROWS:  # the join is by shuffle, so rows that the filter rules out pass it by
            out = self._attach(held.probe(rows), groups, n_hits).unionByName(self._attach(held.probe(rows, passing=False), groups.limit(0), 0))
        else:
            out = self._attach(rows, groups, n_hits)
        if n_mixed:
            apart = out.where("texts > 1").drop("texts", "keep_id", "group_size")
            exact = apart.groupBy("digest", "_text").agg(self._pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            out = out.where("texts = 1").drop("texts").unionByName(apart.join(exact, ["digest", "_text"]))
        return out.drop("texts", "digest")

    @staticmethod
    def _attach(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
        """rows left-joined to groups by digest; a row without a group is its own."""
        return rows.join(_small(groups, n), "digest", "left").select(
            *rows.columns,
            F.coalesce("texts", F.lit(1)).alias("texts"),
            F.when(F.col("texts").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        )


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", digest_bytes: int = 32, memtables: int = 8) -> DataFrame:
    """One row per row of docs: `_id`, `_text`, keep_id, group_size, kept."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    index = DigestIndex(docs.sparkSession, keep=keep, digest_bytes=digest_bytes, memtables=memtables)
    index.flush(rows)
    index.compact()
    return index.resolve(rows).withColumn("kept", F.col("_id").eqNullSafe(F.col("keep_id")))


def drop_exact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of docs that stay, all columns as they were."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    index = DigestIndex(docs.sparkSession, keep=keep)
    index.flush(rows.select("_id", "_text"))
    index.compact()
    out = index.resolve(rows).where(F.col("_id").eqNullSafe(F.col("keep_id")))
    return out.select("_row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = exact_dedup(docs, keep="max")
    return out.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
