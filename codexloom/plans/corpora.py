"""Corpora derived from the driver's tables, which hold no books or notes themselves.

The same construction is stated twice: as DataFrames here and as SQL for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Documents of a source that may make a book: those whose identifiers lie in the same range. So books stay of a size,
#: however many documents a source has.
RANGE = 2_000
KEY_SQL = f"(source || '-' || (doc_id // {RANGE}))"

#: A book per source and range; every document is a page with a section heading, every tenth also with a chapter heading.
BOOK_SQL = """
book AS (
  SELECT doc, n::INT AS page, (CASE WHEN (n - 1) % 10 = 0 THEN {chapter} || chr(10) ELSE '' END) || {section} || chr(10) || text AS text
  FROM (SELECT doc, doc_id, text, row_number() OVER (PARTITION BY doc ORDER BY doc_id) AS n, (row_number() OVER (PARTITION BY doc ORDER BY doc_id) - 1) // 10 + 1 AS k FROM (SELECT *, {key} AS doc FROM documents))
)"""
ZH = BOOK_SQL.format(key=KEY_SQL, chapter="'第' || k || '章 Part ' || k", section="'第' || n || '节 Doc ' || doc_id")
EN = BOOK_SQL.format(key=KEY_SQL, chapter="'Part ' || k || ' Volume'", section="'Chapter ' || n || ' Doc ' || doc_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; those of a table that comes in fewer partitions than there are cores are dealt to all of them."""
    df, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def book_key() -> Column:
    return F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / RANGE).cast("string"))


def in_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc (the book), n from 1 and the columns of documents."""
    rows = documents(spark, sf_dir).withColumn("doc", book_key())
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("doc").orderBy("doc_id")))


def book(spark: SparkSession, sf_dir: str, language: str = "zh") -> DataFrame:
    rows = in_books(spark, sf_dir).select("doc", "doc_id", "text", "n").withColumn("k", F.floor((F.col("n") - 1) / 10) + 1)
    c = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) and x not in ("n", "k", "doc_id") else F.col(x).cast("string") for x in xs])
    chapter, section = (c("第", "k", "章 Part ", "k"), c("第", "n", "节 Doc ", "doc_id")) if language == "zh" else (c("Part ", "k", " Volume"), c("Chapter ", "n", " Doc ", "doc_id"))
    head = F.when((F.col("n") - 1) % 10 == 0, F.concat(chapter, F.lit("\n"))).otherwise("")
    return rows.select("doc", F.col("n").alias("page"), F.concat(head, section, F.lit("\n"), "text").alias("text"))


#: A note per conversation: front matter, a heading per turn, a fenced block in every third turn, a deep heading in
#: every fourth.
NOTES_SQL = """
notes AS (
  SELECT 'conv_' || conv_id || '.md' AS path,
    '---' || chr(10) || 'created: 2024-01-' || lpad((1 + conv_id % 28)::VARCHAR, 2, '0') || chr(10) || 'title: "Conversation"' || chr(10) || '---' || chr(10) || '# Conversation' || chr(10) ||
    string_agg('## ' || role || ' ' || turn || chr(10) || text || chr(10) ||
      (CASE WHEN turn % 3 = 0 THEN '```' || chr(10) || '# no heading' || chr(10) || '```' || chr(10) ELSE '' END) ||
      (CASE WHEN turn % 4 = 1 THEN '##### deep ' || turn || chr(10) || 'deep text' || chr(10) ELSE '' END), '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id
)"""


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn").cast("string")
    piece = F.concat(
        F.lit("## "), "role", F.lit(" "), t, F.lit("\n"), "text", F.lit("\n"),
        F.when(F.col("turn") % 3 == 0, "```\n# no heading\n```\n").otherwise(""),
        F.when(F.col("turn") % 4 == 1, F.concat(F.lit("##### deep "), t, F.lit("\ndeep text\n"))).otherwise(""),
    )
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))), lambda x: x["p"]), "").alias("body"))
    head = F.concat(F.lit("---\ncreated: 2024-01-"), F.lpad((F.col("conv_id") % 28 + 1).cast("string"), 2, "0"), F.lit('\ntitle: "Conversation"\n---\n# Conversation\n'))
    return turns.select(F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit(".md")).alias("path"), F.concat(head, "body").alias("text"))


#: Paths of notes by day, by folder and by page.
JOURNAL_SQL = "journal AS (SELECT DISTINCT 'journal/' || CASE WHEN day(o_orderdate) % 7 = 0 THEN strftime(o_orderdate, 'note %Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END || '.md' AS path FROM orders)"


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.dayofmonth("o_orderdate") % 7 == 0, F.date_format("o_orderdate", "'note 'yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("journal/"), day, F.lit(".md")).alias("path")).distinct()


PATHS_SQL = "paths AS (SELECT CASE WHEN page_id % 3 = 0 THEN '' ELSE 'topic' || page_id % 7 || '/' END || 'page ' || page_id || CASE WHEN page_id % 5 = 0 THEN '.MD' ELSE '.md' END AS path FROM pages)"


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    folder = F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("topic"), (i % 7).cast("string"), F.lit("/")))
    return table(spark, sf_dir, "pages").select(F.concat(folder, F.lit("page "), i.cast("string"), F.when(i % 5 == 0, ".MD").otherwise(".md")).alias("path"))
