"""Packs: the records of a document and their identifiers, links and texts."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from codexloom.functions import text as T
from codexloom.functions.profiles import Profile
from codexloom.operators.chunking import ALONE, BACKWARD, CUT, MERGED, NATURAL
from codexloom.session import written

SCHEMA_VERSION = "1.0"
#: What may be wrong with a line of a pack.
NO_JSON, NO_OBJECT = "json", "object"


def document_id(content: Column) -> Column:
    """sha256: and the digest of a file's bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def chunk_id(doc_id: Column, index: Column) -> Column:
    return F.concat(doc_id, F.format_string(":chunk:%06d", index))


def embedding_text(title: Column, path: Column, merged: Column, text: Column) -> Column:
    """What is embedded: title, path, merged headings where there are any, a blank line and the text."""
    lines = F.concat(
        F.array(F.concat(F.lit("书名："), title)),
        F.when(F.size(path) > 0, F.array(F.concat(F.lit("章节路径："), F.array_join(path, " > ")))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(merged) > 0, F.array(F.concat(F.lit("包含小节："), F.array_join(merged, "；")))).otherwise(F.array().cast("array<string>")),
        F.array(F.lit(""), text),
    )
    return F.array_join(lines, "\n")


_TOC = "array<struct<toc_id:string,level:int,title:string>>"


def heading_paths(chunks: DataFrame, toc: DataFrame) -> DataFrame:
    """chunks with heading_path (titles), toc_path and merged_toc (structs) of their path_ords and merged_ords."""
    items = toc.select("doc", F.col("ord").alias("_o"), F.struct("toc_id", "level", "title").alias("_t"))
    both = [chunks.select("doc", "chunk_index", F.lit(k).alias("_k"), F.posexplode(c).alias("pos", "_o")) for k, c in enumerate(("path_ords", "merged_ords"))]
    steps = both[0].unionByName(both[1]).join(items.hint("merge"), ["doc", "_o"])
    of = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("_k") == k, F.struct("pos", "_t")))), lambda x: x["_t"])
    found = steps.groupBy("doc", "chunk_index").agg(of(0).alias("toc_path"), of(1).alias("merged_toc"))
    out = chunks.join(found, ["doc", "chunk_index"], "left")
    for c in ("toc_path", "merged_toc"):
        out = out.withColumn(c, F.coalesce(c, F.array()).cast(_TOC))
    return out.withColumn("heading_path", F.transform("toc_path", lambda x: x["title"]))


#: What was done to make a chunk, by the reason that it gives.
_STRATEGY = {NATURAL: "toc_node", ALONE: "toc_node", MERGED: "toc_node_merge", BACKWARD: "toc_node_merge", CUT: "paragraph_sentence_split"}


def split_info(p: Profile) -> Column:
    """Strategy and reason of a chunk; the fields that its reason does not have are null."""
    reason = F.col("reason")
    strategy = F.coalesce(*[F.when(reason == r, F.lit(v)) for r, v in _STRATEGY.items()])
    ids = F.when(reason.isin(MERGED, BACKWARD), F.transform("merged_toc", lambda x: x["toc_id"]))
    return F.struct(strategy.alias("strategy"), reason.alias("reason"), F.when(reason == NATURAL, p.split).alias("section_split_chars"), ids.alias("merged_toc_ids"), "part_index", "part_count")


def chunk_records(chunks: DataFrame) -> DataFrame:
    """chunks (doc, document_id, book_title, chunk_index, text, heading_path, merged_headings, …) as record columns."""
    w = Window.partitionBy("doc").orderBy("chunk_index")
    rows = chunks.withColumn("chunk_id", chunk_id(F.col("document_id"), F.col("chunk_index"))).withColumn("embedding_text", embedding_text(F.col("book_title"), F.col("heading_path"), F.col("merged_headings"), F.col("text")))
    return (
        rows.withColumn("prev_chunk_id", F.lag("chunk_id").over(w))
        .withColumn("next_chunk_id", F.lead("chunk_id").over(w))
        .withColumn("stats", F.struct(F.length("text").alias("char_count"), F.length("embedding_text").alias("embedding_char_count")))
        .withColumn("content_hash", T.sha256_text(F.col("text")))
    )


def manifest(docs: DataFrame, p: Profile, *, source_type: str = "txt", toc_source: str | Column = "txt_heading_rules", model: str = "none", dimension: int = 0, normalize: bool = False, created: Column | None = None, before: int = 1, after: int = 2) -> DataFrame:
    """docs (doc, document_id, title, file_name, item_count[, files]) with the manifest record. created: by default now."""
    notes = source_type == "markdown"
    parser = {"markdown": "markdown_heading_parser", "pdf": "pymupdf"}.get(source_type, "plain_text")
    search = [] if notes else [F.lit(before).alias("search_before_pages"), F.lit(after).alias("search_after_pages"), F.lit(0.82).alias("title_match_min_confidence")]
    return docs.withColumn(
        "manifest",
        F.struct(
            F.lit("manifest").alias("record_type"),
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.col("document_id"),
            F.col("title"),
            (T.now_iso() if created is None else created).alias("created_at"),
            F.struct("file_name", F.lit(source_type).alias("source_type"), F.col("document_id").alias("source_sha256"), *(["files"] if notes else [])).alias("source"),
            F.lit("zh").alias("language"),
            F.struct(F.lit(parser).alias("name"), F.lit(notes).alias("preserve_layout")).alias("parser"),
            F.struct((F.lit(toc_source) if isinstance(toc_source, str) else toc_source).alias("source"), F.col("item_count").cast("int").alias("item_count")).alias("toc"),
            F.struct(
                F.lit("hierarchical_semantic").alias("strategy"),
                F.lit(p.name).alias("profile"),
                F.lit(p.target).alias("target_chars"),
                F.lit(p.max).alias("max_chars"),
                F.lit(p.split).alias("section_split_chars"),
                F.lit(p.overlap).alias("overlap_chars"),
                F.lit(p.min).alias("min_chunk_chars"),
                F.lit(p.max_level).cast("int").alias("max_chunk_heading_level"),
                F.lit(p.heading_detection).alias("heading_detection"),
                *search,
            ).alias("chunking"),
            F.struct(F.lit("none" if model == "none" else "local").alias("provider"), F.lit(model).alias("model"), F.lit(dimension).alias("dimension"), F.lit(normalize).alias("normalize")).alias("embedding"),
        ),
    )


def toc_record(toc: DataFrame, docs: DataFrame, source: str | Column = "txt_heading_rules") -> DataFrame:
    """Per document of docs (doc, document_id) the table of contents as one record, items in order, nulls kept. It is an
    empty list for documents without any."""
    parents = F.when(F.col("parent_ord").isNotNull(), F.format_string("toc:%06d", F.col("parent_ord")))
    file = ["file"] if "file" in toc.columns else []
    rows = toc.select("doc", F.struct("ord", "toc_id", "title", "level", parents.alias("parent_toc_id"), "page", F.struct("method", "confidence", *file).alias("locate")).alias("_x"))
    out = docs.select("doc", "document_id", (F.lit(source) if isinstance(source, str) else source).alias("_source")).join(rows.hint("merge"), "doc", "left").groupBy("doc", "document_id", "_source").agg(F.array_sort(F.collect_list("_x")).alias("_i"))
    items = F.transform("_i", lambda x: F.struct(x["toc_id"].alias("toc_id"), x["title"].alias("title"), x["level"].alias("level"), x["ord"].alias("order"), x["parent_toc_id"].alias("parent_toc_id"), x["page"].alias("page"), x["locate"].alias("locate")))
    return out.select("doc", F.struct(F.lit("toc").alias("record_type"), "document_id", F.col("_source").alias("source"), items.alias("items")).alias("toc"))


def pack_lines(manifests: DataFrame, tocs: DataFrame, chunks: DataFrame, p: Profile) -> DataFrame:
    """The lines of every pack: doc, line_no from 1, line. Manifest, contents, then chunks in order."""
    keep = {"ignoreNullFields": "false"}
    metadata = [F.col(f"source_metadata.{c}").alias(c) for c in chunks.select("source_metadata.*").columns] + ["merged_sources"] if "source_metadata" in chunks.columns else []
    chunk = F.struct(
        F.lit("chunk").alias("record_type"), "document_id", "chunk_id", "chunk_index", "text", "embedding_text", "heading_path", "toc_path", F.col("merged_toc").alias("merged_headings"),
        F.lit("body").alias("content_type"), F.struct(F.col("page_start").alias("pdf_page_start"), F.col("page_end").alias("pdf_page_end"), *metadata).alias("source"),
        "prev_chunk_id", "next_chunk_id", "stats", "content_hash", split_info(p).alias("split_info"), F.col("embedding") if "embedding" in chunks.columns else F.array().cast("array<float>").alias("embedding"),
    )
    return (
        manifests.select("doc", F.lit(1).alias("line_no"), F.to_json("manifest", keep).alias("line"))
        .unionByName(tocs.select("doc", F.lit(2).alias("line_no"), F.to_json("toc", keep).alias("line")))
        .unionByName(chunks.select("doc", (F.col("chunk_index") + 2).alias("line_no"), F.to_json(chunk, keep).alias("line")))
    )


def read_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """The lines of the files in a folder, or of one file: doc (the file's path), line_no from 1, line.

    Files are read in splits. Within a split lines come in order; how many a split has, and how many stand before it, is
    counted from the written lines, which carry their place in the split."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    split = [F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("_split")]
    lines = written(files.select(*split, F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line")), "lines")
    sizes = lines.groupBy("doc", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("doc").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("doc", "_split", (F.coalesce(before, F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    return lines.join(starts, ["doc", "_split"]).select("doc", (F.col("_id") + F.col("_shift")).cast("int").alias("line_no"), "line")


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the pack files in a folder, or of one pack."""
    return read_lines(spark, path)


@F.arrow_udf(StringType())
def _judged(lines: pa.Array) -> pa.Array:
    """Why a line is no record; null if it is one after all. One line of a batch at a time is a Python string."""

    def why(line: str | None) -> str | None:
        try:
            return None if line is None or isinstance(json.loads(line), dict) else NO_OBJECT
        except (ValueError, RecursionError):
            return NO_JSON

    return pa.array([why(x.as_py()) for x in lines], pa.string())


#: Else a filter on what it says is pushed down as a copy of it, and every task keeps two workers.
_judged = _judged.asNondeterministic()


def record_error(line: Column) -> Column:
    """Null for a JSON object or a blank line, else `json` or `object`. Built-in functions pass what is surely an object;
    they are stricter in one thing (keys that repeat) and laxer in none, and only the other lines go to Python."""
    bare = T.strip(line)
    # The parser does not mind what follows a value. So the line stands in a list before its own hash, which it can't hold.
    told = F.xxhash64(bare)
    pair = F.try_parse_json(F.concat(F.lit("["), bare, F.lit(","), told.cast("string"), F.lit("]"))).try_cast("array<variant>")
    sure = bare.startswith("{") & F.coalesce((F.size(pair) == 2) & (F.get(pair, F.lit(1)).try_cast("long") == told), F.lit(False))
    return _judged(F.when((bare != "") & ~sure, bare))


def told_lines(lines: DataFrame) -> DataFrame:
    """lines (doc, line_no, line) with record_type and kind, what is wrong with a line (null for records and blank lines)."""
    kind = record_error(F.col("line"))
    return lines.select("doc", "line_no", "line", F.get_json_object("line", "$.record_type").alias("record_type"), kind.alias("kind"))


def bad_records(told: DataFrame) -> DataFrame:
    """Of told_lines those that are neither blank nor a JSON object: doc, line_no, kind (`json` or `object`)."""
    return told.where("kind IS NOT NULL").select("doc", "line_no", "kind")


def split_records(told: DataFrame) -> DataFrame:
    """Of told_lines the records that count: the first manifest, the first contents and all chunks, with record_type. Of
    the few manifests and contents the first is looked for by number; chunks are passed on as they are."""
    good = told.where("kind IS NULL").select("doc", "line_no", "line", "record_type")
    heads = good.where("record_type IN ('manifest', 'toc')")
    first = heads.groupBy("doc", "record_type").agg(F.min("line_no").alias("line_no"))
    return good.where("record_type = 'chunk'").unionByName(heads.join(first, ["doc", "record_type", "line_no"], "left_semi").select(good.columns))
