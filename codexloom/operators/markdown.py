"""Markdown notes: headings outside fences, sections, dates and packs.

files: path, text[, modified]. A pack is a set of files; pack_key names it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexloom.functions import text as T
from codexloom.operators.toc import DEEPEST, with_parents

HEADING = r"^(#{1,6})[\t-\r\x1c-\x20\x{3000}]+(.+?)[\t-\r\x1c-\x20]*#*[\t-\r\x1c-\x20]*$"
#: Sections of this level or deeper end at headings of their own level; shallower ones at any heading.
CUT_OFF = 4


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def headings(files: DataFrame) -> DataFrame:
    """Per heading outside ``` and ~~~ fences: doc (path), line, level (marks), title."""
    lines = files.select(F.col("path").alias("doc"), F.posexplode(T.splitlines(F.col("text"))).alias("line", "raw")).withColumn("raw", T.strip(F.col("raw")))
    fence = F.when(F.col("raw").startswith("```") | F.col("raw").startswith("~~~"), 1).otherwise(0)
    seen = F.sum(fence).over(Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    open_ = lines.withColumn("_f", fence).withColumn("_s", seen).where("_f = 0 AND _s % 2 = 0").where(F.col("raw").rlike(HEADING))
    return open_.select("doc", "line", F.length(F.regexp_extract("raw", HEADING, 1)).alias("level"), T.strip(F.regexp_extract("raw", HEADING, 2)).alias("title"))


def sections(files: DataFrame) -> DataFrame:
    """Per file a root section (its stem, level 1) and one per heading (level one deeper), with the text up to its end:
    doc, ord, title, level, parent_ord, path_ords, line, text, is_parent. Front matter is no text."""
    body = files.withColumn("text", T.split_front_matter(F.col("text"))["body"])
    heads = headings(body).select("doc", "line", F.least(F.col("level") + 1, F.lit(7)).alias("level"), "title")
    roots = body.select(F.col("path").alias("doc"), F.lit(-1).alias("line"), F.lit(1).alias("level"), stem(F.col("path")).alias("title"))
    toc = heads.unionByName(roots).withColumn("ord", F.row_number().over(Window.partitionBy("doc").orderBy("line")))
    toc = with_parents(toc)
    after = Window.partitionBy("doc").orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    own = F.least(*[F.when(F.col("level") >= k, F.min(F.when(F.col("level") == k, F.col("line"))).over(after)) for k in range(1, DEEPEST + 1)])
    any_ = F.lead("line").over(Window.partitionBy("doc").orderBy("ord"))
    toc = toc.withColumn("end", F.when(F.col("level") < CUT_OFF, any_).otherwise(own))
    parents = toc.where("parent_ord IS NOT NULL").select("doc", F.col("parent_ord").alias("ord")).distinct().withColumn("is_parent", F.lit(True))
    toc = toc.join(parents, ["doc", "ord"], "left").withColumn("is_parent", F.coalesce("is_parent", F.lit(False)))
    lines = body.select(F.col("path").alias("doc"), T.splitlines(F.col("text")).alias("_l"))
    spans = toc.join(lines, "doc")
    last = F.coalesce("end", F.size("_l"))
    text = F.array_join(F.slice("_l", F.col("line") + 2, F.greatest(F.lit(0), last - F.col("line") - 1)), "\n")
    return T.pinned(spans, text=T.normalize_text(text)).drop("_l", "end")


def select_sections(found: DataFrame) -> DataFrame:
    return found.where((F.col("text") != "") & (F.col("is_parent") | (F.col("level") <= CUT_OFF)))


def dropped_sections(found: DataFrame) -> DataFrame:
    """Sections whose text no chunk has: deep leaves. Their parents' text ends at the heading before them."""
    return found.where((F.col("text") != "") & ~F.col("is_parent") & (F.col("level") > CUT_OFF))


def pack_sections(files: DataFrame) -> DataFrame:
    """sections of packs of files (pack, path, text): doc is the pack, and the numbers of its files' sections follow each
    other by path; path names the file of a section. Headings of one file have no parents in another."""
    found = sections(files).withColumnRenamed("doc", "path")
    sizes = found.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("_n")).join(files.select("pack", "path"), "path")
    before = Window.partitionBy("pack").orderBy(F.split("path", "/")).rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("pack", "path", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("int").alias("_by"))
    out = found.join(shift, "path")
    moved = {"ord": F.col("ord") + F.col("_by"), "parent_ord": F.col("parent_ord") + F.col("_by"), "path_ords": F.transform("path_ords", lambda o: o + F.col("_by"))}
    return out.select(F.col("pack").alias("doc"), *[moved.get(c, F.col(c)).alias(c) for c in found.columns])


def relative_names(files: DataFrame, *by: str) -> DataFrame:
    """files with file_path: the path below the folder that all files of a pack have in common."""
    parts = files.withColumn("_o", F.split("path", "/"))
    ends = parts.groupBy(*by).agg(F.min("_o").alias("_first"), F.max("_o").alias("_last"))
    out = parts.join(ends, list(by)).withColumn("_k", _common(F.col("_first"), F.col("_last")))
    return out.withColumn("file_path", F.array_join(F.slice("_o", F.col("_k") + 1, F.size("_o")), "/")).drop("_o", "_first", "_last", "_k")


def _common(first: Column, last: Column) -> Column:
    """How many folders the first and the last of some sorted paths share; all between them share these too."""
    same = F.aggregate(F.sequence(F.lit(1), F.least(F.size(first), F.size(last))), F.lit(0), lambda a, i: F.when((a == i - 1) & (F.get(first, i - 1) == F.get(last, i - 1)), i).otherwise(a))
    return F.least(same, F.size(first) - 1, F.size(last) - 1)


def metadata(files: DataFrame, profile: str) -> DataFrame:
    """files (path, text[, modified, file_path]) with what a record tells of its file. The store knows when a file was
    changed but not when it was made, so both times are that one."""
    front = T.simple_yaml(T.split_front_matter(F.col("text"))["head"])
    rows = files.withColumn("file_name", file_name(F.col("path"))).withColumn("file_stem", stem(F.col("path"))).withColumn("front_matter_date", T.first_date(front))
    if "file_path" not in files.columns:
        rows = rows.withColumn("file_path", F.col("file_name"))
    named = T.journal_date(F.col("file_stem")) if profile == "journal" else F.lit(None).cast("string")
    changed = T.timestamp_iso(F.col("modified")) if "modified" in files.columns else F.lit(None).cast("string")
    rows = rows.withColumn("file_created_at", changed).withColumn("file_modified_at", changed)
    rows = rows.withColumn("source_type", F.lit("markdown")).withColumn("markdown_profile", F.lit(profile))
    rows = rows.withColumn("logical_date", F.coalesce(named, T.normalize_date(F.col("front_matter_date")), F.left("file_modified_at", F.lit(10))))
    return rows.withColumn("logical_month", F.left("logical_date", F.lit(7)))


#: What a record tells of its file, in order (fixed names).
METADATA = ("source_type", "markdown_profile", "file_name", "file_stem", "file_path", "file_created_at", "file_modified_at", "front_matter_date", "logical_date", "logical_month")


def with_sources(chunks: DataFrame, found: DataFrame, files: DataFrame) -> DataFrame:
    """chunks with source_metadata, what is told of the file of their first section, and merged_sources, that of all
    different files (by path and date) if there are several. found: doc, ord, path; files: path and metadata."""
    told = files.select("path", F.struct(*METADATA).alias("_m"))
    steps = chunks.select("doc", "chunk_index", F.posexplode("source_ords").alias("_pos", "ord")).join(found.select("doc", "ord", "path"), ["doc", "ord"]).join(told, "path")
    rows = steps.groupBy("doc", "chunk_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_m"))), lambda x: x["_m"]).alias("_s"))
    same = lambda a, b: a["file_path"].eqNullSafe(b["file_path"]) & a["logical_date"].eqNullSafe(b["logical_date"])
    own = F.filter("_s", lambda x, i: ~F.exists(F.slice("_s", 1, i), lambda y: same(x, y)))
    rows = T.pinned(rows, _own=own)
    return chunks.join(rows.select("doc", "chunk_index", F.col("_s")[0].alias("source_metadata"), F.when(F.size("_own") > 1, F.col("_own")).alias("merged_sources")), ["doc", "chunk_index"], "left")


def collect_jobs(files: DataFrame, root: str) -> DataFrame:
    """The packs of the notes below root: job_ord, profile, title, output_stem, pack and path, a row per file.

    root/journal holds notes by day, root/TechNotes folders and loose notes, root/WebPageCollection pages."""
    below = re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/") + "/"
    inner = files.select("path", F.substring("path", F.locate(below, F.col("path")) + len(below), F.length("path")).alias("_rel")).where(F.contains(F.col("path"), F.lit(below)))
    inner = inner.withColumn("_top", F.substring_index("_rel", "/", 1)).withColumn("_rel", F.substring("_rel", F.length("_top") + 2, F.length("_rel")))
    part = lambda name: inner.where(F.col("_top") == name).select(F.col("_rel").alias("path"))
    days = part("journal").where(~F.contains(F.col("path"), F.lit("/")) & F.col("path").endswith(".md"))
    jobs = all_packs(days, part("TechNotes"), part("WebPageCollection")).withColumn("pack", F.concat_ws("/", "profile", "title", F.col("files")[0]))
    top = F.when(F.col("profile") == "journal", "journal").when(F.col("profile") == "tech_notes", "TechNotes").otherwise("WebPageCollection")
    rows = jobs.withColumn("_top", top).withColumn("_rel", F.explode("files")).drop("files")
    return rows.join(inner, ["_top", "_rel"]).drop("_top", "_rel")


def journal_packs(paths: DataFrame) -> DataFrame:
    """One pack per month of the file name; names without a date share one."""
    month = F.coalesce(F.left(T.journal_date(stem(F.col("path"))), F.lit(7)), F.lit("undated"))
    out = paths.groupBy(month.alias("pack_key")).agg(F.array_sort(F.collect_list("path")).alias("files"))
    return out.select("pack_key", F.concat(F.lit("日记 "), "pack_key").alias("title"), F.concat(F.lit("journal_"), "pack_key").alias("output_stem"), "files")


def tech_note_packs(paths: DataFrame) -> DataFrame:
    """One pack per folder at the top, with all files below it; a loose file is a pack of its own. path is relative."""
    key = F.when(F.contains(F.col("path"), F.lit("/")), F.substring_index("path", "/", 1)).otherwise(stem(F.col("path")))
    loose = ~F.contains(F.col("path"), F.lit("/"))
    suffix = F.when(loose, F.lower("path").endswith(".md")).otherwise(F.col("path").endswith(".md"))
    out = paths.where(suffix).groupBy(key.alias("title"), loose.alias("loose")).agg(F.array_sort(F.collect_list("path")).alias("files"))
    return out.select("title", T.safe_stem(F.col("title")).alias("output_stem"), "loose", "files")


def web_page_packs(paths: DataFrame) -> DataFrame:
    return paths.where(F.col("path").endswith(".md")).select(stem(F.col("path")).alias("title"), T.safe_stem(stem(F.col("path"))).alias("output_stem"), F.array("path").alias("files"))


def all_packs(journal: DataFrame, notes: DataFrame, web: DataFrame) -> DataFrame:
    """Journal, notes and web packs with their profile, in that order."""
    shape = lambda df, n, profile: df.select(F.lit(n).alias("job_ord"), F.lit(profile).alias("profile"), "title", "output_stem", "files")
    return shape(journal_packs(journal), 1, "journal").unionByName(shape(tech_note_packs(notes), 2, "tech_notes")).unionByName(shape(web_page_packs(web), 3, "web_page_collection"))


def source_hash(files: DataFrame, *by: str) -> DataFrame:
    """Per pack the digest of its files' names below their common folder and digests, in the order of paths."""
    pair = F.struct(F.split("path", "/").alias("o"), T.sha256_text(F.col("text")).alias("h"))
    rows = files.groupBy(*by).agg(F.array_sort(F.collect_list(pair)).alias("_f"))
    rows = rows.withColumn("_k", _common(F.element_at("_f", 1)["o"], F.element_at("_f", -1)["o"]))
    listed = F.flatten(F.transform("_f", lambda x: F.array(F.array_join(F.slice(x["o"], F.col("_k") + 1, F.size(x["o"])), "/"), x["h"])))
    return rows.select(*by, T.sha256_text(F.to_json(F.struct(listed.alias("files")))).alias("document_id"))

