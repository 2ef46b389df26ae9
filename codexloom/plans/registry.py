"""Named queries over the driver's tables, and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexloom import engine
from codexloom.functions import headings as H
from codexloom.functions import text as T
from codexloom.functions.profiles import BOOK_PROFILES, PROFILES, profile_table
from codexloom.operators import chunking, classify, embed, inspect, markdown, packs, toc
from codexloom.plans import chunk_oracles
from codexloom.plans import corpora as C
from codexloom.plans import oracles as O
from codexloom.session import written
from codexloom.sources import files as S

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books from documents, with their chunks judged: a verdict per book."""
    return inspect_result(spark, sf_dir)


def _key(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc", "book")


# ---- text -----------------------------------------------------------------------------------------------------------


def _odd_text() -> Column:
    return F.concat(F.lit("　"), F.replace("text", F.lit(". "), F.lit(".　 \t\r\n\n\n\n")), F.lit(" \t "))


@query
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", F.sha2(T.normalize_text(_odd_text()), 256).alias("normalized"))


@query
def compact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", F.sha2(T.compact_text(_odd_text()), 256).alias("compact"))


@query
def preview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", T.preview_text(F.col("text"), 40).alias("preview"))


@query
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", T.sha256_text(F.col("text")).alias("content_hash"))


@query
def document_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "pages").select("page_id", packs.document_id(F.col("html").cast("binary")).alias("document_id"), packs.chunk_id(F.lit("d"), F.col("page_id").cast("int")).alias("chunk_id"))


@query
def safe_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "pages").select("page_id", T.safe_stem(F.col("url")).alias("stem"), T.safe_filename(F.col("url")).alias("name"))


@query
def english_ratio_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("text", F.lit("摘要第"), F.repeat(F.lit("字"), (F.col("doc_id") % 300).cast("int")))
    return C.documents(spark, sf_dir).select("doc_id", T.english_letters(text).alias("letters"), T.cjk_letters(text).alias("cjk"), (T.english_ratio(text) > 0.55).alias("mostly_english"))


def _marked() -> Column:
    i = F.col("doc_id")
    return F.concat("text", F.when(i % 4 == 0, "□■�").when(i % 4 == 1, "字a中b文Ab字").when(i % 4 == 2, "\ue001").otherwise(""))


@query
def garbled_ratio_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad, n = T.garbled_counts(_marked())
    return C.documents(spark, sf_dir).select("doc_id", bad.alias("suspicious"), n.alias("characters"), T.looks_garbled(_marked()).alias("garbled"))


@query
def is_garbled_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", T.is_garbled_title(_marked()).alias("garbled"))


@query
def normalize_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", T.normalize_title(F.concat(F.lit("ﬁ Ａ１："), "text")).alias("title"))


@query
def reflow_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", F.sha2(T.reflow_text(F.col("text")), 256).alias("reflowed"))


@query
def flatten_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), "text")
    return toc.flatten_lines(pages, normalized=False).select(F.col("doc").alias("doc_id"), "idx", "text")


@query
def sample_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("doc").orderBy("doc_id")
    rows = C.in_books(spark, sf_dir).select("doc_id", F.concat("text", F.coalesce(F.lag("text").over(w), F.lit(""))).alias("a"), F.coalesce(F.lag("text").over(w), F.lit("")).alias("b"))
    rows = T.pinned(rows, m=T.sample_matches(F.col("a"), F.col("b"), 80, 120))
    return rows.select("doc_id", "m.matched", "m.samples", T.rate_of(F.col("m")).cast("double").alias("rate"))


# ---- headings and contents ------------------------------------------------------------------------------------------


def _candidates(profile: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = toc.flatten_lines(C.book(spark, sf_dir, "en" if profile == "english" else "zh"), normalized=False)
        return _key(lines.where(H.is_possible_heading(F.col("text"), profile)).select("doc", "idx", "text", H.own_level(F.col("text"), profile).alias("own_level")))

    return run


def _infer(profile: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _key(toc.infer_toc(C.book(spark, sf_dir, "en" if profile == "english" else "zh"), profile).select("doc", "ord", "toc_id", "title", "level", "parent_ord"))

    return run


for _p in BOOK_PROFILES:
    _QUERIES[f"heading_candidates_{_p}"] = _candidates(_p)
    _QUERIES[f"infer_toc_{_p}"] = _infer(_p)


@query
def body_short_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, as it is and behind a Chinese phrase."""
    lines = C.documents(spark, sf_dir).select("doc_id", F.posexplode(T.splitlines(F.col("text"))).alias("i", "raw")).withColumn("raw", T.strip(F.col("raw")))
    tail = F.when(F.col("doc_id") % 3 == 0, "（一）").when(F.col("doc_id") % 3 == 1, "：").otherwise("")
    tried = lines.select("doc_id", "i", F.explode(F.array(F.col("raw"), F.concat(F.lit("批判思维"), "raw", tail))).alias("line"))
    return tried.where(H.is_body_short_heading(F.col("line"), "textbook"))


@query
def toc_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(toc.toc_paths(toc.infer_toc(C.book(spark, sf_dir), "textbook")))


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of every book, an entry per document, printed over its first ten pages."""
    rows = C.in_books(spark, sf_dir).select("doc", F.col("n").cast("int").alias("ord"), F.count(F.lit(1)).over(Window.partitionBy("doc")).alias("m"))
    rows = rows.withColumn("page", (F.floor((F.col("ord") - 1) / F.ceil(F.col("m") / 10)) + 1).cast("int"))
    return rows.withColumn("title", F.concat(F.lit("第"), F.col("ord").cast("string"), F.when(F.col("ord") % 3 == 0, "章 ").otherwise("篇 "), "doc"))


def _contents_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their part of the printed contents, its last line twice, and then the text of a document."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "title"))), lambda x: x["title"]), "\n")
    printed = _contents(spark, sf_dir).groupBy("doc", "page").agg(F.concat(F.lit("目录\n"), listed, F.lit("\n"), F.max_by("title", "ord")).alias("head"))
    rows = C.in_books(spark, sf_dir).select("doc", F.col("n").cast("int").alias("page"), "text").join(printed, ["doc", "page"], "left")
    return rows.select("doc", "page", F.concat_ws("\n", "head", "text").alias("text"))


@query
def front_matter_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(toc.front_matter_candidates(_contents_pages(spark, sf_dir)))


@query
def repair_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    outline = _contents(spark, sf_dir).drop("m", "page").withColumn("level", F.when(F.col("ord") % 3 == 0, 2).otherwise(1)).withColumn("title", F.when(F.col("ord") % 4 == 0, F.lit("\ue000\ue001")).otherwise(F.col("title")))
    return _key(toc.repair_titles(outline, _contents_pages(spark, sf_dir)).select("doc", "ord", "title", "repaired"))


def _outline(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The book's own contents with pages off by one and some titles altered; lines: the book's, if they are there."""
    found = toc.infer_toc(C.book(spark, sf_dir), "textbook") if lines is None else toc.infer_from_lines(lines, "textbook")
    found = found.where(F.col("title").rlike("^第"))
    title = F.when(F.col("ord") % 5 == 0, F.concat("title", F.lit(" and more than that"))).when(F.col("ord") % 7 == 3, F.concat(F.lit("※"), F.substring("title", 2, 200))).otherwise(F.col("title"))
    return found.select("doc", "ord", title.alias("title"), "level", F.greatest(F.lit(1), F.col("page") + F.col("ord") % 3 - 1).cast("int").alias("page"))


@query
def locate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = written(toc.flatten_lines(C.book(spark, sf_dir)), "lines")
    return _key(toc.locate_pages(_outline(spark, sf_dir, lines), lines).select("doc", "ord", "page", "method", "confidence"))


def _textbook(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Contents and lines of the books, each written once."""
    pages = C.book(spark, sf_dir)
    lines = written(toc.flatten_lines(pages), "lines")
    return written(toc.infer_from_lines(lines, "textbook"), "toc"), lines


@query
def locate_heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(toc.locate_heading_lines(*_textbook(spark, sf_dir)))


@query
def locate_headings_behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The books' contents without pages, with altered titles on pages far behind, or with titles that no line has."""
    found, lines = _textbook(spark, sf_dir)
    k = F.col("ord") % 4
    title = F.when(k == 2, F.concat(F.lit("※"), F.substring("title", 2, 200))).when(k == 3, F.concat(F.lit("Nowhere at all "), F.col("ord").cast("string"))).otherwise(F.col("title"))
    page = F.when(k == 2, F.col("page") + 5).when(k == 3, F.col("page") + 1).when(k == 0, F.col("page"))
    some = found.where(F.col("title").rlike("^第")).select("doc", "ord", title.alias("title"), page.cast("int").alias("page"))
    return _key(toc.locate_heading_lines(some, lines))


@query
def candidate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.floor(F.col("event_id") / 7).cast("int").alias("idx")).distinct()
    return toc.candidate_runs(rows, "doc").select(F.col("doc").alias("user_id"), "idx")


@query
def augment_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.book(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n批判性思维的第"), F.col("page").cast("string"), F.lit("要素")))
    lines = written(toc.flatten_lines(pages), "lines")
    found = toc.infer_from_lines(lines, "textbook").where(F.col("title").rlike(H.CHAPTER))
    found = written(toc.with_parents(found.drop("parent_ord", "path_ords").withColumn("ord", F.row_number().over(Window.partitionBy("doc").orderBy("ord")))), "toc")
    starts = written(toc.locate_heading_lines(found, lines), "starts")
    return _key(toc.augment_headings(found, lines, starts, "textbook").select("doc", "parent_ord", "idx", "title", "level", "page"))


@query
def augment_headings_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with more short headings than a chapter takes, some in several chapters, some in runs of three lines."""
    n = F.col("page").cast("string")
    runs = F.when(F.col("page") % 5 == 0, F.concat(*[x for k in "甲乙丙" for x in (F.lit(f"\n连续短标题{k}"), n)])).otherwise("")
    more = F.concat(F.lit("\n批判性思维的第"), n, F.lit("要素\n这一行不是标题。\n批判思维小结之"), (F.col("page") % 4).cast("string"), F.lit("\n这一行也不是。"), runs)
    pages = C.book(spark, sf_dir).withColumn("text", F.concat("text", more))
    lines = written(toc.flatten_lines(pages), "lines")
    found = toc.infer_from_lines(lines, "textbook").where(F.col("title").rlike(H.CHAPTER))
    found = written(toc.with_parents(found.drop("parent_ord", "path_ords").withColumn("ord", F.row_number().over(Window.partitionBy("doc").orderBy("ord")))), "toc")
    starts = written(toc.locate_heading_lines(found, lines), "starts")
    return _key(toc.augment_headings(found, lines, starts, "textbook").select("doc", "parent_ord", "idx", "title", "toc_id"))


# ---- sections and chunks --------------------------------------------------------------------------------------------


def _book(spark: SparkSession, sf_dir: str, profile: str = "textbook") -> engine.Book:
    return engine.build_books(C.book(spark, sf_dir), profile)


def _spans(max_level: int | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        contents, lines = _textbook(spark, sf_dir)
        return _key(toc.section_ends(contents, toc.locate_heading_lines(contents, lines), max_level).select("doc", "ord", "start", "end"))

    return run


_QUERIES["section_spans"] = _spans(None)
_QUERIES["section_spans_max_level"] = _spans(1)


@query
def book_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _book(spark, sf_dir).sections
    return _key(found.select("doc", "ord", "toc_id", "level", "page_start", "page_end", F.sha2("text", 256).alias("text_sha256")))


@query
def paragraph_sentence_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.replace("text", F.lit(". "), F.lit("。 ")), F.lit(",\n"), F.lit("\n\n"))
    return C.documents(spark, sf_dir).select("doc_id", F.posexplode(chunking.units(text)).alias("pos", "unit")).select("doc_id", "pos", F.length("unit").alias("n"), F.sha2("unit", 256).alias("unit"))


@query
def oversized_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", F.posexplode(chunking.windows_of(F.col("text"), 300, 20)).alias("pos", "part")).select("doc_id", "pos", F.sha2("part", 256).alias("part"))


@query
def long_section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", F.posexplode(chunking.split_long(F.replace("text", F.lit(". "), F.lit("。 ")), 300, 20)).alias("pos", "part")).select("doc_id", "pos", F.length("part").alias("n"), F.sha2("part", 256).alias("part"))


@query
def sibling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = toc.infer_toc(C.book(spark, sf_dir), "textbook")
    return _key(chunking.sibling_runs(contents).select("doc", "ord", "run"))


@query
def chunks_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(_book(spark, sf_dir).chunks.select("doc", "chunk_index", "reason", F.length("text").alias("n"), F.sha2("text", 256).alias("text_sha256")))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _book(spark, sf_dir)
    rows = packs.heading_paths(built.chunks, built.toc).withColumn("document_id", F.concat(F.lit("sha256:"), "doc")).withColumn("book_title", F.col("doc"))
    return packs.chunk_records(rows)


@query
def chunk_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(_records(spark, sf_dir).select("doc", "chunk_index", "chunk_id", "prev_chunk_id", "next_chunk_id", "content_hash"))


@query
def embedding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    path = F.when(i % 2 == 0, F.array("source", "lang")).otherwise(F.array().cast("array<string>"))
    merged = F.when(i % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    return C.documents(spark, sf_dir).select("doc_id", F.sha2(packs.embedding_text(F.col("source"), path, merged, F.col("text")), 256).alias("embedding_text"))


@query
def pack_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir).select(C.book_key().alias("doc")).distinct().select("doc", F.concat(F.lit("sha256:"), "doc").alias("document_id"), F.col("doc").alias("title"), F.concat("doc", F.lit(".txt")).alias("file_name"))
    return _key(engine.pack_table(_book(spark, sf_dir), docs, "textbook", created=F.lit("2024-01-01T00:00:00+00:00")))


def _note_packs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Notes in packs of several folders and files, by the length of their names and numbers, and the packs."""
    digits = F.regexp_extract("path", r"(\d+)", 1).cast("long")
    files = C.notes(spark, sf_dir).withColumn("pack", F.concat(F.lit("pack"), (digits % 40).cast("string"))).withColumn("path", F.concat(F.lit("notes/part"), (digits % 3).cast("string"), F.lit("/"), "path"))
    files = files.withColumn("modified", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    return files, files.select(F.col("pack").alias("doc")).distinct().select("doc", F.col("doc").alias("title"), F.col("doc").alias("file_name"))


@query
def markdown_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers, kinds, identifiers and sources of the records of packs of several notes."""
    lines = engine.markdown_packs(*_note_packs(spark, sf_dir), "tech_notes", created=F.lit("2024-01-01T00:00:00+00:00"))
    at = lambda path: F.get_json_object("line", f"$.{path}")
    names = {"kind": "record_type", "document_id": "document_id", "file_path": "source.file_path", "logical_date": "source.logical_date", "items": "toc.item_count", "text": "text"}
    rows = lines.select("doc", "line_no", *[at(p).alias(n) for n, p in names.items()]).withColumn("text", F.sha2("text", 256))
    return rows.withColumnRenamed("doc", "pack")


@query
def markdown_pack_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markdown.pack_sections(_note_packs(spark, sf_dir)[0])
    return found.select(F.col("doc").alias("pack"), "path", "ord", "title", "level", "parent_ord", F.array_join("path_ords", ">").alias("path_ords"))


@query
def relative_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.relative_names(_note_packs(spark, sf_dir)[0], "pack").select("pack", "path", "file_path")


# ---- Markdown -------------------------------------------------------------------------------------------------------


@query
def md_headings_fenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = C.notes(spark, sf_dir).withColumn("text", T.split_front_matter(F.col("text"))["body"])
    return markdown.headings(files).withColumnRenamed("doc", "path")


@query
def md_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.sections(C.notes(spark, sf_dir)).select(F.col("doc").alias("path"), "ord", "title", "level", "parent_ord", "is_parent", F.sha2("text", 256).alias("text_sha256"))


@query
def md_dropped_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.dropped_sections(markdown.sections(C.notes(spark, sf_dir))).select(F.col("doc").alias("path"), "title", "level")


@query
def chunks_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine.build_markdown(C.notes(spark, sf_dir)).chunks.select(F.col("doc").alias("path"), "chunk_index", "reason", F.length("text").alias("n"))


@query
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = T.split_front_matter(F.col("text"))
    rows = C.notes(spark, sf_dir).withColumn("m", T.simple_yaml(parts["head"]))
    return rows.select("path", F.try_element_at("m", F.lit("created")).alias("created"), F.try_element_at("m", F.lit("title")).alias("title"), F.sha2(parts["body"], 256).alias("body_sha256"))


@query
def logical_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = C.notes(spark, sf_dir).withColumn("modified", F.lit("2020-02-03 04:05:06").cast("timestamp"))
    days = C.journal(spark, sf_dir).select("path", F.lit("plain").alias("text"), F.lit("2020-02-03 04:05:06").cast("timestamp").alias("modified"))
    shape = lambda df, p: markdown.metadata(df, p).select("path", "front_matter_date", "logical_date", "logical_month")
    return shape(files, "tech_notes").unionByName(shape(days, "journal"))


@query
def journal_month_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.journal_packs(C.journal(spark, sf_dir)).select("pack_key", "title", "output_stem", F.size("files").cast("long").alias("n_files"), F.array_join("files", ",").alias("files"))


@query
def tech_note_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.tech_note_packs(C.paths(spark, sf_dir)).select("title", "output_stem", "loose", F.array_join("files", ",").alias("files"))


@query
def web_page_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.web_page_packs(C.paths(spark, sf_dir)).select("title", "output_stem", F.array_join("files", ",").alias("files"))


@query
def markdown_source_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.source_hash(C.notes(spark, sf_dir).withColumn("bucket", F.pmod(F.length("path"), F.lit(3)).cast("int")), "bucket")


# ---- profiles and classification ------------------------------------------------------------------------------------


@query
def profile_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameters that documents get by their profile, where none of their own is given."""
    i, names = F.col("doc_id"), F.array(*[F.lit(p) for p in (*PROFILES, "unknown")])
    asked = C.documents(spark, sf_dir).select("doc_id", F.element_at(names, (i % 13 + 1).cast("int")).alias("profile"), F.when(i % 3 == 0, 500 + i % 7).cast("int").alias("target"), F.when(i % 4 == 0, 0).alias("overlap"))
    rows = asked.join(F.broadcast(profile_table(spark)), "profile", "left")
    return rows.withColumn("target_chars", F.coalesce("target", "target_chars")).withColumn("overlap_chars", F.coalesce("overlap", "overlap_chars")).drop("target", "overlap")


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    names = F.array(*[F.lit(p) for p in (*BOOK_PROFILES, "unknown")])
    rows = C.documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.element_at(names, (i % 10 + 1).cast("int")).alias("profile"))
    return rows.select("doc", "profile", F.lit(700).alias("target_chars"), F.lit(1100).alias("max_chars"), F.lit(2000).alias("section_split_chars"), F.lit(180).alias("min_chunk_chars"), F.when(F.col("doc") % 4 != 0, 80).alias("overlap_chars"), F.when(F.col("doc") % 3 == 0, "none").otherwise("local").alias("provider"), (F.col("doc") % 2).cast("int").alias("dimension"))


@query
def profile_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect.profile_mismatches(_meta(spark, sf_dir)).select(F.col("doc").alias("doc_id"), "profile", "known", F.array_join("mismatches", ",").alias("mismatches"))


@query
def check_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inspect.check_profile(_meta(spark, sf_dir))
    return found.select(F.col("doc").alias("doc_id"), "ord", "status", "message", F.to_json("detail").alias("detail"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    extra = F.when(i % 6 == 0, "\n第一章 总论\n第一节 概念\n第二条 规定\n").when(i % 6 == 1, "\nAbstract\nKeywords: a\nReferences\n").when(i % 6 == 2, "\n1 Intro\n1.1 API\n1.1.1 x\n2.1.1 y\n").when(i % 6 == 3, "\n卷一\n高祖纪\n陈涉传\n列传\n").when(i % 6 == 4, "\nPart I One\nChapter 1 Two\n").otherwise("")
    return C.documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.concat("text", extra).alias("sample"))


@query
def classify_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify.classify(_samples(spark, sf_dir))
    return out.select(F.col("doc").alias("doc_id"), *[F.element_at("scores", F.lit(p)).alias(p) for p in BOOK_PROFILES])


@query
def classify_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_samples(spark, sf_dir)).select(F.col("doc").alias("doc_id"), "profile", "score_text")


@query
def classify_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_samples(spark, sf_dir)).select(F.col("doc").alias("doc_id"), F.array_join("signals", " | ").alias("signals"))


@query
def recommend_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect.recommend_profile(classify.classify(_samples(spark, sf_dir)), _meta(spark, sf_dir)).withColumnRenamed("doc", "doc_id").drop("signals")


# ---- inspection -----------------------------------------------------------------------------------------------------


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the chunks of their book."""
    path = F.when(F.col("doc_id") % 9 == 0, F.array().cast("array<string>")).otherwise(F.array("source", "lang"))
    return C.in_books(spark, sf_dir).select("doc", "doc_id", F.col("n").alias("chunk_index"), "text", path.alias("heading_path"))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select(C.book_key().alias("doc")).distinct().withColumn("section_split_chars", F.lit(2000))


@query
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(inspect.length_stats(_chunks(spark, sf_dir), _split(spark, sf_dir)).drop("split"))


@query
def length_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(inspect.check_lengths(inspect.length_stats(_chunks(spark, sf_dir), _split(spark, sf_dir))).select("doc", "status", "message", F.to_json("detail").alias("detail")))


@query
def heading_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(inspect.heading_stats(_chunks(spark, sf_dir)).drop("body_heading_chunks", "auto_heading_chunks"))


@query
def heading_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inspect.check_headings(inspect.heading_stats(_chunks(spark, sf_dir)))
    return _key(found.select("doc", "status", "message", F.to_json("detail").alias("detail")))


@query
def garbled_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chunks(spark, sf_dir).withColumn("marked", _marked()).withColumn("heading_path", F.array("marked")).drop("text").withColumnRenamed("marked", "text")
    found = inspect.garbled_stats(rows.select("doc", F.col("chunk_index").alias("ord"), F.element_at("heading_path", 1).alias("title")), rows)
    joined = lambda c: F.sha2(F.array_join(c, "\n").cast("binary"), 256).alias(c)
    return _key(found.select("doc", "garbled_titles", "garbled_headings", "garbled_chunks", joined("title_examples"), joined("heading_examples")))


@query
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(_coverage(spark, sf_dir))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every book against some of its documents: most, few or none; none where the length of its name is a multiple of 4."""
    rows = _chunks(spark, sf_dir)
    pages = rows.select("doc", F.col("chunk_index").alias("page"), "text")
    return inspect.coverage(pages, rows.where(F.try_mod("chunk_index", F.length("doc") % 4) > 0))


@query
def coverage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(inspect.check_coverage(_coverage(spark, sf_dir)).select("doc", "status", "message", F.to_json("detail").alias("detail")))


@query
def sample_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(inspect.sample_chunks(_chunks(spark, sf_dir)))


@query
def compare_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chunks(spark, sf_dir).withColumn("page_start", F.col("chunk_index")).withColumn("page_end", F.col("chunk_index"))
    return _key(inspect.compare_samples(rows, rows.select("doc", F.col("chunk_index").alias("page"), "text")))


@query
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(inspect.level_counts(toc.infer_toc(C.book(spark, sf_dir), "textbook")))


@query
def recommend_heading_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _split(spark, sf_dir).withColumn("profile", F.lit("textbook")).withColumn("max_chunk_heading_level", F.lit(1))
    found = inspect.recommend_level(meta, toc.infer_toc(C.book(spark, sf_dir), "textbook"), inspect.length_stats(_chunks(spark, sf_dir), meta))
    return _key(found.withColumn("toc_level_counts", F.to_json("toc_level_counts")))


@query
def recommend_body_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chunks(spark, sf_dir)
    meta = _split(spark, sf_dir).withColumn("profile", F.lit("textbook")).withColumn("toc_source", F.lit("pdf_outline"))
    pages = rows.select("doc", F.col("chunk_index").alias("page"), F.concat("text", F.lit("\n批判性思维要素")).alias("text"))
    return _key(inspect.recommend_body_headings(meta, inspect.body_heading_candidates(pages), inspect.length_stats(rows, meta), inspect.heading_stats(rows)))


@query
def check_file_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc"), F.when(F.col("page_id") % 5 > 0, T.sha256_text(F.col("html"))).otherwise("sha256:0").alias("expected_hash"), packs.document_id(F.col("html").cast("binary")).alias("actual_hash"), F.concat(F.lit("a/"), F.col("page_id").cast("string")).alias("source_name"), F.when(F.col("page_id") % 7 == 0, "other").otherwise(F.col("page_id").cast("string")).alias("actual_name"))
    return inspect.check_file_match(rows).select(F.col("doc").alias("page_id"), "status", "message", F.to_json("detail").alias("detail"))


def _poor_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs of the books' documents, a chunk per document, with faults by number: manifests without title, contents that
    are no list, chunks that lack keys, have a path that is no list, a blank text or an index of their own, lines that are
    cut off, in a list, or followed by more."""
    rows, i = C.in_books(spark, sf_dir), F.col("doc_id")
    books = rows.select("doc").distinct()
    even, third = F.length("doc") % 2 == 0, F.length("doc") % 3 == 0
    empty = F.struct(F.lit("x").alias("x"))
    head = F.to_json(F.struct(F.lit("manifest").alias("record_type"), F.lit("1.0").alias("schema_version"), F.col("doc").alias("document_id"), F.when(~even, F.col("doc")).alias("title"), empty.alias("source"), empty.alias("toc"), empty.alias("chunking"), empty.alias("embedding")))
    contents = F.when(third, '{"record_type":"toc","items":"[none]"}').otherwise('{"record_type":"toc","items":[{"title":"a"},{"title":"b"}]}')
    text = F.when(i % 13 == 0, " ").otherwise(F.col("text"))
    index = F.when(i % 97 == 5, F.col("n") + 1).otherwise(F.col("n")).cast("int")
    one = F.to_json(F.struct(F.lit("chunk").alias("record_type"), F.col("doc_id").cast("string").alias("chunk_id"), index.alias("chunk_index"), text.alias("text"), text.alias("embedding_text"), empty.alias("source"), F.lit("p").alias("prev_chunk_id"), F.when(i % 7 != 0, "n").alias("next_chunk_id"), F.when(i % 21 != 0, empty).alias("stats"), empty.alias("split_info")))
    path = F.when(i % 11 == 0, ',"heading_path":"[a]"').otherwise(',"heading_path":["a"]')
    vector = F.when(i % 29 == 0, ',"embedding":null').otherwise(',"embedding":[]')
    whole = F.concat(F.substring(one, F.lit(1), F.length(one) - 1), path, vector, F.lit("}"))
    line = F.when(i % 17 == 1, F.substring(whole, F.lit(1), F.length(whole) - 1)).when(i % 19 == 1, F.concat(F.lit("["), whole, F.lit("]"))).when(i % 23 == 1, F.concat(whole, F.lit(" {}"))).when(i % 31 == 1, F.lit(" \t")).otherwise(whole)
    lines = [books.select("doc", F.lit(1).alias("line_no"), head.alias("line")), books.select("doc", F.lit(2).alias("line_no"), contents.alias("line")), rows.select("doc", (F.col("n") + 2).cast("int").alias("line_no"), line.alias("line"))]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


@query
def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(packs.bad_records(packs.told_lines(_poor_packs(spark, sf_dir))))


@query
def check_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inspect.check_records(packs.bad_records(written(packs.told_lines(_poor_packs(spark, sf_dir)), "records")))
    return _key(found.select("doc", "ord", "status", "message", F.to_json("detail").alias("detail")))


@query
def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = written(packs.told_lines(_poor_packs(spark, sf_dir)), "records")
    return _key(inspect.check_schema(packs.split_records(told)).select("doc", "ord", "status", "message", F.to_json("detail").alias("detail")))



@query
def inspect_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = written(C.book(spark, sf_dir), "pages")
    hashes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.sha2("text", 256).alias("h")))), lambda x: x["h"]), "")
    sources = pages.groupBy("doc").agg(T.sha256_text(hashes).alias("document_id")).select("doc", "document_id", F.col("doc").alias("title"), F.concat("doc", F.lit(".txt")).alias("file_name"))
    out = engine.inspect_books(engine.build_books(pages, "textbook"), pages, "textbook", sources)
    return _key(out.select("doc", "passed", "warned", "failed", "score", "result", "recommendation", "recommendations", "samples"))


@query
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, split = _chunks(spark, sf_dir), _split(spark, sf_dir)
    checks = inspect.check_lengths(inspect.length_stats(rows, split)).unionByName(inspect.check_headings(inspect.heading_stats(rows)))
    odd = split.select("doc", F.lit("a").alias("expected_hash"), F.when(F.length("doc") % 2 == 0, "a").otherwise("b").alias("actual_hash"), F.lit("x/n").alias("source_name"), F.lit("n").alias("actual_name"))
    checks = checks.unionByName(inspect.check_file_match(odd))
    return _key(inspect.verdict(checks).select("doc", "passed", "warned", "failed", "score", "result"))


@query
def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, split = _chunks(spark, sf_dir), _split(spark, sf_dir)
    checks = inspect.check_lengths(inspect.length_stats(rows, split)).unionByName(inspect.check_headings(inspect.heading_stats(rows)))
    found = inspect.compare_samples(rows.withColumn("page_start", F.col("chunk_index")).withColumn("page_end", F.col("chunk_index")), rows.select("doc", F.col("chunk_index").alias("page"), "text"))
    return _key(inspect.reports(inspect.with_samples(inspect.with_checks(inspect.verdict(checks), checks), found)))


# ---- embeddings and sources -----------------------------------------------------------------------------------------


@query
def null_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", F.size(embed.embedding(F.col("text"))).alias("dimension"))


@query
def hash_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.documents(spark, sf_dir).select("doc_id", embed.embedding(F.col("text"), embed.hash_embedder(16)).alias("embedding"))


@query
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "embeddings").select("vec_id", embed.l2_normalize(F.col("embedding")).alias("v"))
    return rows.select("vec_id", F.posexplode("v").alias("pos", "x")).select("vec_id", "pos", F.round("x", 6).alias("x"))


@query
def failed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unsupported_files(_raw(spark, sf_dir))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    return C.table(spark, sf_dir, "pages").select(F.concat(F.lit("raw/p"), i.cast("string"), F.when(i % 4 == 0, ".pdf").when(i % 4 == 1, ".TXT").when(i % 4 == 2, ".docx").otherwise("")).alias("path"))


@query
def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.source_files(_raw(spark, sf_dir)).where(~classify.is_ignored_file(markdown.file_name(F.col("path"))))


@query
def match_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id").cast("string")
    made = C.table(spark, sf_dir, "pages").select(F.concat(F.lit("out/p"), i, F.lit("_noembedding.pack.jsonl")).alias("path"))
    found, missing = S.match_packs(made, S.source_files(_raw(spark, sf_dir), ".pdf"))
    return found.unionByName(missing.withColumn("book", F.lit(None).cast("string"))).select("pack", "stem", "book")


@query
def sample_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key(classify.sample_text(C.book(spark, sf_dir)).select("doc", F.sha2("sample", 256).alias("sample")))


@query
def remove_heading_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title in the second line, in the first beyond the twentieth, or in none."""
    i = F.col("doc_id")
    text = F.concat(F.when(i % 3 == 1, F.lit("x\n" * 20)).otherwise("Intro line\n"), F.lit("The Title Of It, and so much more\n"), "text")
    title = F.when(i % 3 == 2, "Absent Title Here").otherwise("The Title Of It, and so little")
    return C.documents(spark, sf_dir).select("doc_id", F.sha2(T.remove_heading_prefix(text, title), 256).alias("rest"))


@query
def common_parent_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    last = F.when(i % 2 == 0, F.array("source", F.lit("x"))).otherwise(F.array("source", "lang", F.lit("y")))
    return C.documents(spark, sf_dir).select("doc_id", F.array_join(chunking.common_parent_path(F.array(F.array("source", "lang", F.lit("a")), last)), "/").alias("path"))


@query
def unique_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    rows = C.table(spark, sf_dir, "pages").select(F.concat(F.lit("in/"), F.lpad(i.cast("string"), 9, "0")).alias("path"), F.concat(F.lit("book"), (i % 11).cast("string"), F.lit(".pdf")).alias("name"))
    return classify.unique_destinations(rows)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return O.ORACLES | chunk_oracles.ORACLES
