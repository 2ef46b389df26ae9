"""The engine: books and Markdown from pages to packs, classification, inspection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexloom.functions.profiles import PROFILES, Profile
from codexloom.operators import chunking, classify, inspect, markdown, packs, sections, toc
from codexloom.operators.embed import NO_EMBEDDING, Embedder, embedding
from codexloom.session import written


@dataclass
class Book:
    """The tables of built documents."""

    lines: DataFrame
    toc: DataFrame
    sections: DataFrame
    chunks: DataFrame

    #: doc, toc_source: how the contents of documents that brought their own were made.
    toc_source: DataFrame | None = None

    def of(self, docs: DataFrame) -> Book:
        """The part that belongs to docs (doc)."""
        mine = docs.select("doc").distinct()
        return Book(*[df.join(mine, "doc", "left_semi") for df in (self.lines, self.toc, self.sections, self.chunks)], self.toc_source)


def build_books(pages: DataFrame, profile: str | Profile = "social_science", outline: DataFrame | None = None, *, before: int = 1, after: int = 2) -> Book:
    """pages (doc, page, text) to chunks. outline: doc, ord, title, level, page of documents that bring their own
    contents; those are repaired, located and augmented, all others get contents by heading rules."""
    p = PROFILES[profile] if isinstance(profile, str) else profile
    # Tables that several later steps read are written once; no plan holds them twice.
    lines, toc_source = written(toc.flatten_lines(pages), "lines"), None
    if outline is None:
        contents = written(toc.infer_toc(pages, p.name, lines), "toc")
        starts = written(toc.locate_heading_lines(contents, lines), "starts")
    else:
        fixed = written(toc.repair_titles(outline, pages), "outline")
        repaired = fixed.groupBy("doc").agg(F.bool_or("repaired").alias("repaired"))
        fixed = fixed.drop("repaired")
        located = written(toc.with_parents(toc.locate_pages(fixed, lines, before=before, after=after)).withColumn("toc_id", toc.toc_id(F.col("ord"))), "outline")
        first = written(toc.locate_heading_lines(located, lines), "starts")
        contents = written(toc.augmented_toc(located, first, toc.augment_headings(located, lines, first, p.name), lines), "toc")
        starts = written(toc.locate_heading_lines(contents, lines), "starts")
        added = contents.groupBy("doc").agg(F.bool_or(F.col("method") == "body_short_heading").alias("added"))
        made = F.concat(F.lit("pdf_outline"), F.when(F.col("repaired"), "+front_matter_repair").otherwise(""), F.when(F.col("added"), "+body_heading_augmentation").otherwise(""))
        toc_source = repaired.join(added, "doc").select("doc", made.alias("toc_source"))
    found = sections.build_sections(contents, lines, starts, p.max_level)
    bare = pages.join(contents.select("doc").distinct(), "doc", "left_anti")
    found = found.unionByName(sections.whole_document(bare))
    found = written(found, "sections")
    return Book(lines, contents, found, written(chunking.make_chunks(found, p), "chunks"), toc_source)


def build_markdown(files: DataFrame, profile: str = "tech_notes") -> Book:
    """files (path, text[, modified, pack]) to chunks. A pack's files follow each other by path; a file without a pack is
    its own. Of the result, lines is a row per file with its metadata, and chunks know their sources."""
    p = PROFILES[profile]
    files = files if "pack" in files.columns else files.withColumn("pack", F.col("path"))
    told = written(markdown.metadata(markdown.relative_names(files, "pack"), profile).drop("text"), "files")
    found = written(markdown.pack_sections(files), "notes")
    contents = found.join(told.select("path", F.col("file_path").alias("file")), "path").withColumn("toc_id", toc.toc_id(F.col("ord")))
    contents = contents.withColumn("method", F.when(F.col("line") < 0, "markdown_file").otherwise("markdown_heading")).withColumn("confidence", F.lit(1.0)).withColumn("page", F.lit(None).cast("int"))
    chosen = markdown.select_sections(contents)
    none = F.lit(None).cast("int")
    rows = chosen.select("doc", "ord", "toc_id", "title", "level", "parent_ord", "path_ords", "text", none.alias("page_start"), none.alias("page_end"))
    chunks = written(markdown.with_sources(chunking.make_chunks(rows, p), found, told), "chunks")
    return Book(told, contents.drop("text", "is_parent", "line"), rows, chunks)


def pack_table(book: Book, docs: DataFrame, profile: str | Profile, embedder: Embedder | None = None, **manifest) -> DataFrame:
    """The lines of the packs of docs (doc, document_id, title, file_name); manifest: options of the manifest record."""
    p, e = PROFILES[profile] if isinstance(profile, str) else profile, embedder or NO_EMBEDDING
    counts = book.toc.groupBy("doc").agg(F.count(F.lit(1)).alias("item_count"))
    named = docs.join(counts, "doc", "left").withColumn("item_count", F.coalesce("item_count", F.lit(0)))
    # A document without headings has one section that no contents list.
    step = lambda df: df.select("doc", "ord", "toc_id", "title", "level")
    items = step(book.toc).unionByName(step(book.sections.join(book.toc.select("doc").distinct(), "doc", "left_anti")))
    chunks = packs.heading_paths(book.chunks, items).join(docs.select("doc", "document_id", F.col("title").alias("book_title")), "doc")
    records = packs.chunk_records(chunks)
    if e.dimension:
        records = records.withColumn("embedding", embedding(F.col("embedding_text"), e))
    source = manifest.get("toc_source") or F.when(F.col("item_count") > 0, "txt_heading_rules").otherwise("synthetic")
    if book.toc_source is not None:
        named, source = named.join(book.toc_source, "doc", "left"), F.col("toc_source")
    manifest |= {"toc_source": source, "model": e.model_name, "dimension": e.dimension, "normalize": e.normalize}
    return packs.pack_lines(packs.manifest(named, p, **manifest), packs.toc_record(book.toc, named, source), records, p)


def markdown_packs(files: DataFrame, docs: DataFrame, profile: str, embedder: Embedder | None = None, **manifest) -> DataFrame:
    """The lines of the packs of notes. files: pack, path, text[, modified]; docs: doc (the pack), title, file_name."""
    book = build_markdown(files, profile)
    hashes = markdown.source_hash(files, "pack").withColumnRenamed("pack", "doc")
    listed = book.lines.groupBy(F.col("pack").alias("doc")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.split("path", "/").alias("o"), F.struct(*markdown.METADATA).alias("m")))), lambda x: x["m"]).alias("files"))
    return pack_table(book, docs.join(hashes, "doc").join(listed, "doc"), profile, embedder, source_type="markdown", toc_source="markdown_headings", **manifest)


def inspect_books(book: Book, pages: DataFrame, profile: str | Profile, docs: DataFrame) -> DataFrame:
    """inspect_packs of the packs that docs (doc, document_id, title, file_name) get without embeddings."""
    return inspect_packs(pack_table(book, docs, profile), pages, docs, book.lines)


def inspect_packs(lines: DataFrame, pages: DataFrame, sources: DataFrame, page_lines: DataFrame | None = None) -> DataFrame:
    """A verdict per document from all checks of its pack's lines (doc, line_no, line) against its pages and its source
    (doc, document_id, file_name), with recommendations and samples. page_lines: the pages' flatten_lines, if there."""
    told = written(packs.told_lines(lines), "records")
    records, bad = packs.split_records(told), packs.bad_records(told)
    # A pack without manifest is judged all the same.
    meta = written(sources.select("doc", F.col("document_id").alias("actual_hash"), F.col("file_name").alias("actual_name")).join(inspect.manifest_fields(records), "doc", "left"), "meta")
    chunks, items = written(inspect.pack_chunks(records), "paths"), written(inspect.pack_items(records), "items")
    lengths, heads = written(inspect.length_stats(chunks, meta), "lengths"), written(inspect.heading_stats(chunks), "heads")
    none = sources.select("doc").join(records.select("doc").distinct(), "doc", "left_anti").select("doc", F.lit(None).cast("long").alias("line_no"), F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("record_type"))
    garbled, covered = written(inspect.garbled_stats(items.select("doc", "ord", "title"), chunks), "garbled"), written(inspect.coverage(pages, chunks), "covered")
    checks = written(
        inspect.check_records(bad.join(sources.select("doc").distinct(), "doc", "left_semi"))
        .unionByName(inspect.check_file_match(meta))
        .unionByName(inspect.check_schema(records.select("doc", "line_no", "line", "record_type").unionByName(none)))
        .unionByName(inspect.check_profile(meta))
        .unionByName(inspect.check_lengths(lengths))
        .unionByName(inspect.check_headings(heads))
        .unionByName(inspect.check_garbled(garbled))
        .unionByName(inspect.check_coverage(covered)),
        "checks",
    )
    listed = inspect.body_heading_candidates(pages, lines=page_lines).join(meta.select("doc", "profile"), "doc").select("doc", F.when(F.col("profile") == "reference", 0).otherwise(F.col("candidates")).alias("candidates"))
    advice = {
        "profile": inspect.recommend_profile(classify.classify(classify.sample_text(pages)), meta),
        "level": inspect.recommend_level(meta.drop("section_split_chars"), items, lengths),
        "body_headings": inspect.recommend_body_headings(meta, listed, lengths, heads),
    }
    stats = {"length": lengths.withColumn("average", F.round(F.col("sum_chars") / F.col("chunks"), 1)).drop("split"), "heading": heads, "garbled": garbled, "coverage": covered}
    out = inspect.with_checks(inspect.verdict(checks, meta), checks)
    for name, rows in (advice | stats).items():
        out = out.join(rows.select("doc", F.struct(*[c for c in rows.columns if c != "doc"]).alias(f"_{name}")), "doc", "left")
    counts = records.groupBy("doc").agg(F.count_if(F.col("record_type") == "chunk").alias("chunks")).join(items.groupBy("doc").agg(F.count(F.lit(1)).alias("toc_items")), "doc", "left").fillna(0)
    summary = meta.join(counts, "doc", "left").select("doc", "title", F.struct("chunks", "toc_items", "toc_source", "profile", F.col("provider").alias("embedding_provider"), F.col("dimension").alias("embedding_dimension")).alias("summary"))
    out = out.join(summary, "doc", "left").withColumn("recommendations", F.struct(*[F.col(f"_{n}").alias(n) for n in advice])).withColumn("stats", F.struct(*[F.col(f"_{n}").alias(n) for n in stats]))
    return inspect.with_samples(out.drop(*[f"_{n}" for n in advice | stats]), inspect.compare_samples(chunks, pages))
