"""Command line over a workspace of folders that Spark can read.

    RAW/books/PROFILE/*.pdf|txt, RAW/markdown_files/{journal,TechNotes,WebPageCollection}
    OUTPUT/books_output, OUTPUT/markdown_output

Verbs: classify, build, inspect, preflight. Without a verb: preflight, and if nothing fails, build with embedding.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom import engine
from codexloom.functions import text as T
from codexloom.functions.profiles import BOOK_PROFILES, DEFAULT_EMBEDDING_MODEL, PROFILES, Profile
from codexloom.operators import classify, inspect, markdown, packs
from codexloom.operators.embed import NO_EMBEDDING, Embedder, model_embedder
from codexloom.operators.markdown import file_name, stem
from codexloom.session import drop_scratch, get_session, let_workers_import, written
from codexloom.sources import files as S
from codexloom.sources import sinks

#: What a pack's file name ends in, and what stands before it in a pack without embeddings.
PACK, DRY = ".pack.jsonl", "_noembedding"


def make_parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--raw", default="raw_data", help="folder of the sources")
    common.add_argument("-o", "--output", default="output", help="folder of the packs")
    common.add_argument("--pack-suffix", default=PACK, help="what the names of packs end in, .jsonl included; packs of other tools are found by theirs")
    build = argparse.ArgumentParser(add_help=False)
    build.add_argument("--embedding-model", default=DEFAULT_EMBEDDING_MODEL)
    build.add_argument("--embedding-dimension", type=int, default=1024)
    build.add_argument("--batch-size", type=int, default=16)
    build.add_argument("--no-embedding", action="store_true", help="packs with empty vectors, for inspection")
    for name in ("target", "max", "section-split", "min-chunk", "overlap"):
        build.add_argument(f"--{name}-chars", type=int)
    build.add_argument("--max-chunk-heading-level", type=int)
    build.add_argument("--search-before-pages", type=int, default=1)
    build.add_argument("--search-after-pages", type=int, default=2)
    report = argparse.ArgumentParser(add_help=False)
    report.add_argument("--no-report", action="store_true", help="write no report files")
    parser = argparse.ArgumentParser(prog="codexloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter, parents=[common, build, report])
    parser.set_defaults(run=default_workflow)
    verbs = parser.add_subparsers(dest="verb")
    for verb, run, parents in (("classify", classify_all, [common]), ("build", build_all, [common, build]), ("inspect", inspect_all, [common, report]), ("preflight", preflight_all, [common, build, report])):
        p = verbs.add_parser(verb, parents=parents)
        p.set_defaults(run=run)
        if verb == "build":
            p.add_argument("source", nargs="?", help="a single file or folder of files; without it, the workspace")
            p.add_argument("--title", help="the title of a single file's pack; by default its name")
            p.add_argument("--profile", default="social_science", choices=BOOK_PROFILES, help="how a single file is built")
        if verb == "classify":
            p.add_argument("--dry-run", action="store_true", help="only tell where files would go")
        if verb == "inspect":
            p.add_argument("source", nargs="?", help="a source file")
            p.add_argument("pack", nargs="?", help="its pack; without both, all packs of the output folder")
    return parser


def parameters(args: argparse.Namespace, name: str) -> Profile:
    return PROFILES[name].with_(target=args.target_chars, max=args.max_chars, split=args.section_split_chars, min=args.min_chunk_chars, overlap=args.overlap_chars, max_level=args.max_chunk_heading_level)


def _embedder(args: argparse.Namespace) -> Embedder:
    return NO_EMBEDDING if args.no_embedding else model_embedder(args.embedding_model, args.embedding_dimension, batch_size=args.batch_size)


def _listed(spark: SparkSession, folder: str, **options) -> DataFrame | None:
    return S.list_files(spark, folder, **options) if sinks.exists(spark, folder) else None


def _tell(errors: DataFrame) -> int:
    """Prints a line per error; how many there are."""
    rows = errors.orderBy("path").collect()
    for r in rows:
        print(f"skip: {r.path} -> {r.message}")
    return len(rows)


def ensure_folders(spark: SparkSession, args: argparse.Namespace) -> None:
    notes = ("journal", "TechNotes", "WebPageCollection")
    sinks.make_folders(spark, *[f"{args.raw}/books/{p}" for p in BOOK_PROFILES], *[f"{args.raw}/markdown_files/{n}" for n in notes], *[f"{args.output}/{n}_output" for n in ("books", "markdown")])


def classify_entries(spark: SparkSession, folder: str, *, move: bool) -> tuple[DataFrame, DataFrame]:
    """The PDF files directly in folder with profile, scores, signals and target, and the errors of all other files.
    Files are moved to the folder of their profile if asked."""
    listed = written(S.list_files(spark, folder, recursive=False), "entries")
    books = S.pdf_documents(listed)
    labels = classify.classify(classify.sample_text(books.pages, books.outlines)).withColumnRenamed("doc", "path").withColumn("name", file_name(F.col("path")))
    held = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path").join(listed.select("path"), "path", "left_anti")
    held = held.select(F.element_at(F.split("path", "/"), -2).alias("profile"), file_name(F.col("path")).alias("name"))
    found = written(classify.unique_destinations(labels, held), "labels")
    texts = S.source_files(listed, ".txt").select("path", F.lit("TextNotClassified").alias("error_class"), F.lit(S.TXT_UNCLASSIFIED).alias("message"))
    errors = written(S.unsupported_files(listed).unionByName(texts).unionByName(books.errors), "errors")
    if move:
        sinks.move_files(spark, [(r.path, f"{folder}/{r.profile}/{r.target}") for r in found.select("path", "profile", "target").collect()])
    return found, errors


def classify_all(spark: SparkSession, args: argparse.Namespace) -> int:
    ensure_folders(spark, args)
    dry = getattr(args, "dry_run", False)
    found, errors = classify_entries(spark, f"{args.raw}/books", move=not dry)
    for r in found.orderBy("path").collect():
        print(f"{'would move' if dry else 'moved'}: {r.name} -> {r.profile}/{r.target}", f"  scores: {r.score_text}", "  signals:", *[f"    {s}" for s in r.signals], sep="\n")
    return int(_tell(errors) > 0)


def build_all(spark: SparkSession, args: argparse.Namespace) -> int:
    if getattr(args, "source", None):
        return _build_files(spark, args, S.list_files(spark, args.source), args.profile, args.output)
    failed = classify_all(spark, args)
    for profile in BOOK_PROFILES:
        failed |= _build_files(spark, args, _listed(spark, f"{args.raw}/books/{profile}"), profile, f"{args.output}/books_output")
    return int(bool(failed) | bool(build_notes(spark, args)))


def _build_files(spark: SparkSession, args: argparse.Namespace, files: DataFrame, profile: str, folder: str) -> int:
    """Packs of files by one profile, into folder; 1 if any could not be read."""
    found = S.documents(files)
    pages, outlines = written(found.pages, "pages"), written(found.outlines, "outlines")
    failed = _tell(found.errors) > 0
    p = parameters(args, profile)
    brought = outlines.select("doc").distinct()
    for own, how in ((pages.join(brought, "doc", "left_anti"), None), (pages.join(brought, "doc", "left_semi"), outlines)):
        if own.isEmpty():
            continue
        book = engine.build_books(own, p, how, before=args.search_before_pages, after=args.search_after_pages)
        docs = source_table(files.join(own.select(F.col("doc").alias("path")).distinct(), "path", "left_semi"))
        if getattr(args, "title", None):
            docs = docs.withColumn("title", F.lit(args.title))
        for kind, some in ((k, docs.where(S.suffix(F.col("doc")) == f".{k}")) for k in ("txt", "pdf")):
            if not some.isEmpty():
                _write(engine.pack_table(book.of(some), some, p, _embedder(args), before=args.search_before_pages, after=args.search_after_pages, source_type=kind), some, folder, args)
    return int(failed)


def build_notes(spark: SparkSession, args: argparse.Namespace) -> int:
    root = f"{args.raw}/markdown_files"
    if (files := _listed(spark, root)) is None:
        return 0
    jobs = written(markdown.collect_jobs(files, root), "jobs")
    for profile in ("journal", "tech_notes", "web_page_collection"):
        mine = jobs.where(F.col("profile") == profile)
        if mine.isEmpty():
            continue
        notes = S.read_markdown(files).join(mine.select("path", "pack"), "path")
        docs = mine.select(F.col("pack").alias("doc"), "title", F.col("output_stem").alias("file_name")).distinct()
        _write(engine.markdown_packs(notes, docs, profile, _embedder(args)), docs, f"{args.output}/markdown_output", args)
    return 0


def _write(lines: DataFrame, docs: DataFrame, folder: str, args: argparse.Namespace) -> None:
    name = F.when(F.col("file_name").rlike(r"\.(?i:pdf|txt)$"), T.safe_stem(stem(F.col("file_name")))).otherwise(F.col("file_name"))
    ending = getattr(args, "pack_suffix", PACK)
    named = docs.select("doc", F.concat(name, F.lit(DRY + ending if args.no_embedding else ending)).alias("file"))
    sinks.write_files(lines, named, folder)
    _told(named, folder)


def _told(names: DataFrame, folder: str, label: str = "  -> ") -> None:
    for r in names.select("file").distinct().orderBy("file").toLocalIterator():
        print(f"{label}{folder}/{r.file}")


def inspect_all(spark: SparkSession, args: argparse.Namespace) -> int:
    """1 if a pack fails, or has no source."""
    if getattr(args, "source", None) and getattr(args, "pack", None):
        lines, files = packs.read_packs(spark, args.pack), S.list_files(spark, args.source)
        pairs = lines.select(F.col("doc").alias("pack")).distinct().withColumn("book", F.lit(files.select("path").first().path))
        folder, missing = args.pack.rsplit("/", 1)[0] if "/" in args.pack else ".", 0
    else:
        folder, files = f"{args.output}/books_output", _listed(spark, f"{args.raw}/books")
        lines = packs.read_packs(spark, folder)
        made = lines.select(F.col("doc").alias("path")).distinct().where(F.col("path").endswith(DRY + args.pack_suffix))
        pairs, none = S.match_packs(made, S.source_files(files), DRY + args.pack_suffix)
        missing = _tell(none.select(F.col("pack").alias("path"), F.lit("no source of that name").alias("message")))
    pairs = written(pairs.select("pack", "book"), "pairs")
    files = files.join(pairs.select(F.col("book").alias("path")).distinct(), "path", "left_semi")
    found = S.documents(files)
    failed = _tell(found.errors)
    as_pack = lambda df, c: df.join(pairs, df[c] == pairs["book"])
    pages = written(as_pack(found.pages, "doc").select(F.col("pack").alias("doc"), "page", "text"), "pages")
    sources = as_pack(source_table(files), "doc").select(F.col("pack").alias("doc"), "document_id", "title", "file_name")
    sources = sources.join(pages.select("doc").distinct(), "doc", "left_semi")
    judged = written(engine.inspect_packs(lines.join(sources.select("doc"), "doc", "left_semi"), pages, sources), "judged")
    told = written(inspect.reports(judged), "reports")
    for r in told.orderBy("doc").select("report").collect():
        print(r.report, end="\n\n")
    if not getattr(args, "no_report", False):
        names = told.select("doc", file_name(F.col("doc")).alias("file"))
        sinks.write_reports(told, names, folder)
        _told(names, folder, "reports of: ")
    return int(missing + failed + judged.where("result = 'FAIL'").count() > 0)


def with_changes(args: argparse.Namespace, **changes) -> argparse.Namespace:
    return argparse.Namespace(**(vars(args) | changes))


def preflight_all(spark: SparkSession, args: argparse.Namespace) -> int:
    """All packs without embedding, then all of them inspected; nothing else is built before the verdict on all."""
    if build_all(spark, with_changes(args, no_embedding=True)):
        print("Preflight stopped: no-embedding build failed.")
        return 1
    result = inspect_all(spark, args)
    print(f"Preflight result: {'FAIL' if result else 'PASS'}")
    return result


def default_workflow(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.no_embedding:
        return build_all(spark, args)
    return preflight_all(spark, args) or build_all(spark, args)


def source_table(listed: DataFrame) -> DataFrame:
    return listed.select(F.col("path").alias("doc"), packs.document_id(F.col("content")).alias("document_id"), T.safe_stem(stem(file_name(F.col("path")))).alias("title"), file_name(F.col("path")).alias("file_name"))


def main(argv: list[str] | None = None) -> int:
    args = make_parser().parse_args(argv)
    spark = let_workers_import(get_session())
    try:
        return args.run(spark, args)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    sys.exit(main())
