"""File sources: listing, decoding, errors as rows.

Files come through Spark's binaryFile source, so any store that Spark reads will do. A file that can't be read is a row
of the error table and never fails the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from codexloom.functions import text as T
from codexloom.operators.classify import is_ignored_file
from codexloom.operators.markdown import file_name, stem
from codexloom.session import written

# Fixed values.
UNSUPPORTED, IMAGE_ONLY, TXT_UNCLASSIFIED = "非支持文件，请检查文件格式", "该文件不是可复制文字的pdf文件，请检查格式", "TXT 文件不需要自动分类，请放入对应分类文件夹后再构建"
SUFFIXES = (".pdf", ".txt")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]*)$", 1))


def list_files(spark: SparkSession, root: str, *, recursive: bool = True) -> DataFrame:
    """path, modified, length, content of all files below root that aren't ignored, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    return files.where(~is_ignored_file(file_name(F.col("path")))).select("path", F.col("modificationTime").alias("modified"), "length", "content")


def source_files(files: DataFrame, *suffixes: str) -> DataFrame:
    return files.where(suffix(F.col("path")).isin(*(suffixes or SUFFIXES)))


def unsupported_files(files: DataFrame) -> DataFrame:
    return files.where(~suffix(F.col("path")).isin(*SUFFIXES)).select("path", F.lit("UnsupportedSourceError").alias("error_class"), F.lit(UNSUPPORTED).alias("message"))


@F.arrow_udf(StringType())
def _decoded(content: pa.Array) -> pa.Array:
    out = []
    for c in content:
        data = c.as_py()
        if data is None:
            out.append(None)
            continue
        for encoding in ("utf-8-sig", "utf-8", "gb18030"):
            try:
                out.append(data.decode(encoding))
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append(data.decode("utf-8", "replace"))
    return pa.array(out, pa.string())


def decode(content: Column) -> Column:
    """Bytes as text: UTF-8 with or without a mark, else GB18030, else UTF-8 with replacement marks. Only bytes that
    aren't plain UTF-8 go to Python."""
    plain = F.is_valid_utf8(content.cast("string"))
    marked = F.startswith(content, F.unhex(F.lit("EFBBBF")))
    return F.when(plain & ~marked, content.cast("string")).otherwise(_decoded(content))


def txt_pages(files: DataFrame) -> DataFrame:
    """doc (path), page 1, text of text files."""
    return source_files(files, ".txt").select(F.col("path").alias("doc"), F.lit(1).alias("page"), T.normalize_text(decode(F.col("content"))).alias("text"))


def read_markdown(files: DataFrame) -> DataFrame:
    return source_files(files, ".md").select("path", "modified", decode(F.col("content")).alias("text"))


#: Bytes of a PDF to the texts of its pages and its outline, rows (level, title, page or None).
PdfReader = Callable[[bytes], tuple[list[str], list[tuple[int, str, int | None]]]]


def read_pdf(data: bytes) -> tuple[list[str], list[tuple[int, str, int | None]]]:
    """By PyMuPDF, which the workers need."""
    try:
        import pymupdf
    except ImportError as e:
        raise RuntimeError("no PDF library is installed; give a reader, or a table of pages") from e
    with pymupdf.open(stream=data, filetype="pdf") as book:
        return [p.get_text() for p in book], [(level, title, page if page > 0 else None) for level, title, page in book.get_toc(simple=True)]


@dataclass
class Documents:
    """pages (doc, page, text), outlines (doc, ord, title, level, page) of those that bring one, errors (path,
    error_class, message) of those that can't be read."""

    pages: DataFrame
    outlines: DataFrame
    errors: DataFrame


def pdf_documents(files: DataFrame, reader: PdfReader = read_pdf) -> Documents:
    """PDF files read once each. One that fails, or has no text on any page, is an error row and no document."""
    shape = "struct<pages:array<string>,outline:array<struct<level:int,title:string,page:int>>,error_class:string,message:string>"

    @F.arrow_udf(shape)
    def run(content: pa.Array) -> pa.Array:
        rows = []
        for c in content:
            try:
                pages, outline = reader(c.as_py())
                rows.append({"pages": pages, "outline": [{"level": a, "title": t, "page": p} for a, t, p in outline], "error_class": None, "message": None})
            except Exception as e:  # any file may be broken in any way; its row says how
                rows.append({"pages": None, "outline": None, "error_class": type(e).__name__, "message": str(e)})
        kinds = [("pages", pa.list_(pa.string())), ("outline", pa.list_(pa.struct([("level", pa.int32()), ("title", pa.string()), ("page", pa.int32())]))), ("error_class", pa.string()), ("message", pa.string())]
        return pa.array(rows, pa.struct(kinds))

    read = written(source_files(files, ".pdf").select(F.col("path").alias("doc"), run(F.col("content")).alias("r")).select("doc", "r.*"), "pdf")
    pages = read.select("doc", F.posexplode("pages").alias("p", "raw")).select("doc", (F.col("p") + 1).alias("page"), T.normalize_text(F.coalesce("raw", F.lit(""))).alias("text"))
    # A PDF without pages has no text either.
    blank = image_only(pages).unionByName(read.where("error_class IS NULL AND size(pages) = 0").select(F.col("doc").alias("path"), F.lit("ImageOnlyPdfError").alias("error_class"), F.lit(IMAGE_ONLY).alias("message")))
    failed = read.where("error_class IS NOT NULL").select(F.col("doc").alias("path"), "error_class", "message")
    good = pages.join(blank.select(F.col("path").alias("doc")), "doc", "left_anti")
    outlines = read.select("doc", F.posexplode("outline").alias("p", "o")).join(good.select("doc").distinct(), "doc", "left_semi")
    title = F.replace(T.normalize_text(F.col("o.title")), F.lit("\n"), F.lit(" "))
    return Documents(good, outlines.select("doc", (F.col("p") + 1).alias("ord"), title.alias("title"), "o.level", "o.page"), failed.unionByName(blank))


def documents(files: DataFrame, reader: PdfReader = read_pdf) -> Documents:
    """Files by their suffix: text and PDF are read, all others are error rows."""
    pdf = pdf_documents(files, reader)
    return Documents(txt_pages(files).unionByName(pdf.pages), pdf.outlines, unsupported_files(files).unionByName(pdf.errors))


def image_only(pages: DataFrame) -> DataFrame:
    """Documents without text on any page, as error rows."""
    blank = pages.groupBy("doc").agg(F.bool_and(T.strip(F.coalesce("text", F.lit(""))) == "").alias("blank")).where("blank")
    return blank.select(F.col("doc").alias("path"), F.lit("ImageOnlyPdfError").alias("error_class"), F.lit(IMAGE_ONLY).alias("message"))


def match_packs(packs: DataFrame, books: DataFrame, ending: str = "_noembedding.pack.jsonl") -> tuple[DataFrame, DataFrame]:
    """Packs (path, with that ending) with the book of their stem (the first by path); those without."""
    name = file_name(F.col("path"))
    bare = F.when(name.endswith(ending), F.left(name, F.length(name) - len(ending))).otherwise(name)
    keyed = packs.select(F.col("path").alias("pack"), bare.alias("stem"))
    by_stem = books.select(stem(F.col("path")).alias("stem"), "path").groupBy("stem").agg(F.min("path").alias("book"))
    return keyed.join(by_stem, "stem"), keyed.join(by_stem, "stem", "left_anti")
