"""Sections: the text under each heading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexloom.functions import text as T
from codexloom.operators.toc import BLOCK, section_ends
from codexloom.session import written

#: Lines after a heading that may continue it.
WRAPPED = 12


def heading_extent(spans: DataFrame, lines: DataFrame) -> DataFrame:
    """spans (doc, ord, title, start) with body: the first line after the heading, which may run over several lines."""
    ahead = spans.select("doc", "ord", "start", T.normalize_title(F.col("title")).alias("_t")).withColumn("idx", F.explode(F.sequence(F.col("start"), F.col("start") + WRAPPED)))
    # A line that is longer than all titles continues none, so no more of it is sent to them than shows this.
    most = spans.agg(F.coalesce(F.max(F.length(T.normalize_title(F.col("title")))), F.lit(0))).first()[0] + 1
    joined = ahead.hint("merge").join(lines.select("doc", "idx", F.left(F.col("normalized"), F.lit(most)).alias("normalized")), ["doc", "idx"]).groupBy("doc", "ord").agg(F.first("_t").alias("_t"), F.transform(F.array_sort(F.collect_list(F.struct("idx", "normalized"))), lambda x: x["normalized"]).alias("_l"))
    zero = F.struct(F.col("_l")[0].alias("seen"), F.lit(1).alias("n"), F.lit(True).alias("on"))

    def step(a, v):
        both = F.concat(a["seen"], v)
        on = a["on"] & (F.length(a["seen"]) < F.length("_t")) & F.col("_t").startswith(both)
        return F.when(on, F.struct(both.alias("seen"), (a["n"] + 1).alias("n"), F.lit(True).alias("on"))).otherwise(F.struct(a["seen"].alias("seen"), a["n"].alias("n"), F.lit(False).alias("on")))

    extra = joined.select("doc", "ord", F.aggregate(F.slice("_l", 2, WRAPPED), zero, step, lambda a: a["n"]).alias("_n"))
    return spans.hint("merge").join(extra, ["doc", "ord"]).withColumn("body", F.col("start") + F.col("_n")).drop("_n")


def build_sections(toc: DataFrame, lines: DataFrame, starts: DataFrame, max_level: int | None = None) -> DataFrame:
    """Sections with text: doc, ord, toc_id, title, level, parent_ord, path_ords, text, page_start, page_end."""
    spans = written(heading_extent(written(section_ends(toc, starts, max_level), "ends"), lines), "spans")
    if max_level is not None:
        spans = spans.where(F.col("level") <= max_level)
    # Lines meet their sections in blocks of the document, not line by section.
    size = lines.groupBy("doc").agg((F.max("idx") + 1).alias("_size"))
    marks = spans.join(size, "doc").select("doc", "ord", F.col("body").alias("lo"), F.coalesce("end", "_size").alias("hi"), "start")
    block = lambda c: F.floor(c / BLOCK)
    marks = marks.withColumn("_block", F.explode(F.sequence(block(F.col("start")), F.greatest(block(F.col("start")), block(F.col("hi") - 1)))))
    held = marks.join(lines.select("doc", "idx", "page", "text", block(F.col("idx")).alias("_block")), ["doc", "_block"]).where("idx >= start AND (idx < hi OR idx = start)")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("idx") >= F.col("lo")) & (F.col("idx") < F.col("hi")), F.struct("idx", "text")))), lambda x: x["text"]), "\n")
    body = held.groupBy("doc", "ord").agg(text.alias("_raw"), F.min_by("page", "idx").alias("page_start"), F.max_by("page", "idx").alias("page_end"))
    out = T.pinned(spans.hint("merge").join(body, ["doc", "ord"]), text=T.reflow_text(F.col("_raw")))
    return out.where(T.strip(F.col("text")) != "").select("doc", "ord", "toc_id", "title", "level", "parent_ord", "path_ords", "text", "page_start", "page_end")


def whole_document(pages: DataFrame) -> DataFrame:
    """The one section of documents without any heading."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n\n")
    out = pages.groupBy("doc").agg(text.alias("text"), F.lit(1).alias("page_start"), F.max("page").alias("page_end"))
    return out.select("doc", F.lit(1).alias("ord"), F.lit("toc:000001").alias("toc_id"), F.lit("正文").alias("title"), F.lit(1).alias("level"), F.lit(None).cast("int").alias("parent_ord"), F.array(F.lit(1)).alias("path_ords"), "text", "page_start", "page_end")
