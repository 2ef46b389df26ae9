"""Tables that grow with the headings are not broadcast, however small their files are."""

import re

from pyspark.sql import functions as F

from codexloom.operators import packs, sections, toc
from codexloom.session import written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast_keys(df):
    """The keys of the joins that broadcast a side."""
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"BroadcastHashJoin \[(.*?)\]", plan(df))]


def test_headings_are_merged(spark):
    pages = spark.range(40).select((F.col("id") % 2).cast("string").alias("doc"), F.col("id").cast("int").alias("page"), F.concat(F.lit("第"), F.col("id").cast("string"), F.lit("节 x\nSome text of it.")).alias("text"))
    lines, found = written(toc.flatten_lines(pages), "lines"), written(toc.infer_toc(pages, "textbook"), "toc")
    starts = written(toc.locate_heading_lines(found, lines), "starts")
    ends = written(toc.section_ends(found, starts), "ends")
    spans = written(sections.heading_extent(ends, lines), "spans")
    chunks = written(found.select("doc", F.col("ord").alias("chunk_index"), "path_ords", F.array("ord").alias("merged_ords")), "chunks")
    for df in (toc.section_ends(found, starts), sections.heading_extent(ends, lines), packs.heading_paths(chunks, found)):
        assert not {"doc, ord", "doc, idx", "doc, _o"} & set(broadcast_keys(df)) and "SortMergeJoin" in plan(df)
    assert spans.count() == 40 and {r["n"] for r in packs.heading_paths(chunks, found).select(F.size("toc_path").alias("n")).collect()} == {1}
    assert toc.section_ends(found, starts).where("start IS NOT NULL").count() == 40
