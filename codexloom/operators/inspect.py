"""Inspection of packs: statistics, checks, recommendations, samples, verdict.

chunks: doc, chunk_index, chunk_id, text, heading_path, toc_path, page_start, page_end. meta: one row per doc with the
manifest's parameters. Each check gives rows (doc, ord, status, message, detail); a verdict is one aggregation over them.
detail is a VARIANT object that says what the message is about: counts, ratios, the first offenders. The messages and the
names in details are fixed values.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from codexloom.functions import headings as H
from codexloom.functions import text as T
from codexloom.functions.profiles import profile_table
from codexloom.session import written

#: Characters in a block of a document's text.
BLOCK = 32_768

REQUIRED_MANIFEST = ("record_type", "schema_version", "document_id", "title", "source", "toc", "chunking", "embedding")
REQUIRED_CHUNK = ("chunk_id", "chunk_index", "text", "embedding_text", "heading_path", "source", "prev_chunk_id", "next_chunk_id", "stats", "split_info", "embedding")
M = {
    "line_json": "JSONL 第 {} 行不是合法 JSON",
    "line_object": "JSONL 第 {} 行不是对象记录",
    "hash_bad": "PDF 文件 hash 与 manifest 不一致，可能拿错了 PDF 或 JSONL。",
    "hash_ok": "PDF 文件 hash 与 manifest 匹配。",
    "name_bad": "manifest 中记录的源文件名与当前 PDF 文件名不同。",
    "manifest_bad": "manifest 缺少必要字段。",
    "manifest_ok": "manifest 必要字段完整。",
    "toc_bad": "toc 记录缺失或结构不合法。",
    "toc_ok": "toc 记录结构正常。",
    "no_chunks": "没有找到任何 chunk 记录。",
    "chunk_bad": "部分 chunk 缺少必要字段或字段类型不正确。",
    "chunk_ok": "chunk 记录必要字段完整。",
    "index_bad": "chunk_index 不是连续递增序列。",
    "empty_chunk": "存在空 chunk。",
    "profile_unknown": "manifest 中的 profile 不是已知书籍 profile。",
    "profile_bad": "manifest 中部分 chunking 参数与当前 profile 默认值不同。",
    "profile_ok": "profile 与 chunking 默认参数一致。",
    "provider_bad": "该文件看起来不是 no-embedding 调试文件。",
    "dimension_bad": "no-embedding 文件的 embedding dimension 应为 0。",
    "embedding_ok": "确认是 no-embedding 文件。",
    "very_long": "存在特别长的 chunk，可能需要更细的标题识别或降低 section_split_chars。",
    "very_short": "过短 chunk 比例偏高，可能切得太碎或存在目录/残页内容。",
    "length_ok": "chunk 长度分布健康。",
    "length_bad": "chunk 长度分布需要人工抽查。",
    "path_empty": "存在 heading_path 为空的 chunk。",
    "path_shallow": "多数 chunk 的标题路径较浅，可能需要正文短标题增强或更合适的 profile。",
    "path_crowded": "大量 chunk 集中在同一个标题路径下，可能说明目录层级偏粗。",
    "path_ok": "heading_path 分布正常。",
    "garbled_title": "目录或 heading_path 中仍存在疑似乱码标题。",
    "garbled_text": "部分 chunk 正文存在疑似乱码字符，建议抽查 PDF 文本复制质量。",
    "garbled_ok": "未发现明显目录或正文乱码。",
    "cover_none": "PDF 或 chunk 文本为空，无法估计覆盖率。",
    "cover_bad": "chunk 文本与 PDF 文本覆盖关系异常，可能解析错书或漏内容严重。",
    "cover_low": "PDF 文本覆盖率估计偏低，建议抽查是否漏掉前言、附录或章节。",
    "cover_ok": "PDF 文本覆盖率估计正常。",
}


#: Reasons of recommendations (fixed values).
R = {
    "profile_weak": "离线分类信号较弱，建议保持当前 profile。",
    "profile_same": "当前 profile 与离线分类推荐一致。",
    "level_fits": "当前最细分块层级与 chunk 长度分布基本匹配。",
    "body_on": "当前 RAGPack 已使用正文短标题增强，适合书签较浅但正文标题清晰的书。",
    "body_want": "PDF 书签可能偏浅，正文中检测到较多短标题候选；如 chunk 仍偏长，可考虑启用/加强正文短标题增强。",
    "body_no": "未发现足够强的正文短标题增强需求。",
}


#: How many offenders a detail names.
BAD_CHUNKS, FIRST_INDICES, EMPTY_CHUNKS, TITLES, LINES = 10, 10, 20, 5, 10


def told(**fields: Column | str) -> Column:
    """A detail as JSON, nulls kept; a name stands for a column."""
    return F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def messages(df: DataFrame, first_ord: int, *rules: tuple) -> DataFrame:
    """Rows (doc, ord, status, message, detail) of the rules (condition, status, message key[, detail as JSON]) that hold."""
    items = []
    for i, (when, status, key, *detail) in enumerate(rules):
        items.append(F.when(when, F.struct(F.lit(first_ord + i).alias("ord"), F.lit(status).alias("status"), F.lit(M[key]).alias("message"), (detail[0] if detail else F.lit("{}")).alias("json"))))
    rows = df.select("doc", F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("m"))
    return rows.select("doc", "m.ord", "m.status", "m.message", F.parse_json("m.json").alias("detail"))


def first_of(rows: DataFrame, most: int, order: str, value: str, name: str) -> DataFrame:
    """doc and name, the values (strings) of the first `most` rows of every doc in order. Only that many of a task's rows
    of a doc are sent on."""
    w = Window.partitionBy("doc").orderBy(order)
    some = rows.select("doc", order, value).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return some.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", value))), lambda x: x[value]).alias(name))


def check_records(bad: DataFrame) -> DataFrame:
    """bad: doc, line_no, kind, as packs.bad_records gives them. A failure per pack that has any, named by the first."""
    first = first_of(bad.withColumn("_one", told(line="line_no", kind="kind")), LINES, "line_no", "_one", "_lines")
    rows = bad.groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line_no", "kind")).alias("first")).join(first, "doc")
    says = lambda key: F.replace(F.lit(M[key]), F.lit("{}"), F.col("first.line_no").cast("string"))
    detail = F.concat(F.lit('{"count":'), F.col("n").cast("string"), F.lit(',"lines":['), F.array_join("_lines", ","), F.lit("]}"))
    return rows.select("doc", F.lit(0).alias("ord"), F.lit("FAIL").alias("status"), F.when(F.col("first.kind") == "json", says("line_json")).otherwise(says("line_object")).alias("message"), F.parse_json(detail).alias("detail"))


def length_stats(chunks: DataFrame, meta: DataFrame) -> DataFrame:
    """meta: doc, section_split_chars. Counts by length, extremes, median and mean per doc."""
    rows = chunks.select("doc", F.length(F.coalesce("text", F.lit(""))).alias("n")).join(meta.select("doc", F.when(F.coalesce("section_split_chars", F.lit(0)) == 0, 2000).otherwise(F.col("section_split_chars")).alias("split")), "doc")
    limit = F.greatest(F.col("split") * 2, F.lit(3500))
    n = F.col("n")
    count = lambda c: F.count_if(c)
    return rows.groupBy("doc", "split").agg(
        F.count(F.lit(1)).alias("chunks"), F.min("n").alias("min_chars"), F.median("n").alias("median_chars"), F.sum("n").alias("sum_chars"), F.max("n").alias("max_chars"),
        count(n < 100).alias("very_short"), count((n >= 100) & (n < 300)).alias("short"), count((n >= 300) & (n <= F.col("split"))).alias("normal"), count((n > F.col("split")) & (n <= limit)).alias("long"), count(n > limit).alias("very_long"),
    )


def check_lengths(stats: DataFrame) -> DataFrame:
    n = F.col("chunks")
    healthy = F.col("normal") / n >= 0.65
    buckets = F.struct(F.col("very_short").alias("very_short_lt_100"), F.col("short").alias("short_100_300"), F.col("normal").alias("normal_300_to_section_split"), F.col("long").alias("long_section_split_to_very_long"), "very_long")
    all_ = told(min="min_chars", median="median_chars", average=F.bround(F.col("sum_chars") / n, 1), max="max_chars", section_split_chars="split", buckets=buckets)
    limit = told(count="very_long", limit=F.greatest(F.col("split") * 2, F.lit(3500)))
    return messages(stats, 40, (F.col("very_long") > 0, "WARN", "very_long", limit), (F.col("very_short") / n > 0.12, "WARN", "very_short", told(ratio=F.bround(F.col("very_short") / n, 3))), (healthy, "PASS", "length_ok", all_), (~healthy, "WARN", "length_bad", all_))


def heading_stats(chunks: DataFrame) -> DataFrame:
    """Depths, the commonest path (the first seen among equals), and chunks under added body headings."""
    path = F.coalesce("heading_path", F.array().cast("array<string>"))
    rows = chunks.select("doc", "chunk_index", F.size(path).alias("depth"), F.array_join(path, " > ").alias("path"), F.size(F.filter(F.coalesce("toc_path", F.array()), lambda t: t["toc_id"].startswith("body:"))).alias("body"), F.size(F.filter(F.coalesce("toc_path", F.array()), lambda t: t["toc_id"].startswith("toc:auto:"))).alias("auto")) if "toc_path" in chunks.columns else chunks.select("doc", "chunk_index", F.size(path).alias("depth"), F.array_join(path, " > ").alias("path"), F.lit(0).alias("body"), F.lit(0).alias("auto"))
    by_path = rows.groupBy("doc", "path").agg(F.count(F.lit(1)).alias("n"), F.min("chunk_index").alias("first"), F.sum("depth").alias("depths"), F.max("depth").alias("deep"), F.sum("body").alias("body"), F.sum("auto").alias("auto"))
    return by_path.groupBy("doc").agg(
        F.sum("n").alias("chunks"),
        F.coalesce(F.sum(F.when(F.col("deep") == 0, F.col("n"))), F.lit(0)).alias("empty_paths"),
        F.coalesce(F.sum(F.when(F.col("deep") <= 1, F.col("n"))), F.lit(0)).alias("shallow_paths"),
        F.sum("depths").alias("depth_sum"),
        F.max("deep").alias("max_depth"),
        F.max_by("path", F.struct("n", -F.col("first"))).alias("common_path"),
        F.max("n").alias("common_count"),
        F.sum("body").alias("body_heading_chunks"),
        F.sum("auto").alias("auto_heading_chunks"),
    )


def check_headings(stats: DataFrame) -> DataFrame:
    n = F.col("chunks")
    empty, shallow, crowded = F.col("empty_paths") > 0, (F.col("shallow_paths") / n > 0.65) & (n >= 20), (F.col("common_count") / n > 0.35) & (n >= 20)
    all_ = told(empty_heading_path_count="empty_paths", shallow_heading_path_count="shallow_paths", average_depth=F.bround(F.col("depth_sum") / n, 2), max_depth="max_depth", most_common_path="common_path", most_common_path_count="common_count", body_heading_chunk_count="body_heading_chunks", auto_heading_chunk_count="auto_heading_chunks")
    crowd = told(path="common_path", ratio=F.bround(F.col("common_count") / n, 3))
    # Of the three warnings only two name the title path, and only those stand against a pass.
    return messages(stats, 50, (empty, "WARN", "path_empty", told(count="empty_paths")), (shallow, "WARN", "path_shallow", told(shallow_ratio=F.bround(F.col("shallow_paths") / n, 3))), (crowded, "WARN", "path_crowded", crowd), (~shallow & ~crowded, "PASS", "path_ok", all_))


def garbled_stats(titles: DataFrame, chunks: DataFrame) -> DataFrame:
    """titles: doc, ord, title. Garbled titles, garbled heading titles (each occurrence), garbled starts of the first 80,
    and the first garbled titles and headings in order."""
    bad = lambda c: F.coalesce(T.looks_garbled(c), F.lit(False))
    none = F.array().cast("array<string>")
    w = lambda c: Window.partitionBy("doc").orderBy(c)
    firsts = lambda kept, value: F.transform(F.array_sort(F.collect_list(F.when(kept & (F.col("_nth") <= TITLES), F.struct("_nth", value)))), lambda x: x[value])
    marked = titles.select("doc", "ord", "title", bad(F.col("title")).alias("_bad"))
    a = marked.withColumn("_nth", F.count_if("_bad").over(w("ord"))).groupBy("doc").agg(F.count_if("_bad").alias("garbled_titles"), firsts(F.col("_bad"), "title").alias("title_examples"))
    head = F.filter(F.coalesce("heading_path", none), bad)
    rows = chunks.select("doc", "chunk_index", head.alias("_heads"))
    rows = rows.withColumn("_nth", F.count_if(F.size("_heads") > 0).over(w("chunk_index"))).withColumn("_some", F.slice("_heads", 1, TITLES))
    b = rows.groupBy("doc").agg(F.sum(F.size("_heads")).alias("garbled_headings"), F.slice(F.flatten(firsts(F.size("_heads") > 0, "_some")), 1, TITLES).alias("heading_examples"))
    # Only the first chunks' texts are judged, so no others are sent on.
    starts = chunks.select("doc", "chunk_index", F.left(F.coalesce("text", F.lit("")), F.lit(600)).alias("_start")).withColumn("_n", F.row_number().over(w("chunk_index"))).where("_n <= 80")
    c = starts.groupBy("doc").agg(F.count_if(T.garbled_ratio(F.col("_start")) > 0.04).alias("garbled_chunks"))
    return b.join(c, "doc").join(a, "doc", "left").select("doc", F.coalesce("garbled_titles", F.lit(0)).alias("garbled_titles"), "garbled_headings", "garbled_chunks", F.coalesce("title_examples", none).alias("title_examples"), "heading_examples")


def check_garbled(stats: DataFrame) -> DataFrame:
    title, text = (F.col("garbled_titles") > 0) | (F.col("garbled_headings") > 0), F.col("garbled_chunks") > 0
    all_ = told(garbled_toc_title_count="garbled_titles", garbled_heading_title_count="garbled_headings", garbled_sample_chunk_count="garbled_chunks", garbled_toc_examples="title_examples", garbled_heading_examples="heading_examples")
    return messages(stats, 60, (title, "WARN", "garbled_title", all_), (text, "WARN", "garbled_text", told(sample_chunk_count="garbled_chunks")), (~title & ~text, "PASS", "garbled_ok", all_))


def compact_blocks(rows: DataFrame, order: str, reach: int = 80) -> DataFrame:
    """The texts of each doc joined without white space, in blocks: doc, total (its length), block, text. A block goes on
    `reach` - 1 characters into the next one, so whatever is that long lies whole in a block."""
    own = T.pinned(rows.select("doc", order, "text"), c=T.compact_text(F.coalesce(F.col("text"), F.lit("")))).select("doc", order, "c", F.length("c").cast("long").alias("n")).where("n > 0")
    before = Window.partitionBy("doc").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy("doc")))
    first, last = F.greatest(F.lit(0), F.floor((F.col("at") - reach + 1) / BLOCK)), F.floor((F.col("at") + F.col("n") - 1) / BLOCK)
    pieces = own.withColumn("block", F.explode(F.sequence(first, last))).withColumn("lo", F.greatest(F.col("at"), F.col("block") * BLOCK)).withColumn("hi", F.least(F.col("at") + F.col("n"), (F.col("block") + 1) * BLOCK + reach - 1)).where("lo < hi")
    pieces = pieces.select("doc", "total", "block", "lo", F.substring("c", (F.col("lo") - F.col("at") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("piece"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", "piece"))), lambda x: x["piece"]), "")
    return pieces.groupBy("doc", "total", "block").agg(text.alias("text"))


#: An odd number and its inverse modulo 2**64.
_BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


@lru_cache(4)
def _powers_to(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of base. They are made once for all texts of up to a power of two characters."""
    return _powers_to(base, 1 << max(16, (n - 1).bit_length()))[:n]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def rolling(text: str, size: int) -> np.ndarray:
    """A hash of every window of `size` characters of text, in order; equal windows have equal hashes."""
    codes = _codes(text)
    if len(codes) < size:
        return np.zeros(0, np.uint64)
    # Sums of characters times powers of their places; a window's difference of sums, moved back to place zero.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASE, len(codes)))])
    return (sums[size:] - sums[:-size]) * _powers(_BACK, len(sums) - size)


def hashes_of(windows: list[str], size: int) -> np.ndarray:
    """What rolling gives for each of some texts of `size` characters."""
    return (_codes("".join(windows)).reshape(len(windows), size) * _powers(_BASE, size)).sum(axis=1, dtype=np.uint64)


#: Bits of a hash by which most places of a text are told from all that is asked.
_FEW = 16


def held(text: str, windows: list[str]) -> np.ndarray:
    """Which of the windows text holds. One pass tells all hashes of a length; texts are compared where hashes agree."""
    out = np.zeros(len(windows), bool)
    sizes = np.array([len(w) for w in windows])
    for size in set(sizes.tolist()):
        mine = np.flatnonzero(sizes == size)
        if not size:
            out[mine] = True
            continue
        asked, have = hashes_of([windows[i] for i in mine], size), rolling(text, size)
        order = np.argsort(asked)
        asked, shift = asked[order], np.uint64(64 - _FEW)
        some = np.zeros(1 << _FEW, bool)
        some[asked >> shift] = True
        places = np.flatnonzero(some[have >> shift])
        have = have[places]
        at = np.minimum(np.searchsorted(asked, have), len(mine) - 1)
        # Equal windows stand beside each other; each place asks the first of them.
        for hit in np.flatnonzero(asked[at] == have):
            for k in range(at[hit], len(mine)):
                i = mine[order[k]]
                if asked[k] != have[hit]:
                    break
                out[i] = out[i] or text.startswith(windows[i], int(places[hit]))
    return out


@F.arrow_udf(ArrayType(LongType()))
def _held(texts: pa.Array, numbers: pa.Array, windows: pa.Array) -> pa.Array:
    """Numbers of the windows that a text holds."""
    rows = zip(texts.to_pylist(), numbers.to_pylist(), windows.to_pylist(), strict=True)
    return pa.array([np.array(ks, np.int64)[held(text, ws)].tolist() for text, ks, ws in rows], pa.list_(pa.int64()))


def match_rates(source: DataFrame, target: DataFrame, window: int = 80, most: int = 120) -> DataFrame:
    """doc, rate: the share of windows spread over source's text that target's holds, both as compact_blocks. At most
    some `most` windows of a document meet its blocks, so no row holds a whole text."""
    step, base = F.greatest(F.lit(window), F.floor(F.col("total") / most)), F.col("block") * BLOCK
    first, last = F.ceil(base / step), F.floor(F.least(base + BLOCK - 1, F.greatest(F.lit(0), F.col("total") - window)) / step)
    taken = T.bound(T.wide(F.col("text")), lambda w: F.transform(F.sequence(first, last), lambda k: F.struct(k.alias("_k"), T.cut(w, k * step - base, window).alias("_w"))))
    asked = source.where(first <= last).select("doc", F.explode(taken).alias("_x")).select("doc", "_x.*")
    per = asked.groupBy("doc").agg(F.count(F.lit(1)).alias("samples"), F.collect_list(F.struct("_k", "_w")).alias("_ws"))
    met = target.select("doc", "text").join(per.select("doc", "_ws"), "doc")
    met = met.select("doc", F.explode(_held("text", F.col("_ws")["_k"], F.col("_ws")["_w"])).alias("_k"))
    found = met.groupBy("doc").agg(F.count_distinct("_k").alias("matched"))
    return per.join(found, "doc", "left").select("doc", F.bround(F.coalesce("matched", F.lit(0)) / F.col("samples"), 3).alias("rate"))


def coverage(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """How much of the source the chunks hold and the other way round, by length and by samples of 80 characters."""
    a, b = written(compact_blocks(pages, "page"), "source"), written(compact_blocks(chunks, "chunk_index"), "chunked")
    size = lambda df, name: df.groupBy("doc").agg(F.first("total").cast("int").alias(name))
    rows = pages.select("doc").distinct().join(size(a, "source_chars"), "doc", "left").join(size(b, "chunk_chars"), "doc", "left")
    rows = rows.join(match_rates(a, b).withColumnRenamed("rate", "source_rate"), "doc", "left").join(match_rates(b, a).withColumnRenamed("rate", "chunk_rate"), "doc", "left").fillna(0)
    ratio = F.least(F.lit(1.0), F.col("chunk_chars") / F.nullif(F.col("source_chars"), F.lit(0)))
    return rows.withColumn("char_ratio", F.coalesce(ratio, F.lit(0.0))).withColumn("coverage", F.bround(F.col("char_ratio") * 0.35 + F.col("source_rate") * 0.35 + F.col("chunk_rate") * 0.30, 3))


def check_coverage(stats: DataFrame) -> DataFrame:
    none = (F.col("source_chars") == 0) | (F.col("chunk_chars") == 0)
    bad = ~none & ((F.col("coverage") < 0.45) | (F.col("chunk_rate") < 0.55))
    low = ~none & ~bad & (F.col("coverage") < 0.65)
    all_ = told(pdf_chars_compact="source_chars", chunk_chars_compact="chunk_chars", chunk_to_pdf_char_ratio=F.bround("char_ratio", 3), pdf_sample_match_rate="source_rate", chunk_sample_match_rate="chunk_rate", estimated_coverage="coverage")
    return messages(stats, 70, (none, "FAIL", "cover_none"), (bad, "FAIL", "cover_bad", all_), (low, "WARN", "cover_low", all_), (~none & ~bad & ~low, "PASS", "cover_ok", all_))


def check_file_match(packs: DataFrame) -> DataFrame:
    """packs: doc, expected_hash, actual_hash, source_name, actual_name."""
    bad = (F.coalesce("expected_hash", F.lit("")) != "") & (F.col("expected_hash") != F.col("actual_hash"))
    name = (F.coalesce("source_name", F.lit("")) != "") & (F.element_at(F.split("source_name", "/"), -1) != F.col("actual_name"))
    return messages(packs, 1, (bad, "FAIL", "hash_bad", told(expected="expected_hash", actual="actual_hash")), (~bad, "PASS", "hash_ok"), (name, "WARN", "name_bad", told(manifest_file_name="source_name", pdf_file_name="actual_name")))


def schema_facts(lines: DataFrame) -> DataFrame:
    """lines (doc, line_no, line, record_type) as what their schema check asks: keys that are missing, whether items, path
    and embedding are lists, the index (as JSON), whether the text is blank. Each line is parsed once; texts stay behind."""
    rows = T.pinned(lines.select("doc", "line_no", "record_type", "line"), v=F.try_parse_json("line"))
    # What VARIANT refuses, as keys that repeat, is read once more.
    rows = T.pinned(rows, keys=F.coalesce(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")), F.json_object_keys("line")))
    listed = lambda path: F.try_variant_get("v", f"$.{path}", "array<variant>")
    kind = F.col("record_type")
    lacks = lambda names: F.array_except(F.array(*[F.lit(n) for n in names]), F.coalesce("keys", F.array().cast("array<string>")))
    missing = F.when(kind == "manifest", lacks(REQUIRED_MANIFEST)).when(kind == "chunk", lacks(REQUIRED_CHUNK))
    return rows.select(
        "doc", "line_no", "record_type", missing.alias("missing"), F.size(listed("items")).alias("items"),
        listed("heading_path").isNotNull().alias("has_path"), listed("embedding").isNotNull().alias("has_vector"),
        F.coalesce(F.to_json(F.try_variant_get("v", "$.chunk_index", "variant")), F.lit("null")).alias("index"),
        (T.strip(F.coalesce(F.try_variant_get("v", "$.text", "string"), F.lit(""))) == "").alias("blank"),
    )


def check_schema(lines: DataFrame) -> DataFrame:
    """lines: doc, line_no, line, record_type, as split_records gives them."""
    facts = written(schema_facts(lines), "facts")
    chunk = F.col("record_type") == "chunk"
    nth = F.count_if(chunk).over(Window.partitionBy("doc").orderBy("line_no"))
    rows = facts.withColumn("nth", nth)
    at = lambda rest: F.concat(F.lit('{"chunk_index":'), "index", F.lit(","), rest, F.lit("}"))
    faults = F.array_compact(F.array(
        F.when(F.size("missing") > 0, at(F.concat(F.lit('"missing":'), F.to_json("missing")))),
        F.when(~F.col("has_path"), at(F.lit('"error":"heading_path is not list"'))),
        F.when(~F.col("has_vector"), at(F.lit('"error":"embedding is not list"'))),
    ))
    bad = facts.where(chunk).select("doc", "line_no", faults.alias("_faults")).where(F.size("_faults") > 0)
    head = lambda k: F.first(F.when(F.col("record_type") == k[0], F.col(k[1])), ignorenulls=True)
    per = rows.groupBy("doc").agg(
        F.count_if(F.col("record_type") == "manifest").alias("_manifests"),
        head(("manifest", "missing")).alias("_missing"),
        head(("toc", "items")).alias("items"),
        F.count_if(chunk).alias("n"),
        F.count_if(chunk & (F.col("index") != F.col("nth").cast("string"))).alias("gaps"),
        F.count_if(chunk & F.col("blank")).alias("empty"),
    )
    named = facts.where(chunk)
    for some in (
        first_of(bad, BAD_CHUNKS, "line_no", "_faults", "faults"),
        first_of(named, FIRST_INDICES, "line_no", "index", "firsts"),
        first_of(named.where("blank"), EMPTY_CHUNKS, "line_no", "index", "blanks"),
    ):
        per = per.join(some, "doc", "left")
    listed = lambda name, xs: F.concat(F.lit(f'{{"{name}":['), F.array_join(xs, ","), F.lit("]}"))
    missing = F.when(F.col("_manifests") == 0, F.array(*[F.lit(n) for n in REQUIRED_MANIFEST])).otherwise(F.col("_missing"))
    n, poor, toc = F.col("n"), F.size(missing) > 0, F.coalesce(F.col("items") >= 0, F.lit(False))
    examples = listed("examples", F.slice(F.flatten("faults"), 1, BAD_CHUNKS))
    return messages(
        per, 10,
        (poor, "FAIL", "manifest_bad", F.to_json(F.struct(missing.alias("missing")))), (~poor, "PASS", "manifest_ok"),
        (~toc, "FAIL", "toc_bad"), (toc, "PASS", "toc_ok", told(toc_items="items")), (n == 0, "FAIL", "no_chunks"),
        ((n > 0) & F.col("faults").isNotNull(), "FAIL", "chunk_bad", examples), ((n > 0) & F.col("faults").isNull(), "PASS", "chunk_ok", told(chunks="n")),
        ((n > 0) & (F.col("gaps") > 0), "WARN", "index_bad", listed("first_indices", F.col("firsts"))), ((n > 0) & (F.col("empty") > 0), "FAIL", "empty_chunk", listed("chunk_indices", F.col("blanks"))),
    )


PARAMETERS = ("target_chars", "max_chars", "section_split_chars", "min_chunk_chars", "overlap_chars")


def profile_mismatches(meta: DataFrame) -> DataFrame:
    """meta (doc, profile, parameters) with known, mismatches (the names of parameters unlike the profile's) and unlike
    (both values of each, as JSON)."""
    table = F.broadcast(profile_table(meta.sparkSession).where("kind = 'book'").toDF(*[f"_{c}" for c in profile_table(meta.sparkSession).columns]))
    out = meta.join(table, F.col("profile") == F.col("_profile"), "left")
    differs = lambda c: F.col(c).isNotNull() & (F.col(c) != F.col(f"_{c}"))
    unlike = F.array_compact(F.array(*[F.when(differs(c), F.lit(c)) for c in PARAMETERS]))
    both = F.map_filter(F.create_map(*[x for c in PARAMETERS for x in (F.lit(c), F.when(differs(c), F.struct(F.col(c).alias("manifest"), F.col(f"_{c}").alias("profile_default"))))]), lambda _, v: v.isNotNull())
    return out.select(*[meta[c] for c in meta.columns], F.col("_profile").isNotNull().alias("known"), unlike.alias("mismatches"), F.to_json(both).alias("unlike"))


def check_profile(meta: DataFrame) -> DataFrame:
    """meta also has provider and dimension."""
    rows = profile_mismatches(meta)
    known, bad = F.col("known"), F.size("mismatches") > 0
    other = known & ~F.coalesce(F.col("provider") == "none", F.lit(False))
    wide = known & ~other & (F.coalesce("dimension", F.lit(0)) != 0)
    return messages(
        rows, 30,
        (~known, "WARN", "profile_unknown", told(profile="profile")), (known & bad, "WARN", "profile_bad", F.col("unlike")), (known & ~bad, "PASS", "profile_ok", told(profile="profile")),
        (other, "WARN", "provider_bad", told(provider="provider")), (wide, "WARN", "dimension_bad", told(dimension="dimension")), (known & ~other & ~wide, "PASS", "embedding_ok"),
    )


def manifest_fields(records: DataFrame) -> DataFrame:
    """Of the packs' manifests what the checks ask for: hash and name of the source, profile, parameters, embedding."""
    at = lambda path: F.get_json_object("line", f"$.{path}")
    named = {"source_name": "source.file_name", "title": "title", "profile": "chunking.profile", "toc_source": "toc.source", "provider": "embedding.provider"}
    numbers = {c: f"chunking.{c}" for c in (*PARAMETERS, "max_chunk_heading_level")} | {"dimension": "embedding.dimension"}
    hashed = F.coalesce(F.nullif(at("source.source_sha256"), F.lit("")), at("document_id")).alias("expected_hash")
    return records.where("record_type = 'manifest'").select("doc", hashed, *[at(path).alias(c) for c, path in named.items()], *[at(path).try_cast("int").alias(c) for c, path in numbers.items()])


def pack_chunks(records: DataFrame) -> DataFrame:
    """The chunks of the packs' lines."""
    kind = "chunk_index int, chunk_id string, text string, heading_path array<string>, toc_path array<struct<toc_id:string,level:int,title:string>>, source struct<pdf_page_start:int,pdf_page_end:int>"
    rows = records.where("record_type = 'chunk'").select("doc", F.from_json("line", kind).alias("c")).select("doc", "c.*")
    return rows.withColumn("page_start", F.col("source.pdf_page_start")).withColumn("page_end", F.col("source.pdf_page_end")).drop("source")


def pack_items(records: DataFrame) -> DataFrame:
    """The items of the packs' contents, in order."""
    items = F.from_json("line", "items array<struct<toc_id:string,title:string,level:int>>")["items"]
    return records.where("record_type = 'toc'").select("doc", F.posexplode(items).alias("ord", "i")).select("doc", "ord", "i.*")


def score(failed: Column, warned: Column) -> Column:
    return F.greatest(F.lit(0), F.lit(100) - 35 * failed - 8 * warned)


def verdict(checks: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Per doc: passed, warned, failed, score, result, reasons (of failures, in order) and the sentence to show."""
    fail = F.transform(F.array_sort(F.collect_list(F.when(F.col("status") == "FAIL", F.struct("ord", "message")))), lambda x: x["message"])
    out = checks.groupBy("doc").agg(*[F.count_if(F.col("status") == s).alias(n) for s, n in (("PASS", "passed"), ("WARN", "warned"), ("FAIL", "failed"))], fail.alias("reasons"))
    out = out.withColumn("score", score(F.col("failed"), F.col("warned")))
    out = out.withColumn("result", F.when(F.col("failed") > 0, "FAIL").when((F.col("score") < 75) | (F.col("warned") > 0), "WARN").otherwise("PASS"))
    if titles is not None:
        out = out.join(titles.select("doc", "title"), "doc", "left")
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit("这本书")) if titles is not None else F.lit("这本书")
    told = (
        F.when(F.col("result") == "PASS", F.concat(title, F.lit(" 的 no-embedding 自检通过，可以继续生成 embedding。")))
        .when(F.col("result") == "WARN", F.concat(title, F.lit(" 基本可用，但建议先抽查 warnings 中提到的 chunk 或标题路径，再决定是否生成 embedding。")))
        .otherwise(F.concat(title, F.lit(" 不建议继续生成 embedding。请先处理失败项："), F.array_join(F.slice("reasons", 1, 3), "；")))
    )
    return out.withColumn("recommendation", told).drop("title")


def recommend_profile(classified: DataFrame, meta: DataFrame) -> DataFrame:
    """classified (doc, profile, scores) against meta (doc, profile): confidence by the gap between the best two."""
    top = F.array_sort(F.transform(F.map_values("scores"), lambda v: -v))
    rows = classified.withColumn("_best", -top[0]).withColumn("_gap", top[1] - top[0]).join(meta.select("doc", F.col("profile").alias("current")), "doc")
    sure = F.when((F.col("_best") >= 6) & (F.col("_gap") >= 4), "high").when((F.col("_best") >= 4) & (F.col("_gap") >= 2), "medium").otherwise("low")
    rows = rows.withColumn("confidence", sure)
    keep = (F.col("profile") == F.col("current")) | (F.col("confidence") == "low")
    reason = F.when(F.col("confidence") == "low", R["profile_weak"]).when(F.col("profile") == F.col("current"), R["profile_same"]).otherwise(F.concat(F.lit("离线分类器更倾向 "), "profile", F.lit("，建议确认是否应改用 --profile "), "profile", F.lit("。")))
    told = F.when(F.col("confidence") == "low", F.col("current")).otherwise(F.col("profile"))
    more = [F.col("profile").alias("classifier_top"), *[F.col(a).alias(b) for a, b in (("score_text", "scores"), ("signals", "signals")) if a in classified.columns]]
    return rows.select("doc", "current", told.alias("recommended"), "confidence", F.when(keep, "keep").otherwise("consider_change").alias("action"), *more, reason.alias("reason"))


def recommend_level(meta: DataFrame, toc: DataFrame, lengths: DataFrame) -> DataFrame:
    """meta: doc, profile, max_chunk_heading_level."""
    deep = toc.groupBy("doc").agg(F.max("level").alias("_deep"))
    rows = meta.join(deep, "doc", "left").join(lengths, "doc", "left")
    n, level = F.greatest(F.lit(1), F.coalesce("chunks", F.lit(0))), F.col("max_chunk_heading_level")
    long_, short = F.coalesce(F.col("long") + F.col("very_long"), F.lit(0)), F.coalesce(F.col("very_short") + F.col("short"), F.lit(0))
    plain = ~F.col("profile").isin("fiction", "reference") & (F.coalesce(level, F.lit(0)) > 0)
    up = F.coalesce(plain & (F.col("_deep") > level) & (long_ / n > 0.18), F.lit(False))
    down = F.coalesce(plain & ~up & (short / n > 0.35), F.lit(False))
    up_to, down_to = F.least(F.col("_deep"), level + 1).cast("string"), F.greatest(F.lit(1), level - 1).cast("string")
    reason = (
        F.when(F.col("profile").isin("fiction", "reference"), F.concat("profile", F.lit(" 类资料通常不需要追求很深的标题层级。")))
        .when(up, F.concat(F.lit("存在较多长 chunk，且 TOC 还有更深层级，可尝试 --max-chunk-heading-level "), up_to, F.lit("。")))
        .when(down, F.concat(F.lit("短 chunk 比例偏高，可人工评估是否降低到 --max-chunk-heading-level "), down_to, F.lit("。")))
        .otherwise(R["level_fits"])
    )
    counts = toc.groupBy("doc", "level").agg(F.count(F.lit(1)).alias("n")).groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("level", "n")))).alias("toc_level_counts"))
    return rows.join(counts, "doc", "left").select("doc", "toc_level_counts", reason.alias("reason"), level.alias("current"), F.when(up, F.least(F.col("_deep"), level + 1)).when(down, F.greatest(F.lit(1), level - 1)).otherwise(level).cast("int").alias("recommended"), F.when(up, "consider_increase").when(down, "consider_decrease").otherwise("keep").alias("action"), F.when(down, "low").otherwise("medium").alias("confidence"))


def level_counts(toc: DataFrame) -> DataFrame:
    return toc.groupBy("doc", "level").agg(F.count(F.lit(1)).alias("n"))


def body_heading_candidates(pages: DataFrame, profile: str = "social_science", lines: DataFrame | None = None) -> DataFrame:
    """lines (doc, text): the stripped lines of pages, where they are there already; empty ones don't count."""
    split = pages.select("doc", F.explode(F.transform(T.splitlines(F.col("text")), T.stripped)).alias("line")) if lines is None else lines.select("doc", F.col("text").alias("line"))
    return split.groupBy("doc").agg(F.count_if(H.is_body_short_heading(F.col("line"), profile)).alias("candidates"))


def recommend_body_headings(meta: DataFrame, candidates: DataFrame, lengths: DataFrame, heads: DataFrame) -> DataFrame:
    """meta: doc, profile, toc_source."""
    rows = meta.join(candidates, "doc", "left").join(lengths.select("doc", "chunks", "long", "very_long"), "doc", "left").join(heads.select("doc", "shallow_paths", "body_heading_chunks"), "doc", "left")
    n = F.greatest(F.lit(1), F.coalesce("chunks", F.lit(0)))
    on = F.contains(F.coalesce("toc_source", F.lit("")), F.lit("body_heading_augmentation"))
    never = F.col("profile").isin("reference", "fiction", "legal")
    want = ~on & ~never & (F.coalesce("candidates", F.lit(0)) >= 12) & ((F.coalesce(F.col("long") + F.col("very_long"), F.lit(0)) / n > 0.12) | (F.coalesce("shallow_paths", F.lit(0)) / n > 0.45))
    return rows.select("doc", F.when(on, "enabled").otherwise("disabled").alias("current"), F.when(on | want, "enabled").otherwise("disabled").alias("recommended"), F.when(want, "consider_enable").otherwise("keep").alias("action"), F.when(on & (F.coalesce("body_heading_chunks", F.lit(0)) > 0), "high").otherwise("medium").alias("confidence"), F.coalesce("candidates", F.lit(0)).alias("candidates"), F.when(on, R["body_on"]).when(never, F.concat("profile", F.lit(" 类资料通常不优先使用正文短标题增强。"))).when(want, R["body_want"]).otherwise(R["body_no"]).alias("reason"))


def sample_chunks(chunks: DataFrame, most: int = 5) -> DataFrame:
    """First, middle, last, longest and shortest chunk (the first of equals), without repeats: doc, pick, chunk_index."""
    w = Window.partitionBy("doc")
    rows = chunks.select("doc", "chunk_index", F.length(F.coalesce("text", F.lit(""))).alias("_len"))
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_i", F.row_number().over(w.orderBy("chunk_index")) - 1)
    rows = rows.withColumn("_l", F.row_number().over(w.orderBy(F.desc("_len"), "chunk_index"))).withColumn("_s", F.row_number().over(w.orderBy("_len", "chunk_index")))
    picks = F.array(*[F.when(c, F.lit(k)) for k, c in enumerate((F.col("_i") == 0, F.col("_i") == F.floor(F.col("_n") / 2), F.col("_i") == F.col("_n") - 1, F.col("_l") == 1, F.col("_s") == 1), 1)])
    rows = rows.select("doc", "chunk_index", F.array_min(picks).alias("pick")).where("pick IS NOT NULL")
    return rows.withColumn("pick", F.row_number().over(Window.partitionBy("doc").orderBy("pick"))).where(F.col("pick") <= most)


def compare_samples(chunks: DataFrame, pages: DataFrame, most: int = 5) -> DataFrame:
    """The sample chunks beside the pages that they come from: match rate and previews."""
    path = F.array_join(F.coalesce("heading_path", F.array().cast("array<string>")), " > ").alias("heading_path")
    some = sample_chunks(chunks, most).join(chunks.select("doc", "chunk_index", "text", "page_start", F.coalesce("page_end", "page_start").alias("page_end"), path), ["doc", "chunk_index"])
    spans = some.where("page_start <= page_end").select("doc", "chunk_index", F.explode(F.sequence("page_start", "page_end")).alias("page")).join(pages.select("doc", "page", F.col("text").alias("p")), ["doc", "page"])
    source = spans.groupBy("doc", "chunk_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "p"))), lambda x: x["p"]), "\n\n").alias("_src"))
    rows = some.join(source, ["doc", "chunk_index"], "left").withColumn("_src", F.coalesce("_src", F.lit("")))
    rows = T.pinned(rows, _c=T.compact_text(F.col("text")), _p=T.compact_text(F.col("_src"))).withColumn("char_count", F.length(F.coalesce("text", F.lit(""))))
    # The offset in the compact text is used in the page text as it is.
    at = F.when(F.col("_c") == "", 0).otherwise(F.instr(F.col("_p"), F.left(F.col("_c"), F.lit(40))))
    shown = F.when(at > 0, F.substring(F.col("_src"), at, F.length("_src"))).otherwise(F.col("_src"))
    return rows.select("doc", "pick", "chunk_index", "heading_path", "page_start", "page_end", "char_count", T.sample_match_rate(F.col("_c"), F.col("_p"), 40, 30).alias("match_rate"), T.preview_text(F.col("text")).alias("chunk_preview"), T.preview_text(shown).alias("source_preview"))


def escape_html(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _or(judged: DataFrame, name: str, kind: str) -> Column:
    """A column of judged, or null of that type where it is missing."""
    return F.col(name) if name in judged.columns else F.lit(None).cast(kind)


_ADVICE = {"profile": ("profile", "Profile 推荐"), "level": ("max_chunk_heading_level", "标题层级推荐"), "body_headings": ("body_heading_augmentation", "正文短标题增强")}


def _fields(judged: DataFrame, name: str) -> list[str]:
    return judged.select(f"{name}.*").columns if name in judged.columns else []


def reports(judged: DataFrame) -> DataFrame:
    """judged (doc, result, score, recommendation, checks[, title, summary, stats, recommendations, samples]) as doc, json,
    report (plain text) and html. Of what a document lacks, the reports say nothing."""
    return judged.select("doc", _json(judged).alias("json"), _text(judged).alias("report"), _html(judged).alias("html"))


def _json(judged: DataFrame) -> Column:
    advice = [F.struct(*[F.col(f"recommendations.{k}").alias(name) for k, (name, _) in _ADVICE.items()]).alias("recommendations")] if "recommendations" in judged.columns else []
    names = [c for c in ("title", "summary", "stats") if c in judged.columns]
    samples = ["samples"] if "samples" in judged.columns else []
    return F.to_json(F.struct("result", "score", "doc", *names, *advice, *samples, "checks", "recommendation"), {"ignoreNullFields": "false"})


def _text(judged: DataFrame) -> Column:
    told = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    lines = [F.concat("result", F.lit(": "), F.coalesce(_or(judged, "title", "string"), F.col("doc"))), F.lit(""), F.concat(F.lit("score: "), F.col("score").cast("string"), F.lit("/100"))]
    if "summary" in judged.columns:
        lines += [F.lit("\nsummary:"), *[F.concat(F.lit(f"  {f}: "), told(F.col(f"summary.{f}"))) for f in _fields(judged, "summary")]]
    if "stats" in judged.columns:
        shown = (("length", (("min", "min_chars"), ("median", "median_chars"), ("avg", "average"), ("max", "max_chars"))), ("coverage", (("estimated", "coverage"), ("source_sample", "source_rate"), ("chunk_sample", "chunk_rate"))))
        lines += [F.lit("\nstats:"), *[F.concat(F.lit(f"  {part}: "), F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), told(F.col(f"stats.{part}.{c}"))) for n, c in fields])) for part, fields in shown]]
    if "recommendations" in judged.columns:
        one = lambda k, name: F.concat(F.lit(f"  {name}: "), told(F.col(f"recommendations.{k}.current")), F.lit(" -> "), told(F.col(f"recommendations.{k}.recommended")), F.lit(" ("), told(F.col(f"recommendations.{k}.action")), F.lit(", "), told(F.col(f"recommendations.{k}.confidence")), F.lit(")"))
        lines += [F.lit("\nlocal recommendations:"), *[one(k, name) for k, (name, _) in _ADVICE.items()]]
    checks = F.transform("checks", lambda c: F.concat(F.lit("  ["), c["status"], F.lit("] "), c["message"]))
    return F.concat_ws("\n", *lines, F.lit("\nchecks:"), F.array_join(checks, "\n"), F.lit("\nrecommendation:"), F.concat(F.lit("  "), "recommendation"))


_STYLE = "body{font-family:sans-serif;margin:2em}.pass{color:#176b34}.warn{color:#9a5b00}.fail{color:#a11}.card{border:1px solid #ccc;border-radius:6px;padding:1em;margin:.5em 0}td,th{border:1px solid #ccc;padding:.4em;vertical-align:top}pre{white-space:pre-wrap;background:#f6f6f6;padding:.6em}"


def _html(judged: DataFrame) -> Column:
    """Verdict, summary, recommendation cards, statistics, checks and sample cards; every value is escaped."""
    e = lambda c: escape_html(F.coalesce(c.cast("string"), F.lit("")))
    tag = lambda name, *inner, cls="": F.concat(F.lit(f"<{name}{cls and f' class={chr(34)}{cls}{chr(34)}'}>"), *inner, F.lit(f"</{name}>"))
    heading = lambda text: F.lit(f"<h2>{text}</h2>")
    title = e(F.coalesce(_or(judged, "title", "string"), F.col("doc")))
    parts = [F.lit('<!doctype html><html lang="zh-CN"><head><meta charset="utf-8">'), tag("title", title), F.lit(f"<style>{_STYLE}</style></head><body>"), tag("h1", title)]
    parts += [F.concat(F.lit('<p class="'), F.lower(e(F.col("result"))), F.lit('">'), e(F.col("result")), F.lit(" · "), e(F.col("score")), F.lit(" / 100</p>")), tag("p", e(F.col("recommendation")))]
    if "summary" in judged.columns:
        parts += [heading("摘要"), tag("ul", *[tag("li", F.lit(f"<strong>{f}</strong>: "), e(F.col(f"summary.{f}"))) for f in _fields(judged, "summary")])]
    if "recommendations" in judged.columns:
        of = lambda k, f: e(F.col(f"recommendations.{k}.{f}"))
        parts += [heading("本地建议"), *[tag("div", F.lit(f"<h3>{label}</h3>"), tag("p", of(k, "current"), F.lit(" → "), of(k, "recommended")), tag("p", of(k, "action"), F.lit(" / "), of(k, "confidence")), tag("p", of(k, "reason")), cls="card") for k, (_, label) in _ADVICE.items()]]
    if "stats" in judged.columns:
        rows = [tag("tr", F.lit(f"<th>{part}.{f}</th>"), tag("td", e(F.col(f"stats.{part}.{f}")))) for part in _fields(judged, "stats") for f in judged.select(f"stats.{part}.*").columns]
        parts += [heading("统计"), tag("table", *rows)]
    row = lambda c: F.concat(F.lit('<tr><td class="'), F.lower(e(c["status"])), F.lit('">'), e(c["status"]), F.lit("</td><td>"), e(c["message"]), F.lit("</td><td><code>"), e(F.to_json(c["detail"])), F.lit("</code></td></tr>"))
    parts += [heading("检查项"), tag("table", tag("tr", *[tag("th", F.lit(x)) for x in ("状态", "说明", "详情")]), F.array_join(F.transform("checks", row), ""))]
    if "samples" in judged.columns:
        card = lambda x: tag("div", F.lit("<h3>chunk "), e(x["chunk_index"]), F.lit(" · "), e(x["page_start"]), F.lit("-"), e(x["page_end"]), F.lit("</h3>"), tag("p", e(x["heading_path"])), tag("p", e(x["char_count"]), F.lit(" · "), e(x["match_rate"])), tag("pre", e(x["chunk_preview"])), tag("pre", e(x["source_preview"])), cls="card")
        parts += [heading("抽样对照"), F.coalesce(F.array_join(F.transform("samples", card), ""), F.lit(""))]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts], F.lit("</body></html>"))


def with_checks(verdicts: DataFrame, checks: DataFrame) -> DataFrame:
    """verdicts with checks, the array of (status, message, detail) in order."""
    one = F.struct("ord", "status", "message", F.to_json("detail").alias("json"))
    parsed = lambda x: F.struct(x["status"].alias("status"), x["message"].alias("message"), F.parse_json(x["json"]).alias("detail"))
    rows = checks.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(one)), parsed).alias("checks"))
    return verdicts.join(rows, "doc")


def with_samples(judged: DataFrame, samples: DataFrame) -> DataFrame:
    """judged with samples, the array of the sample chunks in order."""
    rows = samples.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(*[c for c in samples.columns if c != "doc"]))).alias("samples"))
    return judged.join(rows, "doc", "left")
