"""Tables of contents: inferred, repaired, located and augmented.

Tables: pages (doc, page, text), lines (doc, idx, page, text, normalized), toc (doc, ord, toc_id, title, level,
parent_ord, page, method, confidence). All windows are partitioned by doc; one document is the largest unit of work.

Tables with a row per heading are merged, never broadcast: their files are a small part of what their rows take in
memory, a plan goes by the files, and the driver would hold all of them.
"""

from __future__ import annotations

import difflib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from codexloom.functions import headings as H
from codexloom.functions import text as T
from codexloom.session import written

#: Deepest level of a heading: six from the rules, one more for Markdown, two to spare for outlines.
DEEPEST = 9
#: The ratio from which a line is like a title on the pages around its own.
LIKE = 0.82
#: Lines in a block in which lines and spans of a document meet.
BLOCK = 64


def toc_id(ord_: Column) -> Column:
    return F.format_string("toc:%06d", ord_)


def flatten_lines(pages: DataFrame, *, normalized: bool = True) -> DataFrame:
    """Stripped lines that aren't empty, numbered from 0 within the document. Pages are put in order, not lines: a page's
    first line has the number of lines on the pages before. Pages of a document have different numbers."""
    cut = pages.select("doc", "page", F.filter(F.transform(T.splitlines(F.col("text")), T.stripped), lambda x: x != "").alias("_lines"))
    before = Window.partitionBy("doc").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_before", F.coalesce(F.sum(F.greatest(F.size("_lines"), F.lit(0))).over(before), F.lit(0)))
    out = cut.select("doc", "page", "_before", F.posexplode("_lines").alias("_pos", "text"))
    out = out.select("doc", (F.col("_before") + F.col("_pos")).cast("int").alias("idx"), "page", "text")
    return out.withColumn("normalized", T.normalize_title(F.col("text"))) if normalized else out


def _last_at(levels: int, of: Column, order: str = "ord") -> list[Column]:
    w = Window.partitionBy("doc").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return [F.last(F.when(F.col("level") == k, of), ignorenulls=True).over(w) for k in range(1, levels + 1)]


def with_parents(toc: DataFrame) -> DataFrame:
    """toc with parent_ord (the nearest row before it of a smaller level) and path_ords (its ancestors and itself)."""
    last = toc
    for k, c in enumerate(_last_at(DEEPEST, F.col("ord")), 1):
        last = last.withColumn(f"_a{k}", c)
    parent = F.greatest(*[F.when(F.col("level") > k, F.col(f"_a{k}")) for k in range(1, DEEPEST + 1)])
    above = []
    for k in range(1, DEEPEST + 1):
        newer = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"_a{j}") < F.col(f"_a{k}"), F.lit(True)) for j in range(1, k)], F.lit(True))
        above.append(F.when((F.col("level") > k) & newer, F.col(f"_a{k}")))
    path = F.concat(F.filter(F.array(*above), lambda x: x.isNotNull()), F.array("ord"))
    return last.withColumn("parent_ord", parent).withColumn("path_ords", path).drop(*[f"_a{k}" for k in range(1, DEEPEST + 1)])


def with_levels(heads: DataFrame, profile: str) -> DataFrame:
    """heads (doc, ord from 1, title) with level: the rules', or by the heading before where they are silent."""
    w = Window.partitionBy("doc").orderBy("ord")
    heads = heads.withColumn("_own", H.own_level(F.col("title"), profile))
    before = F.lag("_own").over(w)
    deep = F.when(before.isNotNull(), before >= 2).otherwise(F.col("ord") > 2)
    level = F.coalesce("_own", F.when(F.col("ord") == 1, 1).when(F.col("title").rlike(H.HAS_COLON) & deep, 3).otherwise(2))
    return heads.withColumn("level", level.cast("int")).drop("_own")


def infer_toc(pages: DataFrame, profile: str = "social_science", lines: DataFrame | None = None) -> DataFrame:
    """The outline that heading rules find in text without one. lines: those of pages, where they are there already."""
    return infer_from_lines(flatten_lines(pages, normalized=False) if lines is None else lines, profile)


def infer_from_lines(lines: DataFrame, profile: str = "social_science") -> DataFrame:
    """infer_toc for lines that are there already, so that no text is split twice."""
    lines = lines.where(H.is_possible_heading(F.col("text"), profile))
    heads = lines.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("idx")).alias("ord"), F.col("text").alias("title"), "page")
    out = with_parents(with_levels(heads, profile))
    confidence = 0.7 if profile == "textbook" else 0.65
    return out.select("doc", "ord", toc_id(F.col("ord")).alias("toc_id"), "title", "level", "parent_ord", "path_ords", "page", F.lit(f"{profile}_heading_rule").alias("method"), F.lit(confidence).alias("confidence"))


def toc_paths(toc: DataFrame) -> DataFrame:
    """Per heading the titles from the root to itself, joined by ' > '."""
    titles = toc.select("doc", F.col("ord").alias("_o"), F.col("title").alias("_t"))
    steps = toc.select("doc", "ord", F.posexplode("path_ords").alias("pos", "_o")).join(titles, ["doc", "_o"])
    return steps.groupBy("doc", "ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_t"))), lambda x: x["_t"]), " > ").alias("path"), F.count(F.lit(1)).alias("depth"))


def front_matter_candidates(pages: DataFrame, first_pages: int = 8) -> DataFrame:
    """Lines of a printed table of contents: doc, ord, title, level; the first of equal titles."""
    raw = pages.where(F.col("page") <= first_pages).select("doc", "page", F.posexplode(T.splitlines(F.col("text"))).alias("pos", "raw"))
    hits = raw.withColumn("title", T.normalize_text(F.col("raw"))).where((F.col("title") != "") & (F.col("title") != "目录") & F.col("title").rlike(H.FRONT_TOC_LINE))
    hits = hits.withColumn("_key", T.normalize_title(F.col("title")))
    first = hits.withColumn("_n", F.row_number().over(Window.partitionBy("doc", "_key").orderBy("page", "pos"))).where("_n = 1")
    return first.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("page", "pos")).alias("ord"), "title", H.front_toc_level(F.col("title")).alias("level"))


def repair_titles(toc: DataFrame, pages: DataFrame) -> DataFrame:
    """toc with garbled titles replaced by those of the printed contents, position by position where levels agree."""
    items = toc.withColumn("_bad", T.is_garbled_title(F.col("title"))).withColumn("_pos", F.row_number().over(Window.partitionBy("doc").orderBy("ord")))
    size = items.groupBy("doc").agg(F.count(F.lit(1)).alias("_n"), F.bool_or("_bad").alias("_any"))
    found = front_matter_candidates(pages)
    ready = size.join(found.groupBy("doc").agg(F.count(F.lit(1)).alias("_m")), "doc").where(F.col("_any") & (F.col("_m") >= F.greatest(F.lit(3), F.floor(F.col("_n") * 0.6)))).select("doc")
    clean = found.join(ready, "doc", "left_semi").select("doc", F.col("ord").alias("_pos"), F.col("title").alias("_title"), F.col("level").alias("_level"))
    out = items.join(clean, ["doc", "_pos"], "left")
    swap = F.col("_bad") & F.coalesce(F.col("_level") == F.col("level"), F.lit(False))
    return out.withColumn("repaired", swap).withColumn("title", F.when(swap, F.col("_title")).otherwise(F.col("title"))).drop("_bad", "_pos", "_title", "_level")


@F.arrow_udf(DoubleType())
def match_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


def _pairs_of(x: Column) -> Column:
    """Neighbouring characters of x, each pair with how often it has come so far."""
    pairs = F.when(F.length(x) > 1, F.transform(F.sequence(F.lit(1), F.length(x) - 1), lambda i: F.substring(x, i, 2))).otherwise(F.array().cast("array<string>"))
    return T.bound(pairs, lambda ps: F.transform(ps, lambda p, i: F.concat(p, F.size(F.filter(F.slice(ps, F.lit(1), i + 1), lambda q: q == p)).cast("string"))))


def similar(targets: DataFrame, texts: DataFrame, keys: list[str], least: float) -> DataFrame:
    """Of targets (keys, target) and texts (keys, text) the pairs with equal keys and a ratio of `least` or more, once each:
    keys, target, text, ratio. A set-similarity join: only pairs that share a rare pair of characters are compared.

    Strings of a and b characters with the ratio r match in M >= r(a+b)/2 characters. What is left over, a+b-2M, parts the
    matching blocks, so there are at most a+b-2M+1 of them, and M less their number is a lower bound of common pairs of
    neighbours: (a+b)(1.5r-1)-1. A string with n pairs of which o must be common has one of those among its n-o+1 rarest."""
    close = lambda a, b: F.least(a, b) * 2 >= (a + b) * least
    common = lambda total: F.greatest(F.lit(1), F.ceil(total * (1.5 * least - 1) - 1 - 1e-6))
    sizes = targets.groupBy(*keys).agg(F.collect_set(F.length("target")).alias("_sizes"))
    some = texts.join(sizes, keys).where(F.exists("_sizes", lambda n: close(F.length("text"), n))).select(*keys, F.lit(1).alias("_side"), F.col("text").alias("_s"))
    both = targets.select(*keys, F.lit(0).alias("_side"), F.col("target").alias("_s")).unionByName(some).distinct()
    grams = both.select(*keys, "_side", "_s", F.explode(_pairs_of(F.col("_s"))).alias("_g"))
    n = F.length("_s")
    first = n - common(n * (2 / (2 - least)))
    rare = grams.withColumn("_f", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_g")))
    rare = rare.withColumn("_k", F.row_number().over(Window.partitionBy(*keys, "_side", "_s").orderBy("_f", "_g"))).where(F.col("_k") <= first)
    side = lambda k, name: rare.where(F.col("_side") == k).select(*keys, "_g", F.col("_s").alias(name))
    met = side(0, "target").join(side(1, "text"), [*keys, "_g"]).where(close(F.length("text"), F.length("target"))).select(*keys, "target", "text").distinct()
    shared = F.size(F.array_intersect(_pairs_of(F.col("target")), _pairs_of(F.col("text"))))
    met = met.where(shared >= common(F.length("text") + F.length("target")))
    return met.withColumn("ratio", match_ratio("text", "target")).where(F.col("ratio") >= least)


def locate_pages(toc: DataFrame, lines: DataFrame, *, before: int = 1, after: int = 2) -> DataFrame:
    """toc (doc, ord, title, page) with page, method and confidence of the best line on the pages around its own."""
    items = written(toc.withColumn("_target", T.normalize_title(F.col("title"))), "items")
    near = items.where("page IS NOT NULL").select("doc", "ord", "_target", F.explode(F.sequence(F.greatest(F.lit(1), F.col("page") - before), F.greatest(F.lit(1), F.col("page") + after))).alias("page"))
    # A line that is much longer than all titles can only begin like one: its first characters go to the titles.
    longest = near.agg(F.coalesce(F.max(F.length("_target")), F.lit(0))).first()[0]
    most = max(18, int(longest * (2 / LIKE - 1)) + 1)
    full = lines.where("normalized <> ''").select("doc", "page", "idx", (F.length("normalized") > most).alias("_long"), F.left(F.col("normalized"), F.when(F.length("normalized") > most, 18).otherwise(most)).alias("normalized"))
    exact = ~F.col("_long") & (F.col("normalized") == F.col("_target"))
    starts = F.col("normalized").startswith(F.left(F.col("_target"), F.lit(18))) | (~F.col("_long") & F.col("_target").startswith(F.col("normalized")))
    columns = ["doc", "ord", "page", "idx", F.when(exact, 1.0).when(starts, 0.9).alias("_sure")]
    sure = written(near.hint("merge").join(full, ["doc", "page"]).where(exact | starts).select(*columns), "sure")
    settled = sure.where("_sure = 1.0").select("doc", "ord").distinct()
    left = written(near.join(settled, ["doc", "ord"], "left_anti"), "left")
    short = written(full.where("NOT _long").drop("_long"), "short")
    alike = similar(left.select("doc", "page", F.col("_target").alias("target")).distinct(), short.select("doc", "page", F.col("normalized").alias("text")), ["doc", "page"], LIKE)
    alike = alike.select("doc", "page", F.col("target").alias("_target"), F.col("text").alias("normalized"), "ratio")
    fuzzy = left.hint("merge").join(alike, ["doc", "page", "_target"]).join(short, ["doc", "page", "normalized"]).withColumn("_long", F.lit(False)).where(~exact & ~starts).select("doc", "ord", "page", "idx", F.col("ratio").alias("_sure"))
    best = sure.unionByName(fuzzy).groupBy("doc", "ord").agg(F.max_by(F.struct("page", "_sure"), F.struct("_sure", -F.col("idx"))).alias("_b"))
    method = F.when(F.col("_b._sure") == 1.0, "exact_normalized").when(F.col("_b._sure") == 0.9, "prefix_normalized").otherwise("fuzzy_ratio")
    out = items.drop("_target", "method", "confidence").join(best, ["doc", "ord"], "left")
    return out.select(
        *[c for c in items.columns if c not in ("_target", "method", "confidence", "page")],
        F.coalesce("_b.page", "page").alias("page"),
        F.when(F.col("page").isNull(), "no_page").when(F.col("_b").isNotNull(), method).otherwise("bookmark_page_fallback").alias("method"),
        F.when(F.col("page").isNull(), 0.3).otherwise(F.coalesce("_b._sure", F.lit(0.5))).alias("confidence"),
    )


def locate_heading_lines(toc: DataFrame, lines: DataFrame) -> DataFrame:
    """doc, ord, start: the line of each heading, null where there is none.

    The first line near the heading's page that begins with its first 18 characters decides; those prefixes are joined
    by equality. Next comes the likeliest line near the page, then, behind all lines found for the headings before, the
    first that begins so and the likeliest, then the first of its page or a later one. See `_behind`."""
    items = toc.select("doc", "ord", "page", T.normalize_title(F.col("title")).alias("_target")).withColumn("_cut", F.least(F.length("_target"), F.lit(18))).withColumn("_head", F.left(F.col("_target"), F.lit(18)))
    hits = items.hint("merge").join(_heads(items, lines), ["doc", "_cut", "_head"]).where("_page BETWEEN page - 1 AND page + 2").groupBy("doc", "ord").agg(F.min("idx").alias("start"))
    placed = written(items.join(hits, ["doc", "ord"], "left"), "placed")
    if placed.where("start IS NULL").isEmpty():
        return placed.select("doc", F.col("ord").cast("int").alias("ord"), F.col("start").cast("int").alias("start"))
    return _behind(placed, lines)


def _heads(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines (doc, idx, _page) by the beginnings (_cut, _head; 18 characters at most) that items of their document could have."""
    # Most lines begin like no item: their first characters tell, before lines are sent to items.
    cuts = items.groupBy("doc").agg(F.collect_set(F.struct("_cut", F.left(F.col("_head"), F.lit(2)).alias("_begin"))).alias("_cuts"))
    heads = lines.select("doc", "idx", F.col("page").alias("_page"), F.left(F.col("normalized"), F.lit(18)).alias("normalized")).join(cuts, "doc")
    fits = F.filter("_cuts", lambda c: (F.length("normalized") >= c["_cut"]) & F.col("normalized").startswith(c["_begin"]))
    heads = heads.select("doc", "idx", "_page", "normalized", F.explode(F.array_distinct(F.transform(fits, lambda c: c["_cut"]))).alias("_cut"))
    return heads.withColumn("_head", F.left(F.col("normalized"), F.col("_cut"))).drop("normalized")


def _behind(placed: DataFrame, lines: DataFrame) -> DataFrame:
    """doc, ord, start of placed headings (doc, ord, page, _target, _cut, _head, start) of which some have no start yet.

    Which lines a heading could have is found by joins, whatever came before it. What remains is a running maximum: a
    heading takes the first of its lines that is not before the cursor, and moves the cursor behind it. Headings that have
    their line move it too, which a window tells; the others follow in a fold over their lists of line numbers."""
    open_ = placed.where("start IS NULL").drop("start")
    mine = lines.join(open_.select("doc").distinct(), "doc", "left_semi").select("doc", "idx", "page", "normalized")
    alike = written(similar(open_.select("doc", F.col("_target").alias("target")).distinct(), mine.select("doc", F.col("normalized").alias("text")), ["doc"], 0.9), "alike")
    alike = mine.select("doc", "idx", F.col("page").alias("_page"), F.col("normalized").alias("text")).join(alike, ["doc", "text"]).select("doc", F.col("target").alias("_target"), "idx", "_page", "ratio")
    close = open_.hint("merge").join(alike, ["doc", "_target"]).where("_page BETWEEN page - 1 AND page + 2").groupBy("doc", "ord").agg(F.max_by("idx", F.struct("ratio", -F.col("idx"))).alias("_near"))
    before = Window.partitionBy("doc").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    known = placed.join(close, ["doc", "ord"], "left").withColumn("start", F.coalesce("start", "_near")).drop("_near")
    known = written(known.withColumn("_cursor", F.coalesce(F.max("start").over(before) + 1, F.lit(0))), "known")

    left = known.where("start IS NULL")
    wanted = left.select("doc", "_target", "_cut", "_head").distinct().withColumn("_k", F.row_number().over(Window.partitionBy("doc").orderBy("_target")))
    begins = wanted.hint("merge").join(_heads(wanted, mine), ["doc", "_cut", "_head"]).groupBy("doc", "_k").agg(F.array_sort(F.collect_list("idx")).alias("begins"))
    likely = wanted.hint("merge").join(alike, ["doc", "_target"]).groupBy("doc", "_k").agg(F.collect_list(F.struct("ratio", (-F.col("idx")).alias("back"))).alias("likely"))
    none, no_pairs = F.array().cast("array<int>"), F.array().cast("array<struct<ratio:double,back:int>>")
    lists = wanted.hint("merge").select("doc", "_k").join(begins, ["doc", "_k"], "left").join(likely, ["doc", "_k"], "left")
    lists = lists.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("_k", F.coalesce("begins", none).alias("begins"), F.coalesce("likely", no_pairs).alias("likely")))).alias("lists"))

    # The first line of a page, or of the next one that has any.
    firsts = mine.groupBy("doc", "page").agg(F.min("idx").alias("idx")).select("doc", "page", "idx", F.lit(0).alias("_asks"), F.lit(None).cast("int").alias("ord"))
    asks = left.where("page IS NOT NULL").select("doc", "page", F.lit(None).cast("int").alias("idx"), F.lit(1).alias("_asks"), F.col("ord").cast("int").alias("ord"))
    down = Window.partitionBy("doc").orderBy(F.desc("page"), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    paged = firsts.unionByName(asks).withColumn("_first", F.last("idx", ignorenulls=True).over(down)).where("_asks = 1").select("doc", "ord", "_first")

    asked = left.join(wanted.select("doc", "_target", "_k").hint("merge"), ["doc", "_target"]).join(paged, ["doc", "ord"], "left")
    rows = asked.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(F.col("ord").cast("int").alias("ord"), "_cursor", "_k", "_first"))).alias("items")).join(lists, "doc")
    state = lambda at, out: F.struct(at.cast("int").alias("at"), out.alias("out"))

    def one(a: Column, x: Column) -> Column:
        cursor, own = F.greatest(a["at"], x["_cursor"]), F.get(F.col("lists"), x["_k"] - 1)
        ahead = F.get(F.filter(own["begins"], lambda i: i >= cursor), F.lit(0))
        best = F.array_max(F.filter(own["likely"], lambda c: -c["back"] >= cursor))
        return T.bound(F.coalesce(ahead, -best["back"], x["_first"]), lambda at: state(F.greatest(cursor, at + 1), F.concat(a["out"], F.array(at.cast("int")))))

    def block(a: Column, some: Column) -> Column:
        return T.bound(F.aggregate(some, state(a["at"], none), one), lambda r: state(r["at"], F.concat(a["out"], F.array(r["out"]))))

    found = T.fold_blocks(F.col("items"), state(F.lit(0), F.array().cast("array<array<int>>")), block, lambda a: F.flatten(a["out"]))
    walked = rows.select("doc", F.explode(F.arrays_zip(F.col("items")["ord"].alias("ord"), found.alias("start"))).alias("x")).select("doc", "x.ord", "x.start")
    done = known.where("start IS NOT NULL").select("doc", F.col("ord").cast("int").alias("ord"), F.col("start").cast("int").alias("start"))
    return done.unionByName(walked)


def section_ends(toc: DataFrame, starts: DataFrame, max_level: int | None = None) -> DataFrame:
    """Located headings (doc, ord, level, parent_ord, start) with end: the line of the next located heading of the same
    or a smaller level, or of the first located child where children end a section; null for the end of the document."""
    at = toc.join(starts.hint("merge"), ["doc", "ord"]).where("start IS NOT NULL")
    after = Window.partitionBy("doc").orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    spot = F.struct("ord", "start")
    nexts = [F.when(F.col("level") >= k, F.first(F.when(F.col("level") == k, spot), ignorenulls=True).over(after)) for k in range(1, DEEPEST + 1)]
    child = at.where("parent_ord IS NOT NULL").groupBy("doc", F.col("parent_ord").alias("ord")).agg(F.min(spot).alias("_child"))
    stops = F.lit(True) if max_level is None else F.col("level") < max_level
    out = at.withColumn("_next", F.least(*nexts)).join(child.hint("merge"), ["doc", "ord"], "left")
    return out.withColumn("end", F.least(F.col("_next"), F.when(stops, F.col("_child")))["start"]).drop("_next", "_child")


def candidate_runs(candidates: DataFrame, *by: str) -> DataFrame:
    """candidates (…, idx) without those in runs of three or more consecutive lines."""
    w = Window.partitionBy(*by).orderBy("idx")
    runs = candidates.withColumn("_run", F.col("idx") - F.row_number().over(w))
    return runs.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by, "_run"))).where("_n < 3").drop("_run", "_n")


def _taken(candidates: DataFrame, most: int) -> DataFrame:
    """The first `most` candidates under each parent that aren't in a run."""
    rows = candidate_runs(candidates, "doc", "parent_ord")
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy("doc", "parent_ord").orderBy("idx"))).where(F.col("_nth") <= most).drop("_nth")


def accepted(candidates: DataFrame, most: int) -> DataFrame:
    """Of candidates (doc, parent_ord, idx, key, …) those that are taken, parent by parent: without keys taken under a
    parent before, then without runs of lines, then the first `most`.

    All parents are decided at once, first as if none took a key from another. Then keys that a parent before has taken
    are left out, and all are decided again, until nothing changes. After each round one more parent of every document is
    sure to be right, mostly all of them are. Only documents where parents share a key go through rounds."""
    shared = candidates.groupBy("doc", "key").agg(F.min("parent_ord").alias("_a"), F.max("parent_ord").alias("_b")).where("_a < _b").select("doc").distinct()
    shared = written(shared, "shared")
    if shared.isEmpty():
        return _taken(candidates, most)
    easy, hard = candidates.join(shared, "doc", "left_anti"), candidates.join(shared, "doc", "left_semi")
    print_ = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("doc", "parent_ord", "idx").cast("decimal(38,0)"))).first()
    now, told = None, None
    while True:
        fresh = hard
        if now is not None:
            first = now.groupBy("doc", "key").agg(F.min("parent_ord").alias("_first"))
            fresh = hard.join(first, ["doc", "key"], "left").where(F.col("_first").isNull() | (F.col("parent_ord") <= F.col("_first"))).drop("_first")
        now = written(_taken(fresh, most), "taken")
        if told == (told := print_(now)):
            return _taken(easy, most).unionByName(now.select(candidates.columns))


def augment_headings(toc: DataFrame, lines: DataFrame, starts: DataFrame, profile: str = "social_science", most: int = 16) -> DataFrame:
    """Short body headings to add under leaf chapters: doc, parent_ord, idx, title, level, page, toc_id."""
    spans = section_ends(toc, starts, 0)
    parents = toc.where("parent_ord IS NOT NULL").select("doc", F.col("parent_ord").alias("ord")).distinct()
    spans = spans.join(parents, ["doc", "ord"], "left_anti").where((F.col("level") <= 2) & H.is_augmentable_parent(F.col("title"))).select("doc", F.col("ord").alias("parent_ord"), "level", "start", F.coalesce("end", F.lit(1 << 30)).alias("end"))
    short = lines.where(H.is_body_short_heading(F.col("text"), profile)).select("doc", "idx", "page", F.col("text").alias("title"), F.col("normalized").alias("key"))
    known = toc.select("doc", T.normalize_title(F.col("title")).alias("key")).distinct()
    # Lines meet the chapters that they lie in by blocks of the document.
    block = lambda c: F.floor(c / BLOCK)
    size = lines.groupBy("doc").agg((F.max("idx") + 1).alias("_size"))
    spans = spans.join(size, "doc").withColumn("end", F.least("end", "_size")).withColumn("_block", F.explode(F.sequence(block(F.col("start")), F.greatest(block(F.col("start")), block(F.col("end")))))).drop("_size")
    found = short.join(known.hint("merge"), ["doc", "key"], "left_anti").withColumn("_block", block(F.col("idx"))).join(spans, ["doc", "_block"]).where("idx > start AND idx < end")
    rows = accepted(written(found.select("doc", "parent_ord", "idx", "title", "level", "page", "key"), "candidates"), most)
    number = F.row_number().over(Window.partitionBy("doc").orderBy("parent_ord", "idx"))
    return rows.select("doc", F.col("parent_ord").cast("int").alias("parent_ord"), F.col("idx").cast("int").alias("idx"), "title", (F.col("level") + 1).alias("level"), "page", F.format_string("toc:auto:%06d", number).alias("toc_id"))


def augmented_toc(toc: DataFrame, starts: DataFrame, added: DataFrame, lines: DataFrame) -> DataFrame:
    """toc and the added headings in one order, numbered anew; identifiers stay."""
    total = lines.groupBy("doc").agg(F.count(F.lit(1)).alias("_lines"))
    old = toc.join(starts.hint("merge"), ["doc", "ord"], "left").join(total, "doc", "left").select("doc", F.coalesce("start", F.coalesce("_lines", F.lit(0)) + F.col("ord")).alias("_at"), F.lit(0).alias("_new"), F.col("ord").alias("_seq"), "toc_id", "title", "level", "page", "method", "confidence")
    new = added.select("doc", F.col("idx").alias("_at"), F.lit(1).alias("_new"), F.col("idx").alias("_seq"), "toc_id", "title", "level", "page", F.lit("body_short_heading").alias("method"), F.lit(0.72).alias("confidence"))
    both = old.unionByName(new)
    order = F.row_number().over(Window.partitionBy("doc").orderBy("_at", "level", "_new", "_seq"))
    return with_parents(both.withColumn("ord", order).drop("_at", "_new", "_seq"))
