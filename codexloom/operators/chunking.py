"""Chunks: sections cut, kept whole or merged with their neighbours.

Sections go by runs of siblings, runs by islands between sections that close any buffer. A fold over an island's lengths
says which chunk a section belongs to and why; long sections are cut by a fold over the lengths of their units; texts are
put together once, at the end. Folds collect in blocks, so that n items cost n * sqrt(n) copies of a pointer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexloom.functions import text as T
from codexloom.functions.profiles import PLAIN, Profile
from codexloom.session import written

#: A paragraph up to this length is a unit; a longer one is cut into sentences.
PARAGRAPH = 500
NATURAL, CUT, MERGED, BACKWARD, ALONE = "natural_section_within_split_threshold", "section_exceeds_max_chars", "merged_short_sibling_sections", "merged_short_last_section_backward", "short_section_without_merge_target"


def units(x: Column) -> Column:
    """Paragraphs, the long ones as sentences."""
    sentences = lambda p: F.filter(F.transform(F.split(p, "(?<=[。！？；;!?])", -1), T.stripped), lambda s: s != "")
    return F.flatten(F.transform(F.transform(T.paragraphs(x), T.stripped), lambda p: F.when(F.length(p) <= PARAGRAPH, F.array(p)).otherwise(sentences(p))))


def windows_of(unit: Column, most: int, overlap: int) -> Column:
    """A unit longer than most as overlapping windows."""
    step = max(1, most - overlap)
    n = 1 + F.greatest(F.lit(0), F.ceil((F.length(unit) - most) / step).cast("int"))
    return T.bound(T.wide(unit), lambda w: F.transform(F.sequence(F.lit(0), n - 1), lambda k: T.cut(w, k * step, most)))


def split_long(x: Column, most: int, overlap: int) -> Column:
    """The parts of a long section: units packed with blank lines between, each part led by the end of the one before.

    The fold goes over lengths: of the growing part it knows the first unit, the length and the last `overlap` characters.
    The parts' texts are put together once, from the units between their ends."""
    part, open_ = "struct<lead:string,first:int,last:int>", "struct<n:int,lead:string,first:int,tail:string>"
    parts = f"array<{part}>"
    of = lambda kind, *fields: F.struct(*fields).cast(kind)
    none = of(open_, F.lit(0), F.lit(None), F.lit(0), F.lit(""))
    state = lambda out, cur: F.struct(out.alias("out"), cur.alias("cur"))
    keep = lambda t: F.right(t, F.lit(overlap)) if overlap else F.lit("")

    def closed(a: Column, before: Column) -> Column:
        """a's parts with the one that grows, which ends before a unit."""
        cur = a["cur"]
        return F.when(cur["n"] == 0, a["out"]).otherwise(F.concat(a["out"], F.array(of(part, cur["lead"], cur["first"], before - 1))))

    def step(a: Column, u: Column) -> Column:
        cur, begun = a["cur"], of(open_, u["n"], F.lit(None), u["i"], u["tail"])
        led = of(open_, F.length(F.ltrim(cur["tail"], F.lit(T.WHITE))) + 2 + u["n"], F.ltrim(cur["tail"], F.lit(T.WHITE)), u["i"], keep(F.concat(F.ltrim(cur["tail"], F.lit(T.WHITE)), F.lit("\n\n"), u["tail"]))) if overlap else begun
        return (
            F.when(u["n"] > most, state(F.concat(closed(a, u["i"]), F.array(of(part, F.lit(None), u["i"], F.lit(-1)))), none))
            .when(cur["n"] == 0, state(a["out"], begun))
            .when(cur["n"] + u["n"] + 2 <= most, state(a["out"], of(open_, cur["n"] + 2 + u["n"], cur["lead"], cur["first"], keep(F.concat(cur["tail"], F.lit("\n\n"), u["tail"])))))
            .otherwise(state(closed(a, u["i"]), led))
        )

    def block(a: Column, some: Column) -> Column:
        inner = F.aggregate(some, state(F.array().cast(parts), a["cur"]), step)
        return T.bound(inner, lambda r: state(F.concat(a["out"], F.array(r["out"])), r["cur"]))

    def cut(us: Column) -> Column:
        told = F.transform(us, lambda u, i: F.struct(i.alias("i"), F.length(u).alias("n"), keep(u).alias("tail")))
        end = lambda a: closed(state(F.flatten(a["out"]), a["cur"]), F.size(us))
        made = T.fold_blocks(told, state(F.array().cast(f"array<{parts}>"), none), block, end)
        text = lambda p: F.concat(F.when(p["lead"].isNull(), "").otherwise(F.concat(p["lead"], F.lit("\n\n"))), F.array_join(F.slice(us, p["first"] + 1, p["last"] - p["first"] + 1), "\n\n"))
        return F.flatten(F.transform(made, lambda p: F.when(p["last"] < 0, windows_of(F.get(us, p["first"]), most, overlap)).otherwise(F.array(text(p)))))

    return T.bound(units(x), cut)


def sibling_runs(sections: DataFrame) -> DataFrame:
    """sections with run: consecutive sections of one parent share a number."""
    w = Window.partitionBy("doc").orderBy("ord")
    new = F.when(F.col("parent_ord").eqNullSafe(F.lag("parent_ord").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return sections.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


_ITEM = "array<struct<ord:int,chunk:int,role:string,part:int>>"


def merge_plan(runs: DataFrame, p: Profile) -> DataFrame:
    """Of runs (doc, run, ord, len, head, parts, last): per section its chunk within the run and the role it has there.

    head: length of the heading line; parts, last: number of parts of a long section and the length of the last.

    A section of p.min or more always closes the open buffer, whether it joins it or not. So a run falls into islands that
    end with such a section, and all that an island hands on is the length of its last chunk, which its own sections tell.
    Each island is a fold of its own; the chunks before it are counted by a window."""
    first = Window.partitionBy("doc", "run").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    cut = runs.withColumn("island", F.coalesce(F.count_if(F.col("len") >= p.min).over(first), F.lit(0)))
    items = cut.groupBy("doc", "run", "island").agg(F.array_sort(F.collect_list(F.struct("ord", "len", "head", "parts", "last"))).alias("items"))
    buf = "array<struct<ord:int,len:int,head:int>>"
    made = lambda out, b, size, chunk, prev: F.struct(out.alias("out"), b.alias("buf"), size.cast("int").alias("size"), chunk.cast("int").alias("chunk"), prev.cast("int").alias("prev"))
    entry = lambda o, chunk, role, part=0: F.struct(o.alias("ord"), chunk.cast("int").alias("chunk"), F.lit(role).alias("role"), F.lit(part).alias("part"))
    none, no_items = F.array().cast(buf), F.array().cast(_ITEM)

    def close(a: Column) -> Column:
        """The state after the open buffer has become a chunk, or has joined the one before."""
        b = a["buf"]
        total = F.aggregate(b, F.lit(0), lambda n, x: n + x["len"] + x["head"]) + 2 * (F.size(b) - 1)
        one = b[0]
        own = one["len"] + one["head"]
        return (
            F.when(F.size(b) == 0, made(a["out"], none, F.lit(0), a["chunk"], a["prev"]))
            .when(F.size(b) > 1, made(F.concat(a["out"], F.transform(b, lambda x: entry(x["ord"], a["chunk"] + 1, MERGED))), none, F.lit(0), a["chunk"] + 1, total))
            .when((a["prev"] >= 0) & (a["prev"] + 2 + own <= p.max), made(F.concat(a["out"], F.array(entry(one["ord"], a["chunk"], BACKWARD))), none, F.lit(0), a["chunk"], a["prev"] + 2 + own))
            .otherwise(made(F.concat(a["out"], F.array(entry(one["ord"], a["chunk"] + 1, ALONE))), none, F.lit(0), a["chunk"] + 1, one["len"]))
        )

    def fresh(a: Column, s: Column) -> Column:
        return (
            F.when(s["len"] > p.split, made(F.concat(a["out"], F.array(entry(s["ord"], a["chunk"] + 1, CUT))), none, F.lit(0), a["chunk"] + s["parts"], s["last"]))
            .when(s["len"] >= p.min, made(F.concat(a["out"], F.array(entry(s["ord"], a["chunk"] + 1, NATURAL))), none, F.lit(0), a["chunk"] + 1, s["len"]))
            .otherwise(made(a["out"], F.array(F.struct(s["ord"].alias("ord"), s["len"].alias("len"), s["head"].alias("head"))), s["len"], a["chunk"], a["prev"]))
        )

    def step(a: Column, s: Column) -> Column:
        joins = (F.size(a["buf"]) > 0) & (a["size"] < min(p.target, p.min)) & (a["size"] + s["len"] <= p.max)
        more = made(a["out"], F.concat(a["buf"], F.array(F.struct(s["ord"].alias("ord"), s["len"].alias("len"), s["head"].alias("head")))), a["size"] + s["len"], a["chunk"], a["prev"])
        # One step closes and starts afresh: the closed state is bound by a fold over a single element.
        closed = F.aggregate(F.array(a), a, lambda _, x: close(x), lambda c: fresh(c, s))
        return F.when(joins, more).otherwise(closed)

    def block(a: Column, some: Column) -> Column:
        """A block's entries, in an array of their own."""
        inner = F.aggregate(some, made(no_items, a["buf"], a["size"], a["chunk"], a["prev"]), step)
        return T.bound(inner, lambda r: made(F.concat(a["out"], F.array(r["out"])), r["buf"], r["size"], r["chunk"], r["prev"]))

    def folded(prev: Column) -> Column:
        end = lambda a: T.bound(close(made(no_items, a["buf"], a["size"], a["chunk"], a["prev"])), lambda c: F.struct(F.flatten(F.concat(a["out"], F.array(c["out"]))).alias("out"), c["chunk"].alias("chunks"), c["prev"].alias("prev")))
        return T.fold_blocks(F.col("items"), made(F.array().cast(f"array<{_ITEM}>"), none, F.lit(0), F.lit(0), prev), block, end)

    # What an island hands on does not depend on what it was handed: its last chunk holds its last section. And only an
    # island whose first chunk would join the one before is folded again.
    by = Window.partitionBy("doc", "run").orderBy("island")
    known = items.select("doc", "run", "island", "items", folded(F.lit(-1)).alias("f")).withColumn("prev", F.coalesce(F.lag("f.prev").over(by), F.lit(-1)))
    first = F.col("items")[0]
    joins = (F.col("f.out")[0]["role"] == ALONE) & (F.col("prev") >= 0) & (F.col("prev") + 2 + first["len"] + first["head"] <= p.max)
    told = known.select("doc", "run", "island", F.when(joins, folded(F.col("prev"))).otherwise(F.col("f")).alias("f"))
    told = told.withColumn("before", F.coalesce(F.sum("f.chunks").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    plan = told.select("doc", "run", "before", F.explode("f.out").alias("x"))
    return plan.select("doc", "run", "x.ord", (F.col("x.chunk") + F.col("before")).cast("int").alias("slot"), F.col("x.role").alias("reason"))


def make_chunks(sections: DataFrame, p: Profile = PLAIN) -> DataFrame:
    """Chunks of sections (doc, ord, title, parent_ord, path_ords, text, …): doc, chunk_index from 1, text, reason,
    part_index, part_count, ords (sections in it), path_ords, merged_headings, merged_ords, source_ords (the sections that
    its source is told from), page_start, page_end."""
    run = sibling_runs(sections.withColumn("_t", T.strip(F.col("text"))).where("_t <> ''"))
    run = run.withColumn("len", F.length("_t")).withColumn("_parts", F.when(F.col("len") > p.split, split_long(F.col("text"), p.max, p.overlap)))
    run = written(run, "runs")
    sized = run.select("doc", "run", F.col("ord").cast("int").alias("ord"), "len", (F.length("title") + 3).alias("head"), F.coalesce(F.size("_parts"), F.lit(0)).alias("parts"), F.coalesce(F.length(F.element_at("_parts", -1)), F.lit(0)).alias("last"))
    plan = merge_plan(sized.withColumn("parts", F.greatest("parts", F.lit(0))), p)
    told = run.join(plan, ["doc", "run", "ord"])
    headed = F.concat(F.lit("【"), F.col("title"), F.lit("】\n"), F.col("_t"))
    body = F.when(F.col("reason").isin(MERGED, BACKWARD), headed).otherwise(F.col("_t"))
    pieces = told.select("doc", "run", "ord", "title", "path_ords", "page_start", "page_end", "reason", F.posexplode(F.when(F.col("reason") == CUT, F.col("_parts")).otherwise(F.array(body))).alias("part", "piece"), F.when(F.col("reason") == CUT, F.size("_parts")).alias("part_count"), "slot")
    # Dealt by document, as the chunks are numbered, so texts are sent once.
    pieces = pieces.withColumn("slot", F.col("slot") + F.col("part")).repartition("doc")
    rows = pieces.groupBy("doc", "run", "slot").agg(F.array_sort(F.collect_list(F.struct("ord", "piece", "reason", "path_ords", "title"))).alias("_x"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.max("part").alias("part"), F.max("part_count").alias("part_count"))
    first = F.col("_x")[0]
    merged = F.transform(F.filter("_x", lambda x: x["reason"] == MERGED), lambda x: x["path_ords"])
    joined = first["reason"] == MERGED
    back = F.element_at("_x", -1)["reason"] == BACKWARD
    reason = F.when(back, BACKWARD).otherwise(first["reason"])
    out = rows.select(
        "doc",
        F.row_number().over(Window.partitionBy("doc").orderBy("run", "slot")).alias("chunk_index"),
        F.array_join(F.transform("_x", lambda x: x["piece"]), "\n\n").alias("text"),
        reason.alias("reason"),
        F.when(first["reason"] == CUT, F.col("part") + 1).alias("part_index"),
        F.col("part_count"),
        F.transform("_x", lambda x: x["ord"]).alias("ords"),
        F.when(joined, T.bound(merged, common_parent_path)).otherwise(first["path_ords"]).alias("path_ords"),
        F.transform(F.filter("_x", lambda x: joined | (x["reason"] == BACKWARD)), lambda x: x["title"]).alias("merged_headings"),
        F.transform(F.filter("_x", lambda x: joined | (x["reason"] == BACKWARD)), lambda x: x["ord"]).alias("merged_ords"),
        F.transform(F.filter("_x", lambda x, i: F.when(joined, x["reason"] == MERGED).otherwise(i == 0)), lambda x: x["ord"]).alias("source_ords"),
        "page_start",
        "page_end",
    )
    return out


def common_parent_path(paths: Column) -> Column:
    """The longest common prefix of an array of paths; the first element of the first where there is none."""
    first = paths[0]
    n = F.aggregate(F.sequence(F.lit(1), F.size(first)), F.lit(0), lambda a, i: F.when((a == i - 1) & F.forall(paths, lambda q: F.slice(q, 1, i) == F.slice(first, F.lit(1), i)), i).otherwise(a))
    return F.when(n == 0, F.slice(first, 1, 1)).otherwise(F.slice(first, F.lit(1), n))
