"""Which profile a document fits: rules with points, summed per profile.

The rules' patterns, points and reasons are fixed values. Each pattern is looked for once in a text, so a document is
scored in one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexloom.functions import text as T
from codexloom.functions.profiles import BOOK_PROFILES
from codexloom.functions.text import rx

#: Ties go to the profile named first.
PRIORITY = ("legal", "paper", "reference", "classical", "english", "technical", "textbook", "fiction", "social_science")
IGNORED_NAMES = (".gitkeep", ".gitignore", ".ds_store", "thumbs.db")
_N = r"[一二三四五六七八九十百千万\d]+"
#: How often each pattern occurs, by name.
COUNTS = {
    "deep": r"(?m)^\s*\d+(?:\.\d+){2,}\s+\S+",
    "articles": rf"第\s*{_N}\s*条",
    "fiction": rf"第\s*{_N}\s*[章节回]",
    "sections": rf"第\s*{_N}\s*节",
    "chapters": rf"第\s*{_N}\s*章",
    "bios": r"[\x{4e00}-\x{9fff}]{1,12}(传|纪|志|论|说|赋|铭|序|跋)",
    "entries": r"(?m)^[A-Za-z0-9\x{4e00}-\x{9fff}][A-Za-z0-9\x{4e00}-\x{9fff}·・、（）() -]{1,24}$",
    "letters": r"(?m)^[A-Z]$",
}
FICTION_MARKER = rf"(?i)(楔子|序章|尾声|番外|第\s*{_N}\s*回|Chapter\s+\d+)"
#: profile, points, reason, pattern that must occur.
PATTERNS = (
    ("english", 8, "detected Part/Chapter/Appendix headings", r"(?i)\b(Part\s+[IVXLCDM\d]+|Chapter\s+\d+|Appendix\s+[A-Z\d]+)\b"),
    ("technical", 2, "detected technical vocabulary", r"(?i)\b(API|SDK|HTTP|JSON|Python|JavaScript|架构|部署|接口|配置|模块)\b"),
    ("paper", 5, "detected abstract", r"(?im)^\s*(摘要|摘\s*要|Abstract)\s*$"),
    ("paper", 4, "detected keywords", r"(?im)^\s*(关键词|关键字|Keywords?)[:：]?"),
    ("paper", 4, "detected references", r"(?im)^\s*(参考文献|References|Bibliography)\s*$"),
    ("legal", 5, "detected 编 structure", rf"第\s*{_N}\s*编"),
    ("legal", 2, "detected legal/policy vocabulary", r"(条例|办法|规定|法律|规章|标准|规范|实施细则)"),
    ("fiction", 5, "detected strong fiction chapter markers", FICTION_MARKER),
    ("fiction", 2, "detected fiction vocabulary", r"(小说|长篇|故事|主人公|叙事|人物对白|尾声|番外)"),
    ("classical", 5, "detected 卷 structure", r"卷\s*[一二三四五六七八九十百千万\d上下]+"),
    ("classical", 4, "detected classical section names", r"(本纪|世家|列传|志|表|内篇|外篇|上篇|下篇)"),
    ("reference", 6, "detected reference-work vocabulary", r"(?i)(词典|辞典|百科|索引|术语表|Glossary|Dictionary|Encyclopedia)"),
    ("textbook", 4, "detected Chinese outline enumerators", r"(?m)^(?:[一二三四五六七八九十]+、|（[一二三四五六七八九十]+）)"),
    ("social_science", 2, "detected narrative book front/back matter", r"(译序|序言|前言|导论|绪论|后记)"),
    ("social_science", 5, "detected philosophy/social-science vocabulary", r"(哲学|思想|理性|伦理|人生|幸福|智慧|认识|自由|意志|道德|审美|精神|社会|心理)"),
)
#: The order in which rules are asked and signals are listed.
_ORDER = [
    "detected Part/Chapter/Appendix headings", "mostly English text", "detected 1 / 1.1 numeric hierarchy", "detected deep numeric hierarchy", "detected technical vocabulary", "detected abstract", "detected keywords", "detected references",
    "detected 编 structure", "detected 条 structure", "detected legal/policy vocabulary", "detected chapter-only structure/fiction", "detected strong fiction chapter markers", "detected fiction markers with chapter sequence", "detected fiction vocabulary",
    "detected 卷 structure", "detected classical section names", "detected classical text headings", "detected reference-work vocabulary", "detected many short entry-like headings", "detected alphabetical index headings",
    "detected 章/节 structure", "detected Chinese outline enumerators", "detected chapter-only structure", "detected narrative book front/back matter", "detected philosophy/social-science vocabulary",
]


def java(pattern: str) -> str:
    r"""A pattern over many lines: only LF ends a line, \b knows letters of all scripts."""
    return "(?d)" + rx(pattern).replace(r"\b", r"(?U:\b)")


#: What a match of a pattern with several alternatives can begin with, by the pattern's reason (letters of either case).
_BEGINS = {
    "detected Part/Chapter/Appendix headings": "PCApca", "detected technical vocabulary": r"ASHJPashjp\x{4e00}-\x{9fff}", "detected strong fiction chapter markers": r"Cc\x{4e00}-\x{9fff}",
    "detected reference-work vocabulary": r"GDEgde\x{4e00}-\x{9fff}",
} | {f"detected {k}": r"\x{4e00}-\x{9fff}" for k in ("legal/policy vocabulary", "fiction vocabulary", "classical section names", "narrative book front/back matter", "philosophy/social-science vocabulary")}
#: Patterns, by name or reason, of which each match holds an ideograph.
_IDEOGRAPHIC = {"articles", "fiction", "sections", "chapters", "bios"} | {
    f"detected {k}" for k in ("编 structure", "legal/policy vocabulary", "fiction vocabulary", "卷 structure", "classical section names", "Chinese outline enumerators", "narrative book front/back matter", "philosophy/social-science vocabulary")
}


def _found(samples: DataFrame) -> DataFrame:
    """samples with `_points`, per rule in order the points it gives or 0. Every pattern is looked for once per text, and
    those that ask for an ideograph only in texts that have any."""
    x = F.col("sample")
    led = lambda r, p: f"(?=[{_BEGINS[r]}])(?:{java(p)})" if r in _BEGINS else java(p)
    some = lambda name, c, none: F.when(F.col("_cjk") == 0, none).otherwise(c) if name in _IDEOGRAPHIC else c
    asked = {f"_n_{k}": some(k, F.regexp_count(x, F.lit(java(p))), 0) for k, p in COUNTS.items()}
    asked |= {f"_has{i}": some(r, x.rlike(led(r, p)), False) for i, (*_, r, p) in enumerate(PATTERNS)}
    asked |= {"_top": x.rlike(java(r"(?m)^\s*\d+\s+\S+")), "_sub": x.rlike(java(r"(?m)^\s*\d+\.\d+"))}
    rows = T.pinned(T.pinned(samples, _english=T.english_letters(x), _cjk=T.cjk_letters(x)), **asked)
    n = {k: F.col(f"_n_{k}") for k in COUNTS}
    held = {reason: (F.col(f"_has{i}"), points) for i, (_, points, reason, _) in enumerate(PATTERNS)}
    marker = held["detected strong fiction chapter markers"][0]
    held |= {
        "mostly English text": (F.col("_english") > 0.55 * (F.col("_english") + F.col("_cjk")), 6),
        "detected 1 / 1.1 numeric hierarchy": (F.col("_top") & F.col("_sub"), 7),
        "detected deep numeric hierarchy": (n["deep"] >= 2, 4),
        "detected 条 structure": (n["articles"] > 0, F.least(F.lit(10), n["articles"] + 2)),
        "detected chapter-only structure/fiction": ((n["fiction"] >= 5) & (n["sections"] == 0), 2),
        "detected fiction markers with chapter sequence": (marker & (n["fiction"] > 0), 2),
        "detected classical text headings": (n["bios"] >= 3, 3),
        "detected many short entry-like headings": (n["entries"] >= 20, 4),
        "detected alphabetical index headings": (n["letters"] >= 3, 3),
        "detected 章/节 structure": ((n["chapters"] > 0) & (n["sections"] > 0), 6),
        "detected chapter-only structure": ((n["chapters"] > 0) & (n["sections"] == 0), 3),
    }
    points = F.array(*[F.when(held[r][0], held[r][1]).otherwise(0).cast("int") for r in _ORDER])
    return T.pinned(rows.select(*samples.columns, points.alias("_each")), _points=F.col("_each")).drop("_each")


#: Profile of each rule that is no single pattern.
_PROFILE = {reason: profile for profile, _, reason, _ in PATTERNS} | {
    "mostly English text": "english", "detected 1 / 1.1 numeric hierarchy": "technical", "detected deep numeric hierarchy": "technical", "detected 条 structure": "legal",
    "detected chapter-only structure/fiction": "fiction", "detected fiction markers with chapter sequence": "fiction", "detected classical text headings": "classical", "detected many short entry-like headings": "reference",
    "detected alphabetical index headings": "reference", "detected 章/节 structure": "textbook", "detected chapter-only structure": "social_science",
}


def _scored(points: Column) -> list[Column]:
    """Points per profile; the fallback gives one where no rule holds."""
    none = F.forall(points, lambda p: p == 0)
    total = {p: sum((points[i] for i, r in enumerate(_ORDER) if _PROFILE[r] == p), F.lit(0)) for p in BOOK_PROFILES}
    return [(F.when(none, 1).otherwise(c) if p == "social_science" else c).cast("int").alias(f"_s_{p}") for p, c in total.items()]


def _signals(points: Column) -> Column:
    """array<struct<profile, points, reason>> of the rules that hold."""
    names = F.array(*[F.struct(F.lit(_PROFILE[r]).alias("profile"), F.lit(r.split("/fiction")[0]).alias("reason")) for r in _ORDER])
    found = F.filter(F.zip_with(names, points, lambda a, p: F.struct(a["profile"].alias("profile"), p.alias("points"), a["reason"].alias("reason"))), lambda r: r["points"] > 0)
    fallback = F.array(F.struct(F.lit("social_science").alias("profile"), F.lit(1).alias("points"), F.lit("fallback default").alias("reason")))
    return T.bound(found, lambda f: F.when(F.size(f) == 0, fallback).otherwise(f))


def choose_profile(by_profile: Column) -> Column:
    ranked = F.array(*[F.struct(F.element_at(by_profile, F.lit(p)).alias("s"), F.lit(-i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(PRIORITY)])
    return F.array_max(ranked)["p"]


def format_scores(by_profile: Column) -> Column:
    ordered = F.array_sort(F.transform(F.map_entries(by_profile), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("p"))))
    return F.array_join(F.transform(ordered, lambda e: F.concat(e["p"], F.lit("="), (-e["s"]).cast("string"))), ", ")


def format_signals(profile: Column, by_profile: Column, found: Column) -> Column:
    """The winner's reasons in one line, then all other signals."""
    won = F.transform(F.filter(found, lambda r: r["profile"] == profile), lambda r: r["reason"])
    others = F.transform(F.filter(found, lambda r: r["profile"] != profile), lambda r: F.concat(r["profile"], F.lit("+"), r["points"].cast("string"), F.lit(": "), r["reason"]))
    told = F.when(F.size(won) > 0, F.array_join(won, "; ")).otherwise("selected by highest total score")
    return F.concat(F.array(F.concat(profile, F.lit("+"), F.element_at(by_profile, profile).cast("string"), F.lit(": "), told)), others)


def sample_text(pages: DataFrame, outline: DataFrame | None = None, *, first: int = 20, titles: int = 200) -> DataFrame:
    """doc, sample: up to 200 outline titles and the first 20 pages; if these are blank, pages up to the first that
    isn't."""
    text = F.coalesce(F.col("text"), F.lit(""))
    w = Window.partitionBy("doc").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max(F.when(T.strip(text) != "", 1)).over(w), F.lit(0))
    taken = pages.withColumn("_seen", seen).where((F.col("page") <= first) | (F.col("_seen") == 0))
    body = taken.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", text.alias("t")))), lambda p: p["t"]), "\n").alias("_body"))
    if outline is None:
        return body.select("doc", F.col("_body").alias("sample"))
    heads = outline.groupBy("doc").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("ord", "title"))), 1, titles), lambda x: x["title"]).alias("_heads"))
    out = body.join(heads, "doc", "left")
    return out.select("doc", F.array_join(F.concat(F.coalesce("_heads", F.array().cast("array<string>")), F.array("_body")), "\n").alias("sample"))


def classify(samples: DataFrame) -> DataFrame:
    """samples (doc, sample) with profile, scores, signals. Texts are read in one pass; what follows has small rows."""
    rows = _found(samples).select("doc", "_points", *_scored(F.col("_points")))
    rows = rows.withColumn("scores", F.create_map(*[v for p in BOOK_PROFILES for v in (F.lit(p), F.col(f"_s_{p}"))])).withColumn("_r", _signals(F.col("_points")))
    rows = T.pinned(rows.select("doc", "scores", "_r"), profile=choose_profile(F.col("scores")))
    return rows.select("doc", "profile", "scores", format_scores(F.col("scores")).alias("score_text"), format_signals(F.col("profile"), F.col("scores"), F.col("_r")).alias("signals"))


def is_ignored_file(name: Column) -> Column:
    return F.lower(name).isin(*IGNORED_NAMES) | name.startswith(".")


def unique_destinations(names: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """names (path, name[, profile]) with target: the name, or the first of stem_1, stem_2 ... that neither a file of the
    batch nor one of existing (name[, profile]) in the same folder has. Equal names of a batch go by path."""
    by = ["profile"] if "profile" in names.columns else []
    split = r"^(.+?)(\.[^.]*)?$"
    numbered = r"^(.+)_(\d{1,9})$"
    base, end = F.regexp_extract("name", split, 1), F.regexp_extract("name", split, 2)
    rows = names.withColumn("_stem", base).withColumn("_end", end).withColumn("_n", F.row_number().over(Window.partitionBy(*by, "name").orderBy("path")))
    there = names.select(*by, "name").distinct().withColumn("_there", F.lit(False))
    if existing is not None:
        there = there.unionByName(existing.select(*by, "name").distinct().withColumn("_there", F.lit(True)))
    # A name is number 0 of itself and, if it ends in a number, that one of what stands before it.
    own = there.where("_there").select(*by, base.alias("_stem"), end.alias("_end"), F.lit(0).alias("_k"))
    part = there.select(*by, base.alias("_s"), end.alias("_end")).where(F.col("_s").rlike(numbered))
    used = own.unionByName(part.select(*by, F.regexp_extract("_s", numbered, 1).alias("_stem"), "_end", F.regexp_extract("_s", numbered, 2).try_cast("int").alias("_k")))
    # Below the j-th number in use (from 0) there are as many free ones as it has less j. So a row's number is its place
    # among the rows and as many more as there are numbers in use with so few below them.
    order = Window.partitionBy(*by, "_stem", "_end")
    used = used.where("_k IS NOT NULL").distinct().withColumn("_at", F.col("_k") - F.row_number().over(order.orderBy("_k")) + 1)
    both = rows.withColumn("_at", F.col("_n") - 1).withColumn("_row", F.lit(True)).unionByName(used.drop("_k").withColumn("_row", F.lit(False)), allowMissingColumns=True)
    ahead = F.count_if(~F.col("_row")).over(order.orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0))
    rows = both.withColumn("_k", F.col("_at") + ahead).where("_row")
    return rows.select(*names.columns, F.when(F.col("_k") == 0, F.col("name")).otherwise(F.concat("_stem", F.lit("_"), F.col("_k").cast("string"), "_end")).alias("target"))
