"""Text functions as Column expressions.

White space is what Unicode and Python call so, spelled out: the regex engines disagree about their shorthands.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: One white-space character, in a form that Java's and RE2's engines both read.
W_IN = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
W = f"[{W_IN}]"
#: The same characters one by one.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Line ends as Python's splitlines() has them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
CJK = r"[\x{4e00}-\x{9fff}]"
#: A run of white space and a line end for Java alone. A character is asked by one range after another until one has it: most
#: have none, so ranges that hold all of them are asked first, and what can be listed is (a list is one question).
_WHITES = rf"[\x00-\x20\x{{85}}-\x{{a0}}\x{{1680}}-\x{{3000}}&&[{W_IN}]]+"
_LINE_END = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}](?:(?<=\r)\n)?"


def rx(pattern: str) -> str:
    r"""A pattern with \s, \S and \d in the Unicode sense."""
    return pattern.replace(r"[^\s", f"[^{W_IN}").replace(r"[:.\s-]", f"[:.{W_IN}-]").replace(r"[　\s]", W).replace(r"\S", f"[^{W_IN}]").replace(r"\s", W).replace(r"\d", r"\p{Nd}")


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once per row. A projection would be merged into what is built on it, and a
    lambda would compute it anew for each element; a generator's output stays as it is."""
    return df.select(*df.columns, F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_pinned")).select(*df.columns, "_pinned.*")


def bound(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x) with x computed once."""
    return F.transform(F.array(x), use)[0]


def stripped(v: Column) -> Column:
    """strip of what costs nothing to name again (a column, a lambda's variable). To trim at the end, Spark lists all of a
    text's characters; most texts don't end in white space, as their last byte tells or, if it isn't ASCII, a comparison."""
    last = F.substring(v.cast("binary"), -1, 1)
    wide = reduce(lambda a, b: a | b, [v.endswith(c) for c in WHITE if ord(c) > 0x7F])
    return F.when(last.between(F.lit(b"\x21"), F.lit(b"\x7f")) | ((last >= F.lit(b"\x80")) & ~wide), F.ltrim(v, F.lit(WHITE))).otherwise(F.btrim(v, F.lit(WHITE)))


def strip(x: Column) -> Column:
    return bound(x, stripped)


def is_blank(x: Column) -> Column:
    """Whether x is white space or nothing."""
    return F.ltrim(x, F.lit(WHITE)) == ""


def rstrip(x: Column) -> Column:
    return F.rtrim(x, F.lit(WHITE))


def occurrences(x: Column, one: str) -> Column:
    """How many characters of x a pattern of one character matches. Runs are taken out at a time: to list matches would
    make a string of each."""
    return F.length(x) - F.length(F.regexp_replace(x, f"(?:{one})+", ""))


def splitlines(x: Column) -> Column:
    return bound(F.split(x, _LINE_END, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def replaced(x: Column, a: str, b: str) -> Column:
    return F.replace(x, F.lit(a), F.lit(b))


def normalize_text(x: Column) -> Column:
    """Patterns are looked for only where what they begin or end with is there."""
    spaced = replaced(replaced(replaced(x, "　", " "), "\r\n", "\n"), "\r", "\n")
    ends = bound(spaced, lambda v: F.when(F.contains(v, F.lit(" \n")) | F.contains(v, F.lit("\t\n")), F.regexp_replace(v, "[ \t]+\n", "\n")).otherwise(v))
    return strip(bound(ends, lambda v: F.when(F.contains(v, F.lit("\n\n\n")), F.regexp_replace(v, "\n{3,}", "\n\n")).otherwise(v)))


def unspaced(x: Column) -> Column:
    """x without white space. The commonest go first, by bytes."""
    return F.regexp_replace(replaced(replaced(x, " ", ""), "\n", ""), _WHITES, "")


def compact_text(x: Column) -> Column:
    """normalize_text without white space. All that it changes is white space, so there is no need for it here."""
    return unspaced(x)


def wide(x: Column) -> Column:
    """x with four bytes a character, for `cut`."""
    return F.encode(x, "UTF-32")


def cut(wide_x: Column, at: Column, n: Column | int) -> Column:
    """n characters of a text from the place `at` (0 is the first). In a string they are counted from its start each time."""
    some = F.substring(wide_x, at.cast("int") * 4 + 1, F.lit(n).cast("int") * 4)
    # The mark that is put before is taken off again; without it a text's own would be.
    return F.decode(F.concat(F.lit(b"\x00\x00\xfe\xff"), some), "UTF-32")


#: All but ASCII, accented Latin letters, unified ideographs and their commonest punctuation, which stay as they are in
#: NFKC. (Spelled out: Java is ten times slower at a class of all but several ranges.)
_MAY_CHANGE = r"[\x{80}-\x{bf}\x{100}-\x{3000}\x{3003}-\x{3009}\x{3012}-\x{4dff}\x{a000}-\x{10ffff}]"


@F.arrow_udf(StringType())
def _nfkc(x: pa.Array) -> pa.Array:
    return pa.array([None if v is None else unicodedata.normalize("NFKC", v) for v in x.to_pylist()], pa.string())


def normalize_title(x: Column, *, ascii_only: bool = False) -> Column:
    """NFKC, full-width colon to ASCII, no white space. ascii_only spares the Python call where no text can need it;
    otherwise only texts go there with characters other than those that the form surely keeps."""
    folded = x if ascii_only else F.coalesce(_nfkc(F.when((F.octet_length(x) > F.length(x)) & x.rlike(_MAY_CHANGE), x)), x)
    return unspaced(replaced(folded, "：", ":"))


def preview_text(x: Column, most: int = 500) -> Column:
    text = normalize_text(x)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(rstrip(F.left(text, F.lit(most))), F.lit("...")))


def sha256_text(x: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(x.cast("binary"), 256))


def safe_stem(x: Column) -> Column:
    """A file stem without characters that file systems refuse."""
    clean = strip(F.regexp_replace(x, r'[<>:"/\\|?*]+', "_"))
    return F.when(clean == "", "document").otherwise(clean)


def safe_filename(title: Column) -> Column:
    """safe_stem of a title, whose last suffix goes as that of a path would."""
    return safe_stem(F.regexp_replace(F.regexp_replace(title, r"^.*/", ""), r"(?<=.)\.[^.]*$", ""))


def english_letters(x: Column) -> Column:
    return occurrences(x, "[A-Za-z]")


def cjk_letters(x: Column) -> Column:
    return occurrences(x, CJK)


def english_ratio(x: Column) -> Column:
    a, c = english_letters(x), cjk_letters(x)
    return F.when(a + c == 0, F.lit(0.0)).otherwise(a / F.nullif(a + c, F.lit(0)))


# Scripts, symbols and marks that a clean title does not hold, and those that it may.
_ODD = r"[\x{590}-\x{8ff}\x{d00}-\x{d7f}\x{c80}-\x{cff}\x{fb00}-\x{feff}\x{e000}-\x{f8ff}\p{So}\p{Sk}]"
#: What a text must hold for odd ones to be counted; what _ODD may match.
_WEIRD, _ODD_FIRST = r"[\x00-\x08\x0e-\x1b\x{3001}-\x{10ffff}]", r"(?=[\^`\x{80}-\x{10ffff}])"
_PLAIN = r"[\x{4e00}-\x{9fff}\p{L}\p{N}：:、，,（）()\[\]【】《》]"


def odd_counts(x: Column) -> tuple[Column, Column]:
    """Weird (controls and replacement marks twice) and meaningful characters."""
    spaced = F.regexp_replace(x, f"{_PLAIN}+", "")
    weird = bound(unspaced(spaced), lambda rest: 2 * occurrences(rest, r"[\x00-\x1f\x{fffd}]") + occurrences(rest, r"[\x{3000}-\x{fffc}\x{fffe}-\x{10ffff}]"))
    return weird, F.length(x) - F.length(spaced)


def is_garbled_title(x: Column) -> Column:
    weird, plain = odd_counts(x)
    many = bound(F.struct(weird.alias("w"), plain.alias("p")), lambda n: (n["w"] + n["p"] > 0) & (n["w"] * 50 >= (n["w"] + n["p"]) * 9))
    return F.coalesce((x != "") & (x.rlike(_ODD_FIRST + _ODD) | (x.rlike(_WEIRD) & many)), F.lit(False))


def garbled_counts(x: Column) -> tuple[Column, Column]:
    """Suspicious marks and mixed-script pairs, and characters that aren't white space."""
    marks = occurrences(x, r"[\x{fffd}□■◆◇\x00-\x08\x0e-\x1b\x{e000}-\x{f8ff}]")
    pairs = F.regexp_count(x, F.lit(f"[A-Za-z]{CJK}[A-Za-z]|{CJK}[A-Za-z]{{2,}}{CJK}"))
    return marks + pairs, F.length(x) - F.length(F.regexp_replace(x, f"[^{W_IN}]+", ""))


def garbled_ratio(x: Column) -> Column:
    bad, n = garbled_counts(x)
    return bound(bad, lambda b: F.when(b == 0, 0.0).when(n == 0, 0.0).otherwise(F.least(F.lit(1.0), b / F.nullif(n, F.lit(0)))))


def looks_garbled(x: Column) -> Column:
    return ~is_blank(x) & (is_garbled_title(x) | (garbled_ratio(x) > 0.12))


def fold_blocks(items: Column, zero: Column, step: Callable[[Column, Column], Column], done: Callable[[Column], Column]) -> Column:
    """A fold whose step takes a block of items, as many blocks as a block has items. A fold that adds to an array copies
    it at each step; over blocks, n items cost n * sqrt(n) copies instead of n * n."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items))).cast("int"))
    return bound(F.struct(items.alias("x"), size.alias("n")), lambda b: F.aggregate(F.sequence(F.lit(0), b["n"]), zero, lambda acc, k: step(acc, F.slice(b["x"], k * b["n"] + 1, b["n"])), done))


# Starts of a line that always begin a new one, and ends after which a line may.
_STARTS = rx(r"^(?:[■●•—-]|[（(]?\d+[）)、.．]|图\s*\d|表\s*\d|策略\s*\d+)")
_ENDS_SHORT, _ENDS_SENTENCE = ("：", ":", "？", "?", "。", "！", "!"), ("。", "！", "？", "；", ";")


def reflow_paragraph(x: Column) -> Column:
    """Wrapped lines joined. What a line is and how the one before it ends is told beforehand; the fold carries only the
    length of the line that still grows."""
    lines = F.filter(F.transform(splitlines(x), stripped), lambda v: v != "")

    def told(v: Column, p: Column) -> Column:
        # How p ends is asked of its bytes: to find its last character, all others would be counted.
        ends = lambda marks: reduce(lambda a, b: a | b, [p.endswith(c) for c in marks])
        letter = bound(F.substring(p.cast("binary"), -1, 1), lambda b: reduce(lambda x, y: x | y, [b.between(F.lit(lo), F.lit(hi)) for lo, hi in ((b"a", b"z"), (b"A", b"Z"), (b"0", b"9"))]))
        return F.struct(
            v.alias("v"),
            F.length(v).alias("n"),
            (v.rlike(_STARTS) | ((F.length(v) <= 40) & ends(_ENDS_SENTENCE))).alias("breaks"),
            ends(_ENDS_SHORT).alias("may"),
            (letter & F.left(v, F.lit(1)).rlike("[A-Za-z0-9]")).alias("spaced"),
        )

    def one(acc: Column, w: Column) -> Column:
        breaks = w["breaks"] | (w["may"] & (acc["n"] <= 18))
        glue = F.when(breaks, "\n").when(w["spaced"], " ").otherwise("")
        n = F.when(breaks, w["n"]).otherwise(acc["n"] + F.when(w["spaced"], 1).otherwise(0) + w["n"])
        return F.struct(n.alias("n"), F.concat(acc["out"], F.array(F.concat(glue, w["v"]))).alias("out"))

    strings = "array<string>"

    def block(acc: Column, some: Column) -> Column:
        return F.aggregate(some, F.struct(acc["n"].alias("n"), F.array().cast(strings).alias("out")), one, lambda r: F.struct(r["n"].alias("n"), F.concat(acc["out"], F.array(F.array_join(r["out"], ""))).alias("out")))

    def joined(all_: Column) -> Column:
        before = F.slice(all_, 1, F.greatest(F.lit(0), F.size(all_) - 1))
        pairs = F.zip_with(F.slice(all_, 2, F.size(all_)), before, told)
        zero = F.struct(F.length(all_[0]).alias("n"), F.array(all_[0]).alias("out"))
        return F.when(F.size(all_) == 0, "").when(F.size(all_) == 1, all_[0]).otherwise(fold_blocks(pairs, zero, block, lambda a: F.array_join(a["out"], "")))

    return bound(lines, joined)


def paragraphs(x: Column) -> Column:
    return F.filter(F.split(x, f"\n{W}*\n", -1), lambda p: ~is_blank(p))


def reflow_text(x: Column) -> Column:
    return strip(F.array_join(F.transform(paragraphs(normalize_text(x)), reflow_paragraph), "\n\n"))


def sample_windows(x: Column, window: int, most: int) -> Column:
    """Windows spread over a text that is longer than one."""
    step = F.greatest(F.lit(window), F.floor(F.length(x) / most).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.length(x) - window, step), lambda i: F.substring(x, i + 1, F.lit(window)))


def sample_matches(source: Column, target: Column, window: int = 80, most: int = 120) -> Column:
    """struct<matched, samples>: windows of source and how many of them target holds."""
    pair = lambda a, b: F.struct(a.cast("long").alias("matched"), b.cast("long").alias("samples"))
    return (
        F.when((source == "") | (target == "") | source.isNull() | target.isNull(), pair(F.lit(0), F.lit(0)))
        .when(F.length(source) <= window, pair(F.contains(target, source).cast("int"), F.lit(1)))
        .otherwise(bound(sample_windows(source, window, most), lambda many: pair(F.size(F.filter(many, lambda s: F.contains(target, s))), F.size(many))))
    )


def sample_match_rate(source: Column, target: Column, window: int = 80, most: int = 120) -> Column:
    return bound(sample_matches(source, target, window, most), rate_of)


def rate_of(m: Column) -> Column:
    """The share of matches, from what sample_matches gives."""
    return F.when(m["samples"] == 0, 0.0).otherwise(F.bround(m["matched"] / F.nullif(m["samples"], F.lit(0).cast("long")), 3))


def split_front_matter(x: Column) -> Column:
    """struct<head, body>: a block between --- lines at the start, and what follows."""
    at = F.locate("\n---\n", x, 5)
    has = x.startswith("---\n") & (at > 0)
    return F.when(has, F.struct(F.substring(x, F.lit(5), at - 5).alias("head"), F.substring(x, at + 5, F.length(x)).alias("body"))).otherwise(F.struct(F.lit("").alias("head"), x.alias("body")))


def simple_yaml(head: Column) -> Column:
    """map of `key: value` lines; the last of a key wins. Session setting mapKeyDedupPolicy does not matter."""
    lines = F.filter(F.transform(splitlines(head), strip), lambda v: (v != "") & ~v.startswith("#") & F.contains(v, F.lit(":")))
    entries = F.transform(lines, lambda v: F.struct(strip(F.substring_index(v, ":", 1)).alias("k"), F.regexp_replace(strip(F.substring(v, F.locate(":", v) + 1, F.length(v))), "^[\"']+|[\"']+$", "").alias("v")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["k"] == k), -1)["v"]))


#: Front-matter keys that may hold a date, by preference (fixed values).
DATE_KEYS = ("created", "date", "saved_at", "saved", "published", "updated", "modified")


def first_date(front: Column) -> Column:
    return F.coalesce(*[F.nullif(F.try_element_at(front, F.lit(k)), F.lit("")) for k in DATE_KEYS])


def normalize_date(x: Column) -> Column:
    """The first year-month-day of x, zero-padded; digits only, no calendar."""
    part = lambda g: F.regexp_extract(x, r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", g)
    return F.when(part(1) != "", F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")))


def journal_date(stem: Column) -> Column:
    part = lambda g: F.regexp_extract(stem, r"^(\d{4})[-_.](\d{2})[-_.](\d{2})", g)
    return F.when(part(1) != "", F.concat_ws("-", part(1), part(2), part(3)))


def timestamp_iso(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssXXX")


def now_iso() -> Column:
    return timestamp_iso(F.current_timestamp())


def remove_heading_prefix(text: Column, title: Column) -> Column:
    """text after the first of its first 20 lines that matches the title; all of it if none does."""
    lines = splitlines(text)
    head = F.array_join(F.slice(lines, 1, 20), "\n")
    folded = F.coalesce(_nfkc(F.when(head.rlike(_MAY_CHANGE), head)), head)
    keys = F.transform(F.split(folded, "\n", -1), lambda v: F.regexp_replace(F.translate(v, "：", ":"), f"{W}+", ""))
    # The title stands beside each line: a lambda may not reach for what Python has computed.
    pairs = F.arrays_zip(keys.alias("key"), F.array_repeat(F.left(normalize_title(title), F.lit(18)), 20).alias("head"))
    hit = F.array_position(F.transform(pairs, lambda p: F.coalesce(p["key"].startswith(p["head"]), F.lit(False))), True)
    return F.when(hit > 0, F.array_join(F.slice(lines, hit.cast("int") + 1, F.greatest(F.size(lines), F.lit(1))), "\n")).otherwise(text)
