"""Heading rules: which lines are headings, and the level that a line has by itself.

The patterns are fixed values; `rx` reads their shorthands in the Unicode sense.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexloom.functions.text import CJK, W, cjk_letters, english_letters, rx

_N = r"[一二三四五六七八九十百千万\d]+"
CHAPTER = rx(rf"^第\s*{_N}\s*章[　\s]*(.+)?$")
PART = rx(rf"^第\s*{_N}\s*[编篇部][　\s]*(.+)?$")
SECTION = rx(rf"^第\s*{_N}\s*节[　\s]*(.+)?$")
ARTICLE = rx(rf"^第\s*{_N}\s*条[　\s]*(.+)?$")
FICTION_CHAPTER = rx(rf"^第\s*{_N}\s*[章节回][　\s]*(.*)$")
FICTION_SPECIAL = rx(r"^(楔子|序章|引子|尾声|后记|番外(?:篇)?)(?:[　\s].*)?$")
VOLUME = rx(r"^卷\s*[一二三四五六七八九十百千万\d上下]+(?:[　\s].*)?$")
CLASSICAL_SECTION = rx(r"^(上篇|下篇|内篇|外篇|本纪|世家|列传|志|表|书|论|序)(?:[　\s].*)?$")
CLASSICAL_BIO = rf"^{CJK}{{1,12}}(传|纪|志|论|说|赋|铭|序|跋)$"
REFERENCE_ALPHA = r"^[A-Z]$"
REFERENCE_ENTRY = r"^[A-Za-z0-9\x{4e00}-\x{9fff}][A-Za-z0-9\x{4e00}-\x{9fff}·・、（）() -]{1,40}$"
CN_ENUM = rx(r"^[一二三四五六七八九十百千万]+、\S+")
CN_PAREN_ENUM = rx(r"^（[一二三四五六七八九十百千万]+）\S+")
ARABIC_ENUM = rx(r"^\d+[、.．]\s*\S+")
DECIMAL_ENUM = rx(r"^\d+(?:\.\d+)+[　\s]+\S+")
TECHNICAL_TOP = rx(r"^\d+[　\s]+[^\s].+")
PAPER_ABSTRACT = rx(r"(?i)^(摘要|摘\s*要|Abstract)$")
PAPER_KEYWORDS = rx(r"(?i)^(关键词|关键字|Keywords?)[:：]?\s*.*$")
PAPER_REFERENCE = rx(r"(?i)^(参考文献|References|Bibliography)$")
EN_PART = rx(r"(?i)^Part\s+[IVXLCDM\d]+[:.\s-].*$")
EN_CHAPTER = rx(r"(?i)^Chapter\s+\d+[:.\s-].*$")
EN_APPENDIX = rx(r"(?i)^Appendix\s+[A-Z\d]+[:.\s-]?.*$")
SHORT_HEADING = rx(r"^[^\s，。！？；;,.!?]{4,40}$")
FRONT_TOC_LINE = rx(rf"^(译\s*序|序\s*言|前\s*言|后\s*记|第\s*{_N}\s*[篇章部编]\s*.+|附录[一二三四五六七八九十百千万\d]?.*)$")
FRONT_TOC_CHAPTER = rx(rf"^第\s*{_N}\s*章")

END_MARKS = "[。，；：！？.,;:!?]$"
HAS_COLON = "[：:]"
#: Rules that make a line a heading in every profile but social_science.
ANY_RULE = (PART, CHAPTER, SECTION, ARTICLE, FICTION_CHAPTER, FICTION_SPECIAL, VOLUME, CLASSICAL_SECTION, CLASSICAL_BIO, CN_ENUM, CN_PAREN_ENUM, ARABIC_ENUM, DECIMAL_ENUM, TECHNICAL_TOP, PAPER_ABSTRACT, PAPER_KEYWORDS, PAPER_REFERENCE, EN_PART, EN_CHAPTER, EN_APPENDIX, SHORT_HEADING, HAS_COLON)
SOCIAL_RULE = (CHAPTER, SHORT_HEADING, HAS_COLON)

#: Levels that a line has by itself, per profile: rules in the order in which they are asked. "dots+n": n and the dots of
#: the number, 6 at most.
_COMMON = [(PART, 1), (SECTION, 2), (CN_ENUM, 3), (CN_PAREN_ENUM, 4)]
LEVELS: dict[str, list[tuple[str, int | str]]] = {
    "social_science": [(CHAPTER, 1)],
    "textbook": [(CHAPTER, 1), *_COMMON, (ARABIC_ENUM, 5), (DECIMAL_ENUM, "dots+2")],
    "technical": [(CHAPTER, 1), *_COMMON, (TECHNICAL_TOP, 1), (DECIMAL_ENUM, "dots+1")],
    "paper": [(CHAPTER, 1), *_COMMON, (TECHNICAL_TOP, 1), (DECIMAL_ENUM, "dots+1"), (PAPER_ABSTRACT, 1), (PAPER_KEYWORDS, 1), (PAPER_REFERENCE, 1)],
    "legal": [(CHAPTER, 2), (PART, 1), (ARTICLE, 4), (SECTION, 3), (CN_ENUM, 3), (CN_PAREN_ENUM, 4)],
    "english": [(CHAPTER, 1), *_COMMON, (DECIMAL_ENUM, "dots+1"), (EN_PART, 1), (EN_CHAPTER, 2), (EN_APPENDIX, 1)],
    "fiction": [(CHAPTER, 1), (FICTION_SPECIAL, 1), (FICTION_CHAPTER, 1), (EN_CHAPTER, 1), *_COMMON],
    "classical": [(CHAPTER, 1), (VOLUME, 1), (CLASSICAL_SECTION, 2), (CLASSICAL_BIO, 3), *_COMMON],
    "reference": [(CHAPTER, 1), (REFERENCE_ALPHA, 1), (REFERENCE_ENTRY, 2), *_COMMON],
}


def any_of(x: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [x.rlike(p) for p in patterns])


def is_possible_heading(x: Column, profile: str = "social_science") -> Column:
    rules = SOCIAL_RULE if profile == "social_science" else (*ANY_RULE, *((REFERENCE_ALPHA, REFERENCE_ENTRY) if profile == "reference" else ()))
    return (x != "") & (F.length(x) <= 60) & ~x.rlike("^[■•—-]") & ~x.rlike(END_MARKS) & any_of(x, rules)


def own_level(x: Column, profile: str = "social_science") -> Column:
    """The level that the rules give; null where it depends on the headings before."""
    out = None
    for pattern, level in LEVELS[profile]:
        value = F.lit(level) if isinstance(level, int) else F.least(F.lit(6), F.lit(int(level[-1])) + F.regexp_count(F.regexp_extract(x, f"^[^ ]*?(?={W})", 0), F.lit(r"\."))).cast("int")
        out = F.when(x.rlike(pattern), value) if out is None else out.when(x.rlike(pattern), value)
    return out.cast("int")


def front_toc_level(x: Column) -> Column:
    return F.when(x.rlike(FRONT_TOC_CHAPTER), 2).otherwise(1)


def is_augmentable_parent(title: Column) -> Column:
    return title.rlike(CHAPTER) | title.rlike(EN_CHAPTER)


def is_body_short_heading(x: Column, profile: str = "social_science") -> Column:
    if profile == "reference":
        return F.lit(False)
    n, cjk, ascii_ = F.length(x), cjk_letters(x), english_letters(x)
    count = lambda c: F.length(x) - F.length(F.translate(x, c, ""))
    return (
        n.between(4, 30)
        & ~x.rlike(END_MARKS)
        & ~x.rlike('[。！？；“”"《》]|——')
        & ~any_of(x, (CHAPTER, PART, SECTION))
        & ~x.rlike(r"^[（(\[A-Za-z]")
        & (count("（") == count("）"))
        & (count("(") == count(")"))
        & (cjk >= 4)
        & (ascii_ * 20 <= n * 7)
    )
