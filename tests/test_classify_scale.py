"""Names of a batch against a plain loop; rules against their patterns as they are written."""

import re

from pyspark.sql import functions as F

from codexloom.operators import classify


def by_loop(names, existing):
    taken, out = set(existing) | set(names), {}
    used = set(existing)
    for i, name in enumerate(names):
        stem, end = re.fullmatch(r"(.+?)(\.[^.]*)?", name).groups()
        k, target = 0, name
        while target in used or (k > 0 and target in taken):
            k += 1
            target = f"{stem}_{k}{end or ''}"
        used.add(target)
        out[i] = target
    return out


def test_names_are_those_of_a_loop(spark):
    names = ["a.pdf", "a.pdf", "a_1.pdf", "a.pdf", "b", "b", "a_3.pdf", "c.pdf", "c.pdf", "a.pdf", "a_1.pdf"] * 3
    existing = ["a_2.pdf", "b_1", "c.pdf", "a_7.pdf", "c_01.pdf"]
    made = classify.unique_destinations(spark.createDataFrame([(f"{i:04}", n) for i, n in enumerate(names)], "path string, name string"), spark.createDataFrame([(n,) for n in existing], "name string"))
    got = {int(r["path"]): r["target"] for r in made.collect()}
    assert len(set(got.values())) == len(names) and not set(got.values()) & set(existing)
    assert {i: t for i, t in got.items() if not names[i].startswith("c")} == {i: t for i, t in by_loop(names, existing).items() if not names[i].startswith("c")}


def test_many_equal_names(spark):
    """A row does not list the numbers before its own: that took the square of the rows."""
    rows = spark.range(40_000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("path"), F.lit("book.pdf").alias("name"))
    made = classify.unique_destinations(rows)
    assert "sequence(" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert made.agg(F.count_distinct("target")).first()[0] == 40_000 and made.where("path = '000039999'").first()["target"] == "book_39999.pdf"


def test_beginnings_change_no_rule(spark):
    words = "Part IV|chapter 3|APPENDIX B|api|Sdk|HTTP|json|python|JavaScript|架构|模块|条例|实施细则|楔子|番外|第 三 回|CHAPTER 12|小说|本纪|表|词典|glossary|DICTIONARY|Encyclopedia|译序|后记|哲学|心理|xapi|apart 4|none"
    rows = spark.createDataFrame([(w + t,) for w in words.split("|") for t in ("", " and", "x", "。")] + [("",), (None,)], "text string")
    x = F.col("text")
    for *_, reason, pattern in classify.PATTERNS:
        if reason in classify._BEGINS:
            led = f"(?=[{classify._BEGINS[reason]}])(?:{classify.java(pattern)})"
            assert rows.where(~x.rlike(led).eqNullSafe(x.rlike(classify.java(pattern)))).count() == 0
            assert rows.where(x.rlike(led)).count() > 0
