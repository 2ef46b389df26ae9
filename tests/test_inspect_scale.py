"""What an inspection of many texts does once a text, not once a window, line or character: the results stay Python's."""

import pytest
from pyspark.sql import functions as F

from codexloom import engine
from codexloom.functions import text as T
from codexloom.operators import chunking, inspect, toc
from codexloom.plans import registry

ODD = ["", " ", "a", "　标题。　", "a\r\nb\rc\n\n\n\nd \t\n e", "é\x85", "\xa0é", "。 ", "x ", "x y ", "\U0001f600 a b\x1c", "﻿a\x0bb\x0c", "é ", "​z​", "ends.\n", "\r\n", "a\r", "\r\r\n\n\r", "ß ü\tö"]


def test_windows_are_hashed_together(monkeypatch):
    """One pass over a text for all windows of a length: a pass for every window took most of the time."""
    calls, real = [], inspect.rolling
    monkeypatch.setattr(inspect, "rolling", lambda text, size: calls.append(size) or real(text, size))
    text = "".join(chr(97 + (i * i) % 23) if i % 9 else "标\U0001f600"[i % 2] for i in range(5000))
    windows = [text[i : i + 80] for i in range(0, 4900, 50)] + [text[i : i + 79] + "!" for i in range(0, 4900, 70)] + [text[:33], "?" * 33, ""]
    assert inspect.held(text, windows).tolist() == [w in text for w in windows]
    assert sorted(calls) == [33, 80]
    assert inspect.hashes_of(windows[:5], 80).tolist() == [int(real(w, 80)[0]) for w in windows[:5]]


def test_lines_are_not_split_again(spark, monkeypatch):
    """Contents and candidates for headings come from the lines that are there."""
    calls, real = [], toc.flatten_lines
    monkeypatch.setattr(toc, "flatten_lines", lambda *a, **b: calls.append(a) or real(*a, **b))
    pages = spark.createDataFrame([("a", 1, "第一章 起点\n一、短标题\n\n 正文正文。\n  正文短标题  "), ("a", 2, "第二章 终点\r\n没有标题的正文。")], "doc string, page int, text string")
    built = engine.build_books(pages, "textbook")
    assert len(calls) == 1
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(built.toc) == rows(toc.infer_toc(pages, "textbook"))
    split = inspect.body_heading_candidates(pages)
    assert rows(inspect.body_heading_candidates(pages, lines=built.lines)) == rows(split) and split.first().candidates > 0


def test_texts_are_as_python_has_them(spark):
    """White space is Python's wherever a short way is taken."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "i int, x string").repartition(2)
    x = F.col("x")
    got = df.select("i", T.strip(x).alias("s"), T.is_blank(x).alias("b"), T.splitlines(x).alias("l"), T.compact_text(x).alias("c"), F.transform(F.array(x), T.stripped)[0].alias("v")).orderBy("i").collect()
    for r, t in zip(got, ODD, strict=True):
        assert (r.s, r.v, r.b, r.c) == (t.strip(), t.strip(), not t.strip(), "".join(t.split())), repr(t)
        assert r.l == t.splitlines() or (not t and r.l in ([], [""])), repr(t)
    assert spark.range(1).select(T.strip(F.lit(None).cast("string"))).first()[0] is None


@pytest.mark.parametrize("text", ["﻿ab﻿c" * 90, "\U0001f600x。é" * 100, "a" * 403])
def test_windows_of_a_long_unit(spark, text):
    """Cut by place, whatever the characters: a mark for the byte order at a window's start stays."""
    got = spark.createDataFrame([(text,)], "x string").select(chunking.windows_of(F.col("x"), 100, 37)).first()[0]
    n = 1 + max(0, -(-(len(text) - 100) // 63))
    assert got == [text[k * 63 : k * 63 + 100] for k in range(n)]


def test_the_query_reads_its_pages_once(spark, monkeypatch, tmp_path):
    """The pages are written before the many steps that read them."""
    labels, real = [], registry.written
    monkeypatch.setattr(registry, "written", lambda df, label, **o: labels.append(label) or real(df, label, **o))
    spark.createDataFrame([(i, f"第{i}章 标题\n正文正文正文。", "zh", "s", 9) for i in range(1, 6)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert registry.inspect_result(spark, str(tmp_path)).count() == 1 and labels[0] == "pages"
