"""Levels and parents that the heading rules give, per profile."""

import pytest

from codexloom.operators import toc

CASES = {
    "technical": [("3 Wire format", 1), ("3.2 Frames", 2), ("3.2.7 Padding rules", 3), ("3.2.7.1 Odd sizes", 4), ("Frames follow one another.", None)],
    "paper": [("Abstract", 1), ("Keywords: tides, harbours", 1), ("We measured the water.", None), ("2 Harbour data", 1), ("2.4 Gauges", 2), ("Bibliography", 1)],
    "legal": [("第三编 河道管理", 1), ("第七章 堤防维护", 2), ("第二节 巡查职责", 3), ("第十六条 汛期值守", 4), ("第十七条 经费来源", 4)],
    "english": [("Part IV Rivers", 1), ("Chapter 12: Floods", 2), ("12.3 Levees", 2), ("12.3.5 Sandbags", 3), ("Appendix C Gauges", 1)],
    "fiction": [("序章", 1), ("第十二回 渡口", 1), ("第三章 灯塔", 1), ("番外篇 归途", 1)],
    "classical": [("卷十七", 1), ("世家", 2), ("河渠志", 3), ("卷下 列传", 1), ("沧浪赋", 3)],
    "reference": [("M", 1), ("Mangrove", 2), ("Marsh Harrier", 2), ("N", 1), ("Neap Tide", 2)],
    "textbook": [("第四章 潮汐", 1), ("第二节 测量工具", 2), ("三、浮标布设", 3), ("（六）读数误差", 4), ("8. 记录表格", 5), ("每天清晨读一次水位，然后写进表格。", None)],
}


@pytest.mark.parametrize("profile", CASES)
def test_levels(spark, profile):
    pages = spark.createDataFrame([("d", 1, "\n".join(t for t, _ in CASES[profile]))], "doc string, page int, text string")
    got = [(r.title, r.level) for r in toc.infer_toc(pages, profile).orderBy("ord").collect()]
    assert got == [(t, n) for t, n in CASES[profile] if n]


def test_parents_follow_a_stack(spark):
    import random

    rng, rows, want = random.Random(3), [], {}
    for d in range(20):
        stack = []
        for o in range(1, 30):
            level = rng.randint(1, 7)
            while stack and stack[-1][1] >= level:
                stack.pop()
            want[str(d), o] = (stack[-1][0] if stack else None, [s[0] for s in stack] + [o])
            stack.append((o, level))
            rows.append((str(d), o, level))
    got = toc.with_parents(spark.createDataFrame(rows, "doc string, ord int, level int")).collect()
    assert {(r.doc, r.ord): (r.parent_ord, r.path_ords) for r in got} == want


def test_repair_of_a_garbled_title(spark):
    outline = [("d", i, t, 1, None) for i, t in enumerate(["第一篇 起源", "第二篇 发展", "第三篇 高潮", "☆"], 1)]
    pages = [("d", 1, "目录\n第一篇 起源\n第二篇 发展\n第三篇 高潮\n第四篇 结局")]
    out = toc.repair_titles(spark.createDataFrame(outline, "doc string, ord int, title string, level int, page int"), spark.createDataFrame(pages, "doc string, page int, text string")).orderBy("ord").collect()
    assert [r.repaired for r in out] == [False, False, False, True]
    assert out[3].title == "第四篇 结局"


def test_augmentation_adds_the_short_headings(spark):
    outline = spark.createDataFrame([("d", 1, "toc:000001", "第一章 思考", 1, None, [1], 1, "", 1.0), ("d", 2, "toc:000002", "第二章 行动", 1, None, [2], 1, "", 1.0)], "doc string, ord int, toc_id string, title string, level int, parent_ord int, path_ords array<int>, page int, method string, confidence double")
    pages = spark.createDataFrame([("d", 1, "第一章 思考\n批判性思维的强弱\n正文内容在这里说明。\n独立思考的习惯\n第二章 行动\n这是正文。")], "doc string, page int, text string")
    lines = toc.flatten_lines(pages)
    starts = toc.locate_heading_lines(outline, lines)
    added = toc.augment_headings(outline, lines, starts)
    assert [(r.title, r.level, r.parent_ord) for r in added.orderBy("idx").collect()] == [("批判性思维的强弱", 2, 1), ("独立思考的习惯", 2, 1)]
    merged = toc.augmented_toc(outline, starts, added, lines).orderBy("ord").collect()
    assert [r.title for r in merged] == ["第一章 思考", "批判性思维的强弱", "独立思考的习惯", "第二章 行动"]


def test_locate_falls_back_in_order(spark):
    outline = spark.createDataFrame([("d", 1, "Alpha beta gamma", 1), ("d", 2, "Alpha bets gamma delta epsilon zeta", 9), ("d", 3, "Nowhere", 2)], "doc string, ord int, title string, page int")
    lines = toc.flatten_lines(spark.createDataFrame([("d", 1, "x\nAlpha beta gamma"), ("d", 2, "y\nAlpha betz gamma delta epsilon zeta")], "doc string, page int, text string"))
    got = {r.ord: r.start for r in toc.locate_heading_lines(outline, lines).collect()}
    assert got == {1: 1, 2: 3, 3: 2}


def test_locate_pages(spark):
    outline = spark.createDataFrame([("d", 1, "第一章 总论", 2), ("d", 2, "第二章 方法与材料", 1), ("d", 3, "缺", None), ("d", 4, "不存在的标题", 1)], "doc string, ord int, title string, page int")
    lines = toc.flatten_lines(spark.createDataFrame([("d", 1, "前言"), ("d", 2, "第二章 方法与村料"), ("d", 3, "第一章　总论")], "doc string, page int, text string"))
    got = {r.ord: (r.page, r.method) for r in toc.locate_pages(outline, lines).collect()}
    assert got == {1: (3, "exact_normalized"), 2: (2, "fuzzy_ratio"), 3: (None, "no_page"), 4: (1, "bookmark_page_fallback")}
