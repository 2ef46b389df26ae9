"""Locating and adding headings against sequential models; the similarity join against comparing all pairs."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from codexloom.operators import toc


def ratio(text, target):
    return difflib.SequenceMatcher(None, text, target).ratio()


def changed(rng, s, alphabet):
    """s with a few characters left out, put in, or replaced."""
    out = list(s)
    for _ in range(rng.randint(0, 1 + len(s) // 6)):
        at = rng.randrange(len(out) + 1)
        out[at : at + rng.choice([0, 1])] = rng.choice([[], [rng.choice(alphabet)]])
    return "".join(out)


@pytest.mark.parametrize("least", [0.82, 0.9])
def test_similar_finds_all_pairs(spark, least):
    rng, alphabet = random.Random(7), "abc中文标😀"
    bases = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(25)] + ["a" * 30, "ab" * 12, "x" * 260]
    targets = [("d", x) for x in dict.fromkeys(bases)]
    texts = [("d", x) for x in dict.fromkeys([changed(rng, rng.choice(bases), alphabet) for _ in range(400)] + bases)] + [("e", bases[3])]
    got = toc.similar(spark.createDataFrame(targets, "doc string, target string"), spark.createDataFrame(texts, "doc string, text string"), ["doc"], least)
    # Strings of one character have no pair of neighbours.
    want = {(d, t, x, ratio(x, t)) for d, t in targets for e, x in texts if d == e and len(t) > 1 and ratio(x, t) >= least}
    assert {tuple(r) for r in got.collect()} == want and len(want) > 100


def sequential(items, lines):
    """start of each heading of one document; items: (title, page), lines: (page, text)."""
    out, cursor = [], 0
    for target, page in items:
        def best(places, target=target):
            for i in places:
                if lines[i][1].startswith(target[:18]):
                    return i
            score, at = max(((ratio(lines[i][1], target), -i) for i in places), default=(0, 0))
            return -at if score >= 0.9 else None

        at = best([i for i, (q, _) in enumerate(lines) if page is not None and page - 1 <= q <= page + 2])
        if at is None:
            at = best(range(cursor, len(lines)))
        if at is None and page is not None:
            at = next((i for i, (q, _) in enumerate(lines) if q >= page), None)
        out.append(at)
        cursor = cursor if at is None else max(cursor, at + 1)
    return out


def test_headings_are_located_as_one_by_one(spark):
    rng, docs = random.Random(11), {}
    for d in range(25):
        titles = ["第" + "".join(rng.choice("一二三四五六七八九十甲乙") for _ in range(rng.randint(6, 26))) for _ in range(8)]
        lines = []
        for page in sorted(rng.sample(range(1, 30), 12)):
            for _ in range(rng.randint(1, 6)):
                lines.append((page, rng.choice([rng.choice(titles), rng.choice(titles) + "尾", rng.choice(titles)[1:], changed(rng, rng.choice(titles), "一二三"), "正文"]) or "空"))
        items = [(rng.choice([rng.choice(titles), changed(rng, rng.choice(titles), "甲乙"), "没有"]) or "无", rng.choice([None, rng.randint(1, 32), rng.randint(1, 32)])) for _ in range(rng.randint(1, 25))]
        docs[f"d{d}"] = (items, lines)
    toc_rows = [(d, i, t, p) for d, (items, _) in docs.items() for i, (t, p) in enumerate(items, 1)]
    line_rows = [(d, i, p, x, x) for d, (_, lines) in docs.items() for i, (p, x) in enumerate(lines)]
    found = toc.locate_heading_lines(spark.createDataFrame(toc_rows, "doc string, ord int, title string, page int"), spark.createDataFrame(line_rows, "doc string, idx int, page int, text string, normalized string"))
    got = {(r.doc, r.ord): r.start for r in found.collect()}
    assert got == {(d, i): s for d, (items, lines) in docs.items() for i, s in enumerate(sequential(items, lines), 1)}


def model(rows, most):
    """Candidates of one document that are taken: rows (parent, idx, key)."""
    taken, out = set(), []
    for parent in sorted({p for p, _, _ in rows}):
        fresh = sorted((i, k) for p, i, k in rows if p == parent and k not in taken)
        places = {i for i, _ in fresh}
        alone = []
        for i, k in fresh:
            a = b = i
            while a - 1 in places:
                a -= 1
            while b + 1 in places:
                b += 1
            if b - a < 2:
                alone.append((i, k))
        out += [(parent, i) for i, _ in alone[:most]]
        taken |= {k for _, k in alone[:most]}
    return out


def test_headings_are_added_as_parent_by_parent(spark):
    rng, rows = random.Random(13), []
    for d in range(12):
        keys = [f"k{i}" for i in range(rng.choice([4, 12, 400]))]
        idx = 0
        for parent in range(1, rng.randint(2, 9)):
            for _ in range(rng.randint(1, 40)):
                idx += rng.choice([1, 1, 2, 3])
                rows.append((f"d{d}", parent, idx, rng.choice(keys)))
            idx += 2
    found = toc.accepted(spark.createDataFrame(rows, "doc string, parent_ord int, idx int, key string"), 16)
    want = [(d, *x) for d in {r[0] for r in rows} for x in model([r[1:] for r in rows if r[0] == d], 16)]
    assert sorted((r.doc, r.parent_ord, r.idx) for r in found.collect()) == sorted(want)


def test_no_headings_no_lines(spark):
    items, lines = "doc string, ord int, title string, page int", "doc string, idx int, page int, text string, normalized string"
    assert toc.locate_heading_lines(spark.createDataFrame([], items), spark.createDataFrame([], lines)).count() == 0
    alone = toc.locate_heading_lines(spark.createDataFrame([("d", 1, "t", 1)], items), spark.createDataFrame([], lines))
    assert [tuple(r) for r in alone.select("doc", "ord", F.col("start")).collect()] == [("d", 1, None)]


def test_lines_are_numbered_by_pages(spark):
    """Windows put pages in order, not lines; empty, blank and null pages count for nothing."""
    texts = ["a\n\n b \r\nc", "", None, " \n\t\n", "d", "e\nf\n"]
    pages = spark.createDataFrame([(doc, k, t) for doc in "xy" for k, t in enumerate(texts, 1)][::-1], "doc string, page int, text string")
    lines = toc.flatten_lines(pages, normalized=False)
    want = [(i, p, t) for i, (p, t) in enumerate([(1, "a"), (1, "b"), (1, "c"), (5, "d"), (6, "e"), (6, "f")])]
    assert sorted(tuple(r) for r in lines.select("doc", "idx", "page", "text").collect()) == [(d, *w) for d in "xy" for w in want]
    plan = lines._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate") < plan.index("Window")


def test_contents_are_worked_out_once(spark):
    """locate_pages asks for its contents once, whatever they cost; long lines count by how they begin."""
    long = "第2节 beginning of everything" + " and so on" * 30
    lines = spark.createDataFrame([("d", 0, 1, "x", "第1节Doc"), ("d", 1, 2, "x", long.replace(" ", "")), ("d", 2, 3, "x", "第3节Dcc more"), ("d", 3, 7, "x", "第")], "doc string, idx int, page int, text string, normalized string")
    asked = spark.sparkContext.accumulator(0)

    def told(title):
        asked.add(1)
        return title

    titles = [("d", 1, "第1节Doc", 1), ("d", 2, "第2节 beginning of everything here", 2), ("d", 3, "第3节Doc more", 3), ("d", 4, "第4", 7), ("d", 5, "nowhere", 9)]
    heads = spark.createDataFrame(titles, "doc string, ord int, title string, page int").withColumn("title", F.udf(told, "string")("title"))
    got = {r.ord: (r.page, r.method) for r in toc.locate_pages(heads, lines).collect()}
    assert got == {1: (1, "exact_normalized"), 2: (2, "prefix_normalized"), 3: (3, "fuzzy_ratio"), 4: (7, "prefix_normalized"), 5: (9, "bookmark_page_fallback")}
    assert asked.value == len(titles)
