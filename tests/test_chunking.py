"""Chunking against a small sequential model, and the cases that must hold."""

import random

from codexloom import engine
from codexloom.functions.profiles import PROFILES, Profile
from codexloom.operators import chunking


def sections(spark, texts, titles=None, parent=1):
    rows = [("d", i + 2, titles[i] if titles else f"T{i}", 3, parent, [1, i + 2], t, 1, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc string, ord int, title string, level int, parent_ord int, path_ords array<int>, text string, page_start int, page_end int")


def model(lens, heads, p):
    """Chunks of one sibling run as (reason, places); cut sections count as one."""
    out, i, prev = [], 0, None
    while i < len(lens):
        n = lens[i]
        if n > p.split:
            out.append((chunking.CUT, [i]))
            prev, i = None if False else "cut", i + 1
            continue
        if n >= p.min:
            out.append((chunking.NATURAL, [i]))
            prev, i = n, i + 1
            continue
        group, total = [i], n
        while group[-1] + 1 < len(lens) and total < min(p.target, p.min) and total + lens[group[-1] + 1] <= p.max:
            group.append(group[-1] + 1)
            total += lens[group[-1]]
        if len(group) > 1:
            out.append((chunking.MERGED, group))
            prev = sum(lens[k] + heads[k] for k in group) + 2 * (len(group) - 1)
        elif isinstance(prev, int) and prev + 2 + n + heads[i] <= p.max:
            out[-1] = (chunking.BACKWARD, [*out[-1][1], i])
            prev += 2 + n + heads[i]
        else:
            out.append((chunking.ALONE, group))
            prev = n
        i = group[-1] + 1
    return out


def test_merging_equals_the_sequential_model(spark):
    p, rng = Profile("t", "book", 40, 60, 90, 20, 5, None), random.Random(5)
    texts = ["x" * rng.choice([1, 5, 12, 19, 20, 35, 59, 60, 61, 88]) for _ in range(120)]
    got = chunking.make_chunks(sections(spark, texts), p).orderBy("chunk_index").collect()
    want = model([len(t) for t in texts], [len(f"T{i}") + 3 for i in range(len(texts))], p)
    assert [(r.reason, [o - 2 for o in r.ords]) for r in got] == want
    assert [r.chunk_index for r in got] == list(range(1, len(got) + 1))


def test_short_siblings_merge_under_their_parent(spark):
    got = chunking.make_chunks(sections(spark, ["甲" * 60, "乙" * 60], ["一节", "二节"])).collect()
    assert len(got) == 1 and got[0].path_ords == [1] and got[0].merged_headings == ["一节", "二节"]
    assert got[0].text.startswith("【一节】\n甲")


def test_long_section_is_cut(spark):
    p = Profile("t", "book", 200, 300, 300, 50, 20, None)
    got = chunking.make_chunks(sections(spark, ["这是一个句子。" * 300]), p).collect()
    assert len(got) > 1 and {r.reason for r in got} == {chunking.CUT}
    assert [(r.part_index, r.part_count) for r in sorted(got, key=lambda r: r.chunk_index)] == [(i + 1, len(got)) for i in range(len(got))]


def test_natural_section_stays_whole(spark):
    p = Profile("t", "book", 200, 300, 2000, 50, 20, None)
    got = chunking.make_chunks(sections(spark, ["自然段落内容完整。" * 90]), p).collect()
    assert [(r.reason, r.text) for r in got] == [(chunking.NATURAL, "自然段落内容完整。" * 90)]


def test_oversized_unit_without_sentence_ends(spark):
    p = Profile("t", "book", 200, 300, 800, 50, 20, None)
    got = chunking.make_chunks(sections(spark, ["一二三四五六七八九十" * 260]), p).orderBy("chunk_index").collect()
    assert [len(r.text) for r in got[:-1]] == [300] * (len(got) - 1)
    assert got[0].text[-20:] == got[1].text[:20]


def test_levels_below_the_cut_stay_inside(spark):
    text = "第一章 总论\n第一节 基本概念\n一、研究对象\n（一）基本定义\n1. 主要特点\n这里说明第一个特点的内容。\n2. 次要特点\n这里说明第二个特点的内容。"
    book = engine.build_books(spark.createDataFrame([("b", 1, text)], "doc string, page int, text string"), "textbook")
    found = book.sections.collect()
    assert [r.title for r in found] == ["（一）基本定义"]
    assert "1. 主要特点" in found[0].text and "2. 次要特点" in found[0].text


def test_document_without_headings(spark):
    book = engine.build_books(spark.createDataFrame([("b", 1, "只有正文。"), ("b", 2, "还有一页。")], "doc string, page int, text string"), "textbook")
    assert [(r.title, r.page_end) for r in book.sections.collect()] == [("正文", 2)]
    assert [r.text for r in book.chunks.collect()] == ["只有正文。\n\n还有一页。"]


def test_profile_overrides():
    assert PROFILES["legal"].with_(max=900, min=None).max == 900 and PROFILES["legal"].with_(min=None).min == 120
