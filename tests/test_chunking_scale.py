"""Long runs of siblings and long sections against sequential models."""

import random
import time

import pytest
from pyspark.sql import functions as F

from codexloom.functions.profiles import PROFILES, Profile
from codexloom.operators import chunking
from tests.test_chunking import model


def slots(spark, lens, heads, p):
    rows = spark.createDataFrame([("d", 1, i, n, h, 3 if n > p.split else 0, 17 if n > p.split else 0) for i, (n, h) in enumerate(zip(lens, heads, strict=True))], "doc string, run int, ord int, len int, head int, parts int, last int")
    return [(r.ord, r.slot, r.reason) for r in chunking.merge_plan(rows, p).orderBy("ord").collect()]


def expected(lens, heads, p):
    """Slots by the sequential model; a cut section takes three, and its last part has 17 characters."""
    out, slot, i, prev = [], 0, 0, -1
    while i < len(lens):
        n = lens[i]
        if n > p.split:
            out.append((i, slot + 1, chunking.CUT))
            slot, prev, i = slot + 3, 17, i + 1
        elif n >= p.min:
            out.append((i, slot + 1, chunking.NATURAL))
            slot, prev, i = slot + 1, n, i + 1
        else:
            j, total = i + 1, n
            while j < len(lens) and total < min(p.target, p.min) and total + lens[j] <= p.max:
                total, j = total + lens[j], j + 1
            if j - i > 1:
                slot += 1
                out += [(k, slot, chunking.MERGED) for k in range(i, j)]
                prev = sum(lens[k] + heads[k] for k in range(i, j)) + 2 * (j - i - 1)
            elif prev >= 0 and prev + 2 + n + heads[i] <= p.max:
                out.append((i, slot, chunking.BACKWARD))
                prev += 2 + n + heads[i]
            else:
                slot += 1
                out.append((i, slot, chunking.ALONE))
                prev = n
            i = j
    return out


@pytest.mark.parametrize("p", [Profile("t", "book", 40, 60, 90, 20, 5, None), Profile("t", "book", 15, 60, 90, 40, 5, None), Profile("t", "book", 40, 30, 50, 25, 5, None), Profile("t", "book", 5, 9, 12, 8, 0, None)])
def test_islands_equal_the_sequential_model(spark, p):
    rng = random.Random(p.min)
    for _ in range(4):
        lens = [rng.choice([1, 2, 4, 5, 7, 8, 9, 12, 13, 19, 20, 25, 30, 31, 39, 40, 55, 60, 61, 88, 95]) if rng.random() < 0.6 else rng.randint(1, p.min) for _ in range(300)]
        heads = [rng.randint(4, 12) for _ in lens]
        assert slots(spark, lens, heads, p) == expected(lens, heads, p)


def test_the_two_models_agree():
    p, rng = Profile("t", "book", 40, 60, 90, 20, 5, None), random.Random(9)
    lens = [rng.choice([1, 5, 19, 20, 35, 60, 88]) for _ in range(500)]
    a, b = {}, {}
    for i, slot, _ in expected(lens, [5] * 500, p):
        a.setdefault(slot, []).append(i)
    for k, (_, places) in enumerate(model(lens, [5] * 500, p), 1):
        b[k] = places
    assert a == b


def test_200_000_siblings_in_one_run(spark):
    p, rng = PROFILES["textbook"], random.Random(1)
    lens = [rng.randint(1, p.min - 1) for _ in range(150_000)] + [rng.choice([20, 90, 170, 400, 1090, 1900, 2100]) for _ in range(50_000)]
    heads = [rng.randint(4, 30) for _ in lens]
    began = time.perf_counter()
    assert slots(spark, lens, heads, p) == expected(lens, heads, p)
    assert time.perf_counter() - began < 60


def parts(text, most, overlap):
    """The parts of a section, unit by unit."""
    import re

    us = []
    for q in re.split(r"\n\s*\n", text):
        if q := q.strip():
            us += [q] if len(q) <= 500 else [s for x in re.split(r"(?<=[。！？；;!?])", q) if (s := x.strip())]
    out, cur = [], ""
    for u in us:
        if len(u) > most:
            if cur:
                out.append(cur)
            step, at = max(1, most - overlap), 0
            while True:
                out.append(u[at : at + most])
                if at + most >= len(u):
                    break
                at += step
            cur = ""
        elif not cur:
            cur = u
        elif len(cur) + len(u) + 2 <= most:
            cur += "\n\n" + u
        else:
            out.append(cur)
            cur = ((cur[-overlap:] if overlap else "") + "\n\n" + u).strip()
    return [*out, cur] if cur else out


@pytest.mark.parametrize(("most", "overlap"), [(60, 10), (60, 0), (30, 29), (700, 80), (100, 250)])
def test_parts_equal_the_sequential_model(spark, most, overlap):
    rng = random.Random(most + overlap)
    word = lambda: rng.choice(["字" * rng.randint(1, 40), "word ", "　全角　", "x\n\n \n", "。", "长句子的结尾！", "a;b", "\n", "😀中"])
    texts = ["".join(word() for _ in range(rng.randint(0, 160))) for _ in range(40)] + ["", " \n ", "。" * 700, "无" * 1500, "句。" * 400]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.split_long(F.col("t"), most, overlap).alias("p")).orderBy("i").collect()
    for r, t in zip(got, texts, strict=True):
        assert r.p == parts(t, most, overlap), repr(t)


def test_a_section_of_ten_megabytes(spark):
    text = "".join(f"这是第{i}个句子，写得不太长。" + ("\n\n" if i % 50 == 0 else "") for i in range(200_000))
    assert len(text.encode()) > 7_000_000
    frame = spark.createDataFrame([(text,)], "t string").repartition(1).cache()
    frame.count()
    began = time.perf_counter()
    got = frame.select(chunking.split_long(F.col("t"), 1100, 80).alias("p")).first().p
    assert time.perf_counter() - began < 30
    assert got == parts(text, 1100, 80)
