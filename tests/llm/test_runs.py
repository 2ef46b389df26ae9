"""op11: periodic runs against brute force, on odd rows and on texts that are dealt out by ranges of lags."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

import __spark_entry__
from codexloom.llm import runs

KIND = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, _row string, runs string, start long, _r int, _lags int"
EXTRA = ("a", "b", "c", "d", 7, 8, 9)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periods(words):
    """Periods of a list of words, smallest first."""
    return [q for q in range(1, len(words)) if all(words[i] == words[i + q] for i in range(len(words) - q))]


def brute(words):
    """All runs, by definition."""
    n, out = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q) and (i == 0 or words[i - 1] != words[i - 1 + q]) and periods(words[i : i + length])[0] == q:
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def changed(doc_id, text):
    words = split(text)
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = changed(doc_id, text)
    found = brute(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    told = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *told, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def table():
    rng = random.Random(3)
    some = lambda n, k: [rng.choice("abcdefghij"[:k]) for _ in range(n)]
    texts = [" ".join(some(rng.randint(1, 120), 10)) for _ in range(120)]
    for _ in range(60):
        unit = some(rng.randint(1, 14), rng.randint(1, 4))
        middle = (unit * 40)[: rng.randint(20, 90)]
        texts.append("\t".join(some(rng.randint(0, 9), 6) + middle + some(rng.randint(0, 9), 6) + middle[: rng.randint(0, 60)]))
    texts += [" ".join(["x"] * n) for n in (23, 24, 25, 71)] + [" ".join(["x", "x"] * 20 + ["y"] + ["x", "x"] * 20), " ".join((["p"] * 5 + ["q"]) * 9), "é è\n" * 15, " \t\n", ""]
    return [*enumerate(texts), (None, None), (None, "z " * 30), (4, None), (4, "z " * 30), (4, "z " * 30), (10_000, "x\x0bw \x0c" * 40), (10_001, "no\x85break　here " * 9)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("runs"))
    spark.createDataFrame([(i, t, "en", "s", 1, *EXTRA) for i, t in table()], KIND).write.parquet(f"{path}/documents.parquet")
    return path


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def got(df):
    return sorted(repr(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def test_query_equals_brute_force(spark, folder):
    assert got(__spark_entry__.queries()["op11_periodic_runs"](spark, folder)) == sorted(repr(expected(*r)) for r in table())


def test_texts_dealt_out_by_ranges_of_lags(spark, folder, monkeypatch):
    for name, value in (("LONG", 40), ("RANGE", 300), ("LAGS", 3), ("CELLS", 64)):
        monkeypatch.setattr(runs, name, value)
    assert got(__spark_entry__.queries()["op11_periodic_runs"](spark, folder)) == sorted(repr(expected(*r)) for r in table())


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert __spark_entry__.queries()["op11_periodic_runs"](spark, str(tmp_path)).count() == 0


def test_a_text_of_megabytes(spark):
    words = [f"w{i}" for i in range(60_000)]
    words[30_000:30_000] = ["again", "and"] * 5_000
    row = runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(30_000, 10_000, 2)] and len(row["collapsed"].split()) == 60_002


def test_other_bounds(spark):
    row = runs.periodic_runs(spark.createDataFrame([(1, "a b c a b c a x")], "doc_id long, text string"), least=6, exponent=2).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 7, 3)] and row["collapsed"] == "a b c x"
    with pytest.raises(ValueError):
        runs.periodic_runs(spark.createDataFrame([(1, "a")], "doc_id long, text string"), exponent=1)
