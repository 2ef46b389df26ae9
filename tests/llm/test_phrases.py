"""op12: phrases against plain counting, and the same results however words are ranked, dealt out and looked up."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__
from codexloom.llm import phrases

KIND = "doc_id long, text string, lang string, source string, n_chars long, phrase string, n long, a string, p string, score string, rank int, _part int"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def table(seed=5):
    rng = random.Random(seed)
    vocabulary = [w for k in range(1, 60) for w in [f"W{k}é"] * (60 // k + 1)]
    rows = []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(words))
            words[at:at] = rng.choice([["New", "York", "City"], ["red", "red", "red"], ["hong", "KONG"], ["New", "York"], ["x" * 300, "y"]])
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "　"]) for w in words), rng.choice(["en", "en", "fr", None])))
    hot = "the very same line of the very same words"
    rows += [(1000 + i, hot, "en") for i in range(120)] + [(7, hot, None), (None, hot, "de"), (None, None, "fr"), (2, "", "fr"), (3, " \t.\n", None), (4, "ha " * 40_000, "und")]
    return rows


def brute(rows, most=3, least=10, percent=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, most + 1):
                f[lang or "und"].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longest[p[i : i + size]] = max(longest[p[i : i + size]], a)
        rows_ = []
        for p, a in found.items():
            if p in longest and 100 * longest[p] >= percent * a:
                continue
            value, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows_.append((-value, -a, " ".join(p).encode(), left, right))
        for rank, (value, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -value))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r[c] for c in COLUMNS)) for r in df.collect())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("phrases"))
    spark.createDataFrame([(i, t, lang, "s", 1, "a", 2, "b", "c", "d", 3, 4) for i, t, lang in table()], KIND).write.parquet(f"{path}/documents.parquet")
    return path


def test_query_equals_plain_counting(spark, folder):
    want = brute(table())
    assert len(want) > 50
    assert got(__spark_entry__.queries()["op12_phrases"](spark, folder)) == want


def test_sql_equals_plain_counting(folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    rel = con.sql(__spark_entry__.oracle_sql()["op12_phrases"])
    assert sorted(repr(tuple(r[rel.columns.index(c)] for c in COLUMNS)) for r in rel.fetchall()) == brute(table())


@pytest.mark.parametrize("bounds", [{"RANKED": 40, "GROUP": 3, "HOT": 5, "SLICE": 50}, {"RANKED": 0, "HOT": 0, "STEPS": 0}])
def test_bounds_change_nothing(spark, folder, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(phrases, name, value)
    assert got(__spark_entry__.queries()["op12_phrases"](spark, folder)) == brute(table())


def test_longer_phrases_and_a_short_list(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert got(phrases.collocations(docs, most_words=5, least=4, percent=70, top=7)) == brute(table(), 5, 4, 70, 7)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 123_456_789_012_345, 123_456_789_999_999, 987_654_321_012_345
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases.score(*map(__import__("pyspark").sql.functions.col, "alr")).alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (left * right)


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert __spark_entry__.queries()["op12_phrases"](spark, str(tmp_path)).count() == 0
