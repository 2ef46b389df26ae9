"""op13: the random field against enumeration of all labellings, held-out accuracy, passages of mixed texts, odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from codexloom.llm import language

KIND = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, held_out string, _lang string, _l string, _h string"
EXTRA = ("a", "b", "c", "d", "e", "f")
SYLLABLES = {"xx": ["ka", "to", "mi", "zu"], "yy": ["bré", "gou", "lle", "eau"], "zz": ["sch", "ung", "pfe", "keit"]}


def word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def table(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(240):
        lang = rng.choice(list(SYLLABLES))
        words = [word(rng, lang if rng.random() < 0.95 else rng.choice(list(SYLLABLES))) for _ in range(rng.randint(1, 80))]
        rows.append((i, " ".join(w.capitalize() if rng.random() < 0.2 else w for w in words) + rng.choice([".", " 12", "\n--"]), lang))
    odd = [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 ² -- ½ _ 👍", "yy"), (1003, "中文 文字", None), (1004, "ka" * 30_000, "xx"), (1005, "schung pfekeit " * 30_000, "zz")]
    return rows + odd + [(5, rows[5][1], rows[5][2])] * 2 + [(None, rows[6][1], None), (None, None, None)]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("language"))
    spark.createDataFrame([(i, t, lang, "s", 1, *EXTRA) for i, t, lang in table()], KIND).write.parquet(f"{path}/documents.parquet")
    return path


def test_query(spark, folder):
    rows = __spark_entry__.queries()["op13_language"](spark, folder).collect()
    assert len(rows) == len(table()) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    lang = {i: la for i, _, la in table()}
    asked = [i for i in lang if i is not None and i < 1000 and held_out(i)]
    assert len(asked) > 40 and sum(by_id[i]["lang_pred"] == lang[i] for i in asked) >= 0.97 * len(asked)
    assert {i: by_id[i]["lang_pred"] for i in (1000, 1001, 1002)} == dict.fromkeys((1000, 1001, 1002), "und")
    assert by_id[1003]["lang_pred"] in SYLLABLES and by_id[1004]["lang_pred"] == "xx" and by_id[1005]["lang_pred"] == "zz"
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == 5}) == 1
    assert sorted(r["lang_pred"] for r in rows if r["doc_id"] is None) == sorted(["und", lang[6]])


def test_other_columns_are_not_read(spark, folder, tmp_path):
    """With sources shuffled, lengths wrong and the held-out languages gone, predictions stay."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs.withColumn("lang", F.when(gone, None).otherwise(F.col("lang"))).withColumn("source", F.lit("?")).withColumn("n_chars", F.rand(1).cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    told = lambda path: sorted(map(repr, __spark_entry__.queries()["op13_language"](spark, path).collect()))
    assert told(folder) == told(str(tmp_path))


def enumerated(e, steps, starts):
    n, k = e.shape
    single, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for labels in itertools.product(range(k), repeat=n):
        w = np.exp(starts[labels[0]] + sum(e[t, c] for t, c in enumerate(labels)) + sum(steps[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        total += w
        for t, c in enumerate(labels):
            single[t, c] += w
        for a, b in zip(labels, labels[1:], strict=False):
            pairs[a, b] += w
    return single / total, pairs / total, np.log(total)


@pytest.mark.parametrize("piece", [1, 2, 3, 256])
def test_forward_backward_equals_enumeration(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    rng = np.random.default_rng(1)
    sizes = np.array([3, 1, 7, 5, 2, 6])
    e, steps, starts = rng.normal(size=(sizes.sum(), 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=3)
    ends = np.cumsum(sizes)
    want = [enumerated(e[b - n : b], steps, starts) for n, b in zip(sizes, ends, strict=True)]
    assert np.allclose(language.forward_backward(e, sizes, steps, starts), np.concatenate([w[0] for w in want]))
    begin = np.tile(np.exp(starts), (len(sizes), 1))
    p, pairs, log_sum = language.sweep(np.exp(e), ends - sizes, sizes, np.exp(steps), begin, np.ones_like(begin))
    assert np.allclose(p, np.concatenate([w[0] for w in want])) and np.allclose(pairs, sum(w[1] for w in want)) and np.isclose(log_sum, sum(w[2] for w in want))


def test_features_of_a_word_do_not_depend_on_the_others():
    words = ["a", "ab", "中文", "x" * 100, "straße", "ab"]
    flat, sizes = language.features(words, {"ab": [1]})
    cuts = np.cumsum(sizes)
    for w, n, end in zip(words, sizes, cuts, strict=True):
        own, size = language.features([w], {"ab": [1]})
        assert size[0] == n and sorted(own) == sorted(flat[end - n : end])
    assert (flat == language.BUCKETS + 1).sum() == 2


def test_the_middle_of_a_long_word_counts(monkeypatch):
    """All runs of a word are features, however long it is; batches and slices change nothing."""
    word_ = "ka" * 20 + "schung" * 50 + "ka" * 20
    codes = np.array([ord(c) for c in f"^{word_}$"], np.uint64)
    found = set(language.features([word_], {})[0].tolist())
    assert len(language.features([word_], {})[0]) == 1 + sum(len(codes) - k + 1 for k in (1, 2, 3)) + 8
    assert all(set(language._mixed(np.stack([codes[j : len(codes) - k + 1 + j] for j in range(k)], axis=1), k).tolist()) <= found for k in (1, 2, 3))
    model = language.fit([(t, lang) for _, t, lang in table() if t and lang], rounds=40)
    words = ["ka", word_, "", "pfekeit", "x" * 7, word_[::-1]]
    whole = language.Rows(words, model.lexicon).potentials(model.weights)
    assert model.labels[int(whole[1].argmax())] == "zz"
    monkeypatch.setattr(language, "BATCH", 20)
    assert np.allclose(language.potentials(words, model), whole, atol=1e-4)
    assert [w for some in language.batches_of(words) for w in some] == words
    table_ = language.Table(words, model.lexicon)
    rows, size = language.Rows(words, model.lexicon), len(model.weights)
    assert np.allclose(table_.potentials(model.weights), whole, atol=1e-4) and np.allclose(table_.gradient(whole, size), rows.gradient(whole, size), atol=1e-4)


def test_passages_of_a_mixed_text(spark):
    rng = random.Random(4)
    model = language.fit([(t, lang) for _, t, lang in table() if t and lang], rounds=40)
    plan = [("xx", 30), ("zz", 25), ("yy", 40)]
    text = " ".join(word(rng, lang) for lang, n in plan for _ in range(n))
    row = spark.createDataFrame([(text,), (None,)], "text string").select(language.language(F.col("text"), model, spans=True).alias("x")).select("x.*").collect()
    assert [s["lang"] for s in row[0]["spans"]] == ["xx", "zz", "yy"] and row[0]["lang_pred"] == "yy"
    assert all(abs(s["start"] - a) <= 2 for s, a in zip(row[0]["spans"], (0, 30, 55), strict=True)) and row[1]["spans"] == []
    assert model.steps.diagonal().min() > (model.steps - np.diag(np.full(3, np.inf))).max()


def test_nothing_to_learn_from_and_one_language(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, some in (("empty", docs.limit(0)), ("none", docs.withColumn("lang", F.lit(None).cast("string"))), ("one", docs.where("lang = 'xx'"))):
        some.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    ask = lambda name: __spark_entry__.queries()["op13_language"](spark, f"{tmp_path}/{name}")
    assert ask("empty").count() == 0
    assert {(r["lang_pred"], r["score"]) for r in ask("none").collect()} == {("und", 0.0)}
    assert {r["lang_pred"] for r in ask("one").collect()} == {"und", "xx"}


def test_the_sample_is_bounded(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit", lambda rows, **_: seen.append(rows) or language.Model())
    language.fit_table(spark.read.parquet(f"{folder}/documents.parquet"), sample_rows=5, most_labels=2)
    assert len(seen[0]) == 10 and len({lang for _, lang in seen[0]}) == 2
