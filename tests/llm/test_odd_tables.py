"""Queries on tables that lack something or hold something very large."""

import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def asked(spark, name, folder):
    return __spark_entry__.queries()[name](spark, folder)


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, (v + rng.normal(size=8) * 0.03).tolist()) for i, v in enumerate(base[:20])]
    rows += [(None, base[0].tolist()), (None, base[30].tolist()), (7, base[7].tolist()), (7, base[9].tolist()), (7, None), (None, None), (900, [0.0] * 8), (901, [float("nan")] + [1.0] * 7), (902, []), (903, [1.0, None])]
    # A group none of whose rows has an identifier.
    return rows + [(None, [9.0] + [0.0] * 7)] * 2


def test_op7_null_and_repeated_identifiers(spark, tmp_path):
    rows = vectors()
    spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, _id string").write.parquet(f"{tmp_path}/embeddings.parquet")
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in good}
    links = {k: [j for j in good if j != k and unit[k] @ unit[j] >= 0.95] for k in good}
    want = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        want.append(repr((i, len(links.get(k, [])), least, i == least)))
    got = asked(spark, "op7_embedding_dedup", str(tmp_path))
    assert sorted(repr((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got.collect()) == sorted(want)
    assert sum(len(x) for x in links.values()) > 40


def test_op7_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert asked(spark, "op7_embedding_dedup", str(tmp_path)).count() == 0


@pytest.mark.parametrize(("labels", "score"), [([(i, 1, 0) for i in range(40)], 0.0), ([(i, 1, 1) for i in range(40)], 1.0), ([], 0.0)])
def test_op5_without_one_class(spark, tmp_path, labels, score):
    spark.createDataFrame([(i, f"words of {i}", "en", "s", 9) for i in range(40)], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = asked(spark, "op5_toxicity", str(tmp_path)).collect()
    assert len(got) == 40 and {(r.score, r.predicted) for r in got} == {(score, int(score))}


def test_a_text_of_megabytes(spark, tmp_path):
    rng = random.Random(6)
    long_ = " ".join(rng.choice(["alpha", "beta", "gamma", "password=abcdef123", "deadbeefdeadbeefdeadbeef"]) for _ in range(250_000))
    rows = [(1, long_), (2, long_ + " tail"), (3, "short text of a few words"), (4, None)]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def fingerprint(text):
        w = (text or "").lower().split()
        h = np.array([xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))], np.uint64) if w else np.zeros(0, np.uint64)
        return "".join(str(int(2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h) > 0)) for b in range(63, -1, -1))

    prints = {r.doc_id: (f"{int(r.fingerprint, 16):064b}", r.component_id) for r in asked(spark, "op2_simhash", str(tmp_path)).collect()}
    assert {i: p for i, (p, _) in prints.items()} == {i: fingerprint(t) for i, t in rows} and prints[2][1] == 1
    spans = {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in asked(spark, "op9_secret_scan", str(tmp_path)).collect()}
    assert spans == {i: (len(re.findall("password=", t or "")), 0, len(re.findall("[0-9a-f]{24,}", t or ""))) for i, t in rows}
    scored = {r.doc_id: r.n_tokens for r in asked(spark, "op3_lm_score", str(tmp_path)).collect()}
    assert scored == {1: 250_001, 2: 250_002, 3: 7, 4: 1}
    assert {r.doc_id: r.n_grams for r in asked(spark, "op10_importance", str(tmp_path)).collect()}[4] == 0
