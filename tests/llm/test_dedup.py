"""Exact, near and embedding duplicates against brute force, with odd rows."""

import math
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from codexloom.llm import embedding_dedup, exact_dedup, simhash
from codexloom.llm.components import components

DOCS = "doc_id long, text string, keep_id string, digest string, _id string"  # names that operators use inside


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)


ROWS = [(1, "same"), (2, "same"), (3, None), (4, ""), (5, "Same"), (6, "same "), (7, "same"), (7, "same"), (8, "x" * 200_000), (9, "x" * 200_000), (None, "same"), (None, "lonely")]


def brute(rows, pick):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted(repr((i, pick([x for x in groups[t or ""] if x is not None], default=None), len(groups[t or ""]))) for i, t in rows)


def test_exact_dedup(spark):
    for keep, pick in (("max", max), ("min", min)):
        got = exact_dedup.exact_dedup(docs(spark, ROWS), keep=keep).collect()
        assert sorted(repr((r["_id"], r.keep_id, r.group_size)) for r in got) == brute(ROWS, pick)
        assert all(r.kept == (r["_id"] == r.keep_id) for r in got)


def test_exact_dedup_verifies_bytes(spark):
    rows = [(i, f"text {i % 60}") for i in range(200)]
    got = exact_dedup.exact_dedup(docs(spark, rows), keep="max", digest_bytes=1).collect()
    assert sorted(repr((r["_id"], r.keep_id, r.group_size)) for r in got) == brute(rows, max)


def test_exact_dedup_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    got = exact_dedup.exact_dedup(docs(spark, ROWS), keep="max").collect()
    assert sorted(repr((r["_id"], r.keep_id, r.group_size)) for r in got) == brute(ROWS, max)


def test_exact_dedup_without_filter(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_HITS", -1)
    got = exact_dedup.exact_dedup(docs(spark, ROWS), keep="min").collect()
    assert sorted(repr((r["_id"], r.keep_id, r.group_size)) for r in got) == brute(ROWS, min)


def test_hit_filter_passes_all_hits_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_WORDS", 64)
    digests = spark.range(20_000).select("id", F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest"))
    held = exact_dedup.HitFilter(digests.where("id < 2000").select("digest"), 2_000)
    assert held.blocks.count() == -(-2_000 * exact_dedup.BITS_PER_HIT // (64 * 64))
    passed = {r.id for r in held.probe(digests).collect()}
    assert passed >= set(range(2_000)) and len(passed) < 2_000 + 0.1 * 18_000
    assert {r.id for r in held.probe(digests, passing=False).collect()} == set(range(20_000)) - passed
    assert exact_dedup.HitFilter(digests.where("false").select("digest"), 0).probe(digests).count() == 0


def test_exact_dedup_keeps_rows_and_columns(spark):
    kept = exact_dedup.drop_exact(docs(spark, ROWS[:7]), keep="max")
    assert kept.columns == ["doc_id", "text", "keep_id", "digest", "_id"]
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7]
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


def test_index_grows_and_compacts(spark):
    index = exact_dedup.DigestIndex(spark, keep="min")
    batch = lambda rows: docs(spark, rows).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    index.flush(batch([(5, "a"), (6, "b")]))
    index.flush(batch([(2, "a"), (9, "c")]))
    digest = lambda t: bytes(spark.range(1).select(index.digest(F.lit(t))).first()[0])
    assert [(r.keep_id, r.n) for r in index.lookup([digest("a")]).collect()] == [(2, 2)]
    index.compact()
    assert [(r.keep_id, r.n) for r in index.lookup([digest("a"), digest("no")]).collect()] == [(2, 2)] and len(index.runs) == 1


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_simhash_equals_brute_force(spark):
    rng, rows = random.Random(7), [(900, None), (901, ""), (902, " \t\n"), (903, "ONE two"), (904, "one TWO")]
    for g in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(3, 400))]
        for k in range(8):
            w = list(base)
            for _ in range(k // 2):
                w[rng.randrange(len(w))] = "changed"
            rows.append((g * 8 + k, " ".join(w)))
    rows.append((0, rows[5][1]))
    got = {(r["_id"], r["_fp"]): r["_component"] for r in simhash.near_dedup(docs(spark, rows)).collect()}
    prints = [(i, fingerprint(t)) for i, t in rows]
    parent = {f: f for _, f in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, a in prints:
        for _, b in prints:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for i, f in prints:
        least[root(f)] = min(i, least.get(root(f), 1 << 60))
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    assert got == {(i, signed(f)): least[root(f)] for i, f in prints}


def test_links_are_exact_for_any_blocks(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(6):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 6)):
                q ^= 1 << b
            prints.add(q)
    signed = {f - (1 << 64) if f >> 63 else f for f in prints}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    for blocks in (5, 6, 7):
        pairs = [tuple(r) for r in simhash.links(table, blocks=blocks).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_drop_near_keeps_one_per_group(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(3, text), (1, text), (2, text + " more"), (8, "apart"), (9, None)]
    for limit in (1_000_000, 0):
        monkeypatch.setattr(simhash, "BROADCAST_ROWS", limit)
        out = simhash.drop_near(docs(spark, rows))
        assert sorted(r.doc_id for r in out.collect()) == [1, 8, 9] and out.columns[2:] == ["keep_id", "digest", "_id"]
    assert simhash.near_dedup(docs(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, j) for j in range(501, 560)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in list(parent) if root(x) != x}


def vectors():
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for _ in range(120):
        base = rng.normal(size=16)
        for k in range(rng.integers(1, 5)):
            rows.append((n, (base + rng.normal(size=16) * 0.05 * k).tolist()))
            n += 1
    rows += [(n + i, rows[0][1]) for i in range(40)]
    n += 40
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [math.nan] + [1.0] * 15), (n + 4, [math.inf] + [1.0] * 15), (n + 5, [None] + [1.0] * 15), (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.0])]
    return rows


def test_embedding_links_equal_brute_force(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = [(i, np.array(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    linked = {(i, j) for i, a in good for j, b in good if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95}
    got = {r["_id"]: r for r in embedding_dedup.near_dedup(table, exact=True).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: sum(a == i for a, _ in linked) for i, _ in rows}
    fast = {r["_id"]: r for r in embedding_dedup.near_dedup(table).collect()}
    assert sum(r.n_links for r in fast.values()) >= 0.9 * len(linked)
    assert all(r.kept == (r["_id"] == r.component_id) for r in fast.values())


def test_embeddings_in_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 20)
    monkeypatch.setattr(embedding_dedup, "OWN_BLOCK", 8)
    monkeypatch.setattr(embedding_dedup, "OTHER_BLOCK", 16)
    rows = [r for r in vectors() if r[1] and len(r[1]) == 16]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = [(i, np.array(v)) for i, v in rows if all(x is not None and math.isfinite(x) for x in v) and any(v)]
    want = {i: 0 for i, _ in rows}
    for i, a in good:
        want[i] = sum(a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95 for _, b in good) - 1
    got = {r["_id"]: r.n_links for r in embedding_dedup.near_dedup(table, exact=True).collect()}
    assert got == want
    assert embedding_dedup.near_dedup(table.limit(0)).count() == 0


def test_links_halved_by_a_border_are_found(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 3)
    # A circle in 64 dimensions whose neighbours are linked; two cells cut it between neighbours.
    rows = [(i, [math.cos(i * math.pi / 10), math.sin(i * math.pi / 10)] + [0.0] * 62) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["_id"]: (r.n_links, r.component_id) for r in embedding_dedup.near_dedup(table).collect()}
    assert got == {i: (2, 0) for i in range(20)}
