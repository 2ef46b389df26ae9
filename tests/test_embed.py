"""The stand-in embedder against its definition, character pair by character pair."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from codexloom.operators import embed


def by_definition(text, dimension):
    row = np.zeros(dimension)
    for a, b in zip(text, text[1:], strict=False):
        h = int.from_bytes(hashlib.blake2b((a + b).encode(), digest_size=8).digest(), "little")
        row[h % dimension] += 1 if h >> 63 else -1
    return (row / max(float(np.linalg.norm(row)), 1e-12)).astype(np.float32)


@pytest.mark.parametrize(("slice_", "pairs"), [(1 << 20, 1 << 20), (3, 5), (1, 0)])
def test_vectors_are_those_of_the_definition(monkeypatch, slice_, pairs):
    monkeypatch.setattr(embed, "_SLICE", slice_)
    monkeypatch.setattr(embed, "_PAIRS", pairs)
    rng = random.Random(3)
    texts = ["", "a", "ab", "中文😀", "\x00\x00"] + ["".join(rng.choice("abc 中😀\n") for _ in range(rng.randint(0, 90))) for _ in range(60)]
    got = embed.hash_embedder(16).start()(pa.array(texts)).to_pylist()
    assert np.array_equal(np.array(got, np.float32), np.stack([by_definition(t, 16) for t in texts]))


def test_a_pair_is_hashed_once(monkeypatch):
    asked, real = [], hashlib.blake2b
    monkeypatch.setattr(embed.hashlib, "blake2b", lambda x, **o: asked.append(x) or real(x, **o))
    embed.hash_embedder(16).start()(pa.array(["abab" * 100, "ba" * 100]))
    assert sorted(asked) == [b"ab", b"ba"]
