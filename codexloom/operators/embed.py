"""Embeddings as a plug-in: a function from batches of texts to batches of vectors, made on each worker."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Texts of an Arrow batch to their vectors.
Vectors = Callable[[pa.Array], pa.Array]


@dataclass(frozen=True)
class Embedder:
    """What a manifest states of a provider, and `start`, which a worker calls once for the function that it applies to
    its batches. Without a dimension there are no vectors, and no worker is asked."""

    model_name: str = "none"
    dimension: int = 0
    normalize: bool = False
    start: Callable[[], Vectors] | None = None


#: No embedding: empty vectors, as packs for inspection have them.
NO_EMBEDDING = Embedder()


def _vectors(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows, np.float32)
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float32()))


#: Texts' characters whose pairs are looked up at a time, and distinct pairs that a worker remembers.
_SLICE, _PAIRS = 1 << 20, 1 << 20


def hash_embedder(dimension: int = 64) -> Embedder:
    """A stand-in for tests: signed hashes of character pairs, of unit length. It knows no meaning. A worker hashes each
    distinct pair once."""

    def start() -> Vectors:
        # Distinct pairs, sorted, as one number each, and the signed place (from 1) that each adds to.
        known, places = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def place(pair: int) -> int:
            h = int.from_bytes(hashlib.blake2b((chr(pair >> 32) + chr(pair & 0xFFFFFFFF)).encode(), digest_size=8).digest(), "little")
            return (h % dimension + 1) * (1 if h >> 63 else -1)

        def counted(text: str) -> np.ndarray:
            nonlocal known, places
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            pairs, times = np.unique(codes[:-1] << np.uint64(32) | codes[1:], return_counts=True)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            new = pairs[known[at] != pairs] if len(known) else pairs
            if len(new):
                if len(known) > _PAIRS:
                    known, places, new = known[:0], places[:0], pairs
                order = np.argsort(both := np.concatenate([known, new]))
                known, places = both[order], np.concatenate([places, np.array([place(p) for p in new.tolist()], np.int64)])[order]
                at = np.searchsorted(known, pairs)
            told = places[at] if len(pairs) else places[:0]
            return np.bincount(np.abs(told) - 1, np.sign(told) * times, dimension)

        def of(text: str) -> np.ndarray:
            # A slice goes on one character into the next, so each pair is in one of them.
            row = np.zeros(dimension)
            for i in range(0, len(text) - 1, _SLICE):
                row += counted(text[i : i + _SLICE + 1])
            return row / max(float(np.linalg.norm(row)), 1e-12)

        return lambda texts: _vectors(np.stack([of(t.as_py()) for t in texts]) if len(texts) else np.zeros((0, dimension)))

    return Embedder(f"hash-{dimension}", dimension, True, start)


def model_embedder(model_name: str, dimension: int, *, normalize: bool = True, batch_size: int = 16) -> Embedder:
    """A sentence-transformers model of that dimension. Each worker loads it; the driver needs neither the library nor
    the model's files."""

    def start() -> Vectors:
        try:
            from sentence_transformers import SentenceTransformer
        except ImportError as e:
            raise RuntimeError("sentence-transformers is not installed on the workers; build without embedding or give another Embedder") from e
        model = SentenceTransformer(model_name)
        return lambda texts: _vectors(np.asarray(model.encode(texts.to_pylist(), batch_size=batch_size, normalize_embeddings=normalize)).reshape(len(texts), dimension))

    return Embedder(model_name, dimension, normalize, start)


def embedding(text: Column, embedder: Embedder = NO_EMBEDDING) -> Column:
    if not embedder.dimension:
        return F.array().cast("array<float>")

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vectors = embedder.start()
        for texts in batches:
            yield vectors(pc.fill_null(texts, ""))

    return run(text)


def l2_normalize(vector: Column) -> Column:
    v = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: F.when(norm > 0, x / F.nullif(norm, F.lit(0.0))).otherwise(x))
