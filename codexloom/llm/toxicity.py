"""Toxicity by compression distance to two dictionaries.

A zstandard dictionary is trained on ordinary text and one on toxic text. A text's words are cut into windows; each
window is compressed with either dictionary, and it leans toxic by the bytes that the toxic dictionary saves over the
ordinary one. Three points make differences of a few bytes count:

* The trained dictionaries serve as plain content, so literals cost their bytes and only matches save.
* Every window is followed by a fixed tail that both dictionaries hold. A frame of a dozen bytes would otherwise not be
  compressed at all, and the compressor does not look for matches in the last bytes of a frame.
* Toxic documents consist mostly of ordinary words. The toxic dictionary is trained on those windows of toxic documents
  that are in more of them than chance allows, and ten times as frequent as in ordinary ones.

Per text the windows at each threshold are counted; a logistic model, fitted on the training documents, turns the counts
into a score. Labels are read from a bounded sample: at most `sample_rows` documents and `sample_bytes` of text per class,
the first by hash of the identifier, without single texts over a 64th of these bytes. Every text is scored whole.

Cases: null and empty texts have no windows and get the model's score for that, as any text does. Repeated rows get
equal scores. If the training labels lack a class, every score is the share of toxic labels (0 without any label).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The bytes that follow each window, which no text holds together.
TAIL = bytes(range(1, 9)) + b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ#$%&" + bytes(range(14, 20))
#: Windows that lean toxic by at least so many bytes are counted.
THRESHOLDS = tuple(range(1, 9))
#: Remembered windows of a worker; a full memory is emptied.
MEMORY = 200_000


def windows(text: str | None, words: int = 1) -> list[bytes]:
    """Runs of `words` words, A-Z in lower case, each between spaces."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return w if words == 1 else [b" ".join(w[i : i + words]) for i in range(0, len(w), words)]


@dataclass
class Model:
    """All that scoring needs; about 210 kB whatever the input."""

    prior: float = 0.0
    ordinary: bytes = b""
    toxic: bytes = b""
    level: int = 3
    words: int = 1
    weights: list[float] = field(default_factory=list)


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    content += TAIL
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(level, source_size=64, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.seen = model, {}
        if model.weights:
            self.ordinary, self.toxic = _compressor(model.ordinary, model.level), _compressor(model.toxic, model.level)

    def lean(self, window: bytes) -> int:
        framed = b" " + window + b" " + TAIL
        return len(self.ordinary.compress(framed)) - len(self.toxic.compress(framed))

    def counts(self, text: str | None) -> np.ndarray:
        ws, seen = windows(text, self.model.words), self.seen
        if len(seen) > MEMORY:
            seen.clear()
        for w in set(ws).difference(seen):
            seen[w] = self.lean(w)
        leans = np.fromiter(map(seen.__getitem__, ws), np.int64, len(ws))
        return np.array([(leans >= t).sum() for t in THRESHOLDS], float)

    def score(self, text: str | None) -> float:
        if not self.model.weights:
            return self.model.prior
        z = self.model.weights[0] + float(np.log1p(self.counts(text)) @ np.array(self.model.weights[1:]))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _train(size: int, samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself, most frequent first
        out, total = [], 0
        for s, _ in Counter(samples).most_common():
            out.append(s)
            total += len(s)
            if total >= size:
                break
        return b"".join(reversed(out))[-size:]


def _telling(toxic: list[list[bytes]], ordinary: list[list[bytes]], least: float) -> set[bytes]:
    """Windows in more toxic than ordinary documents: a z of `least`, and ten times the share."""
    a, b = Counter(w for d in toxic for w in set(d)), Counter(w for d in ordinary for w in set(d))
    n, m = len(toxic), len(ordinary)

    def z(w: bytes) -> float:
        p = (a[w] + b[w]) / (n + m)
        return (a[w] / n - b[w] / m) / math.sqrt(max(1e-12, p * (1 - p) * (1 / n + 1 / m)))

    return {w for w in a if 10 * b[w] / m <= a[w] / n and z(w) >= least}


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton's method; the intercept comes first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6, *[l2] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[str | None, int]], *, words: int = 1, level: int = 3, ordinary_bytes: int = 200_000, toxic_bytes: int = 8_192, least_z: float = 7.0) -> Model:
    """A model from (text, label) rows."""
    y = np.array([label for _, label in rows], float)
    if len(y) == 0 or y.min() == y.max():
        return Model(prior=float(y.mean()) if len(y) else 0.0)
    docs = [windows(t, words) for t, _ in rows]
    toxic, ordinary = [d for d, k in zip(docs, y, strict=True) if k], [d for d, k in zip(docs, y, strict=True) if not k]
    telling = _telling(toxic, ordinary, least_z)
    # The trainer passes over samples of under eight bytes, so the windows of a document are one sample.
    picked = [b" " + b" ".join(ws) + b" " for d in toxic if len(b" ".join(ws := [w for w in d if w in telling])) >= 12]
    plain = [b" " + b" ".join(d[i : i + 8]) + b" " for d in ordinary for i in range(0, len(d), 8)]
    model = Model(float(y.mean()), _train(ordinary_bytes, plain), _train(toxic_bytes, picked), level, words, [0.0])
    scorer = Scorer(model)
    counts = np.log1p(np.array([scorer.counts(t) for t, _ in rows]))
    model.weights = [float(v) for v in _logistic(counts, y)]
    return model


def fit_table(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", where: Column | None = None, sample_rows: int = 3_000, sample_bytes: int = 64 << 20, **options) -> Model:
    """A model from at most sample_rows labelled documents with sample_bytes per class, taken by hash of the identifier."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id IS NOT NULL AND _y IN (0, 1)")
    if where is not None:
        known = labels.where(where).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id IS NOT NULL AND _y IN (0, 1)")
    picked = None
    for k in (0, 1):
        part = known.where(F.col("_y") == k).distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(picked), "_id")
    rows = rows.withColumn("_n", F.octet_length("_text")).where(F.col("_n") <= sample_bytes // 64)
    so_far = F.sum("_n").over(Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id", "_text"))
    rows = rows.withColumn("_so_far", so_far).where(F.col("_so_far") <= sample_bytes).select("_text", "_y")
    return fit(sorted((r["_text"], r["_y"]) for r in rows.toLocalIterator()), **options)


def toxicity_score(text: Column, model: Model) -> Column:
    """The score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            yield pa.array([scorer.score(t.as_py()) for t in texts], pa.float64())

    return run(text)


def in_fold(id_col: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def trained_on(spark: SparkSession, sf_dir: str) -> Model:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return fit_table(docs, labels, where=~in_fold())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = docs.select("doc_id", in_fold().alias("held_out"), toxicity_score(F.col("text"), trained_on(spark, sf_dir)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below threshold."""
    return docs.where(toxicity_score(F.col(text_col), model) < threshold)
