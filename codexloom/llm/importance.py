"""Quality by importance resampling.

Two hashed n-gram models are counted: of the target, the documents labelled good, and of raw text, all documents. Words
are runs of letters or single other characters, in lower case; words and neighbouring pairs are hashed into
`buckets` buckets. A document's weight is the likelihood ratio of its n-grams under both models; its Gumbel key is the
log weight plus Gumbel noise drawn from a hash of its identifier and the seed. The k documents with the largest keys are
a sample without replacement by weight.

Counts cover every document whole and are sums of fixed-size vectors, so what is gathered has `buckets` numbers whatever
the input. The k-th largest key is found exactly by counting keys in 2**16 ranges, then in the ranges inside the one
that holds it, four times; no sort and no list of keys is needed.

Cases: a null or empty text has no n-grams and log weight 0. Rows that repeat draw the same noise, so copies with the
same identifier are kept or left together, and ties at the border all stay. A null identifier draws as the empty
string. Without good labels every log weight is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.session import written

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
#: Words whose hash a worker remembers.
MEMORY = 300_000
#: Identifiers of the target are broadcast up to this many (some 70 bytes each when they are unpacked), else joined by
#: shuffle.
BROADCAST_ROWS = 500_000


class Features:
    """Hashed counts of words and neighbouring pairs."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def of(self, text: str | None) -> np.ndarray:
        """The bucket of every n-gram of text, repeats included."""
        words = _WORD.findall((text or "").lower())
        if not words:
            return np.zeros(0, np.int64)
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.known.clear()
            new = set(words)
        for w in new:
            self.known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
        mixed = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return (np.append(mixed, pair) % np.uint64(self.buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of docs (text, good): the n-gram counts of the good rows and of all rows, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets), np.zeros((2, buckets), np.int64)
        for b in batches:
            for t, good in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                n = np.bincount(features.of(t.as_py()), minlength=buckets)
                total[1] += n
                if good:
                    total[0] += n
        hit = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[0][hit]), pa.array(total[1][hit])], ["bucket", "good", "n"])

    summed = docs.mapInArrow(run, "bucket int, good long, n long").groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).toArrow()
    good, raw = np.zeros(buckets), np.zeros(buckets)
    good[summed["bucket"].to_numpy()], raw[summed["bucket"].to_numpy()] = summed["good"].to_numpy(), summed["n"].to_numpy()
    return good, raw


def log_ratio(target: np.ndarray, raw: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Per bucket the log of its share in the target over its share in raw text."""
    if not target.any():
        return np.zeros(len(raw))
    share = lambda x: (x + smooth) / (x.sum() + smooth * len(x))
    return np.log(share(target)) - np.log(share(raw))


def log_weights(text: Column, ratio: np.ndarray) -> Column:
    """n_grams and log_weight of a text column."""
    buckets = len(ratio)

    @F.arrow_udf("struct<n_grams:long,log_weight:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(buckets)
        for texts in batches:
            found = [features.of(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([len(f) for f in found], pa.int64()), pa.array([float(ratio[f].sum()) for f in found], pa.float64())], ["n_grams", "log_weight"])

    return run(text)


def gumbel(id_col: str, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the identifier and the seed."""
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed)), 11)
    return -F.log(-F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))))


def _ordered(key: Column) -> Column:
    """A long from 0 that orders as the double does, in steps of 2**-29."""
    return F.floor((F.greatest(F.lit(-4e9), F.least(F.lit(4e9), key)) + F.lit(4e9)) * F.lit(float(1 << 29))).cast("long")


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """Of one column `_o` of longs from 0, the k-th largest value; None if there are fewer."""
    low = 0
    for width in (48, 32, 16, 0):
        inside = keys if width == 48 else keys.where(F.shiftright("_o", width + 16) == low >> (width + 16))
        counts = sorted(((int(r["b"]), int(r["n"])) for r in inside.groupBy(F.shiftright("_o", width).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
        for b, n in counts:
            if k <= n:
                low = b << width
                break
            k -= n
        else:
            return None
    return low


def resample(docs: DataFrame, good_ids: DataFrame, *, keep_share: float, id_col: str = "doc_id", text_col: str = "text", buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """Per row of docs: `_id`, n_grams, log_weight, gumbel_key, kept. good_ids: one column, the target's identifiers."""
    good = good_ids.toDF("_good").where("_good IS NOT NULL").distinct()
    if good.count() <= BROADCAST_ROWS:
        good = F.broadcast(good)
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(good, F.col("_id") == F.col("_good"), "left")
    ratio = log_ratio(*bucket_counts(marked.select("_text", F.col("_good").isNotNull().alias("good")), buckets))
    scored = docs.select(F.col(id_col).alias("_id"), log_weights(F.col(text_col), ratio).alias("_w")).select("_id", "_w.*")
    scored = written(scored.withColumn("gumbel_key", F.col("log_weight") + gumbel("_id", seed)), "weights")
    k = round(scored.count() * keep_share)
    ordered = scored.withColumn("_o", _ordered(F.col("gumbel_key")))
    border = kth_largest(ordered.select("_o"), k) if k > 0 else None
    kept = F.lit(k > 0) if border is None else F.col("_o") >= border
    return ordered.withColumn("kept", kept).drop("_o")


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    n, good = labels.agg(F.count("quality"), F.coalesce(F.sum("quality"), F.lit(0))).first()
    return resample(docs, labels.where("quality = 1").select("doc_id"), keep_share=good / n if n else 1.0).withColumnRenamed("_id", "doc_id")
