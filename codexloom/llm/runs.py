"""Periodic runs of words: passages that repeat themselves three times or more.

A text's words become numbers. For every lag q up to n / exponent the numbers are compared with themselves q places on;
a stretch of equal places of length m is a stretch of m + q words with period q. Many lags are compared at a time, as rows
of one table. A stretch that is long enough is a run unless its words have a smaller period, which then divides q, since
a run holds its period at least twice (Fine and Wilf).

The comparisons grow with the square of a text's words. So texts up to `LONG` bytes are scanned whole, each in one go,
and longer ones are dealt out: a row per text and range of lags, spread over all tasks, whose runs are gathered again.
Runs have an exponent of two or more, so there are fewer of them than words, and a text's runs stay smaller than the text.

Cases: a null, empty or wordless text has no runs, and its collapsed text is empty. Rows that repeat are scanned each by
itself, whatever their identifiers, null included. A word is dropped once, however many runs hold it. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.session import written

#: Bytes up to which a text is scanned in one go.
LONG = 65_536
#: Comparisons that a range of lags makes, but it has `LAGS` lags at least.
RANGE, LAGS = 1 << 26, 4_096
#: Comparisons at a time.
CELLS = 1 << 16
_WORDS = r"[\x20\x09-\x0D]+"
_RUN = "struct<start:long,length:long,period:long>"


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def _primitive(unit: np.ndarray) -> bool:
    """Whether the words of one period are no repetition of fewer."""
    q = len(unit)
    small = [d for d in range(1, int(q**0.5) + 1) if q % d == 0]
    return not any(d < q and np.array_equal(unit[d:], unit[:-d]) for d in {*small, *(q // d for d in small)})


def scan(ids: np.ndarray, first: int = 1, stop: int | None = None, *, least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) with a period from first up to stop, without it."""
    n = len(ids)
    stop = min(n // exponent + 1, n if stop is None else stop)
    if first >= stop:
        return []
    # Numbers past the end equal nothing, so each row of comparisons ends in at least one that fails.
    shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([ids, np.full(stop, -1, ids.dtype)]), n)
    rows, out = max(1, CELLS // n), []
    for lo in range(first, stop, rows):
        equal = np.flatnonzero(shifted[lo : min(stop, lo + rows)] == ids)
        # No stretch can be shorter than that of the first lag here, nor than twice a lag.
        if len(equal) < least * (exponent - 1) // exponent:
            continue
        breaks = np.flatnonzero(np.diff(equal) != 1)
        begins, ends = np.append(0, breaks + 1), np.append(breaks, len(equal) - 1)
        lengths, lag = ends - begins + 1, equal[begins] // n + lo
        for i in np.flatnonzero(lengths + lag >= np.maximum(least, exponent * lag)):
            q, at = int(lag[i]), int(equal[begins[i]] % n)
            if _primitive(ids[at : at + q]):
                out.append((at, int(lengths[i]) + q, q))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that stay, joined by a space: of every run its first period only."""
    if not found:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0))


def _split(texts: pa.Array) -> Iterator[list[bytes]]:
    for t in texts.cast(pa.binary()):
        yield (t.as_py() or b"").split()


def _batch(runs: list[list[tuple[int, int, int]]], collapsed: list[bytes]) -> pa.Array:
    flat = np.array([r for one in runs for r in one], np.int64).reshape(-1, 3)
    items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), items)
    return pa.StructArray.from_arrays([listed, pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def _whole(text: Column, least: int, exponent: int) -> Column:
    @F.arrow_udf(f"struct<runs:array<{_RUN}>,collapsed:string>")
    def run(texts: pa.Array) -> pa.Array:
        runs, collapsed = [], []
        for words in _split(texts):
            runs.append(sorted(scan(word_ids(words), least=least, exponent=exponent), key=lambda r: (r[0], r[2])))
            collapsed.append(collapse(words, runs[-1]))
        return _batch(runs, collapsed)

    return run(text)


def _ranged(text: Column, first: Column, stop: Column, least: int, exponent: int) -> Column:
    @F.arrow_udf(f"array<{_RUN}>")
    def run(texts: pa.Array, firsts: pa.Array, stops: pa.Array) -> pa.Array:
        runs = [scan(word_ids(w), a, b, least=least, exponent=exponent) for w, a, b in zip(_split(texts), firsts.to_pylist(), stops.to_pylist(), strict=True)]
        return _batch(runs, [b""] * len(runs)).field("runs")

    return run(text, first, stop)


def _collapsed(text: Column, runs: Column) -> Column:
    @F.arrow_udf("string")
    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        kept = [collapse(w, [(r["start"], r["length"], r["period"]) for r in f]) for w, f in zip(_split(texts), found.to_pylist(), strict=True)]
        return pa.array(kept, pa.binary()).cast(pa.string())

    return run(text, runs)


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 24, exponent: int = 3) -> DataFrame:
    """Per row of docs: `_id`, runs (start, length, period; by start, then period) and collapsed, the text of which every
    run has kept its first period. Runs have at least `least` words and `exponent` periods, two or more."""
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    is_long = F.coalesce(F.octet_length("_text") > LONG, F.lit(False))
    short = rows.where(~is_long).select("_id", _whole(F.col("_text"), least, exponent).alias("_r")).select("_id", "_r.runs", "_r.collapsed")

    long_ = written(rows.where(is_long).withColumn("_row", F.monotonically_increasing_id()), "long-texts")
    lags = F.floor(F.size(F.split(F.btrim("_text", F.lit(" \t\n\x0b\x0c\r")), _WORDS, -1)) / exponent)
    width = F.greatest(F.lit(LAGS), F.floor(F.lit(RANGE) / F.greatest(F.lit(1), lags * exponent)))
    ranges = long_.withColumn("_width", width).withColumn("_lags", F.greatest(F.lit(1), lags)).withColumn("_first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_lags"), F.col("_width"))))
    # A range is few bytes and much work: the number of tasks is fixed, so that small ones aren't put together again.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = ranges.repartition(tasks, "_row", "_first").select("_row", F.inline(_ranged(F.col("_text"), F.col("_first"), F.col("_first") + F.col("_width"), least, exponent)))
    runs = found.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("_r"))
    ordered = F.transform("_r", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    met = long_.join(runs, "_row", "left").withColumn("runs", F.coalesce(ordered, F.array().cast(f"array<{_RUN}>")))
    return short.unionByName(met.select("_id", "runs", _collapsed(F.col("_text"), F.col("runs")).alias("collapsed")))


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, exactly; of equals the one with the smallest start, then period."""
    more = lambda a, b: b["length"] * a["period"] - a["length"] * b["period"]
    order = lambda a, b: F.when(more(a, b) != 0, F.signum(more(a, b))).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int")
    return F.get(F.array_sort(runs, order), F.lit(0))


def planted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with a text that repeats itself in every tenth document by hash of its identifier: from word a on, the p words
    that begin there follow each other again and again. Where and how often follows from the hash."""
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.filter(F.split(F.col(text_col), _WORDS, -1), lambda w: w != "")

    def again(x: Column) -> Column:
        n, g = F.size(x["w"]), F.floor(x["h"] / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        at = lambda y, i: F.get(y["w"], F.when(i < y["a"], i).otherwise(y["a"] + (i - y["a"]) % y["p"]))
        return F.transform(F.array(F.struct(x["w"].alias("w"), a.alias("a"), p.alias("p"))), lambda y: F.array_join(F.transform(F.sequence(F.lit(0), F.size(y["w"]) - 1), lambda i: at(y, i)), " "))[0]

    made = F.transform(F.array(F.struct(words.alias("w"), h.alias("h"))), lambda x: F.when(F.size(x["w"]) > 0, again(x)))[0]
    return docs.withColumn(text_col, F.when(F.coalesce(h % 10 == 0, F.lit(False)), F.coalesce(made, F.col(text_col))).otherwise(F.col(text_col)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    told = F.transform("runs", lambda r: F.concat(*[x for c in ("start", "length", "period") for x in (r[c].cast("string"), F.lit("\n" if c == "period" else ","))]))
    out = periodic_runs(planted(docs)).withColumn("_best", strongest(F.col("runs")))
    return out.select(
        F.col("_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
