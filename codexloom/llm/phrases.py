"""Phrase collocations by pivots.

Texts fall into pieces at punctuation and line ends, pieces into words. Words are ordered by how often they occur, and an
n-gram belongs to its pivot, its rarest word (of equals the one with the larger bytes; of its repeats the first). Every
occurrence of a word is routed to that word with the words beside it, rewritten: the context ends where a word is rarer
than the pivot, too rare to be part of any phrase, or, to the left, the pivot itself. So a fragment holds exactly the
n-grams that the occurrence owns. Equal fragments are folded before they are sent. Where they arrive, n-grams are counted
and weighed against the least count at once, since no other pivot has any part in them.

Common words get few distinct fragments, as all rarer words are cut off. A pivot that still has more than a part of a
task's share of words is dealt to several groups by the hash of its fragments, whose counts are added up afterwards.

The order needs counts of words everywhere. They are broadcast as hashes and counts of 16 bytes each, of at most `RANKED`
words, the most frequent; all others count as rarer than those and are ordered by their bytes. Any order that is the same
everywhere gives the same phrases, so neither that bound nor equal hashes change the result.

Cases: a null or empty text has no words, a null language is `und`. Rows that repeat count each time. Identifiers are not
read. A word of any length is a word. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexloom.session import written

#: Words whose counts are broadcast (16 MB).
RANKED = 1 << 20
#: Counts of phrases that are broadcast (with phrases up to `SHORT` bytes); the others are joined by shuffle.
HOT, SHORT = 20_000, 128
#: Ranges of scores that are broadcast, some hundred per language; more are joined by shuffle.
STEPS = 100_000
#: Word occurrences that a worker folds at a time.
SLICE = 1 << 20
#: Fragments of a pivot up to which it is one group, whatever the input.
GROUP = 1 << 14
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


class _Numbers(dict):
    """Words by number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Gathered:
    """Words of texts of one language, with -1 between pieces."""

    def __init__(self) -> None:
        self.known, self.ids = _Numbers(), []

    def add(self, text: bytes) -> None:
        known, ids = self.known, self.ids
        for piece in text.lower().translate(_ENDS).split(b"\n"):
            if words := piece.split():
                ids.extend([known[w] for w in words])
                ids.append(-1)


def gathered(batches: Iterator[pa.RecordBatch], most: int = SLICE) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Of batches (lang, text): language, its words and their occurrences by number, some `most` of all at a time."""
    by_lang: dict[str, Gathered] = {}

    def out() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, g in by_lang.items():
            if g.ids:
                yield lang, list(g.known), np.array(g.ids, np.int32)
        by_lang.clear()

    size = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
            g = by_lang.get(lang) or by_lang.setdefault(lang, Gathered())
            before = len(g.ids)
            g.add(text.as_py())
            size += len(g.ids) - before
            if size >= most:
                yield from out()
                size = 0
    yield from out()


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def word_counts(rows: DataFrame) -> DataFrame:
    """Of rows (lang, text): lang, phrase (a word), n; a null word has the number of all words of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in gathered(batches):
            n = np.bincount(ids[ids >= 0], minlength=len(words))
            told = pa.concat_arrays([_strings(words), pa.nulls(1, pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(words) + 1), pa.string()), told, pa.array(np.append(n, n.sum()), pa.int64())], ["lang", "phrase", "n"])

    return rows.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def at_most(counts: DataFrame, most: int) -> int:
    """The least count from which on counts (n) has at most `most` rows, found by a histogram of powers of 2**(1/16)."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    total = 0
    for b, rows in sorted(((r["b"], r["rows"]) for r in counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True):
        total += rows
        if total > most:
            return int(np.ceil(2 ** ((b + 1) / 16) - 1e-9))
    return 0


class Order:
    """How often words occur, by their hashes."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, complete: bool):
        at = np.argsort(keys, kind="stable")
        self.keys, self.n, self.complete = keys[at], n[at], complete

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Counts of words; 0 for those that aren't listed."""
        if not len(self.keys):
            return np.zeros(len(words), np.int64)
        head, h = lang.encode() + b" ", xxhash.xxh64_intdigest
        asked = np.fromiter((h(head + w, 42) for w in words), np.uint64, len(words)).view(np.int64)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.n[at], 0)


def order_of(words: DataFrame) -> Order:
    """The order that the most frequent of words (lang, phrase, n) have."""
    least = at_most(words, RANKED)
    t = words.where(F.col("n") >= least).select(F.xxhash64(F.concat("lang", F.lit(" "), "phrase")).alias("key"), "n").toArrow()
    return Order(t["key"].to_numpy(), t["n"].to_numpy(), least == 0)


def rewritten(ids: np.ndarray, rank: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Fragments and how often each occurs. A fragment is a row: pivot, the words before it from the nearest on, the words
    after it; -1 stands for none. rank: a word's place in the order, -1 for words that no phrase holds."""
    r = np.where(ids >= 0, rank[ids], -1)
    n = len(r)
    padded = np.concatenate([np.full(reach, -1, r.dtype), r, np.full(reach, -1, r.dtype)])
    columns = [r]
    for side in (-1, 1):
        open_ = r >= 0
        for k in range(1, reach + 1):
            other = padded[reach + side * k : reach + side * k + n]
            open_ = open_ & (other >= 0) & ((other < r) if side < 0 else (other <= r))
            columns.append(np.where(open_, other, -1))
    some = (columns[1] >= 0) | (columns[1 + reach] >= 0)
    rows = np.stack([c[some] for c in columns], axis=1)
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    # Equal rows are found by sorting them as few long numbers.
    bits = int(rows.max() + 1).bit_length()
    per = max(1, 63 // bits)
    keys = []
    for i in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), np.int64)
        for c in rows[:, i : i + per].T:
            key = (key << bits) | (c.astype(np.int64) + 1)
        keys.append(key)
    by = np.lexsort(keys)
    new = np.append(True, np.any([k[by][1:] != k[by][:-1] for k in keys], axis=0))
    first = np.flatnonzero(new)
    return rows[by[first]], np.diff(np.append(first, len(rows)))


def fragments(rows: DataFrame, order: Order, reach: int) -> DataFrame:
    """Of rows (lang, text): lang, p (pivot), l1… and r1… (words beside it), f (its count, 0 if unlisted), n."""
    sides = [f"{s}{k}" for s in "lr" for k in range(1, reach + 1)]
    told = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = told.value
        for lang, words, ids in gathered(batches):
            f = order.of(lang, words)
            listed = [i for i in range(len(words)) if f[i] or not order.complete]
            listed.sort(key=lambda i: (-f[i], words[i]))
            rank = np.full(len(words), -1, np.int32)
            rank[listed] = np.arange(len(listed), dtype=np.int32)
            found, n = rewritten(ids, rank, reach)
            named, count = _strings([words[i] for i in listed]), f[listed]
            for i in range(0, len(found), 65_536):
                some = found[i : i + 65_536]
                columns = [named.take(pa.array(np.maximum(c, 0), mask=c < 0)) for c in some.T]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), *columns, pa.array(count[some[:, 0]]), pa.array(n[i : i + 65_536])], ["lang", "p", *sides, "f", "n"])

    return rows.mapInArrow(run, ", ".join(f"{c} string" for c in ("lang", "p", *sides)) + ", f long, n long")


def owned(reach: int) -> Column:
    """The n-grams of a fragment that hold its pivot; null in place of those that it is too short for."""
    grams = []
    for size in range(2, reach + 2):
        for before in range(size):
            words = [*[f"l{k}" for k in range(before, 0, -1)], "p", *[f"r{k}" for k in range(1, size - before)]]
            grams.append(F.concat(*[x for w in words for x in (F.lit(" "), F.col(w))][1:]))
    return F.array(*grams)


def mined(rows: DataFrame, order: Order, share: int, *, most: int, least: int) -> DataFrame:
    """lang, phrase, n of the phrases of 2 to `most` words that occur `least` times. share: occurrences of a pivot up to
    which it is one group."""
    reach = most - 1
    beside = [f"{s}{k}" for s in "lr" for k in range(1, reach + 1)]
    # A group is known by a hash of its pivot; that of a pivot in several groups is negative.
    one = F.shiftrightunsigned(F.hash("lang", "p"), 1)
    several = -F.shiftrightunsigned(F.hash("lang", "p", F.pmod(F.xxhash64(*beside), F.ceil(F.col("f") / share))), 1) - 1
    routed = fragments(rows, order, reach).withColumn("group", F.when(F.col("f") <= share, one).otherwise(several)).repartition("group")
    grams = routed.select("group", "lang", "n", F.explode(owned(reach)).alias("phrase")).where("phrase IS NOT NULL")
    local = grams.groupBy("group", "lang", "phrase").agg(F.sum("n").alias("n"))
    return local.where((F.col("group") < 0) | (F.col("n") >= least)).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """parts (lang, part, …) with n of counts (lang, phrase, n), which has every part. The most frequent counts, which most
    parts ask for, are broadcast."""
    short = counts.where(F.octet_length("phrase") <= SHORT)
    named = counts.select("lang", F.col("phrase").alias("part"), "n")
    hot = F.broadcast(named.where((F.octet_length("part") <= SHORT) & (F.col("n") >= at_most(short, HOT))))
    rest = parts.join(hot, ["lang", "part"], "left_anti").join(named, ["lang", "part"])
    return parts.join(hot, ["lang", "part"]).unionByName(rest)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a * a / (left * right)), exact for counts of up to 15 digits."""
    d = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (d(a) * d(a)), d(left) * d(right))


def scored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """found (lang, phrase, n) as lang, phrase, a, l, r, score of the cut with the lowest score, the first of equals."""
    words = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", F.col("n").alias("a"), words.alias("w")).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    both = F.array(F.struct((2 * F.col("k")).alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("part")), F.struct((2 * F.col("k") + 1).alias("side"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("part")))
    parts = cuts.select("lang", "phrase", "a", F.inline(both))
    sides = _counted(parts, counts).groupBy("lang", "phrase", "a").agg(F.map_from_entries(F.collect_list(F.struct("side", "n"))).alias("m"))
    cut = F.transform(F.sequence(F.lit(1), (F.size("m") / 2).cast("int")), lambda k: F.struct(k.alias("k"), F.element_at("m", 2 * k).alias("l"), F.element_at("m", 2 * k + 1).alias("r")))
    told = sides.select("lang", "phrase", "a", F.explode(cut).alias("c")).select("lang", "phrase", "a", score(F.col("a"), F.col("c.l"), F.col("c.r")).alias("score"), F.col("c.k").alias("k"), "c.l", "c.r")
    best = told.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def absorbed(found: DataFrame, percent: int) -> DataFrame:
    """The phrases of found (lang, phrase, n) that a longer one holds with percent or more of their count: lang, phrase."""
    w = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    longer = found.withColumn("w", w).where(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("_most"))
    return longer.join(found, ["lang", "phrase"]).where(F.col("_most").cast("decimal(20,0)") * 100 >= F.col("n").cast("decimal(20,0)") * percent).select("lang", "phrase")


def first_of_each(rows: DataFrame, most: int) -> DataFrame:
    """The first `most` of rows (lang, score, a, phrase) of every language, with rank. A histogram of scores first rules out
    what can't be among them; the rest are ranked in parts, then together."""
    step = F.floor(F.log2(F.col("score").cast("double") + 1) * 32).cast("int")
    rows = rows.withColumn("_step", step)
    steps = rows.groupBy("lang", "_step").agg(F.count(F.lit(1)).alias("_n"))
    above = F.sum("_n").over(Window.partitionBy("lang").orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, -1))
    open_ = written(steps.withColumn("_above", F.coalesce(above, F.lit(0))).where(F.col("_above") < most).select("lang", "_step"), "steps")
    if open_.count() <= STEPS:
        open_ = F.broadcast(open_)
    best = [F.desc("score"), F.desc("a"), "phrase"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = rows.join(open_, ["lang", "_step"]).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).where(F.col("rank") <= most)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= most).drop("_step", "_part")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", most_words: int = 3, least: int = 10, percent: int = 50, top: int = 2_000) -> DataFrame:
    """Per language its first `top` phrases of 2 to `most_words` words by score: lang, rank, phrase, a (its count), l and r
    (counts of the parts of its weakest cut), n (all words of the language), score. Phrases that a longer one holds with
    `percent` of their count or more are left out."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = written(word_counts(rows).where(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    totals, words = known.where("phrase IS NULL").select("lang", "n"), known.where("phrase IS NOT NULL")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(GROUP, (totals.agg(F.sum("n")).first()[0] or 0) // (8 * tasks))
    found = written(mined(rows, order_of(words), share, most=most_words, least=least), "phrases")
    out = scored(found, words.unionByName(found)).join(absorbed(found, percent), ["lang", "phrase"], "left_anti")
    return first_of_each(written(out, "scored"), top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by plain counting. Punctuation and line ends part pieces, spaces and tabs words.
OP12_SQL = """
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
words AS (SELECT lang, unnest(ws) AS phrase FROM pieces),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
found AS (
  SELECT lang, phrase, m, count(*) AS a FROM (
    SELECT lang, 2 AS m, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS phrase FROM pieces
    UNION ALL
    SELECT lang, 3 AS m, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS phrase FROM pieces)
  GROUP BY ALL HAVING count(*) >= 10),
counts AS (SELECT lang, phrase, count(*) AS n FROM words GROUP BY ALL UNION ALL SELECT lang, phrase, a FROM found),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM found)),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, s.n AS l, t.n AS r, ((1000000::HUGEINT * c.a * c.a) // (s.n::HUGEINT * t.n))::BIGINT AS score
  FROM cuts c JOIN counts s ON s.lang = c.lang AND s.phrase = c.x JOIN counts t ON t.lang = c.lang AND t.phrase = c.y),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, array_to_string(string_split(phrase, ' ')[1:2], ' ') AS phrase FROM found WHERE m = 3
    UNION ALL SELECT lang, a, array_to_string(string_split(phrase, ' ')[2:3], ' ') FROM found WHERE m = 3) GROUP BY ALL),
kept AS (SELECT w.* FROM weakest w LEFT JOIN inner_ i ON i.lang = w.lang AND i.phrase = w.phrase WHERE i.most IS NULL OR 100 * i.most::HUGEINT < 50 * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
