"""Languages of words and texts by a linear-chain conditional random field.

Words are runs of letters. A word's potentials come from its prefixes, suffixes and character n-grams, hashed, from the
word itself and from the lexicon of each language; a matrix of transitions says how languages follow each other. Forward-
backward gives every word a distribution over the languages, given the whole text. A text's language is the one with the
largest mean; that mean is its score.

Learning takes a bounded sample of labelled texts: at most `sample_rows` of a language, `sample_bytes` in all, no text of
over a 64th of them, and the `most_labels` most frequent languages. Half of a language's texts give its lexicon, the other
half sequences in which passages of different languages alternate, so that the weights of lexicon words are not learned
from the texts that made them and transitions learn that languages switch. The likelihood is climbed on the driver; all
that it gathers has that bound. Every text is labelled whole.

Cases: null texts and those without a letter are `und` with score 0, as are all texts where nothing can be learned. Texts
without a language, or held out, teach nothing. Rows that repeat get equal answers; of equal means the language that sorts
first wins. An empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexloom.llm.toxicity import in_fold

UNKNOWN = "und"
BUCKETS = 1 << 17
#: Distinct words whose potentials a worker remembers, their letters, and words that it labels at a time.
MEMORY, LETTERS, SLICE = 300_000, 8 << 20, 1 << 19
#: Words of a text that are swept one after the other.
PIECE = 256
#: Characters of words whose features are made at a time; the runs of a longer word are summed in slices of that size.
BATCH = 200_000
#: Letters of a word in training; a longer one teaches as several words, one after the other.
TAUGHT = 64
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Labels in order; weights per feature and label; transitions and starts; the labels in whose lexicon a word is."""

    labels: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    steps: np.ndarray | None = None
    starts: np.ndarray | None = None
    lexicon: dict[str, list[int]] = field(default_factory=dict)


def words_of(text: str | None) -> list[str]:
    return [w for w in _WORD.findall((text or "").lower()) if w.isascii() or any(map(str.isalpha, w))]


def _mixed(codes: np.ndarray, kind: int) -> np.ndarray:
    """Rows of code points, equally many, as buckets; kind keeps features of different kinds apart."""
    h = np.full(len(codes), 1469598103934665603 + kind, np.uint64)
    for c in codes.T:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def _codes(words: list[str]) -> np.ndarray:
    """The code points of words between marks of their ends."""
    return np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _runs(codes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The runs of k characters at some places, as buckets."""
    return _mixed(np.stack([codes[at + j] for j in range(k)], axis=1), k)


def features(words: list[str], lexicon: dict[str, list[int]], *, runs: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The features of words, one word's after the other's, and how many each has: the word, its first and last 1 to 4
    letters, all its runs of 1 to 3 characters between marks of its ends, the languages whose lexicon has it."""
    codes = _codes(words)
    size = np.array([len(w) + 2 for w in words], np.int64)
    end = np.cumsum(size)
    start, of = end - size, np.repeat(np.arange(len(words)), size)
    owner, found = [np.arange(len(words))], [np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words], np.int64)]
    for k in (1, 2, 3) if runs else ():
        at = np.arange(len(codes) - k + 1)
        at = at[of[at] == of[at + k - 1]]
        owner.append(of[at])
        found.append(_runs(codes, at, k))
    for k in (2, 3, 4, 5):
        some = np.flatnonzero(size > k)
        for first, kind in ((start[some], 10 + k), (end[some] - k, 20 + k)):
            owner.append(some)
            found.append(_mixed(np.stack([codes[first + j] for j in range(k)], axis=1), kind))
    listed = [(i, BUCKETS + k) for i, w in enumerate(words) for k in lexicon.get(w, ())]
    owner.append(np.array([i for i, _ in listed], np.int64))
    found.append(np.array([f for _, f in listed], np.int64))
    owners = np.concatenate(owner)
    return np.concatenate(found)[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


class Rows:
    """Features of words as one flat list with its cuts."""

    def __init__(self, words: list[str], lexicon: dict[str, list[int]]):
        self.flat, self.sizes = features(words, lexicon)
        self.cuts, self.scale = np.append(0, np.cumsum(self.sizes)[:-1]), 1 / np.sqrt(self.sizes)[:, None]

    def potentials(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.flat], self.cuts, axis=0) * self.scale

    def gradient(self, by_word: np.ndarray, size: int) -> np.ndarray:
        spread = np.repeat(by_word * self.scale, self.sizes, axis=0)
        return np.stack([np.bincount(self.flat, spread[:, k], size) for k in range(by_word.shape[1])], axis=1)


def batches_of(words: list[str]) -> Iterator[list[str]]:
    """Consecutive words with some BATCH characters; a longer word is alone."""
    held, size = [], 0
    for w in words:
        if held and size + len(w) + 2 > BATCH:
            yield held
            held, size = [], 0
        held.append(w)
        size += len(w) + 2
    if held:
        yield held


class Table:
    """Features of words, made in batches; what is computed from them needs little more memory than a batch's."""

    def __init__(self, words: list[str], lexicon: dict[str, list[int]]):
        self.rows = [Rows(some, lexicon) for some in batches_of(words)]
        self.ends = np.cumsum([len(r.sizes) for r in self.rows])

    def potentials(self, weights: np.ndarray) -> np.ndarray:
        return np.concatenate([r.potentials(weights) for r in self.rows])

    def gradient(self, by_word: np.ndarray, size: int) -> np.ndarray:
        return sum(r.gradient(part, size) for r, part in zip(self.rows, np.split(by_word, self.ends[:-1]), strict=True))


def potentials(words: list[str], model: Model) -> np.ndarray:
    """The potentials of words of any length."""
    return np.concatenate([_long(some[0], model) if len(some[0]) + 2 > BATCH else Rows(some, model.lexicon).potentials(model.weights) for some in batches_of(words)])


def _long(word: str, model: Model) -> np.ndarray:
    """The potentials of one word; its runs are summed slice by slice."""
    flat, size = features([word], model.lexicon, runs=False)
    total, n = model.weights[flat].sum(axis=0, dtype=np.float64), int(size[0])
    codes = _codes([word])
    for k in (1, 2, 3):
        for i in range(0, len(codes) - k + 1, BATCH):
            at = np.arange(i, min(i + BATCH, len(codes) - k + 1))
            total += model.weights[_runs(codes, at, k)].sum(axis=0, dtype=np.float64)
            n += len(at)
    return (total / np.sqrt(n))[None]


def _at_work(sizes: np.ndarray) -> np.ndarray:
    """Of sequences, the longest first, how many have a first, second, … word."""
    return np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")


def sweep(e: np.ndarray, at: np.ndarray, sizes: np.ndarray, step: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of sequences at places of e (the exponentials of words' potentials): every word's distribution, the expected
    transitions and the log of what the words' vectors were divided by. first: the vectors that meet a sequence's first
    word; last: those behind its last one. All sequences take a step together, the longest first, so that those at work are
    the first ones."""
    order = np.argsort(-sizes, kind="stable")
    size, at, first, last = sizes[order], at[order], first[order], last[order]
    active, ahead, log_sum, a = _at_work(size), np.empty_like(e), 0.0, None
    for t, n in enumerate(active):
        here = at[:n] + t
        a = (first[:n] if a is None else a[:n] @ step) * e[here]
        total = a.sum(axis=1, keepdims=True)
        a = a / total
        ahead[here] = a
        log_sum += float(np.log(total).sum())
    out, expected, b = np.empty_like(e), np.zeros_like(step), last[:0]
    for t in range(len(active) - 1, -1, -1):
        n, here = active[t], at[: active[t]] + t
        if len(b):
            later = e[here[: len(b)] + 1] * b
            pair, after = ahead[here[: len(b)]], later @ step.T
            expected += step * (pair.T @ (later / (pair * after).sum(axis=1, keepdims=True)))
            b = after / after.sum(axis=1, keepdims=True)
        b = np.concatenate([b, last[len(b) : n]])
        p = ahead[here] * b
        out[here] = p / p.sum(axis=1, keepdims=True)
    return out, expected, log_sum


def _transfers(e: np.ndarray, at: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Per sequence the matrix, up to a factor, that leads from its first word to its last."""
    order = np.argsort(-sizes, kind="stable")
    m = np.repeat(np.eye(len(step))[None], len(sizes), axis=0)
    for t, n in enumerate(_at_work(sizes[order])):
        if t:
            some = (m[:n] @ step) * e[at[order[:n]] + t][:, None, :]
            m[:n] = some / some.sum(axis=(1, 2), keepdims=True)
    out = np.empty_like(m)
    out[order] = m
    return out


def forward_backward(potentials: np.ndarray, sizes: np.ndarray, steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of sequences laid one after the other every word's distribution. Sequences longer than `PIECE` are cut: each piece's
    matrix tells what it hands on in either direction, then all pieces are swept at once. The cuts change nothing."""
    e = np.exp(potentials - potentials.max(axis=1, keepdims=True))
    step, begin = np.exp(steps), np.exp(starts)
    pieces = -(-sizes // PIECE)
    doc = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = np.repeat(np.cumsum(sizes) - sizes, pieces) + nth * PIECE
    size = np.minimum(PIECE, np.repeat(sizes, pieces) - nth * PIECE)
    first, last = np.tile(begin, (len(doc), 1)), np.ones((len(doc), len(step)))
    cut = np.flatnonzero(np.repeat(pieces, pieces) > 1)
    if len(cut):
        m = np.zeros((len(doc), len(step), len(step)))
        m[cut] = _transfers(e, at[cut], size[cut], step)
        unit = lambda v: v / v.sum(axis=1, keepdims=True)
        for k in range(int(pieces.max()) - 1):
            some = cut[(nth[cut] == k) & (nth[cut] + 1 < pieces[doc[cut]])]
            first[some + 1] = unit(unit(((first[some] * e[at[some]])[:, None, :] @ m[some])[:, 0]) @ step)
        for k in range(int(pieces.max()) - 1, 0, -1):
            some = cut[nth[cut] == k]
            last[some - 1] = unit((e[at[some]] * (m[some] @ last[some][:, :, None])[:, :, 0]) @ step.T)
    return sweep(e, at, size, step, first, last)[0]


def lexicons(docs: list[list[list[str]]], least: int = 3, share: float = 0.8) -> dict[str, list[int]]:
    """Words that `least` texts of a language have and of all texts with them a share of `share`."""
    by_label = [Counter(w for d in some for w in set(d)) for some in docs]
    all_ = sum(by_label, Counter())
    found: dict[str, list[int]] = {}
    for k, counts in enumerate(by_label):
        for w, n in counts.items():
            if n >= least and n >= share * all_[w]:
                found.setdefault(w, []).append(k)
    return found


def switched(docs: list[list[list[str]]], sequences: int, length: int, rng: random.Random) -> tuple[list[str], np.ndarray]:
    """Words and labels of sequences in which passages of the languages' texts alternate."""
    words, gold = [], []
    for _ in range(sequences):
        left = length
        while left:
            k = rng.randrange(len(docs))
            text = rng.choice(docs[k])
            n = min(left, rng.randint(8, 48), len(text))
            begin = rng.randint(0, len(text) - n)
            words += text[begin : begin + n]
            gold += [k] * n
            left -= n
    return words, np.array(gold)


def fit(rows: list[tuple[str | None, str]], *, sequences: int = 2_000, length: int = 64, rounds: int = 60, rate: float = 0.3, l2: float = 1e-5, seed: int = 7) -> Model:
    """A model from (text, language) rows."""
    by_label: dict[str, list[list[str]]] = {}
    for text, label in rows:
        if w := words_of(text):
            by_label.setdefault(label, []).append([x[i : i + TAUGHT] for x in w for i in range(0, len(x), TAUGHT)])
    labels = sorted(by_label)
    if not labels:
        return Model()
    docs = [by_label[k] for k in labels]
    lexicon = lexicons([d[::2] for d in docs])
    words, gold = switched([d[1::2] or d for d in docs], sequences, length, random.Random(seed))
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, table, n = np.array([known[w] for w in words]), Table(list(known), lexicon), len(labels)
    size, shape = np.full(sequences, length), (BUCKETS + n, n)
    inside = np.arange(len(ids)) % length > 0
    told = np.zeros((n, n))
    np.add.at(told, (gold[:-1][inside[1:]], gold[1:][inside[1:]]), 1)
    first = np.bincount(gold[~inside], minlength=n)
    one = np.zeros((len(ids), n))
    one[np.arange(len(ids)), gold] = 1
    params = [np.zeros(shape), np.zeros((n, n)), np.zeros(n)]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, rounds + 1):  # steps of Adam on the whole sample
        z = table.potentials(params[0])[ids]
        begin = np.tile(np.exp(params[2]), (sequences, 1))
        p, pairs, _ = sweep(np.exp(z - z.max(axis=1, keepdims=True)), np.arange(sequences) * length, size, np.exp(params[1]), begin, np.ones_like(begin))
        by_word = np.stack([np.bincount(ids, (one - p)[:, j], len(known)) for j in range(n)], axis=1)
        up = [table.gradient(by_word, shape[0]), told - pairs, first - p[~inside].sum(axis=0)]
        for x, g, m, s in zip(params, up, mean, square, strict=True):
            g = g / len(ids) - l2 * x
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            x += rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8) * (1 - 0.9 * k / rounds)
    return Model(labels, params[0].astype(np.float32), params[1], params[2], lexicon)


class Labeller:
    """Labels texts, remembering words' potentials."""

    def __init__(self, model: Model):
        self.model, self.known, self.table, self.letters = model, {}, np.zeros((0, len(model.labels))), 0

    def distributions(self, texts: list[list[str]]) -> np.ndarray:
        """Distributions of all words of texts, one after the other."""
        if len(self.known) > MEMORY or self.letters > LETTERS:
            self.known, self.table, self.letters = {}, self.table[:0], 0
        known = self.known
        new = list({w: None for t in texts for w in t if w not in known})
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.table = np.concatenate([self.table, potentials(new, self.model)])
            self.letters += sum(map(len, new))
        ids = np.fromiter((known[w] for t in texts for w in t), np.int64, sum(map(len, texts)))
        return forward_backward(self.table[ids], np.array([len(t) for t in texts]), self.model.steps, self.model.starts)


def _labelled(batches: Iterator[pa.Array], model: Model, spans: bool) -> Iterator[pa.Array]:
    labeller = Labeller(model)

    def one(texts: list[list[str]]) -> Iterator[tuple]:
        some = [t for t in texts if t] if model.labels else []
        p = labeller.distributions(some) if some else np.zeros((0, 1))
        ends, best, means = np.cumsum([len(t) for t in some]), p.argmax(axis=1), iter(())
        if some:
            means = iter(np.add.reduceat(p, np.append(0, ends[:-1]), axis=0) / np.array([len(t) for t in some])[:, None])
        end = 0
        for t in texts:
            if not t or not model.labels:
                yield UNKNOWN, 0.0, []
                continue
            m, begin, end = next(means), end, end + len(t)
            k, said = int(m.argmax()), []
            if spans:
                own = best[begin:end]
                cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
                said = [{"lang": model.labels[own[a]], "start": a, "length": b - a} for a, b in zip(cuts, cuts[1:], strict=False)]
            yield model.labels[k], min(1.0, max(0.0, float(m[k]))), said

    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("length", pa.int64())])))])
    for batch in batches:
        rows, texts, size = [], [], 0
        for t in batch:
            texts.append(words_of(t.as_py()))
            size += len(texts[-1])
            if size >= SLICE:
                rows += one(texts)
                texts, size = [], 0
        rows += one(texts)
        yield pa.array([{"lang_pred": a, "score": b, "spans": c} for a, b, c in rows], kind)


def language(text: Column, model: Model, *, spans: bool = False) -> Column:
    """struct<lang_pred, score, spans>: a text's language and, if asked for, its passages (language, number of the first
    word, words) as the words' likeliest languages make them."""

    @F.arrow_udf("struct<lang_pred:string,score:double,spans:array<struct<lang:string,start:long,length:long>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _labelled(batches, model, spans)

    return run(text)


def fit_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", where: Column | None = None, sample_rows: int = 400, sample_bytes: int = 32 << 20, most_labels: int = 256, **options) -> Model:
    """A model from a sample of docs, drawn by hash of identifier and text."""
    rows = docs if where is None else docs.where(where)
    rows = rows.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h")).where(F.col("_lang").isNotNull() & (F.octet_length("_text") <= sample_bytes // 64) & F.col("_text").rlike(r"\p{L}"))
    counts = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_lang").limit(most_labels)
    counts = rows.sparkSession.createDataFrame(counts.collect(), counts.schema)
    # By hash some two times as many as wanted, whatever the size of the language, then the first of those.
    share = F.shiftrightunsigned("_h", 33).cast("double") / F.lit(float(1 << 31)) * F.col("_n") < 2 * sample_rows + 50
    some = rows.join(F.broadcast(counts), "_lang").where(share)
    order = Window.partitionBy("_lang").orderBy("_h", "_text")
    some = some.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= sample_rows)
    some = some.withColumn("_bytes", F.sum(F.octet_length("_text")).over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_bytes") <= F.lit(sample_bytes) / max(1, counts.count()))
    return fit([(r["_text"], r["_lang"]) for r in some.orderBy("_lang", "_k").select("_text", "_lang").toLocalIterator()], **options)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 4, 2)
    model = fit_table(docs, where=~held_out)
    return docs.select("doc_id", held_out.alias("held_out"), language(F.col("text"), model).alias("_l")).select("doc_id", "held_out", "_l.lang_pred", "_l.score")
