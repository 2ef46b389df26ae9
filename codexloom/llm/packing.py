"""Best-fit packing by a configuration linear program over the histogram of lengths.

Only lengths matter to a packing, and there are at most `capacity` of them. Their histogram, `capacity` numbers whatever
the input, goes to the driver. A configuration is a multiset of lengths that fits one sequence; the program asks for the
fewest configurations, counted with multiplicity, that hold every piece. It starts from a cover in whole numbers by the
lengths themselves. Multiplicative weights then move both the uses of configurations and the prices of lengths; knapsack
dynamic programming over the capacity prices the best configuration with each length, adds it to the program, and gives
a dual bound, below which no packing can go. It ends when the fractional uses meet the bound to one part in a thousand.
The uses are rounded down; what remains is covered in whole numbers at the program's prices. Sequences that stay under
98 % full are packed again best-fit decreasing where that takes fewer of them.

The plan then names, per length, which ranks go to which sequences and offsets. Pieces are ranked within their length:
row numbers within (length, bucket) and the sizes of the buckets before, so that a length that a third of all pieces
share is ranked by many tasks.

Cases: a null or empty text is one piece that holds the end token. Rows that repeat are packed row by row. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.llm.merges import Memory, arrow_slices, byte_letters, gather, without_marks
from codexloom.session import written

#: Pieces that one task ranks per length, on average, at most.
BUCKET = 100_000


# ---- token ids ------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _memory(path: str) -> Memory:
    """The ids of words. The tokenizer's model ends every run of letters with a token that says so, so many runs go to it
    in one call; white space, case, normal form and the letters for bytes are settled before."""
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    bare = Tokenizer(whole.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    called = {t: getattr(t, "encode_batch_fast", t.encode_batch) for t in (whole, bare)}
    letters = {b: letter for letter, b in byte_letters().items()} | {0x20: " "}
    last = np.zeros(whole.get_vocab_size(with_added_tokens=True), bool)
    last[[i for t, i in whole.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True

    def learn(words: list[str], runs: bool) -> tuple[np.ndarray, np.ndarray]:
        if runs:
            text = unicodedata.normalize("NFC", " ".join(words)).encode().decode("latin-1").translate(letters)
            ids = np.array(called[bare]([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(last[ids])
            if len(ends) == len(words):
                return ids, np.diff(ends, prepend=-1)
        found = [np.array(e.ids, "<u4") for e in called[whole](words, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    return Memory(learn, 1_024)


def _parts(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct words: distinct parts, which of these are runs of letters; per word the number of its first part and
    of the marks behind it (-1: none).

    The tokenizer reads letters in lower case and merges nothing across the end of a run of letters. So a run of letters
    is a part in lower case, without the marks behind it; any other word is a part as it is."""
    core, letters, marks = without_marks(words)
    letters = letters & ~pc.match_substring_regex(core, "[İΣ]").to_numpy(zero_copy_only=False)
    first = pc.if_else(pa.array(letters), pc.utf8_lower(core), words)
    parts, n = pa.concat_arrays([first, marks]).dictionary_encode(), len(words)
    number, runs = parts.indices.to_numpy().astype(np.int64), np.zeros(len(parts.dictionary), bool)
    runs[number[:n]] = letters
    return parts.dictionary, runs, number[:n], np.where(letters & (pc.binary_length(marks).to_numpy(zero_copy_only=False) > 0), number[n:], -1)


def encode(texts: pa.Array, path: str) -> list[bytes]:
    """The ids of each text, none null, as little-endian unsigned 32-bit integers."""
    known, out = _memory(path), []
    for part in arrow_slices(texts):
        # Words are told apart and numbered by Arrow; Python sees the distinct ones of a slice.
        lists = pc.ascii_split_whitespace(part)
        words = lists.flatten().dictionary_encode()
        parts, letters, first, then = _parts(words.dictionary)
        flat, start, many = known.of(parts.to_pylist(), letters)
        start, many, which = np.append(start, 0), np.append(many, 0), words.indices.to_numpy()
        # Per word the ids of its first part and those of the marks behind it.
        two = [np.stack([x[first], x[then]], 1)[which].ravel() for x in (start, many)]
        ids, ends = gather(flat, *two)
        found, cuts = ids.tobytes(), (ends[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())] * 4).tolist()
        out += [found[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return out


def pieces(text: Column, *, capacity: int = 2048, end_id: int = 0, path: str | None = None, with_ids: bool = False) -> Column:
    """array<struct<piece, start, length, ids_crc32[, ids]>> of a text column: its ids and the end id, cut to capacity."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    shape = "array<struct<piece:int,start:long,length:long,ids_crc32:long" + (",ids:array<int>" if with_ids else "") + ">>"

    @F.arrow_udf(shape)
    def run(texts: pa.Array) -> pa.Array:
        tail, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        cut, ends = [], [0]
        for ids in encode(pc.fill_null(texts, ""), path):
            ids += tail
            cut += [(i // step, i // 4, ids[i : i + step]) for i in range(0, len(ids), step)]
            ends.append(len(cut))
        columns = [pa.array([p for p, _, _ in cut], pa.int32()), pa.array([s for _, s, _ in cut], pa.int64()), pa.array([len(b) // 4 for _, _, b in cut], pa.int64()), pa.array([zlib.crc32(b) for _, _, b in cut], pa.int64())]
        names = ["piece", "start", "length", "ids_crc32"]
        if with_ids:
            offsets = np.cumsum([0, *[len(b) // 4 for _, _, b in cut]])
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(b for _, _, b in cut), "<i4"))))
            names.append("ids")
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names))

    return run(text)


# ---- the plan -------------------------------------------------------------------------------------------------------

Plan = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, times) from the longest, sequences of that kind)


def price(lengths: np.ndarray, weight: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """By room: the greatest weight of a configuration that fits, and the place of its first length plus one (0: none).
    lengths fall; how many pieces a length has is not asked."""
    best, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    start = (len(lengths) - np.searchsorted(lengths[::-1], np.arange(capacity + 1), side="right")).tolist()
    for room in range(int(lengths[-1]), capacity + 1):
        k = start[room]
        gain = best[room - lengths[k:]]
        gain += weight[k:]
        i = int(gain.argmax())
        best[room], first[room] = gain[i], k + i + 1
    return best, first.tolist()


Kind = tuple[tuple[int, int], ...]  # (length, times) from the longest
Uses = dict[Kind, int]  # configuration -> sequences


def configuration(j: int, sizes: list[int], first: list[int], free: list[int], capacity: int) -> dict[int, int]:
    """Places of lengths and their times in the best configuration that holds length j, by a table of `price`; a length
    used up gives way to the next shorter."""
    room, times = capacity - sizes[j], {j: 1}
    while first[room]:
        i = first[room] - 1
        while i < len(sizes) and (sizes[i] > room or times.get(i, 0) >= free[i]):
            i += 1
        if i == len(sizes):
            break
        times[i] = times.get(i, 0) + 1
        room -= sizes[i]
    return times


def cover(hist: dict[int, int], capacity: int, step: float, worth: dict[int, float] | None = None) -> Uses:
    """Configurations in whole numbers that cover every length exactly. A round serves no length beyond `step` of its
    pieces; pieces are worth the given prices (None: the room they take), less the more of their length is covered."""
    lengths = np.array(sorted(hist, reverse=True), np.int64)
    n = np.array([hist[int(x)] for x in lengths], np.int64)
    value = np.array([worth[int(x)] for x in lengths]) if worth else lengths / capacity
    most, left, rng, out = np.maximum(1, (step * n).astype(np.int64)), n.copy(), np.random.default_rng(0), defaultdict(int)
    while left.any():
        share = 1 - left / n
        at = np.flatnonzero(left)
        size = lengths[at]
        # A little noise parts those worth the same.
        weight = value[at] * np.exp(share.mean() - share[at]) * (1 + 0.1 * step * rng.random(len(at)))
        best, first = price(size, weight, capacity)
        given = np.minimum(left, most)[at]
        free, sizes = given.tolist(), size.tolist()
        total = weight + best[capacity - size]
        enough, taken = float(total.max()) * (1 - 0.2 * step), False
        for j in np.argsort(-total, kind="stable").tolist():
            if total[j] < enough:
                break
            if not free[j]:
                continue
            times = configuration(j, sizes, first, free, capacity)
            if taken and sum(weight[i] * t for i, t in times.items()) < enough:
                continue
            taken = True
            use = min(free[i] // t for i, t in times.items())
            for i, t in times.items():
                free[i] -= use * t
            out[tuple(sorted(((sizes[i], t) for i, t in times.items()), reverse=True))] += use
        left[at] -= given - np.array(free, np.int64)
    return dict(out)


def fractional(hist: dict[int, int], capacity: int, start: Uses, *, rounds: int = 60, steps: int = 250, rate: float = 0.4, tolerance: float = 0.001) -> tuple[dict[Kind, float], dict[int, float], float]:
    """The linear program by multiplicative weights: how often each configuration is used, what a piece of each length is
    worth, and the value of these prices, below which no packing can go.

    Both sides are weights. A configuration's use grows by exp(rate * (what its pieces are worth - 1)), the price of a
    length by exp(rate * (1 - its covered share)), each step looking one step ahead. Uses move by their own size and
    prices by that of the pieces they pay for, so one rate serves lengths with one piece and with a million. After
    `steps` steps their mean is the point to go on from; the knapsack prices it, which gives a dual bound once the best
    configuration is worth 1, and adds the best configuration with each length. It ends when the uses, with what they
    leave uncovered put in sequences of its own, are within `tolerance` of the bound."""
    lengths = np.array(sorted(hist, reverse=True), np.int64)
    n = np.array([hist[int(x)] for x in lengths], np.float64)
    sizes, place = lengths.tolist(), {int(x): i for i, x in enumerate(lengths)}
    alone, plenty = 1.0 / (capacity // lengths), [capacity] * len(lengths)
    kinds: dict[Kind, float] = {((x, capacity // x),): 0.1 for x in sizes} | {kind: float(use) for kind, use in start.items()}
    y = lengths / capacity
    prices, bound, made, least, room = y, 0.0, kinds, math.inf, float(n @ lengths) / capacity
    for turn in range(rounds):
        # Three prices: half way to the best so far, which moves less from turn to turn; lengths that weigh little at the
        # price of the next shorter one that weighs more, since no configuration gains by longer pieces; and as they are.
        heavy = np.where(n * y >= 0.1 * float(n @ y) / len(n), np.arange(len(n)), len(n))
        next_heavy = np.minimum.accumulate(heavy[::-1])[::-1]
        for asked in ((y + prices) / 2, np.append(y, 0)[next_heavy], y):
            best, first = price(lengths, asked, capacity)
            top = float(best[capacity])
            if (value := float(asked @ n) / top) > bound:
                prices, bound = asked / top, value
        if least <= max(bound, room) * (1 + tolerance):
            break
        total = asked + best[capacity - lengths]
        floor = 0.1 * sum(kinds.values()) / len(kinds)
        for j in np.flatnonzero(total > top * 0.98).tolist():
            times = configuration(j, sizes, first, plenty, capacity)
            kinds.setdefault(tuple(sorted(((sizes[i], t) for i, t in times.items()), reverse=True)), floor)
        entries = [(place[length], j, t) for j, kind in enumerate(kinds) for length, t in kind]
        row, column, many = (np.array(x) for x in zip(*entries, strict=True))
        x, sum_x, sum_y = np.array(list(kinds.values())), np.zeros(len(kinds)), np.zeros(len(n))
        before = None
        for step in range(steps):
            gain = np.bincount(column, many * y[row], len(x)) - 1
            short = 1 - np.bincount(row, many * x[column], len(n)) / n
            ahead = (gain, short) if before is None else (2 * gain - before[0], 2 * short - before[1])
            before = gain, short
            x = x * np.exp(rate * np.clip(ahead[0], -2, 2))
            # No piece is worth more than its share of a sequence of its kind; none so little that its price can't come back.
            y = np.clip(y * np.exp(rate * np.clip(ahead[1], -2, 2)), 1e-9 * alone, 1.05 * alone)
            if step >= steps // 2:
                sum_x += x
                sum_y += y
        x, y = sum_x / (steps - steps // 2), sum_y / (steps - steps // 2)
        short = np.maximum(0.0, n - np.bincount(row, many * x[column], len(n)))
        if (value := float(x.sum() + short @ alone)) < least:
            least, made = value, dict(zip(kinds, x.tolist(), strict=True))
        # Configurations that nothing is left of go.
        keep = x > 1e-6 * x.sum() / len(x)
        kinds = {kind: float(u) for kind, u, k in zip(kinds, x, keep, strict=True) if k}
    return made, dict(zip(sizes, prices.tolist(), strict=True)), bound


def rounded(made: dict[Kind, float], hist: dict[int, int], capacity: int, prices: dict[int, float], step: float) -> Uses:
    """A cover in whole numbers: of each configuration its whole uses, as far as pieces are left, from the most used; what
    remains is covered by configurations that are best at the program's prices."""
    left, out = dict(hist), defaultdict(int)
    for kind, use in sorted(made.items(), key=lambda kv: (-kv[1], kv[0])):
        whole = min(int(use + 1e-9), *(left[length] // times for length, times in kind))
        if whole:
            out[kind] += whole
            for length, times in kind:
                left[length] -= whole * times
    if rest := {length: k for length, k in left.items() if k}:
        for kind, use in cover(rest, capacity, step, prices).items():
            out[kind] += use
    return dict(out)


def solve(hist: dict[int, int], capacity: int, *, step: float = 0.25, **options) -> tuple[Uses, int]:
    """A cover of every length by the rounded program, and a lower bound for any: the greater of the room that all pieces
    take and the dual value. The program starts from a cover by the lengths themselves, which stands if it meets the
    bound or is not bettered; steps of the rounding are halved while that saves sequences."""
    bound = -(-sum(length * n for length, n in hist.items()) // capacity)
    best = cover(hist, capacity, step)
    size = lambda uses: sum(uses.values())
    if size(best) == bound:
        return best, bound
    made, prices, dual = fractional(hist, capacity, best, **options)
    bound = max(bound, math.ceil(dual * (1 - 1e-9)))
    for turn in range(4):
        if size(best) == bound:
            break
        before, step = size(best), step / 2
        best = min(best, rounded(made, hist, capacity, prices, step), key=size)
        if turn and size(best) > before * (1 - 2e-4):
            break
    return best, bound


def best_fit(hist: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over counts of equal lengths at a time."""
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)  # room -> kinds and how many

    def put(kind: tuple[tuple[int, int], ...], room: int, n: int) -> None:
        open_[room].append((kind, n))

    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            rooms = [r for r in open_ if r >= length and open_[r]]
            if not rooms:
                per = capacity // length
                if full := left // per:
                    put(((length, per),), capacity - per * length, full)
                if rest := left % per:
                    put(((length, rest),), capacity - rest * length, 1)
                break
            room = min(rooms)
            kind, n = open_[room].pop()
            per = room // length
            if full := min(n, left // per):
                put((*kind, (length, per)), room - per * length, full)
            left -= full * per
            if n > full:
                if left and left < per:
                    put((*kind, (length, left)), room - left * length, 1)
                    n, left = n - 1, 0
                if n > full:
                    put(kind, room, n - full)
    return [(kind, n) for kinds in open_.values() for kind, n in kinds]


def plan(hist: dict[int, int], capacity: int, **options) -> Plan:
    """Configurations with whole numbers of sequences that hold every piece exactly once."""
    made = sorted(solve(hist, capacity, **options)[0].items(), key=lambda kv: (-kv[1], kv[0])) if hist else []
    # Whole numbers may leave sequences unfilled; best fit packs those again where it needs fewer.
    loose = [(kind, n) for kind, n in made if sum(length * t for length, t in kind) < 0.98 * capacity]
    rest: dict[int, int] = defaultdict(int)
    for kind, n in loose:
        for length, times in kind:
            rest[length] += n * times
    again = best_fit(rest, capacity)
    if sum(n for _, n in again) < sum(n for _, n in loose):
        made = [x for x in made if x not in loose] + again
    return made


def assignment(made: Plan) -> dict[str, np.ndarray]:
    """Blocks of ranks per length, sorted by (length, first rank): first sequence, pieces of it per sequence, offset."""
    rows, ranks, sequence = [], defaultdict(int), 0
    for kind, n in made:
        offset = 0
        for length, times in kind:
            rows.append((length, ranks[length], sequence, times, offset))
            ranks[length] += n * times
            offset += length * times
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "times", "offset"), table.T.copy(), strict=True))


# ---- on DataFrames --------------------------------------------------------------------------------------------------


def _ranked(cut: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """cut with _rank, 0 ... within each length."""
    buckets = max(32, -(-n // BUCKET))
    order = ", ".join(keys)
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    sizes = cut.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.expr("coalesce(sum(_n) OVER (PARTITION BY length ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")).drop("_n")
    ranked = cut.withColumn("_row", F.expr(f"row_number() OVER (PARTITION BY length, _bucket ORDER BY {order})"))
    return ranked.join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_row") - 1).drop("_bucket", "_before", "_row")


def pack(cut: DataFrame, *, keys: list[str], capacity: int = 2048, **options) -> DataFrame:
    """cut (a table with a long `length` of 1 to capacity) with sequence_id and offset. keys order pieces of a length;
    rows that agree in all keys are interchangeable."""
    hist = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = cut.sparkSession.sparkContext.broadcast(assignment(plan(hist, capacity, **options)))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        t = table.value
        key = t["length"] << 44 | t["rank"]
        for length, rank in batches:
            length, rank = length.to_numpy(zero_copy_only=False).astype(np.int64), rank.to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            within = rank - t["rank"][at]
            yield pa.StructArray.from_arrays([pa.array(t["sequence"][at] + within // t["times"][at]), pa.array(t["offset"][at] + within % t["times"][at] * length)], ["sequence_id", "offset"])

    ranked = _ranked(cut, sum(hist.values()), keys)
    return ranked.withColumn("_at", place("length", "_rank")).select(*cut.columns, "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, path: str | None = None, with_ids: bool = False, **options) -> DataFrame:
    """Per piece: `_id`, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    cut = docs.select(F.col(id_col).alias("_id"), F.explode(pieces(F.col(text_col), capacity=capacity, end_id=end_id, path=path, with_ids=with_ids)).alias("_p")).select("_id", "_p.*")
    return pack(written(cut, "pieces"), keys=["_id", "piece", "ids_crc32"], capacity=capacity, **options)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("_id", "doc_id")
