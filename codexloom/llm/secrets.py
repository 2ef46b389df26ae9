"""Secret scans with multipart credential linking (DataFrame functions only).

*Base spans* are the matches of three patterns, leftmost and non-overlapping per kind; matches that are too short are
dropped after matching, so they still consume their text.

*Linked spans*: a credential often comes in parts that look harmless alone: an account name, a random string, a host.
Identifiers, secrets and endpoints are weak candidates. Their intervals are joined inside a document: each part lies in
a scope of `reach` code points on either side, scopes are cut into cells of that width, and parts meet when they share a
cell and their distance is at most `reach`. A weak secret is reported only with an identifier in its scope (an access
key, or a named account) or with an endpoint; the identifier and the endpoint are reported with it. A weak part without
its complement is not reported. A cell holds at most a few hundred parts whatever the document's length, so the join
grows with the text.

Cases: a null text counts as empty and has no spans. Repeated rows are scanned row by row; parts are joined within
(identifier, hash of the text), so rows with the same identifier and other texts do not mix, and a null identifier is a
key like any other. Extra columns are ignored by `scan` and kept by `redact`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.session import written

# The three base patterns, the part that must reach a length, and that length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# A match of AKIA[A-Z0-9]+ or [0-9a-f]+ runs to the end of its run of characters, so asking for the length in the
# pattern finds the same spans as dropping short matches afterwards, without visiting every "a" of a text.

#: Weak parts by role. A weak secret is a run of 32 to 88 base64 characters with upper case, lower case and a digit.
WEAK = (
    ("secret", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{32,88}={0,2}(?![A-Za-z0-9+/_=-])"),
    ("identifier", r"""(?i)\b(?:client_?id|access_?key_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,64}"""),
    ("endpoint", r"""(?i)\b(?:https?|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]+"""),
)

#: Code points on either side of a part that belong to its scope.
REACH = 200
#: Linked rows are broadcast to their texts up to so many bytes, counting each row and each of its spans with `ROW_BYTES`,
#: more than either takes; else they are joined by shuffle.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 128
_SPAN = "array<struct<s:long,e:long>>"


def _bound(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x) with x computed once: an expression inside a lambda is computed for each element."""
    return F.transform(F.array(x), use)[0]


def _in_blocks(items: Column, zero: Column, step: Callable[[Column, Column, Column], Column], done: Callable[[Column, Column], Column]) -> Column:
    """A fold over blocks of items, as many as a block has items: a fold that adds to an array copies it at each step, so
    one over n items costs n * n, and this one n * sqrt(n). step(state, block, begin) gives the next state."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items))).cast("int"))
    return _bound(F.struct(items.alias("x"), size.alias("n")), lambda b: F.aggregate(F.sequence(F.lit(0), b["n"]), zero, lambda acc, k: step(acc, F.slice(b["x"], k * b["n"] + 1, b["n"]), k), lambda acc: done(acc, b["x"])))


def _spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """Start and end, in code points, of each match whose group has `least` code points."""
    part = lambda w: F.length(w) if group == 0 else F.length(F.regexp_extract(w, pattern, group))
    matched = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda w: F.struct(F.length(w).cast("long").alias("len"), part(w).alias("part")))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    found = F.arrays_zip(gaps.alias("gap"), matched.alias("m"))
    none = F.array().cast(_SPAN)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["m"]["len"], F.lit(0).cast("long"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.when(x["m"]["part"] >= least, F.array(F.struct(start.alias("s"), end.alias("e")))).otherwise(none)).alias("out"))

    def block(acc: Column, items: Column, _: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), none.alias("out"))
        return F.aggregate(items, begin, one, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    return F.when(text.rlike(pattern), _in_blocks(found, zero, block, lambda acc, _: F.flatten(acc["out"]))).otherwise(none)


def _base(rows: DataFrame) -> DataFrame:
    for kind, pattern, group, least in BASE:
        rows = rows.withColumn(f"_{kind}", _spans(F.col("_text"), pattern, group, least))
    return rows


def _named(kind: str, order: int, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(order).alias("o"), x["e"].alias("e"), F.lit(kind).alias("k")))


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def linked(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """Of rows (_id, _text): `_id`, `_key` and `_linked`, the array of linked spans, for rows that have any."""
    pieces = rows.select("_id", F.xxhash64("_text").alias("_key"), *[_spans(F.col("_text"), p, 0, 1).alias(f"_w{r}") for r, p in WEAK], _spans(F.col("_text"), BASE[1][1], 0, BASE[1][3]).alias("_wkey"))
    pieces = pieces.where(F.size("_wsecret") > 0).where((F.size("_widentifier") > 0) | (F.size("_wendpoint") > 0) | (F.size("_wkey") > 0))
    role = lambda name, c, reported: F.transform(F.col(c), lambda x: F.struct(F.lit(name).alias("role"), F.lit(reported).alias("reported"), x["s"].alias("s"), x["e"].alias("e")))
    parts = pieces.select("_id", "_key", F.explode(F.concat(role("secret", "_wsecret", True), role("identifier", "_widentifier", True), role("endpoint", "_wendpoint", True), role("identifier", "_wkey", False))).alias("p")).select("_id", "_key", "p.*").distinct()
    cell = lambda c: F.floor(F.col(c) / reach)
    secrets = parts.where("role = 'secret'").withColumn("cell", F.explode(F.sequence(cell("s") - 1, cell("e") + 1))).select("_id", "_key", "cell", F.col("s").alias("s1"), F.col("e").alias("e1"))
    others = parts.where("role <> 'secret'").withColumn("cell", F.explode(F.sequence(cell("s"), cell("e"))))
    near = (
        secrets.alias("a")
        .join(others.alias("b"), F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._key") == F.col("b._key")) & (F.col("a.cell") == F.col("b.cell")) & (F.greatest("a.s1", "b.s") - F.least("a.e1", "b.e") <= reach))
        .select("a._id", "a._key", "s1", "e1", "b.role", "b.reported", "b.s", "b.e")
    )
    # A part that the secret itself covers (a host inside a longer run) is no complement.
    near = near.where("NOT (s < e1 AND s1 < e)")
    spans = near.select("_id", "_key", F.explode(F.array(F.struct(F.lit(True).alias("reported"), F.col("s1").alias("s"), F.lit(3).alias("o"), F.col("e1").alias("e"), F.lit("linked_secret").alias("k")), F.struct("reported", "s", F.when(F.col("role") == "identifier", 4).otherwise(5).alias("o"), "e", F.concat(F.lit("linked_"), "role").alias("k")))).alias("x")).where("x.reported")
    return spans.groupBy("_id", "_key").agg(F.collect_set(F.struct("x.s", "x.o", "x.e", "x.k")).alias("_linked"))


def _with_linked(rows: DataFrame, reach: int) -> DataFrame:
    """rows with `_linked` (empty where there is none)."""
    found = written(linked(rows.select("_id", "_text"), reach), "linked")
    found = found.select(F.col("_id").alias("_fid"), F.col("_key").alias("_fkey"), "_linked")
    parts = found.agg(F.coalesce(F.sum(F.size("_linked") + 1), F.lit(0))).first()[0]
    if parts * ROW_BYTES <= BROADCAST_BYTES:
        found = F.broadcast(found)
    out = rows.withColumn("_key", F.xxhash64("_text"))
    out = out.join(found, out["_id"].eqNullSafe(found["_fid"]) & (out["_key"] == found["_fkey"]), "left")
    none = F.array().cast("array<struct<s:long,o:int,e:long,k:string>>")
    return out.withColumn("_linked", F.coalesce("_linked", none)).drop("_fid", "_fkey", "_key")


def _all_spans() -> Column:
    return F.concat(*[_named(kind, i, F.col(f"_{kind}")) for i, (kind, *_) in enumerate(BASE)])


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per row: `_id`, `_base` and `_all`, arrays of (s start, o order of kinds, e end, k kind) in code points."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = _base(_with_linked(rows, reach)).select("_id", "_linked", _all_spans().alias("_base"))
    return base.select("_id", "_base", F.concat("_base", "_linked").alias("_all"))


def _cut_out(text: Column, spans: Column, mark: str) -> Column:
    """text with mark in place of what the spans, in order, cover; spans that overlap or lie in one another get one.
    Block by block: a block's part of the text is taken off its front, and the gaps are cut from that part."""
    strings = "array<string>"
    zero = F.struct(F.lit(0).cast("long").alias("at"), text.alias("rest"), F.array().cast(strings).alias("out"))

    def block(acc: Column, items: Column, _: Column) -> Column:
        end = F.greatest(acc["at"], F.coalesce(F.array_max(F.transform(items, lambda x: x["e"])), acc["at"]))
        n = (end - acc["at"]).cast("int")
        own = F.struct(F.substring(acc["rest"], F.lit(1), n).alias("text"), F.substring(acc["rest"], n + 1, F.length(acc["rest"])).alias("rest"))

        def cut(o: Column) -> Column:
            def one(a: Column, x: Column) -> Column:
                gap = F.substring(o["text"], (a["at"] - acc["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int"))
                return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(gap, F.lit(mark)))).otherwise(a["out"]).alias("out"))

            begin = F.struct(acc["at"].alias("at"), F.array().cast(strings).alias("out"))
            return F.aggregate(items, begin, one, lambda r: F.struct(r["at"].alias("at"), o["rest"].alias("rest"), F.concat(acc["out"], F.array(F.array_join(r["out"], ""))).alias("out")))

        return _bound(own, cut)

    return _in_blocks(spans, zero, block, lambda acc, _: F.concat(F.array_join(acc["out"], ""), acc["rest"]))


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "<REDACTED>", reach: int = REACH) -> DataFrame:
    """docs with every span of its texts replaced by mark; overlapping spans get one. Columns and other texts stay."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    rows = _base(_with_linked(rows, reach)).withColumn("_spans", F.array_sort(F.concat(_all_spans(), "_linked")))
    cut = _cut_out(F.col("_text"), F.col("_spans"), mark)
    fields = [F.when(F.size("_spans") > 0, cut).otherwise(F.col(f"_row.`{c}`")).alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return rows.select(*fields)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("_base", lambda x: x["k"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("_id").alias("doc_id"), n("assign"), n("access"), n("hex"), F.sha2(_told(F.col("_base")), 256).alias("base_sha256"), _told(F.col("_all")).alias("spans"))
