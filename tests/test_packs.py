"""Markdown, packs, classification, inspection, sources."""

import hashlib
import json
import random
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from codexloom import engine
from codexloom.functions import text as T
from codexloom.operators import classify, embed, inspect, markdown, packs
from codexloom.plans import registry
from codexloom.sources import files as S
from codexloom.sources.sinks import write_packs


def test_markdown_parent_intro_is_kept_and_fences_hide_headings(spark):
    text = "---\ncreated: 2026-04-10\n---\n# 分块\n介绍文字\n```\n# 不是标题\n```\n## 子标题\n正文\n##### 太深\n看不见"
    files = spark.createDataFrame([("TechNotes/RAG/Chunking.md", text)], "path string, text string")
    found = markdown.sections(files)
    assert [(r.title, r.level) for r in found.orderBy("ord").collect()] == [("Chunking", 1), ("分块", 2), ("子标题", 3), ("太深", 6)]
    assert [r.title for r in markdown.dropped_sections(found).collect()] == ["太深"]
    body = "\n".join(r.text for r in engine.build_markdown(files).chunks.collect())
    assert "介绍文字" in body and "正文" in body and "created" not in body
    dated = markdown.metadata(files, "tech_notes").first()
    assert (dated.front_matter_date, dated.logical_date, dated.logical_month) == ("2026-04-10", "2026-04-10", "2026-04")


def test_packs_by_month_folder_and_page(spark):
    one = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    jobs = markdown.all_packs(one("journal/2026-04-25.md", "journal/2026-04-26.md"), one("RAG/Chunking.md", "loose.MD"), one("Milvus HNSW.md")).orderBy("job_ord", "title").collect()
    assert [(r.profile, r.output_stem, len(r.files)) for r in jobs] == [("journal", "journal_2026-04", 2), ("tech_notes", "RAG", 1), ("tech_notes", "loose", 1), ("web_page_collection", "Milvus HNSW", 1)]


def test_source_hash_names_files_below_their_common_folder(spark):
    shapes = {"one": ["n/a/x.md", "n/c/y.md"], "moved": ["n/b/x.md", "n/c/y.md"], "elsewhere": ["m/a/x.md", "m/c/y.md"], "single": ["q/x.md"]}
    rows = [(k, path, "t") for k, paths in shapes.items() for path in paths]
    got = {r["pack"]: r.document_id for r in markdown.source_hash(spark.createDataFrame(rows, "pack string, path string, text string"), "pack").collect()}
    digest = lambda text: "sha256:" + hashlib.sha256(text.encode()).hexdigest()
    want = lambda *names: digest(json.dumps({"files": [x for n in names for x in (n, digest("t"))]}, separators=(",", ":")))
    assert got == {"one": want("a/x.md", "c/y.md"), "moved": want("b/x.md", "c/y.md"), "elsewhere": want("a/x.md", "c/y.md"), "single": want("x.md")}


def test_pack_lines_read_back(spark, tmp_path):
    pages = spark.createDataFrame([("b", 1, "第一章 总论\n" + "内容说明。" * 60 + "\n第二章 方法\n" + "方法说明。" * 60)], "doc string, page int, text string")
    book = engine.build_books(pages, "textbook")
    docs = spark.createDataFrame([("b", "sha256:x", "书", "b.txt")], "doc string, document_id string, title string, file_name string")
    lines = engine.pack_table(book, docs, "textbook", embed.hash_embedder(8))
    rows = [json.loads(r.line) for r in lines.orderBy("line_no").collect()]
    assert [r["record_type"] for r in rows] == ["manifest", "toc", *["chunk"] * (len(rows) - 2)]
    chunks = rows[2:]
    assert [c["prev_chunk_id"] for c in chunks] == [None, *[c["chunk_id"] for c in chunks[:-1]]]
    assert all(len(c["embedding"]) == 8 for c in chunks) and rows[0]["toc"]["item_count"] == 2
    checks = inspect.check_schema(packs.split_records(packs.told_lines(lines))).collect()
    assert {r.status for r in checks} == {"PASS"}
    write_packs(lines, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == len(rows)
    broken = spark.createDataFrame([("b", 1, "{not json"), ("b", 2, ""), ("b", 3, '{"a": 1}')], "doc string, line_no int, line string")
    assert [(r.line_no, r.kind) for r in packs.bad_records(packs.told_lines(broken)).collect()] == [(1, "json")]


def test_line_errors_are_those_of_a_json_parser(spark):
    lines = ['{"a":1}', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}],{"b":2}', '{"a":1},0],{}', "{'a':1}", '{"a":NaN}', '{"a":1,}', "[1,2]", '"s"', "1", "{broken", "nul", '{"a":"x\ty"}', '{"a":01}', ' {"a":1} ', '{"a":1,"a":2}', '{"a":1e999}', "", " \u3000", "null", "{}", '{"b":"\\ud800"}', '{"a":.5}', '{"a":1/*c*/}', "{}]", "{}}"]

    def wrong(line):
        if not line.strip():
            return None
        try:
            return None if isinstance(json.loads(line), dict) else "object"
        except ValueError:
            return "json"

    got = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)], "doc string, line_no int, line string")
    assert {r.line_no: r.kind for r in packs.told_lines(got).collect()} == {i: wrong(x) for i, x in enumerate(lines)}


def test_bad_records_judge_a_line_once(spark, tmp_path):
    lines = [("d", i, x) for i, x in enumerate(["{}", "[1]", "{cut", "", '{"a":1}'] * 8)]
    bad = packs.bad_records(packs.told_lines(spark.createDataFrame(lines, "doc string, line_no int, line string")))
    assert bad._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [_judged") == 1
    assert sorted((r.line_no, r.kind) for r in bad.collect()) == [(i, "object" if x == "[1]" else "json") for _, i, x in lines if x in ("[1]", "{cut")]
    spark.createDataFrame([(i, "x", "s") for i in range(60)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = registry.queries()["bad_records"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [_judged") == 1


def test_lines_are_judged_one_at_a_time():
    lines = pa.array([None, "{}", *['{"a":"' + "x" * 200_000] * 40, "[1]"])
    tracemalloc.start()
    try:
        got = packs._judged.func(lines)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.to_pylist() == [None, None, *["json"] * 40, "object"] and most < 2e6


def test_lines_are_numbered_across_splits(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    texts = {"a.jsonl": "".join(f'{{"n":{i},"x":"{"y" * (i % 97)}"}}\n' + "\n" * (i % 3 == 0) for i in range(3_000)), "sub/b.jsonl": "{}\r\n\r\n[1]\n{cut", "c.jsonl": "", "d.txt": "{}"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        lines = packs.read_lines(spark, str(tmp_path))
        assert lines.sparkSession.read.option("pathGlobFilter", "*.jsonl").text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = sorted((r.doc.split("/")[-1], r.line_no, r.line) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((name.split("/")[-1], i, x) for name, text in texts.items() if name.endswith(".jsonl") for i, x in enumerate(text.splitlines(), 1))
    bad = packs.bad_records(packs.told_lines(lines)).select(F.element_at(F.split("doc", "/"), -1).alias("f"), "line_no", "kind")
    assert sorted(map(tuple, bad.collect())) == [("b.jsonl", 3, "object"), ("b.jsonl", 4, "json")]


def test_classification(spark):
    samples = spark.createDataFrame([("en", "Part I One\nChapter 1 Two\nplain English text"), ("legal", "第一编 总则\n第一条 目的\n第二条 范围\n本条例"), ("none", "一二三")], "doc string, sample string")
    got = {r.doc: r for r in classify.classify(samples).collect()}
    assert got["en"].profile == "english" and got["legal"].profile == "legal" and got["none"].profile == "social_science"
    assert got["none"].scores["social_science"] == 1 and got["none"].signals == ["social_science+1: fallback default"]
    assert got["legal"].score_text.split(", ")[0].startswith("legal=")
    ratio = spark.createDataFrame([("plain English",), ("中文内容",), ("",)], "x string").select(T.english_ratio(F.col("x"))).collect()
    assert ratio[0][0] > 0.9 and ratio[1][0] < 0.1 and ratio[2][0] == 0.0


def chunk_rows(spark, texts, path=("书", "章")):
    rows = [("d", i + 1, t, list(path), 1, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc string, chunk_index int, text string, heading_path array<string>, page_start int, page_end int")


def test_inspection_verdicts(spark):
    meta = spark.createDataFrame([("d", 2000)], "doc string, section_split_chars int")
    good = chunk_rows(spark, ["这是一个完整的句子内容说明。" * 40])
    checks = inspect.check_lengths(inspect.length_stats(good, meta)).unionByName(inspect.check_headings(inspect.heading_stats(good)))
    pages = spark.createDataFrame([("d", 1, "这是一个完整的句子内容说明。" * 40)], "doc string, page int, text string")
    checks = checks.unionByName(inspect.check_coverage(inspect.coverage(pages, good)))
    v = inspect.verdict(checks).first()
    assert (v.result, v.score) == ("PASS", 100)
    poor = chunk_rows(spark, ["短"] * 30)
    warned = inspect.check_lengths(inspect.length_stats(poor, meta)).unionByName(inspect.check_headings(inspect.heading_stats(poor))).collect()
    assert sum(r.status == "WARN" for r in warned) == 3
    files = spark.createDataFrame([("d", "sha256:a", "sha256:b", "x.pdf", "x.pdf")], "doc string, expected_hash string, actual_hash string, source_name string, actual_name string")
    v = inspect.verdict(inspect.check_file_match(files)).first()
    assert (v.result, v.score) == ("FAIL", 65) and "hash" in v.recommendation
    titles = spark.createDataFrame([("d", 1, "标题□")], "doc string, ord int, title string")
    found = inspect.garbled_stats(titles, good).first()
    assert (found.garbled_titles, found.title_examples, found.heading_examples) == (1, ["标题□"], [])


def test_inspection_uses_every_check_of_the_pack(spark):
    pages = spark.createDataFrame([("b", 1, "第一章 总论\n" + "这是一个完整的句子内容说明。" * 40)], "doc string, page int, text string")
    docs = spark.createDataFrame([("b", "sha256:x", "书", "b.txt")], "doc string, document_id string, title string, file_name string")
    lines = engine.pack_table(engine.build_books(pages, "textbook"), docs, "textbook").toPandas()
    frame = lambda: spark.createDataFrame(lines)
    good = engine.inspect_packs(frame(), pages, docs).first()
    assert (good.failed, good.passed >= 9) == (0, True) and good.samples and good.recommendations.profile.current == "textbook"
    stranger = engine.inspect_packs(frame(), pages, docs.withColumn("document_id", F.lit("sha256:y"))).first()
    assert (stranger.result, stranger.failed) == ("FAIL", 1)
    lines["line"] = [x.replace('"schema_version"', '"version"').replace('"profile":"textbook"', '"profile":"none such"') for x in lines["line"]]
    poor = engine.inspect_packs(frame(), pages, docs).first()
    assert (poor.result, poor.failed, poor.warned) == ("FAIL", 1, good.warned + 1)
    detail = {c.message: json.loads(c.detail.toJson()) for c in poor.checks}
    assert detail["manifest 缺少必要字段。"] == {"missing": ["schema_version"]} and detail["manifest 中的 profile 不是已知书籍 profile。"] == {"profile": "none such"}
    lines.loc[len(lines)] = ["b", len(lines) + 1, '{"record_type":"chunk",']
    broken = engine.inspect_packs(frame(), pages, docs)
    assert broken.first().failed == 2 and f"JSONL 第 {len(lines)} 行不是合法 JSON" in broken.first().recommendation
    told = inspect.reports(broken).first()
    assert json.loads(told.json)["checks"][0]["detail"] == {"count": 1, "lines": [{"kind": "json", "line": len(lines)}]}
    assert "{&quot;missing&quot;:[&quot;schema_version&quot;]}" in told.html


def test_samples_and_reports(spark):
    rows = chunk_rows(spark, ["甲" * 50, "乙" * 90, "丙" * 10, "丁" * 50, "<b>" + "戊" * 50])
    pages = spark.createDataFrame([("d", 1, "\n".join(["甲" * 50, "乙" * 90]))], "doc string, page int, text string")
    picks = inspect.sample_chunks(rows).orderBy("pick").collect()
    assert [r.chunk_index for r in picks] == [1, 3, 5, 2]
    samples = inspect.compare_samples(rows, pages)
    assert {r.chunk_index: r.match_rate for r in samples.collect()}[1] == 1.0
    checks = inspect.check_headings(inspect.heading_stats(rows))
    told = inspect.reports(inspect.with_samples(inspect.with_checks(inspect.verdict(checks), checks), samples)).first()
    assert "&lt;b&gt;" in told.html and "<b>" not in told.html
    assert told.report.startswith("PASS: d\n\nscore: 100/100") and json.loads(told.json)["samples"][0]["chunk_index"] == 1


def test_level_recommendation(spark):
    rows = chunk_rows(spark, ["长" * 2500] * 3 + ["中" * 500] * 7)
    meta = spark.createDataFrame([("d", 2000, "textbook", 4)], "doc string, section_split_chars int, profile string, max_chunk_heading_level int")
    levels = spark.createDataFrame([("d", n) for n in range(1, 6)], "doc string, level int")
    r = inspect.recommend_level(meta, levels, inspect.length_stats(rows, meta)).first()
    assert (r.recommended, r.action) == (5, "consider_increase")


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("第一章 甲\r\n正文".encode("gb18030"))
    (tmp_path / "b.TXT").write_bytes(b"\xef\xbb\xbfhello")
    (tmp_path / "c.docx").write_bytes(b"x")
    listed = S.list_files(spark, str(tmp_path))
    assert {r.doc.split("/")[-1]: r.text for r in S.txt_pages(listed).collect()} == {"a.txt": "第一章 甲\n正文", "b.TXT": "hello"}
    assert [r.path.split("/")[-1] for r in S.unsupported_files(listed).collect()] == ["c.docx"]
    names = spark.createDataFrame([(".gitkeep",), ("Thumbs.db",), ("book.pdf",)], "n string")
    assert [r[0] for r in names.select(classify.is_ignored_file(F.col("n"))).collect()] == [True, True, False]
    blank = spark.createDataFrame([("p", 1, " "), ("p", 2, None), ("q", 1, "x")], "doc string, page int, text string")
    assert [r.path for r in S.image_only(blank).collect()] == ["p"]


def test_streaming_ingest(spark, tmp_path):
    from codexloom.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("第一章 甲\n" + "正文内容。" * 80)
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"), lambda pages: engine.build_books(pages, "textbook").chunks).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_hash_embedding_query_reads_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, "ab" * 150 + "x"), (2, "ab" * 150 + "y")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    a, b = registry.queries()["hash_embedding"](spark, str(tmp_path)).collect()
    assert a.embedding != b.embedding


def test_windows_are_found_by_rolling_hashes():
    rng = random.Random(3)
    text = "".join(rng.choice("ab中😀") for _ in range(3_000))
    windows = [text[i : i + 80] for i in rng.sample(range(2_920), 60)] + [text[5:85]] * 3 + ["".join(rng.choice("ab中😀") for _ in range(80)) for _ in range(40)] + ["a", "zz", "", text, text + "a", text[:79] + "!"]
    rng.shuffle(windows)
    assert inspect.held(text, windows).tolist() == [w in text for w in windows]
    assert inspect.held("", ["", "a"]).tolist() == [True, False] and inspect.held("aaaa" * 50, ["a" * 80, "a" * 79 + "b"]).tolist() == [True, False]
