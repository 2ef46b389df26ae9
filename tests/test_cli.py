"""The command line over a small workspace, and files that can't be read."""

import json

import pytest
from pyspark.sql import functions as F

from codexloom import cli, engine
from codexloom.operators import classify
from codexloom.sources import files as S

BOOK = "第一章 总论\n" + "这是一个完整的句子内容说明，用来检查覆盖。" * 40 + "\n第二章 方法\n" + "方法部分的句子也要写得足够长，才能成为一块。" * 40


def run(spark, *argv):
    args = cli.make_parser().parse_args(list(argv))
    return args.run(spark, args)


@pytest.fixture
def workspace(tmp_path):
    for name, text in {"books/textbook/甲.txt": BOOK, "markdown_files/journal/2026-04-25.md": "# 今日\n内容\n\n## 想法\n更多内容", "markdown_files/journal/2026-04-26.md": "# 次日\n另一天的内容", "markdown_files/TechNotes/检索/切分.md": "# 分块\n引言。\n\n## 子题\n子题正文。", "markdown_files/WebPageCollection/Saved Page.md": "---\ncreated: 2026-04-10\n---\n# Page\nSaved content."}.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(tmp_path / "raw"), str(tmp_path / "out")


def records(path):
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines()]


def test_preflight_builds_and_inspects(spark, workspace, tmp_path, capsys):
    raw, out = workspace
    assert run(spark, "preflight", "--raw", raw, "-o", out) == 0
    made = sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.startswith("."))
    assert made == sorted(["甲_noembedding.pack.jsonl", "甲_noembedding.pack.inspect.json", "甲_noembedding.pack.inspect.html", "journal_2026-04_noembedding.pack.jsonl", "检索_noembedding.pack.jsonl", "Saved Page_noembedding.pack.jsonl"])
    report = json.loads((tmp_path / "out/books_output/甲_noembedding.pack.inspect.json").read_text(encoding="utf-8"))
    assert report["result"] in ("PASS", "WARN") and report["stats"]["coverage"]["coverage"] > 0.9 and report["recommendations"]["profile"]["current"] == "textbook"
    html = (tmp_path / "out/books_output/甲_noembedding.pack.inspect.html").read_text(encoding="utf-8")
    assert "<h2>统计</h2>" in html and html.count('class="card"') >= 4
    assert "Preflight result: PASS" in capsys.readouterr().out
    head, contents, *chunks = records(tmp_path / "out/markdown_output/journal_2026-04_noembedding.pack.jsonl")
    assert head["source"]["source_type"] == "markdown" and head["chunking"]["profile"] == "journal" and head["created_at"]
    assert [f["file_path"] for f in head["source"]["files"]] == ["2026-04-25.md", "2026-04-26.md"]
    assert [i["title"] for i in contents["items"]] == ["2026-04-25", "今日", "想法", "2026-04-26", "次日"] and [i["parent_toc_id"] for i in contents["items"]] == [None, "toc:000001", "toc:000002", None, "toc:000004"]
    assert chunks[0]["embedding"] == [] and chunks[0]["source"]["logical_month"] == "2026-04" and chunks[0]["source"]["file_modified_at"]
    web = records(tmp_path / "out/markdown_output/Saved Page_noembedding.pack.jsonl")
    assert web[0]["source"]["files"][0]["logical_date"] == "2026-04-10" and web[2]["source"]["front_matter_date"] == "2026-04-10"
    notes = records(tmp_path / "out/markdown_output/检索_noembedding.pack.jsonl")
    assert "引言" in "".join(c["text"] for c in notes[2:]) and "子题正文" in "".join(c["text"] for c in notes[2:])
    # A pack that is there is inspected as it is: of another source it fails.
    (tmp_path / "raw/books/textbook/甲.txt").write_text(BOOK + "改", encoding="utf-8")
    assert run(spark, "inspect", "--raw", raw, "-o", out, "--no-report") == 1


def test_merged_chunks_tell_all_their_sources(spark):
    # Roots of two files are siblings; both are short.
    files = spark.createDataFrame([("n/a.md", "甲" * 40, "p"), ("n/b.md", "乙" * 90, "p")], "path string, text string, pack string")
    chunk = engine.build_markdown(files, "tech_notes").chunks.collect()
    assert [(c.source_metadata.file_path, [m.file_path for m in c.merged_sources]) for c in chunk] == [("a.md", ["a.md", "b.md"])]


def test_pdf_files_give_documents_or_error_rows(spark, tmp_path):
    def reader(data):
        if data.startswith(b"broken"):
            raise ValueError("no PDF")
        body, _, outline = data.decode().partition("|")
        return body.split("\f"), [(1, t, None if t == "无页" else 1) for t in outline.split(",") if t]

    for name, data in {"a.pdf": "第一章 甲\n正文\f第二页|第一章 甲,无页".encode(), "b.pdf": b"broken", "c.pdf": b" \f ", "d.txt": "文".encode(), "e.docx": b"x"}.items():
        (tmp_path / name).write_bytes(data)
    found = S.documents(S.list_files(spark, str(tmp_path)), reader)
    name = F.element_at(F.split("path", "/"), -1)
    assert sorted((r.n, r.error_class) for r in found.errors.select(name.alias("n"), "error_class").collect()) == [("b.pdf", "ValueError"), ("c.pdf", "ImageOnlyPdfError"), ("e.docx", "UnsupportedSourceError")]
    assert sorted(r.page for r in found.pages.collect()) == [1, 1, 2]
    assert [(r.ord, r.title, r.level, r.page) for r in found.outlines.orderBy("ord").collect()] == [(1, "第一章 甲", 1, 1), (2, "无页", 1, None)]
    # Without the library a file is an error row too.
    assert "pdf" in S.documents(S.list_files(spark, str(tmp_path))).errors.where(F.col("path").endswith("a.pdf")).first().message.lower()


def test_outline_of_a_book_is_named_in_the_manifest(spark):
    pages = spark.createDataFrame([("d", 1, "第一章 思考\n批判性思维的强弱\n" + "正文内容在这里说明。" * 30 + "\n第二章 行动\n" + "这是正文。" * 60)], "doc string, page int, text string")
    outline = spark.createDataFrame([("d", 1, "第一章 思考", 1, 1), ("d", 2, "第二章 行动", 1, 1)], "doc string, ord int, title string, level int, page int")
    docs = spark.createDataFrame([("d", "sha256:x", "书", "d.pdf")], "doc string, document_id string, title string, file_name string")
    lines = engine.pack_table(engine.build_books(pages, "social_science", outline), docs, "social_science", source_type="pdf").orderBy("line_no").collect()
    head, contents = json.loads(lines[0].line), json.loads(lines[1].line)
    assert head["toc"]["source"] == contents["source"] == "pdf_outline+body_heading_augmentation" and head["parser"]["name"] == "pymupdf"
    assert head["chunking"]["search_before_pages"] == 1 and head["chunking"]["heading_detection"] == "pdf_outline_first_zh_social_science_v1"


def test_destinations_avoid_names_that_are_taken(spark):
    rows = spark.createDataFrame([("1", "x.pdf", "legal"), ("2", "x.pdf", "legal"), ("3", "x_1.pdf", "legal"), ("4", "x.pdf", "paper"), ("5", "y", "paper")], "path string, name string, profile string")
    held = spark.createDataFrame([("x.pdf", "legal"), ("x_2.pdf", "legal"), ("y", "paper")], "name string, profile string")
    got = {r.path: r.target for r in classify.unique_destinations(rows, held).collect()}
    assert got == {"1": "x_3.pdf", "2": "x_4.pdf", "3": "x_1.pdf", "4": "x.pdf", "5": "y_1"}


def test_options_by_verb():
    args = cli.make_parser().parse_args(["build", "--no-embedding", "--max-chars", "900", "-o", "o"])
    assert args.no_embedding and cli.parameters(args, "legal").max == 900 and cli.parameters(args, "legal").min == 120
    assert cli.make_parser().parse_args([]).run is cli.default_workflow


def test_a_single_file_with_a_title_and_a_suffix_of_its_own(spark, tmp_path, capsys):
    (tmp_path / "乙.txt").write_text(BOOK, encoding="utf-8")
    source, out = str(tmp_path / "乙.txt"), str(tmp_path / "packs")
    assert run(spark, "build", source, "--title", "我的书", "--profile", "textbook", "--no-embedding", "-o", out, "--pack-suffix", ".kb.jsonl") == 0
    made = tmp_path / "packs" / "乙_noembedding.kb.jsonl"
    assert [p.name for p in (tmp_path / "packs").iterdir() if not p.name.endswith(".crc")] == [made.name] and made.name in capsys.readouterr().out
    head, contents, *chunks = records(made)
    assert head["title"] == "我的书" and head["chunking"]["profile"] == "textbook" and len(contents["items"]) == 2
    assert all(c["embedding_text"].startswith("书名：我的书\n") for c in chunks)
    with made.open("a", encoding="utf-8") as f:
        f.write('{"record_type":"chunk"')
    assert run(spark, "inspect", source, str(made), "--no-report") == 1 and f"第 {len(chunks) + 3} 行不是合法 JSON" in capsys.readouterr().out


def test_files_are_replaced_whole_and_others_stay(spark, tmp_path):
    from codexloom.sources import sinks

    (tmp_path / "old.txt").write_text("old")
    lines = spark.createDataFrame([(f"d{d}", i, f"{d}-{i}") for d in range(40) for i in range(30, 0, -1)] + [("x", 1, "lost"), ("y", 1, "kept")], "doc string, line_no int, line string")
    names = spark.createDataFrame([(f"d{d}", f"f{d}.txt") for d in range(40)] + [("x", "same.txt"), ("y", "same.txt"), ("z", "none.txt")], "doc string, file string")
    for _ in range(2):
        sinks.write_files(lines, names, f"file://{tmp_path}")
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted([f"f{d}.txt" for d in range(40)] + ["same.txt", "old.txt"])
    assert (tmp_path / "f7.txt").read_text() == "".join(f"7-{i}\n" for i in range(1, 31)) and (tmp_path / "same.txt").read_text() == "kept\n"
    failing = lines.withColumn("line", F.when(F.col("line") == "3-9", F.raise_error(F.lit("stop"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="stop"):
        sinks.write_files(failing, names.where("file = 'f3.txt'"), f"file://{tmp_path}/sub")
    assert not [p for p in (tmp_path / "sub").rglob("*") if p.is_file()] if (tmp_path / "sub").exists() else True
