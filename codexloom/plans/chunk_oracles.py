"""SQL for sections, chunks and what is made of them: each a left fold over a list, as one would write it by hand."""

from __future__ import annotations

from codexloom.functions.profiles import PROFILES, Profile
from codexloom.operators import classify as K
from codexloom.operators import inspect as I
from codexloom.plans import corpora as C
from codexloom.plans import oracles as O
from codexloom.plans.oracles import CH, GLUE, KEEP, MDS, NPACK, STARTS, W, lines, norm, q, strip

NL2 = "chr(10) || chr(10)"


def units(x: str) -> str:
    """Paragraphs, those over 500 characters as sentences."""
    ps = f"list_filter(list_transform(string_split_regex({x}, {q(chr(10) + W + '*' + chr(10))}), lambda x: {strip('x')}), lambda x: x <> '')"
    cut = f"list_filter(list_transform(string_split(regexp_replace(x, '([。！？；;!?])', '\\1' || chr(31), 'g'), chr(31)), lambda y: {strip('y')}), lambda y: y <> '')"
    return f"flatten(list_transform({ps}, lambda x: CASE WHEN length(x) <= 500 THEN [x] ELSE {cut} END))"


def parts(us: str, most: int, overlap: int) -> str:
    """The parts of a long section from its units."""
    one = lambda x: f"{{'out': []::VARCHAR[], 'cur': {x}}}"
    shown = lambda a: f"list_concat({a}.out, CASE WHEN {a}.cur = '' THEN []::VARCHAR[] ELSE [{a}.cur] END)"
    windows = f"list_transform(range(0, 1 + ceil((length(x.cur) - {most}) / {max(1, most - overlap)}.0)::BIGINT), lambda k: substr(x.cur, k * {max(1, most - overlap)} + 1, {most}))"
    step = f"""CASE WHEN length(x.cur) > {most} THEN {{'out': list_concat({shown('a')}, {windows}), 'cur': ''}} WHEN a.cur = '' THEN {{'out': a.out, 'cur': x.cur}}
 WHEN length(a.cur) + length(x.cur) + 2 <= {most} THEN {{'out': a.out, 'cur': a.cur || {NL2} || x.cur}} ELSE {{'out': list_append(a.out, a.cur), 'cur': {strip(f"right(a.cur, {overlap}) || {NL2} || x.cur")}}} END"""
    folded = f"list_reduce(list_prepend({one(q(''))}, list_transform({us}, lambda u: {one('u')})), lambda a, x: {step})"
    return f"list_transform([{folded}], lambda r: {shown('r')})[1]"


def chunks(source: str, p: Profile) -> str:
    """CTEs from `source` (doc, ord, title, parent_ord, text) to chunks: doc, chunk_index, reason, text; o, the sections in
    them; m, those that were merged; j, whether the first ones were; part and parts of a cut section."""
    kind = "STRUCT(reason VARCHAR, text VARCHAR, o INT[], m INT[], j BOOLEAN, part INT, parts INT)"
    none, empty = "[]::STRUCT(t VARCHAR, h VARCHAR, o INT)[]", f"[]::{kind}[]"
    headed = lambda b: f"'【' || {b}.h || '】' || chr(10) || {b}.t"

    def said(reason: str, text: str, o: str, m: str = "[]::INT[]", j: str = "FALSE", part: str = "NULL::INT", parts_: str = "NULL::INT") -> str:
        return f"{{'reason': '{reason}', 'text': {text}, 'o': {o}, 'm': {m}, 'j': {j}, 'part': {part}, 'parts': {parts_}}}"

    def close(a: str) -> str:
        joined, ords = f"array_to_string(list_transform({a}.buf, lambda b: {headed('b')}), {NL2})", f"list_transform({a}.buf, lambda b: b.o)"
        own, last = headed(f"{a}.buf[1]"), f"{a}.out[len({a}.out)]"
        back = said("merged_short_last_section_backward", f"{last}.text || {NL2} || {own}", f"list_append({last}.o, {a}.buf[1].o)", f"list_append({last}.m, {a}.buf[1].o)", f"{last}.j", f"{last}.part", f"{last}.parts")
        return f"""CASE WHEN len({a}.buf) = 0 THEN {a}.out WHEN len({a}.buf) > 1 THEN list_append({a}.out, {said('merged_short_sibling_sections', joined, ords, ords, 'TRUE')})
 WHEN len({a}.out) > 0 AND length({last}.text) + 2 + length({own}) <= {p.max} THEN list_append({a}.out[1:len({a}.out) - 1], {back})
 ELSE list_append({a}.out, {said('short_section_without_merge_target', f"{a}.buf[1].t", f"[{a}.buf[1].o]")}) END"""

    n, one = "length(x.buf[1].t)", "[x.buf[1].o]"
    made = lambda out, buf, size, cuts="[]::VARCHAR[]": f"{{'out': {out}, 'buf': {buf}, 'size': ({size})::BIGINT, 'cuts': {cuts}}}"
    cut = said("section_exceeds_max_chars", "y", one, part="i::INT", parts_="len(x.cuts)::INT")
    step = f"""CASE WHEN len(a.buf) > 0 AND a.size < {min(p.target, p.min)} AND a.size + {n} <= {p.max} THEN {made('a.out', 'list_append(a.buf, x.buf[1])', f'a.size + {n}')}
 WHEN {n} > {p.split} THEN {made(f"list_concat({close('a')}, list_transform(x.cuts, lambda y, i: {cut}))", none, '0')}
 WHEN {n} >= {p.min} THEN {made(f"list_append({close('a')}, {said('natural_section_within_split_threshold', 'x.buf[1].t', one)})", none, '0')}
 ELSE {made(close('a'), 'x.buf', n)} END"""
    return f"""cx AS (SELECT doc, ord, title, parent_ord, text, {strip('text')} AS t FROM {source} WHERE {strip('text')} <> ''),
cn AS (SELECT *, CASE WHEN lag(ord) OVER w IS NOT NULL AND parent_ord IS NOT DISTINCT FROM lag(parent_ord) OVER w THEN 0 ELSE 1 END AS fresh FROM cx WINDOW w AS (PARTITION BY doc ORDER BY ord)),
cr AS (SELECT *, sum(fresh) OVER (PARTITION BY doc ORDER BY ord) AS run FROM cn),
cp AS (SELECT doc, run, ord, {made(empty, "[{'t': t, 'h': title, 'o': ord::INT}]", '0', f"CASE WHEN length(t) > {p.split} THEN {parts(units('text'), p.max, p.overlap)} ELSE []::VARCHAR[] END")} AS item FROM cr),
cl AS (SELECT doc, run, list(item ORDER BY ord) AS items FROM cp GROUP BY doc, run),
cf AS (SELECT doc, run, list_reduce(list_prepend({made(empty, none, '0')}, items), lambda a, x: {step}) AS folded FROM cl),
cc AS (SELECT doc, run, {close('folded')} AS cs FROM cf),
cu AS (SELECT doc, run, i, cs[i] AS c FROM (SELECT doc, run, cs, unnest(range(1, len(cs) + 1)) AS i FROM cc)),
made AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY run, i)::INT AS chunk_index, c.reason AS reason, c.text AS text, c.o AS o, c.m AS m, c.j AS j, c.part AS part, c.parts AS parts FROM cu)"""


#: Sections of the books by the textbook profile: headings to level 4 hold text, those above end at their first child.
SECTIONS = f"""{STARTS}, loc AS (SELECT h.*, s.start FROM heads h JOIN starts s USING (doc, ord) WHERE s.start IS NOT NULL),
ends AS (SELECT a.doc, a.ord, a.title, a.level, a.parent_ord, a.start, arg_min(b.start, b.ord) AS stop FROM loc a LEFT JOIN loc b ON a.doc = b.doc AND b.ord > a.ord AND (b.level <= a.level OR (b.parent_ord = a.ord AND a.level < 4)) WHERE a.level <= 4 GROUP BY ALL),
held AS (SELECT e.doc, e.ord, e.title, e.level, e.parent_ord, min(f.page) AS page_start, max(f.page) AS page_end, coalesce(string_agg(f.text, chr(10) ORDER BY f.idx) FILTER (f.idx > e.start), '') AS raw
 FROM ends e JOIN flat f ON f.doc = e.doc AND f.idx >= e.start AND (f.idx < coalesce(e.stop, 1 << 30) OR f.idx = e.start) GROUP BY ALL),
secs AS (SELECT doc, ord, title, level, parent_ord, page_start, page_end, {strip(f"list_reduce(CASE WHEN len(l) = 0 THEN [''] ELSE l END, lambda a, c: CASE WHEN {KEEP} THEN a || chr(10) || c ELSE a || {GLUE} || c END)")} AS text
 FROM (SELECT *, list_filter(list_transform({lines(norm('raw'))}, lambda x: {strip('x')}), lambda x: x <> '') AS l FROM held))"""
BOOK_CHUNKS = f"{SECTIONS}, {chunks('secs', PROFILES['textbook'])}"

# The rules of the classifier with what they say, in the order of signals.
_others = {
    ("english", "6"): "mostly English text", ("technical", "7"): "detected 1 / 1.1 numeric hierarchy", ("technical", "4"): "detected deep numeric hierarchy", ("classical", "3"): "detected classical text headings",
    ("reference", "4"): "detected many short entry-like headings", ("reference", "3"): "detected alphabetical index headings", ("textbook", "6"): "detected 章/节 structure", ("social_science", "3"): "detected chapter-only structure",
}
_said = [r for _, _, r, _ in K.PATTERNS]
for _p, _n, _c in O._rules[len(_said) :]:
    _said.append("detected 条 structure" if _p == "legal" else ("detected fiction markers with chapter sequence" if "fiction marker" in _c or O._has(K.FICTION_MARKER) in _c else "detected chapter-only structure/fiction") if _p == "fiction" else _others[_p, _n])
_ruled = sorted(zip(_said, O._rules, strict=True), key=lambda r: K._ORDER.index(r[0]))
_list = "[" + ", ".join(f"CASE WHEN {c} THEN {{'p': '{p}', 'n': ({n})::INT, 'r': {q(r.split('/fiction')[0])}}} END" for r, (p, n, c) in _ruled) + "]"
SIGNALS = f"""WITH {O.SCORED}, found AS (SELECT doc_id, list_filter({_list}, lambda x: x IS NOT NULL) AS f FROM smp),
told AS (SELECT sc.*, {O._pick} AS top, {O._best} AS best, CASE WHEN len(f) = 0 THEN [{{'p': 'social_science', 'n': 1, 'r': 'fallback default'}}] ELSE f END AS f FROM sc JOIN found USING (doc_id))
SELECT doc_id, array_to_string(list_prepend(top || '+' || best || ': ' || CASE WHEN len(list_filter(f, lambda x: x.p = top)) > 0 THEN array_to_string(list_transform(list_filter(f, lambda x: x.p = top), lambda x: x.r), '; ') ELSE 'selected by highest total score' END,
 list_transform(list_filter(f, lambda x: x.p <> top), lambda x: x.p || '+' || x.n || ': ' || x.r)), ' | ') AS signals FROM told"""

# Packs: every record as it is written, its fields in order.
_t = lambda x: f"to_json({x})::VARCHAR"
_rec = lambda **fields: "'{' || " + " || ',' || ".join(f"""'"{n}":' || {v}""" for n, v in fields.items()) + " || '}'"
_s = lambda x: f"""'"{x}"'"""
_or = lambda x: f"coalesce(({x})::VARCHAR, 'null')"
_id = lambda x: f"""'"toc:' || lpad(({x})::VARCHAR, 6, '0') || '"'"""
_array = lambda xs: f"'[' || array_to_string({xs}, ',') || ']'"
_p = PROFILES["textbook"]
_doc = """'"sha256:' || doc || '"'"""
_step = lambda xs: f"list_transform({xs}, lambda x: " + _rec(toc_id=_id("x"), level="lv[x]", title=_t("ti[x]")) + ")"
_chunk = lambda x: f"""'"sha256:' || doc || ':chunk:' || lpad(({x})::VARCHAR, 6, '0') || '"'"""
PACK = f"""WITH RECURSIVE {BOOK_CHUNKS},
up AS (SELECT doc, ord, [ord]::INT[] AS path, parent_ord FROM heads UNION ALL SELECT u.doc, u.ord, list_prepend(h.ord, u.path), h.parent_ord FROM up u JOIN heads h ON h.doc = u.doc AND h.ord = u.parent_ord),
paths AS (SELECT doc, ord, path FROM up WHERE parent_ord IS NULL),
names AS (SELECT doc, list(title ORDER BY ord) AS ti, list(level ORDER BY ord) AS lv, count(*) AS items FROM heads GROUP BY doc),
ext AS (SELECT m.*, ti, lv, CASE WHEN NOT j THEN p.path WHEN len(p.path) > 1 THEN p.path[1:len(p.path) - 1] ELSE p.path END AS path, (SELECT min(page_start) FROM secs s WHERE s.doc = m.doc AND list_contains(m.o, s.ord)) AS pa, (SELECT max(page_end) FROM secs s WHERE s.doc = m.doc AND list_contains(m.o, s.ord)) AS pb, max(chunk_index) OVER (PARTITION BY m.doc) AS last
 FROM made m JOIN paths p ON p.doc = m.doc AND p.ord = m.o[1] JOIN names n ON n.doc = m.doc),
emb AS (SELECT *, '书名：' || doc || chr(10) || '章节路径：' || array_to_string(list_transform(path, lambda x: ti[x]), ' > ') || chr(10) || CASE WHEN len(m) > 0 THEN '包含小节：' || array_to_string(list_transform(m, lambda x: ti[x]), '；') || chr(10) ELSE '' END || chr(10) || text AS embedded FROM ext)
SELECT doc AS book, 1::INT AS line_no, {_rec(record_type=_s('manifest'), schema_version=_s('1.0'), document_id=_doc, title=_t('doc'), created_at=_s('2024-01-01T00:00:00+00:00'), source=_rec(file_name=_t("doc || '.txt'"), source_type=_s('txt'), source_sha256=_doc), language=_s('zh'),
 parser=_rec(name=_s('plain_text'), preserve_layout="'false'"), toc=_rec(source=_s('txt_heading_rules'), item_count='items'), chunking=_rec(strategy=_s('hierarchical_semantic'), profile=_s('textbook'), target_chars=_p.target, max_chars=_p.max, section_split_chars=_p.split, overlap_chars=_p.overlap, min_chunk_chars=_p.min, max_chunk_heading_level=_p.max_level, heading_detection=_s(_p.heading_detection), search_before_pages=1, search_after_pages=2, title_match_min_confidence="'0.82'"),
 embedding=_rec(provider=_s('none'), model=_s('none'), dimension=0, normalize="'false'"))} AS line FROM names
UNION ALL SELECT doc, 2, {_rec(record_type=_s('toc'), document_id=_doc, source=_s('txt_heading_rules'), items=_array("list(" + _rec(toc_id=_id('ord'), title=_t('title'), level='level', order='ord', parent_toc_id=f"CASE WHEN parent_ord IS NULL THEN 'null' ELSE {_id('parent_ord')} END", page='page', locate=_rec(method=_s('textbook_heading_rule'), confidence="'0.7'")) + " ORDER BY ord)"))} FROM heads GROUP BY doc
UNION ALL SELECT doc, chunk_index + 2, {_rec(record_type=_s('chunk'), document_id=_doc, chunk_id=_chunk('chunk_index'), chunk_index='chunk_index', text=_t('text'), embedding_text=_t('embedded'), heading_path=_array(f"list_transform(path, lambda x: {_t('ti[x]')})"), toc_path=_array(_step('path')), merged_headings=_array(_step('m')),
 content_type=_s('body'), source=_rec(pdf_page_start='pa', pdf_page_end='pb'), prev_chunk_id=f"CASE WHEN chunk_index = 1 THEN 'null' ELSE {_chunk('chunk_index - 1')} END", next_chunk_id=f"CASE WHEN chunk_index = last THEN 'null' ELSE {_chunk('chunk_index + 1')} END", stats=_rec(char_count='length(text)', embedding_char_count='length(embedded)'), content_hash="""'"sha256:' || sha256(text) || '"'""",
 split_info=_rec(strategy="CASE WHEN reason LIKE 'merged%' THEN '\"toc_node_merge\"' WHEN reason = 'section_exceeds_max_chars' THEN '\"paragraph_sentence_split\"' ELSE '\"toc_node\"' END", reason=_t('reason'), section_split_chars=f"CASE WHEN reason LIKE 'natural%' THEN '{_p.split}' ELSE 'null' END", merged_toc_ids=f"CASE WHEN reason LIKE 'merged%' THEN {_array('list_transform(m, lambda x: ' + _id('x') + ')')} ELSE 'null' END", part_index=_or('part'), part_count=_or('parts')), embedding="'[]'")} FROM emb"""

# Packs of several notes: sections are numbered through all files of a pack; a chunk tells the file of its first section.
NOTE_PACKS = f"""WITH {MDS}, {NPACK}, named AS ({O.ORACLES['relative_names'].replace(f'WITH {C.NOTES_SQL}, {NPACK}, k AS', 'WITH k AS')}),
nums AS (SELECT p.pack, p.path, m.ord AS o, m.title, m.level, m.parent_ord AS po, m.is_parent, m.text, row_number() OVER (PARTITION BY p.pack ORDER BY string_split(p.path, '/'), m.ord)::INT AS ord FROM ms m JOIN npack p ON p.note = m.path),
chosen AS (SELECT c.pack AS doc, c.ord, c.title, p.ord AS parent_ord, c.text FROM nums c LEFT JOIN nums p ON p.pack = c.pack AND p.path = c.path AND p.o = c.po WHERE c.text <> '' AND (c.is_parent OR c.level <= 4)),
{chunks('chosen', PROFILES['tech_notes'])},
hashed AS (SELECT n.pack, 'sha256:' || sha256('{{"files":["' || string_agg(file_path || '","sha256:' || sha256(notes.text), '","' ORDER BY string_split(n.path, '/')) || '"]}}') AS document_id FROM named n JOIN npack USING (pack, path) JOIN notes ON notes.path = npack.note GROUP BY n.pack)
SELECT pack, 1::INT AS line_no, 'manifest' AS kind, document_id, NULL::VARCHAR AS file_path, NULL::VARCHAR AS logical_date, (SELECT count(*) FROM nums WHERE nums.pack = hashed.pack)::VARCHAR AS items, NULL::VARCHAR AS text FROM hashed
UNION ALL SELECT pack, 2, 'toc', document_id, NULL, NULL, NULL, NULL FROM hashed
UNION ALL SELECT h.pack, chunk_index + 2, 'chunk', document_id, file_path, regexp_extract(notes.text, 'created: (\\S+)', 1), NULL, sha256(made.text) FROM made JOIN hashed h ON h.pack = made.doc JOIN nums ON nums.pack = made.doc AND nums.ord = made.o[1] JOIN named ON named.pack = nums.pack AND named.path = nums.path JOIN npack ON npack.pack = nums.pack AND npack.path = nums.path JOIN notes ON notes.path = npack.note"""

_preview = f"CASE WHEN length({norm('text')}) <= 500 THEN {norm('text')} ELSE regexp_replace(left({norm('text')}, 500), {q(W + '+$')}, '') || '...' END"
_short = O._SHORT.replace("text", "line")

ORACLES = {
    "normalize_title": f"SELECT doc_id, 'fiA1:' || regexp_replace(replace(nfc_normalize(text), '：', ':'), {q(W + '+')}, '', 'g') AS title FROM documents",
    "long_section_split": f"""WITH p AS (SELECT doc_id, {parts(units("replace(text, '. ', '。 ')"), 300, 20)} AS ps FROM documents)
SELECT doc_id, (i - 1)::INT AS pos, length(ps[i])::INT AS n, sha256(ps[i]) AS part FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p)""",
    "book_sections": f"WITH {SECTIONS} SELECT doc AS book, ord, 'toc:' || lpad(ord::VARCHAR, 6, '0') AS toc_id, level, page_start, page_end, sha256(text) AS text_sha256 FROM secs WHERE text <> ''",
    "chunks_book": f"WITH {BOOK_CHUNKS} SELECT doc AS book, chunk_index, reason, length(text)::INT AS n, sha256(text) AS text_sha256 FROM made",
    "chunk_links": f"""WITH {BOOK_CHUNKS}, ids AS (SELECT *, 'sha256:' || doc || ':chunk:' || lpad(chunk_index::VARCHAR, 6, '0') AS chunk_id FROM made)
SELECT doc AS book, chunk_index, chunk_id, lag(chunk_id) OVER w AS prev_chunk_id, lead(chunk_id) OVER w AS next_chunk_id, 'sha256:' || sha256(text) AS content_hash FROM ids WINDOW w AS (PARTITION BY doc ORDER BY chunk_index)""",
    "pack_jsonl": PACK,
    "markdown_packs": NOTE_PACKS,
    "chunks_markdown": f"""WITH {MDS}, chosen AS (SELECT path AS doc, ord, title, parent_ord, text FROM ms WHERE text <> '' AND (is_parent OR level <= 4)), {chunks('chosen', PROFILES['tech_notes'])}
SELECT doc AS path, chunk_index, reason, length(text)::INT AS n FROM made""",
    "classify_signals": SIGNALS,
    # Each sample is compared with the page that it is.
    "compare_samples": f"""WITH {CH}, picks AS ({O.ORACLES['sample_chunks'].replace(f'WITH {CH}, x AS', 'WITH x AS')})
SELECT p.book, p.pick, p.chunk_index, array_to_string(path, ' > ') AS heading_path, p.chunk_index AS page_start, p.chunk_index AS page_end, n::INT AS char_count, CASE WHEN {O.compact('text')} = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS match_rate, {_preview} AS chunk_preview, {_preview} AS source_preview
FROM picks p JOIN ch ON ch.doc = p.book AND ch.chunk_index = p.chunk_index""",
    "recommend_body_headings": f"""WITH {O.LEN}, {O.HEAD}, lx AS (SELECT {C.KEY_SQL} AS doc, unnest(list_append(list_transform({lines('text')}, lambda x: {strip('x')}), '批判性思维要素')) AS line FROM documents),
cand AS (SELECT doc, count(*) FILTER ({_short}) AS candidates FROM lx GROUP BY doc),
r AS (SELECT doc, candidates, candidates >= 12 AND ((long + very_long) / ls.chunks > 0.12 OR shallow_paths / ls.chunks > 0.45) AS want FROM cand JOIN ls USING (doc) JOIN hs USING (doc))
SELECT doc AS book, 'disabled' AS "current", CASE WHEN want THEN 'enabled' ELSE 'disabled' END AS recommended, CASE WHEN want THEN 'consider_enable' ELSE 'keep' END AS action, 'medium' AS confidence, candidates,
 CASE WHEN want THEN 'PDF 书签可能偏浅，正文中检测到较多短标题候选；如 chunk 仍偏长，可考虑启用/加强正文短标题增强。' ELSE '未发现足够强的正文短标题增强需求。' END AS reason FROM r""",
}

# Reports of the checks of lengths and headings, with samples: JSON, plain text and HTML.
_places = " ".join(f"WHEN {q(I.M[k])} THEN {n}" for k, n in (("very_long", 40), ("very_short", 41), ("length_ok", 42), ("length_bad", 43), ("path_empty", 50), ("path_shallow", 51), ("path_crowded", 52), ("path_ok", 53)))


def _esc(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


_sample = _rec(pick="pick", chunk_index="chunk_index", heading_path=_t("heading_path"), page_start="page_start", page_end="page_end", char_count="char_count", match_rate="match_rate::VARCHAR", chunk_preview=_t("chunk_preview"), source_preview=_t("source_preview"))
_card = f"""'<div class="card"><h3>chunk ' || chunk_index || ' · ' || page_start || '-' || page_end || '</h3><p>' || {_esc("heading_path")} || '</p><p>' || char_count || ' · ' || match_rate::VARCHAR || '</p><pre>' || {_esc("chunk_preview")} || '</pre><pre>' || {_esc("source_preview")} || '</pre></div>'"""
_row = f"""'<tr><td class="' || lower(status) || '">' || status || '</td><td>' || {_esc("message")} || '</td><td><code>' || {_esc("detail")} || '</code></td></tr>'"""
ORACLES["reports"] = f"""WITH raw AS (({O.ORACLES["length_checks"]}) UNION ALL ({O.ORACLES["heading_checks"]})), ck AS (SELECT *, CASE message {_places} END AS ord FROM raw),
v AS (SELECT book, greatest(0, 100 - 8 * count(*) FILTER (status = 'WARN')) AS score, CASE WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS result,
 string_agg({_rec(status=_t("status"), message=_t("message"), detail="detail")}, ',' ORDER BY ord) AS checks, string_agg('  [' || status || '] ' || message, chr(10) ORDER BY ord) AS told, string_agg({_row}, '' ORDER BY ord) AS shown FROM ck GROUP BY book),
s AS (SELECT book, string_agg({_sample}, ',' ORDER BY pick) AS samples, string_agg({_card}, '' ORDER BY pick) AS cards FROM ({ORACLES["compare_samples"]}) GROUP BY book),
r AS (SELECT *, '这本书' || CASE result WHEN 'PASS' THEN ' 的 no-embedding 自检通过，可以继续生成 embedding。' ELSE ' 基本可用，但建议先抽查 warnings 中提到的 chunk 或标题路径，再决定是否生成 embedding。' END AS advice FROM v JOIN s USING (book))
SELECT book, {_rec(result=_t("result"), score="score", doc=_t("book"), samples="'[' || samples || ']'", checks="'[' || checks || ']'", recommendation=_t("advice"))} AS json,
 result || ': ' || book || chr(10) || chr(10) || 'score: ' || score || '/100' || chr(10) || chr(10) || 'checks:' || chr(10) || told || chr(10) || chr(10) || 'recommendation:' || chr(10) || '  ' || advice AS report,
 '<!doctype html><html lang="zh-CN"><head><meta charset="utf-8"><title>' || {_esc("book")} || '</title><style>' || {q(I._STYLE)} || '</style></head><body><h1>' || {_esc("book")} || '</h1><p class="' || lower(result) || '">' || result || ' · ' || score || ' / 100</p><p>' || {_esc("advice")} || '</p><h2>检查项</h2><table><tr><th>状态</th><th>说明</th><th>详情</th></tr>' || shown || '</table><h2>抽样对照</h2>' || cards || '</body></html>' AS html FROM r"""
