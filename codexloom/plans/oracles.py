"""The SQL that states the registered queries' results, for DuckDB."""

from __future__ import annotations

from codexloom.functions import headings as H
from codexloom.functions import text as T
from codexloom.functions.profiles import BOOK_PROFILES
from codexloom.operators import classify as K
from codexloom.operators import inspect as I
from codexloom.plans import corpora as C


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def obj(**fields: str) -> str:
    """A JSON object of SQL expressions that give JSON, its names in order."""
    return "'{' || " + " || ',' || ".join(f"""'"{n}":' || {v}""" for n, v in sorted(fields.items())) + " || '}'"


def num(x: str) -> str:
    return f"regexp_replace(({x})::VARCHAR, '\\.0+$', '')"


def text(x: str) -> str:
    return f"to_json({x})::VARCHAR"


W, LE = T.W, T.LINE_END


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q('^' + W + '+')}, ''), {q(W + '+$')}, '')"


def norm(x: str) -> str:
    x = f"regexp_replace(replace({x}, '　', ' '), {q(chr(13) + chr(10) + '|' + chr(13))}, chr(10), 'g')"
    x = f"regexp_replace({x}, '[ \\t]+\\n', chr(10), 'g')"
    return strip(f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def compact(x: str) -> str:
    return f"regexp_replace({norm(x)}, {q(W + '+')}, '', 'g')"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def like(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def lines(x: str) -> str:
    return f"string_split_regex({x}, {q(LE)})"


ODD = "'　' || replace(text, '. ', '.　 ' || chr(9) || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || chr(10)) || ' ' || chr(9) || ' '"
MARKED = "text || CASE doc_id % 4 WHEN 0 THEN '□■�' WHEN 1 THEN '字a中b文Ab字' WHEN 2 THEN chr(57345) ELSE '' END"
BARE = f"regexp_replace(m, {q(W + '+')}, '', 'g')"
REST = f"regexp_replace({BARE}, {q(T._PLAIN)}, '', 'g')"
GARBLED = f"(m <> '' AND ({like('m', T._ODD)} OR (w + p > 0 AND w * 50 >= (w + p) * 9)))"
TITLE = f"""t1 AS (SELECT *, {MARKED} AS m FROM documents),
t2 AS (SELECT *, 2 * {count(REST, '[\\x00-\\x1f' + chr(0xfffd) + ']')} + {count(REST, '[\\x{3000}-\\x{fffc}\\x{fffe}-\\x{10ffff}]')} AS w, {count(BARE, T._PLAIN)} AS p,
  {count(BARE, '[' + chr(0xfffd) + '□■◆◇\\x00-\\x1f]')} + {count(BARE, '[\\x{e000}-\\x{f8ff}]')} + {count('m', f'[A-Za-z]{T.CJK}[A-Za-z]|{T.CJK}[A-Za-z]{{2,}}{T.CJK}')} AS bad, length({BARE}) AS n FROM t1)"""

ORACLES: dict[str, str] = {
    "normalize_text": f"SELECT doc_id, sha256({norm(ODD)}) AS normalized FROM documents",
    "compact_text": f"SELECT doc_id, sha256({compact(ODD)}) AS compact FROM documents",
    "preview_text": f"SELECT doc_id, CASE WHEN length(t) <= 40 THEN t ELSE regexp_replace(left(t, 40), {q(W + '+$')}, '') || '...' END AS preview FROM (SELECT doc_id, {norm('text')} AS t FROM documents)",
    "content_hash": "SELECT doc_id, 'sha256:' || sha256(text) AS content_hash FROM documents",
    "document_id": "SELECT page_id, 'sha256:' || sha256(html) AS document_id, 'd:chunk:' || lpad(page_id::VARCHAR, 6, '0') AS chunk_id FROM pages",
    "safe_stem": r"""SELECT page_id, regexp_replace(url, '[<>:"/\\|?*]+', '_', 'g') AS stem, CASE WHEN n = '' THEN 'document' ELSE n END AS name
FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(url, '^.*/', ''), '(.)\.[^.]*$', '\1'), '[<>:"/\\|?*]+', '_', 'g') AS n FROM pages)""",
    "english_ratio_counts": f"SELECT doc_id, {count('t', '[A-Za-z]')}::INT AS letters, {count('t', T.CJK)}::INT AS cjk, CASE WHEN {count('t', '[A-Za-z]')} + {count('t', T.CJK)} = 0 THEN FALSE ELSE {count('t', '[A-Za-z]')}::DOUBLE / ({count('t', '[A-Za-z]')} + {count('t', T.CJK)}) > 0.55 END AS mostly_english FROM (SELECT doc_id, text || '摘要第' || repeat('字', (doc_id % 300)::INT) AS t FROM documents)",
    "garbled_ratio_counts": f"WITH {TITLE} SELECT doc_id, bad::INT AS suspicious, n::INT AS characters, ({strip('m')} <> '' AND ({GARBLED} OR (n > 0 AND least(1.0, bad::DOUBLE / n) > 0.12))) AS garbled FROM t2",
    "is_garbled_title": f"WITH {TITLE} SELECT doc_id, coalesce({GARBLED}, FALSE) AS garbled FROM t2",
    "flatten_lines": f"SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS idx, t AS text FROM (SELECT doc_id, i, {strip('l[i]')} AS t FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {lines('text')} AS l FROM documents))) WHERE t <> ''",
    "candidate_runs": "WITH r AS (SELECT DISTINCT user_id, (event_id // 7)::INT AS idx FROM events), g AS (SELECT *, idx - row_number() OVER (PARTITION BY user_id ORDER BY idx) AS g FROM r) SELECT user_id, idx FROM g QUALIFY count(*) OVER (PARTITION BY user_id, g) < 3",
    "null_embedding": "SELECT doc_id, 0::INT AS dimension FROM documents",
    "l2_normalize": "SELECT vec_id, (i - 1)::INT AS pos, round(embedding[i]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)",
    "failed_sources": "SELECT 'raw/p' || page_id || CASE page_id % 4 WHEN 2 THEN '.docx' ELSE '' END AS path, 'UnsupportedSourceError' AS error_class, '非支持文件，请检查文件格式' AS message FROM pages WHERE page_id % 4 IN (2, 3)",
    "unique_destinations": "SELECT 'in/' || lpad(page_id::VARCHAR, 9, '0') AS path, 'book' || page_id % 11 || '.pdf' AS name, CASE WHEN n = 0 THEN 'book' || page_id % 11 || '.pdf' ELSE 'book' || page_id % 11 || '_' || n || '.pdf' END AS target FROM (SELECT page_id, row_number() OVER (PARTITION BY page_id % 11 ORDER BY page_id) - 1 AS n FROM pages)",
}

# Reflow: the last line so far is what stands after the last line break kept.
KEEP = f"""(regexp_matches(c, '^[■●•—-]') OR regexp_matches(c, '^[（(]?\\p{{Nd}}+[）)、.．]') OR regexp_matches(c, {q(T.rx(r'^图\s*\d|^表\s*\d|^策略\s*\d+'))})
  OR (length(regexp_extract(a, '[^\\n]*$')) <= 18 AND regexp_matches(a, '[：:？?。！!]$')) OR (regexp_matches(a, '[。！？；;]$') AND length(c) <= 40))"""
GLUE = "CASE WHEN regexp_matches(a, '[A-Za-z0-9]$') AND regexp_matches(c, '^[A-Za-z0-9]') THEN ' ' ELSE '' END"
ORACLES["reflow_text"] = f"""SELECT doc_id, sha256({strip(f"coalesce(list_reduce(l, lambda a, c: CASE WHEN {KEEP} THEN a || chr(10) || c ELSE a || {GLUE} || c END), '')")}) AS reflowed
FROM (SELECT doc_id, list_filter(list_transform({lines(norm('text'))}, lambda x: {strip('x')}), lambda x: x <> '') AS l FROM documents)"""


def windows(a: str, size: int, most: int) -> str:
    return f"range(0, (length({a}) - {size} + 1)::BIGINT, greatest({size}, length({a}) // {most}))"


ORACLES["sample_match_rate"] = f"""
WITH r AS (SELECT doc_id, text || coalesce(lag(text) OVER w, '') AS a, coalesce(lag(text) OVER w, '') AS b FROM documents WINDOW w AS (PARTITION BY {C.KEY_SQL} ORDER BY doc_id)),
m AS (SELECT doc_id, CASE WHEN a = '' OR b = '' THEN 0 WHEN length(a) <= 80 THEN contains(b, a)::BIGINT ELSE len(list_filter({windows('a', 80, 120)}, lambda i: contains(b, substr(a, i + 1, 80))))::BIGINT END AS matched,
  CASE WHEN a = '' OR b = '' THEN 0 WHEN length(a) <= 80 THEN 1 ELSE len({windows('a', 80, 120)})::BIGINT END AS samples FROM r)
SELECT *, CASE WHEN samples = 0 THEN 0 ELSE round_even(matched / samples, 3) END::DOUBLE AS rate FROM m"""
ORACLES["oversized_windows"] = """
WITH n AS (SELECT doc_id, text, 1 + greatest(0, ceil((length(text) - 300) / 280.0))::BIGINT AS n FROM documents)
SELECT doc_id, k::INT AS pos, sha256(substr(text, k * 280 + 1, 300)) AS part FROM (SELECT doc_id, text, unnest(range(0, n)) AS k FROM n)"""
ORACLES["paragraph_sentence_units"] = f"""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(replace(replace(text, '. ', '。 '), ',' || chr(10), chr(10) || chr(10)), {q(chr(10) + W + '*' + chr(10))}), lambda x: {strip('x')}), lambda x: x <> '') AS ps FROM documents),
u AS (SELECT doc_id, flatten(list_transform(ps, lambda x: CASE WHEN length(x) <= 500 THEN [x] ELSE list_filter(list_transform(string_split(regexp_replace(x, '([。！？；;!?])', '\\1' || chr(31), 'g'), chr(31)), lambda y: {strip('y')}), lambda y: y <> '') END)) AS us FROM p)
SELECT doc_id, (i - 1)::INT AS pos, length(us[i])::INT AS n, sha256(us[i]) AS unit FROM (SELECT doc_id, us, unnest(range(1, len(us) + 1)) AS i FROM u)"""
ORACLES["embedding_text"] = """SELECT doc_id, sha256('书名：' || source || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '章节路径：' || source || ' > ' || lang ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN chr(10) || '包含小节：a；b' ELSE '' END || chr(10) || chr(10) || text) AS embedding_text FROM documents"""

# ---- headings -------------------------------------------------------------------------------------------------------


def gate(x: str, profile: str) -> str:
    rules = (H.CHAPTER, H.SHORT_HEADING, H.HAS_COLON) if profile == "social_science" else (*H.ANY_RULE, *((H.REFERENCE_ALPHA, H.REFERENCE_ENTRY) if profile == "reference" else ()))
    return f"({x} <> '' AND NOT {like(x, '^[■•—-]')} AND length({x}) <= 60 AND NOT {like(x, H.END_MARKS)} AND ({' OR '.join(like(x, r) for r in rules)}))"


def own(x: str, profile: str) -> str:
    cases = []
    for pattern, level in H.LEVELS[profile]:
        value = level if isinstance(level, int) else f"least(6, {level[-1]} + length(regexp_extract({x}, '^[^ ]*')) - length(replace(regexp_extract({x}, '^[^ ]*'), '.', '')))"
        cases.append(f"WHEN {like(x, pattern)} THEN {value}")
    return f"(CASE {' '.join(cases)} END)::INT"


def flat(book: str) -> str:
    return f"""{book},
flat AS (SELECT doc, (row_number() OVER (PARTITION BY doc ORDER BY page, i) - 1)::INT AS idx, page, t AS text FROM
  (SELECT doc, page, i, {strip('l[i]')} AS t FROM (SELECT doc, page, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc, page, {lines('text')} AS l FROM book))) WHERE t <> '')"""


def contents(book: str, profile: str) -> str:
    """heads: doc, ord, title, page, level, parent_ord."""
    return f"""{flat(book)},
h1 AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY idx)::INT AS ord, text AS title, page, {own('text', profile)} AS own FROM flat WHERE {gate('text', profile)}),
h2 AS (SELECT *, lag(own) OVER w AS b, lag(ord) OVER w AS bo FROM h1 WINDOW w AS (PARTITION BY doc ORDER BY ord)),
h3 AS (SELECT doc, ord, title, page, coalesce(own, CASE WHEN ord = 1 THEN 1 WHEN NOT {like('title', H.HAS_COLON)} THEN 2 WHEN b >= 2 OR (b IS NULL AND bo > 1) THEN 3 ELSE 2 END)::INT AS level FROM h2),
heads AS (SELECT a.doc, a.ord, any_value(a.title) AS title, any_value(a.page) AS page, any_value(a.level) AS level, max(b.ord) AS parent_ord FROM h3 a LEFT JOIN h3 b ON a.doc = b.doc AND b.ord < a.ord AND b.level < a.level GROUP BY a.doc, a.ord)"""


for _p in BOOK_PROFILES:
    _b = C.EN if _p == "english" else C.ZH
    ORACLES[f"heading_candidates_{_p}"] = f"WITH {flat(_b)} SELECT doc AS book, idx, text, {own('text', _p)} AS own_level FROM flat WHERE {gate('text', _p)}"
    ORACLES[f"infer_toc_{_p}"] = f"WITH {contents(_b, _p)} SELECT doc AS book, ord, 'toc:' || lpad(ord::VARCHAR, 6, '0') AS toc_id, title, level, parent_ord FROM heads"
TB = contents(C.ZH, "textbook")
ORACLES["toc_paths"] = f"""WITH RECURSIVE {TB}, up AS (SELECT doc, ord, title AS path, 1 AS depth, parent_ord FROM heads
  UNION ALL SELECT u.doc, u.ord, h.title || ' > ' || u.path, u.depth + 1, h.parent_ord FROM up u JOIN heads h ON h.doc = u.doc AND h.ord = u.parent_ord)
SELECT doc AS book, ord, path, depth::BIGINT AS depth FROM up WHERE parent_ord IS NULL"""
ORACLES["level_counts"] = f"WITH {TB} SELECT doc AS book, level, count(*) AS n FROM heads GROUP BY ALL"
ORACLES["sibling_groups"] = f"""WITH {TB}, c AS (SELECT doc, ord, CASE WHEN ord > 1 AND parent_ord IS NOT DISTINCT FROM lag(parent_ord) OVER (PARTITION BY doc ORDER BY ord) THEN 0 ELSE 1 END AS new FROM heads)
SELECT doc AS book, ord, sum(new) OVER (PARTITION BY doc ORDER BY ord)::INT AS run FROM c"""


def key(x: str) -> str:
    return f"regexp_replace(replace({x}, '：', ':'), {q(W + '+')}, '', 'g')"



STARTS = f"""{TB}, keyed AS (SELECT doc, idx, page, {key('text')} AS k FROM flat),
starts AS (SELECT h.doc, h.ord, min(k.idx)::INT AS start FROM heads h LEFT JOIN keyed k ON k.doc = h.doc AND k.page BETWEEN h.page - 1 AND h.page + 2 AND starts_with(k.k, left({key('h.title')}, 18)) GROUP BY h.doc, h.ord)"""
ORACLES["locate_heading_lines"] = f"WITH {STARTS} SELECT doc AS book, ord, start FROM starts"
for _name, _rule in (("section_spans", "b.parent_ord = a.ord"), ("section_spans_max_level", "FALSE AND b.parent_ord = a.ord")):
    ORACLES[_name] = f"""WITH {STARTS}, loc AS (SELECT h.*, s.start FROM heads h JOIN starts s USING (doc, ord) WHERE s.start IS NOT NULL)
SELECT a.doc AS book, a.ord, a.start, arg_min(b.start, b.ord) AS "end" FROM loc a LEFT JOIN loc b ON a.doc = b.doc AND b.ord > a.ord AND (b.level <= a.level OR {_rule}) GROUP BY a.doc, a.ord, a.start"""
ORACLES["body_short_headings"] = f"""WITH l AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {lines('text')} AS l FROM documents)),
r AS (SELECT doc_id, (i - 1)::INT AS i, {strip('l[i]')} AS raw FROM l WHERE i < len(l) OR l[i] <> ''),
t AS (SELECT doc_id, i, raw AS line FROM r UNION ALL SELECT doc_id, i, '批判思维' || raw || CASE doc_id % 3 WHEN 0 THEN '（一）' WHEN 1 THEN '：' ELSE '' END FROM r)
SELECT doc_id, i, line FROM t WHERE length(line) BETWEEN 4 AND 30 AND NOT {like('line', H.END_MARKS)} AND NOT {like('line', '[。！？；“”"《》]|——')} AND NOT {like('line', H.CHAPTER)} AND NOT {like('line', H.PART)} AND NOT {like('line', H.SECTION)}
 AND NOT {like('line', '^[（(' + chr(92) + '[A-Za-z]')} AND {count('line', '（')} = {count('line', '）')} AND {count('line', chr(92) + '(')} = {count('line', chr(92) + ')')} AND {count('line', T.CJK)} >= 4 AND {count('line', '[A-Za-z]')} * 20 <= length(line) * 7"""
PRINTED = f"""items AS (SELECT *, '第' || ord || CASE WHEN ord % 3 = 0 THEN '章 ' ELSE '篇 ' END || doc AS title, (ord - 1) // ceil(m / 10.0)::INT + 1 AS page
 FROM (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY doc_id)::INT AS ord, count(*) OVER (PARTITION BY doc) AS m FROM (SELECT {C.KEY_SQL} AS doc, doc_id FROM documents)))"""
ORACLES["front_matter_candidates"] = f"WITH {PRINTED} SELECT doc AS book, ord, title, CASE WHEN ord % 3 = 0 THEN 2 ELSE 1 END::INT AS level FROM items WHERE page <= 8"
ORACLES["repair_titles"] = f"""WITH {PRINTED}, n AS (SELECT doc, count(*) AS n, count(*) FILTER (page <= 8) AS seen FROM items GROUP BY doc), r AS (SELECT doc, ord, title, page <= 8 AND ord % 4 = 0 AND seen >= greatest(3, floor(n * 0.6)) AS fixed FROM items JOIN n USING (doc))
SELECT doc AS book, ord, CASE WHEN ord % 4 = 0 AND NOT fixed THEN chr(57344) || chr(57345) ELSE title END AS title, fixed AS repaired FROM r"""

# ---- Markdown -------------------------------------------------------------------------------------------------------

BODY = "CASE WHEN starts_with(text, '---' || chr(10)) AND contains(text[5:], chr(10) || '---' || chr(10)) THEN substr(text, 5 + instr(text[5:], chr(10) || '---' || chr(10)) - 1 + 5) ELSE text END"
MDH = f"""{C.NOTES_SQL}, body AS (SELECT path, {BODY} AS body FROM notes), bl AS (SELECT path, {lines('body')} AS l FROM body),
ml AS (SELECT path, i - 1 AS line, {strip('l[i]')} AS raw FROM (SELECT path, l, unnest(range(1, len(l) + 1)) AS i FROM bl)),
fenced AS (SELECT *, starts_with(raw, '```') OR starts_with(raw, '~~~') AS f, sum((starts_with(raw, '```') OR starts_with(raw, '~~~'))::INT) OVER (PARTITION BY path ORDER BY line) AS s FROM ml),
mh AS (SELECT path, line::INT AS line, length(regexp_extract(raw, '^(#{{1,6}}) (.+)$', 1))::INT AS level, regexp_extract(raw, '^(#{{1,6}}) (.+)$', 2) AS title FROM fenced WHERE NOT f AND s % 2 = 0 AND regexp_matches(raw, '^#{{1,6}} .'))"""
ORACLES["md_headings_fenced"] = f"WITH {MDH} SELECT path, line, level, title FROM mh"
MDS = f"""{MDH}, mt AS (SELECT path, line, least(level + 1, 7) AS level, title FROM mh UNION ALL SELECT path, -1, 1, regexp_replace(path, '\\.[^.]*$', '') FROM notes),
mo AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY line)::INT AS ord FROM mt),
me AS (SELECT a.path, a.ord, a.line, a.level, a.title, max(CASE WHEN b.ord < a.ord AND b.level < a.level THEN b.ord END) AS parent_ord, min(CASE WHEN b.ord > a.ord AND (a.level < 4 OR b.level <= a.level) THEN b.line END) AS e FROM mo a JOIN mo b ON a.path = b.path GROUP BY ALL),
ms AS (SELECT me.path, ord, title, level::INT AS level, parent_ord, EXISTS (SELECT 1 FROM me c WHERE c.path = me.path AND c.parent_ord = me.ord) AS is_parent, {norm("array_to_string(l[(line + 2)::BIGINT : coalesce(e, len(l))::BIGINT], chr(10))")} AS text FROM me JOIN bl ON bl.path = me.path)"""
ORACLES["md_sections"] = f"WITH {MDS} SELECT path, ord, title, level, parent_ord, is_parent, sha256(text) AS text_sha256 FROM ms"
ORACLES["md_dropped_sections"] = f"WITH {MDS} SELECT path, title, level FROM ms WHERE text <> '' AND NOT is_parent AND level > 4"
ORACLES["front_matter"] = f"WITH {C.NOTES_SQL} SELECT path, regexp_extract(text, 'created: (\\S+)', 1) AS created, 'Conversation' AS title, sha256({BODY}) AS body_sha256 FROM notes"
ORACLES["logical_dates"] = f"""WITH {C.NOTES_SQL}, {C.JOURNAL_SQL}
SELECT path, regexp_extract(text, 'created: (\\S+)', 1) AS front_matter_date, regexp_extract(text, 'created: (\\S+)', 1) AS logical_date, '2024-01' AS logical_month FROM notes
UNION ALL SELECT path, NULL, d, left(d, 7) FROM (SELECT path, CASE WHEN contains(path, 'note') THEN '2020-02-03' ELSE substr(path, 9, 10) END AS d FROM journal)"""
ORACLES["journal_month_packs"] = f"WITH {C.JOURNAL_SQL} SELECT k AS pack_key, '日记 ' || k AS title, 'journal_' || k AS output_stem, count(*) AS n_files, string_agg(path, ',' ORDER BY path) AS files FROM (SELECT path, CASE WHEN contains(path, 'note') THEN 'undated' ELSE substr(path, 9, 7) END AS k FROM journal) GROUP BY k"
ORACLES["tech_note_packs"] = f"""WITH {C.PATHS_SQL} SELECT t AS title, t AS output_stem, loose, string_agg(path, ',' ORDER BY path) AS files FROM
(SELECT path, NOT contains(path, '/') AS loose, CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE regexp_replace(path, '\\.[^.]*$', '') END AS t FROM paths WHERE path LIKE '%.md' OR (NOT contains(path, '/') AND lower(path) LIKE '%.md')) GROUP BY t, loose"""
ORACLES["web_page_packs"] = f"WITH {C.PATHS_SQL} SELECT t AS title, t AS output_stem, path AS files FROM (SELECT path, regexp_replace(regexp_replace(path, '^.*/', ''), '\\.[^.]*$', '') AS t FROM paths WHERE path LIKE '%.md')"
ORACLES["markdown_source_hash"] = f"""WITH {C.NOTES_SQL} SELECT (length(path) % 3)::INT AS bucket, 'sha256:' || sha256('{{"files":["' || string_agg(path || '","sha256:' || sha256(text), '","' ORDER BY path) || '"]}}') AS document_id FROM notes GROUP BY 1"""

_DIGITS = "regexp_extract(path, '(\\d+)', 1)::BIGINT"
NPACK = f"npack AS (SELECT 'pack' || {_DIGITS} % 40 AS pack, path AS note, 'notes/part' || {_DIGITS} % 3 || '/' || path AS path FROM notes)"
ORACLES["relative_names"] = f"""WITH {C.NOTES_SQL}, {NPACK}, k AS (SELECT pack, count(*) AS files, count(DISTINCT split_part(path, '/', 2)) AS parts FROM npack GROUP BY pack)
SELECT pack, path, CASE WHEN parts = 1 THEN split_part(path, '/', 3) ELSE split_part(path, '/', 2) || '/' || split_part(path, '/', 3) END AS file_path FROM npack JOIN k USING (pack)"""
ORACLES["markdown_pack_sections"] = f"""WITH RECURSIVE {MDS}, {NPACK}, nums AS (SELECT p.pack, p.path, m.ord AS o, m.title, m.level, m.parent_ord AS po, row_number() OVER (PARTITION BY p.pack ORDER BY string_split(p.path, '/'), m.ord)::INT AS ord FROM ms m JOIN npack p ON p.note = m.path),
tied AS (SELECT c.pack, c.path, c.ord, c.title, c.level, p.ord AS parent_ord FROM nums c LEFT JOIN nums p ON p.pack = c.pack AND p.path = c.path AND p.o = c.po),
up AS (SELECT pack, ord, ord::VARCHAR AS path_ords, parent_ord FROM tied UNION ALL SELECT u.pack, u.ord, t.ord || '>' || u.path_ords, t.parent_ord FROM up u JOIN tied t ON t.pack = u.pack AND t.ord = u.parent_ord)
SELECT t.pack, t.path, t.ord, t.title, t.level, t.parent_ord, u.path_ords FROM tied t JOIN up u ON u.pack = t.pack AND u.ord = t.ord AND u.parent_ord IS NULL"""

# ---- profiles, classification ---------------------------------------------------------------------------------------

# The parameters of every profile.
DIM = """SELECT * FROM (VALUES
 ('social_science', 'book', 800, 1200, 2000, 220, 100, NULL::INT),
 ('textbook', 'book', 700, 1100, 2000, 180, 80, 4),
 ('technical', 'book', 700, 1100, 2000, 180, 80, 4),
 ('paper', 'book', 700, 1100, 1800, 180, 80, 4),
 ('legal', 'book', 650, 1000, 1600, 120, 60, 4),
 ('english', 'book', 900, 1400, 2200, 220, 120, 4),
 ('fiction', 'book', 1000, 1600, 2400, 260, 160, NULL),
 ('classical', 'book', 700, 1100, 2000, 160, 80, 3),
 ('reference', 'book', 550, 900, 1400, 80, 40, 2),
 ('journal', 'markdown', 700, 1100, 1800, 120, 80, 4),
 ('tech_notes', 'markdown', 700, 1100, 2000, 120, 80, 4),
 ('web_page_collection', 'markdown', 700, 1100, 1800, 120, 80, 4)) t(profile, kind, target_chars, max_chars, section_split_chars, min_chunk_chars, overlap_chars, max_chunk_heading_level)"""
_names = "[" + ", ".join(q(p) for p in (*BOOK_PROFILES, "unknown")) + "]"
META = f"""meta AS (SELECT doc_id, {_names}[(doc_id % 10 + 1)::INT] AS profile, CASE WHEN doc_id % 4 <> 0 THEN 80 END AS overlap, CASE WHEN doc_id % 3 = 0 THEN 'none' ELSE 'local' END AS provider, doc_id % 2 AS dimension FROM documents),
dim AS ({DIM}),
pm AS (SELECT meta.*, dim.profile IS NOT NULL AS known, CASE WHEN dim.profile IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN target_chars <> 700 THEN 'target_chars' END, CASE WHEN max_chars <> 1100 THEN 'max_chars' END, CASE WHEN section_split_chars <> 2000 THEN 'section_split_chars' END, CASE WHEN min_chunk_chars <> 180 THEN 'min_chunk_chars' END, CASE WHEN overlap_chars <> overlap THEN 'overlap_chars' END], lambda x: x IS NOT NULL), ',') END AS mismatches
 FROM meta LEFT JOIN dim ON dim.profile = meta.profile AND dim.kind = 'book')"""
ORACLES["profile_defaults"] = f"""WITH dim AS ({DIM}), u AS (SELECT doc_id, CASE doc_id % 13 {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(('social_science', 'textbook', 'technical', 'paper', 'legal', 'english', 'fiction', 'classical', 'reference', 'journal', 'tech_notes', 'web_page_collection', 'unknown')))} END AS profile, CASE WHEN doc_id % 3 = 0 THEN (500 + doc_id % 7)::INT END AS target, CASE WHEN doc_id % 4 = 0 THEN 0::INT END AS overlap FROM documents)
SELECT u.doc_id, u.profile, kind, coalesce(target, target_chars) AS target_chars, max_chars, section_split_chars, min_chunk_chars, coalesce(overlap, overlap_chars) AS overlap_chars, max_chunk_heading_level FROM u LEFT JOIN dim USING (profile)"""
ORACLES["profile_mismatches"] = f"WITH {META} SELECT doc_id, profile, known, mismatches FROM pm"
_pair = lambda name, mine: f"""CASE WHEN {name} <> {mine} THEN '"{name}":' || {obj(manifest=mine, profile_default=name)} END"""
_unlike = "'{' || array_to_string(list_filter([" + ", ".join(_pair(*x) for x in (("max_chars", "1100"), ("min_chunk_chars", "180"), ("overlap_chars", "overlap"), ("section_split_chars", "2000"), ("target_chars", "700"))) + "], lambda x: x IS NOT NULL), ',') || '}'"
ORACLES["check_profile"] = f"""WITH {META}, x AS (SELECT pm.*, CASE WHEN known THEN {_unlike} END AS unlike FROM pm LEFT JOIN dim ON dim.profile = pm.profile AND dim.kind = 'book'), r AS (
 SELECT doc_id, CASE WHEN NOT known THEN 30 WHEN mismatches <> '' THEN 31 ELSE 32 END AS ord, CASE WHEN known AND mismatches = '' THEN 'PASS' ELSE 'WARN' END AS status, CASE WHEN NOT known THEN {q(I.M['profile_unknown'])} WHEN mismatches <> '' THEN {q(I.M['profile_bad'])} ELSE {q(I.M['profile_ok'])} END AS message, CASE WHEN known AND mismatches <> '' THEN unlike ELSE {obj(profile=text('profile'))} END AS detail FROM x
 UNION ALL SELECT doc_id, CASE WHEN provider <> 'none' THEN 33 WHEN dimension <> 0 THEN 34 ELSE 35 END, CASE WHEN provider = 'none' AND dimension = 0 THEN 'PASS' ELSE 'WARN' END, CASE WHEN provider <> 'none' THEN {q(I.M['provider_bad'])} WHEN dimension <> 0 THEN {q(I.M['dimension_bad'])} ELSE {q(I.M['embedding_ok'])} END,
  CASE WHEN provider <> 'none' THEN {obj(provider=text('provider'))} WHEN dimension <> 0 THEN {obj(dimension='dimension')} ELSE '{{}}' END FROM pm WHERE known)
SELECT doc_id, ord::INT AS ord, status, message, detail FROM r"""


def re2(pattern: str) -> str:
    return T.rx(pattern)


SAMPLE = """smp AS (SELECT doc_id, text || CASE doc_id % 6 WHEN 0 THEN '
第一章 总论
第一节 概念
第二条 规定
' WHEN 1 THEN '
Abstract
Keywords: a
References
' WHEN 2 THEN '
1 Intro
1.1 API
1.1.1 x
2.1.1 y
' WHEN 3 THEN '
卷一
高祖纪
陈涉传
列传
' WHEN 4 THEN '
Part I One
Chapter 1 Two
' ELSE '' END AS s FROM documents)"""
_n = {k: f"len(regexp_extract_all(s, {q(re2(p))}))" for k, p in K.COUNTS.items()}
_has = lambda p: f"regexp_matches(s, {q(re2(p))})"
_ratio = f"{count('s', '[A-Za-z]')}::DOUBLE / nullif({count('s', '[A-Za-z]')} + {count('s', T.CJK)}, 0)"
_rules = [(p, str(points), _has(x)) for p, points, _, x in K.PATTERNS] + [
    ("english", "6", f"coalesce({_ratio} > 0.55, FALSE)"),
    ("technical", "7", f"{_has(r'(?m)^\s*\d+\s+\S+')} AND {_has(r'(?m)^\s*\d+\.\d+')}"),
    ("technical", "4", f"{_n['deep']} >= 2"),
    ("legal", f"least(10, 2 + {_n['articles']})", f"{_n['articles']} > 0"),
    ("fiction", "2", f"{_n['fiction']} >= 5 AND {_n['sections']} = 0"),
    ("fiction", "2", f"{_has(K.FICTION_MARKER)} AND {_n['fiction']} > 0"),
    ("classical", "3", f"{_n['bios']} >= 3"),
    ("reference", "4", f"{_n['entries']} >= 20"),
    ("reference", "3", f"{_n['letters']} >= 3"),
    ("textbook", "6", f"{_n['chapters']} > 0 AND {_n['sections']} > 0"),
    ("social_science", "3", f"{_n['chapters']} > 0 AND {_n['sections']} = 0"),
]
_sums = {p: " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for pp, n, c in _rules if pp == p) for p in BOOK_PROFILES}
SCORED = f"{SAMPLE}, raw AS (SELECT doc_id, {', '.join(f'({s})::INT AS {p}' for p, s in _sums.items())} FROM smp), sc AS (SELECT * REPLACE (CASE WHEN greatest({', '.join(BOOK_PROFILES)}) = 0 THEN 1 ELSE social_science END::INT AS social_science) FROM raw)"
ORACLES["classify_scores"] = f"WITH {SCORED} SELECT doc_id, {', '.join(BOOK_PROFILES)} FROM sc"
_best = f"greatest({', '.join(BOOK_PROFILES)})"
_pick = "CASE " + " ".join(f"WHEN {p} = {_best} THEN '{p}'" for p in K.PRIORITY) + " END"
_told = "array_to_string(list_transform(list_sort([" + ", ".join(f"{{'s': -{p}, 'p': '{p}'}}" for p in BOOK_PROFILES) + "]), lambda x: x.p || '=' || (-x.s)), ', ')"
ORACLES["classify_profile"] = f"WITH {SCORED} SELECT doc_id, {_pick} AS profile, {_told} AS score_text FROM sc"

# ---- inspection -----------------------------------------------------------------------------------------------------

CH = f"ch AS (SELECT {C.KEY_SQL} AS doc, doc_id, row_number() OVER (PARTITION BY {C.KEY_SQL} ORDER BY doc_id) AS chunk_index, text, length(text) AS n, CASE WHEN doc_id % 9 = 0 THEN [] ELSE [source, lang] END AS path FROM documents)"
LEN = f"{CH}, ls AS (SELECT doc, count(*) AS chunks, min(n)::INT AS min_chars, median(n)::DOUBLE AS median_chars, sum(n)::BIGINT AS sum_chars, max(n)::INT AS max_chars, count(*) FILTER (n < 100) AS very_short, count(*) FILTER (n >= 100 AND n < 300) AS short, count(*) FILTER (n BETWEEN 300 AND 2000) AS normal, count(*) FILTER (n > 2000 AND n <= 4000) AS long, count(*) FILTER (n > 4000) AS very_long FROM ch GROUP BY doc)"
ORACLES["length_stats"] = f"WITH {LEN} SELECT doc AS book, * EXCLUDE (doc) FROM ls"
_lengths = obj(min="min_chars", max="max_chars", median=num("median_chars"), average=num("round_even(sum_chars / chunks, 1)"), section_split_chars="2000", buckets=obj(very_short_lt_100="very_short", short_100_300="short", normal_300_to_section_split="normal", long_section_split_to_very_long="long", very_long="very_long"))
LCHECK = f"""lc AS (SELECT doc, 'WARN' AS status, {q(I.M['very_long'])} AS message, {obj(count='very_long', limit='4000')} AS detail FROM ls WHERE very_long > 0 UNION ALL SELECT doc, 'WARN', {q(I.M['very_short'])}, {obj(ratio=num('round_even(very_short / chunks, 3)'))} FROM ls WHERE very_short / chunks > 0.12
 UNION ALL SELECT doc, CASE WHEN normal / chunks >= 0.65 THEN 'PASS' ELSE 'WARN' END, CASE WHEN normal / chunks >= 0.65 THEN {q(I.M['length_ok'])} ELSE {q(I.M['length_bad'])} END, {_lengths} FROM ls)"""
ORACLES["length_checks"] = f"WITH {LEN}, {LCHECK} SELECT doc AS book, status, message, detail FROM lc"
HEAD = "hp AS (SELECT doc, array_to_string(path, ' > ') AS p, count(*) AS n, min(chunk_index) AS f FROM ch GROUP BY ALL), hb AS (SELECT doc, p, n FROM hp QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n DESC, f) = 1), hs AS (SELECT doc, count(*) AS chunks, count(*) FILTER (len(path) = 0) AS empty_paths, count(*) FILTER (len(path) <= 1) AS shallow_paths, sum(len(path))::BIGINT AS depth_sum, max(len(path))::INT AS max_depth FROM ch GROUP BY doc)"
ORACLES["heading_stats"] = f"WITH {CH}, {HEAD} SELECT doc AS book, hs.* EXCLUDE (doc), p AS common_path, n AS common_count FROM hs JOIN hb USING (doc)"
_paths = obj(empty_heading_path_count="empty_paths", shallow_heading_path_count="shallow_paths", average_depth=num("round_even(depth_sum / hs.chunks, 2)"), max_depth="max_depth", most_common_path=text("p"), most_common_path_count="n", body_heading_chunk_count="0", auto_heading_chunk_count="0")
ORACLES["heading_checks"] = f"""WITH {CH}, {HEAD}, b AS (SELECT hs.*, p, n, shallow_paths / chunks > 0.65 AND chunks >= 20 AS shallow, n / chunks > 0.35 AND chunks >= 20 AS crowded, {_paths} AS stats FROM hs JOIN hb USING (doc))
SELECT doc AS book, 'WARN' AS status, {q(I.M['path_empty'])} AS message, {obj(count='empty_paths')} AS detail FROM b WHERE empty_paths > 0
UNION ALL SELECT doc, 'WARN', {q(I.M['path_shallow'])}, {obj(shallow_ratio=num('round_even(shallow_paths / chunks, 3)'))} FROM b WHERE shallow
UNION ALL SELECT doc, 'WARN', {q(I.M['path_crowded'])}, {obj(path=text('p'), ratio=num('round_even(n / chunks, 3)'))} FROM b WHERE crowded
UNION ALL SELECT doc, 'PASS', {q(I.M['path_ok'])}, stats FROM b WHERE NOT shallow AND NOT crowded"""
ORACLES["verdicts"] = f"""WITH {LEN}, {LCHECK}, {HEAD}, hc AS (SELECT hs.doc, unnest([CASE WHEN empty_paths > 0 THEN 'WARN' END, CASE WHEN shallow_paths / chunks > 0.65 AND chunks >= 20 THEN 'WARN' END, CASE WHEN n / chunks > 0.35 AND chunks >= 20 THEN 'WARN' END, CASE WHEN NOT (shallow_paths / chunks > 0.65 AND chunks >= 20) AND NOT (n / chunks > 0.35 AND chunks >= 20) THEN 'PASS' END]) AS status FROM hs JOIN hb USING (doc)),
a AS (SELECT doc, status FROM lc UNION ALL SELECT doc, status FROM hc WHERE status IS NOT NULL), v AS (SELECT doc, count(*) FILTER (status = 'PASS') + (length(doc) + 1) % 2 AS passed, count(*) FILTER (status = 'WARN') AS warned, length(doc) % 2 AS failed FROM a GROUP BY doc)
SELECT doc AS book, passed, warned, failed, greatest(0, 100 - 35 * failed - 8 * warned) AS score, CASE WHEN failed > 0 THEN 'FAIL' WHEN warned > 0 THEN 'WARN' ELSE 'PASS' END AS result FROM v"""
ORACLES["sample_chunks"] = f"""WITH {CH}, x AS (SELECT doc, chunk_index, count(*) OVER w AS c, chunk_index - 1 AS i, row_number() OVER (PARTITION BY doc ORDER BY n DESC, chunk_index) AS l, row_number() OVER (PARTITION BY doc ORDER BY n, chunk_index) AS s FROM ch WINDOW w AS (PARTITION BY doc)),
y AS (SELECT doc, chunk_index, CASE WHEN i = 0 THEN 1 WHEN i = c // 2 THEN 2 WHEN i = c - 1 THEN 3 WHEN l = 1 THEN 4 WHEN s = 1 THEN 5 END AS pick FROM x)
SELECT doc AS book, chunk_index::INT AS chunk_index, row_number() OVER (PARTITION BY doc ORDER BY pick)::INT AS pick FROM y WHERE pick IS NOT NULL"""


def rate(a: str, b: str) -> str:
    many = windows(a, 80, 120)
    found = f"list_filter({many}, lambda i: contains({b}, substr({a}, i + 1, 80)))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 WHEN length({a}) <= 80 THEN contains({b}, {a})::INT ELSE round_even(len({found}) / len({many}), 3) END"


COVER = f"""{CH}, cv AS (SELECT doc, {compact('string_agg(text, chr(10) ORDER BY chunk_index)')} AS s, coalesce({compact('string_agg(text, chr(10) ORDER BY chunk_index) FILTER (chunk_index % (length(doc) % 4) > 0)')}, '') AS c FROM ch GROUP BY doc),
cr AS (SELECT doc, length(s)::INT AS source_chars, length(c)::INT AS chunk_chars, ({rate('s', 'c')})::DOUBLE AS source_rate, ({rate('c', 's')})::DOUBLE AS chunk_rate FROM cv),
cc AS (SELECT *, coalesce(least(1.0::DOUBLE, chunk_chars / nullif(source_chars, 0)), 0) AS char_ratio FROM cr), co AS (SELECT *, round_even(char_ratio * 0.35::DOUBLE + source_rate * 0.35::DOUBLE + chunk_rate * 0.30::DOUBLE, 3) AS coverage FROM cc)"""
ORACLES["coverage"] = f"WITH {COVER} SELECT doc AS book, * EXCLUDE (doc) FROM co"
_covered = obj(pdf_chars_compact="source_chars", chunk_chars_compact="chunk_chars", chunk_to_pdf_char_ratio=num("round_even(char_ratio, 3)"), pdf_sample_match_rate=num("source_rate"), chunk_sample_match_rate=num("chunk_rate"), estimated_coverage=num("coverage"))
ORACLES["coverage_checks"] = f"""WITH {COVER} SELECT doc AS book, CASE WHEN k IN ('cover_none', 'cover_bad') THEN 'FAIL' WHEN k = 'cover_low' THEN 'WARN' ELSE 'PASS' END AS status,
 CASE k WHEN 'cover_none' THEN {q(I.M['cover_none'])} WHEN 'cover_bad' THEN {q(I.M['cover_bad'])} WHEN 'cover_low' THEN {q(I.M['cover_low'])} ELSE {q(I.M['cover_ok'])} END AS message, CASE k WHEN 'cover_none' THEN '{{}}' ELSE {_covered} END AS detail
FROM (SELECT *, CASE WHEN source_chars = 0 OR chunk_chars = 0 THEN 'cover_none' WHEN coverage < 0.45 OR chunk_rate < 0.55 THEN 'cover_bad' WHEN coverage < 0.65 THEN 'cover_low' ELSE 'cover_ok' END AS k FROM co)"""
_match = obj(expected="CASE WHEN page_id % 5 > 0 THEN '\"sha256:' || sha256(html) || '\"' ELSE '\"sha256:0\"' END", actual="'\"sha256:' || sha256(html) || '\"'")
ORACLES["check_file_match"] = f"""SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN page_id % 5 = 0 THEN {q(I.M['hash_bad'])} ELSE {q(I.M['hash_ok'])} END AS message, CASE WHEN page_id % 5 = 0 THEN {_match} ELSE '{{}}' END AS detail FROM pages
UNION ALL SELECT page_id, 'WARN', {q(I.M['name_bad'])}, {obj(manifest_file_name="'\"a/' || page_id || '\"'", pdf_file_name="'\"other\"'")} FROM pages WHERE page_id % 7 = 0"""
# Of a text its first 600 characters count, of a heading all.
ORACLES["garbled_checks"] = f"""WITH {TITLE}, u AS (SELECT {C.KEY_SQL} AS doc, doc_id, m, left(m, 600) AS f, {strip('m')} <> '' AND ({GARBLED} OR (n > 0 AND least(1.0, bad::DOUBLE / n) > 0.12)) AS looks FROM t2),
g AS (SELECT doc, m, looks, {count('f', f'[^{T.W_IN}]')} AS n, {count('f', '[' + chr(0xfffd) + '□■◆◇\\x00-\\x08\\x0e-\\x1b]')} + {count('f', '[\\x{e000}-\\x{f8ff}]')} + {count('f', f'[A-Za-z]{T.CJK}[A-Za-z]|{T.CJK}[A-Za-z]{{2,}}{T.CJK}')} AS bad, row_number() OVER (PARTITION BY doc ORDER BY doc_id) AS k FROM u)
SELECT doc AS book, count(*) FILTER (looks) AS garbled_titles, count(*) FILTER (looks) AS garbled_headings, count(*) FILTER (n > 0 AND least(1.0, bad::DOUBLE / n) > 0.04 AND k <= 80) AS garbled_chunks, {{some}} AS title_examples, {{some}} AS heading_examples FROM g GROUP BY doc""".replace("{some}", "sha256(coalesce(array_to_string((list(m ORDER BY k) FILTER (looks))[1:5], chr(10)), ''))")
# Packs with faults: what is wrong with a line follows from its number.
POOR = f"""rows AS (SELECT {C.KEY_SQL} AS doc, doc_id AS i, text, row_number() OVER (PARTITION BY {C.KEY_SQL} ORDER BY doc_id) AS n FROM documents),
bad AS (SELECT doc, (n + 2)::INT AS line_no, CASE WHEN i % 17 = 1 THEN 'json' WHEN i % 19 = 1 THEN 'object' WHEN i % 23 = 1 THEN 'json' END AS kind FROM rows WHERE i % 17 = 1 OR i % 19 = 1 OR i % 23 = 1)"""
ORACLES["bad_records"] = f"WITH {POOR} SELECT doc AS book, line_no, kind FROM bad"
ORACLES["check_records"] = f"""WITH {POOR} SELECT doc AS book, 0::INT AS ord, 'FAIL' AS status, 'JSONL 第 ' || min(line_no) || CASE WHEN arg_min(kind, line_no) = 'json' THEN ' 行不是合法 JSON' ELSE ' 行不是对象记录' END AS message,
 {obj(count='count(*)', lines="'[' || array_to_string(list(" + obj(kind=text('kind'), line='line_no') + " ORDER BY line_no)[1:10], ',') || ']'")} AS detail FROM bad GROUP BY doc"""
_i = "idx::VARCHAR"
_lack = "CASE WHEN i % 7 = 0 THEN '[' || CASE WHEN i % 7 = 0 THEN '\"next_chunk_id\"' ELSE '' END || CASE WHEN i % 21 = 0 THEN ',\"stats\"' ELSE '' END || ']' END"
ORACLES["check_schema"] = f"""WITH {POOR}, c AS (SELECT r.doc, r.n, i, CASE WHEN i % 97 = 5 THEN n + 1 ELSE n END AS idx, row_number() OVER (PARTITION BY r.doc ORDER BY n) AS nth FROM rows r WHERE NOT (i % 17 = 1 OR i % 19 = 1 OR i % 23 = 1 OR i % 31 = 1)),
f AS (SELECT doc, n, 1 AS k, {obj(chunk_index=_i, missing=_lack)} AS e FROM c WHERE i % 7 = 0
 UNION ALL SELECT doc, n, 2, {obj(chunk_index=_i, error="'\"heading_path is not list\"'")} FROM c WHERE i % 11 = 0
 UNION ALL SELECT doc, n, 3, {obj(chunk_index=_i, error="'\"embedding is not list\"'")} FROM c WHERE i % 29 = 0),
fs AS (SELECT doc, {obj(examples="'[' || array_to_string(list(e ORDER BY n, k)[1:10], ',') || ']'")} AS faults FROM f GROUP BY doc),
b AS (SELECT doc, count(*) AS chunks, bool_or(idx <> nth) AS gaps, {obj(first_indices="'[' || array_to_string(list(idx ORDER BY n)[1:10], ',') || ']'")} AS firsts, {obj(chunk_indices="'[' || array_to_string((list(idx ORDER BY n) FILTER (i % 13 = 0))[1:20], ',') || ']'")} AS blanks, bool_or(i % 13 = 0) AS empty FROM c GROUP BY doc),
d AS (SELECT doc, coalesce(chunks, 0) AS chunks, coalesce(gaps, FALSE) AS gaps, firsts, blanks, coalesce(empty, FALSE) AS empty, faults FROM (SELECT DISTINCT doc FROM rows) LEFT JOIN b USING (doc) LEFT JOIN fs USING (doc))
SELECT doc AS book, CASE WHEN length(doc) % 2 = 0 THEN 10 ELSE 11 END::INT AS ord, CASE WHEN length(doc) % 2 = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN length(doc) % 2 = 0 THEN {q(I.M['manifest_bad'])} ELSE {q(I.M['manifest_ok'])} END AS message, CASE WHEN length(doc) % 2 = 0 THEN '{{"missing":["title"]}}' ELSE '{{}}' END AS detail FROM d
UNION ALL SELECT doc, CASE WHEN length(doc) % 3 = 0 THEN 12 ELSE 13 END, CASE WHEN length(doc) % 3 = 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN length(doc) % 3 = 0 THEN {q(I.M['toc_bad'])} ELSE {q(I.M['toc_ok'])} END, CASE WHEN length(doc) % 3 = 0 THEN '{{}}' ELSE '{{"toc_items":2}}' END FROM d
UNION ALL SELECT doc, 14, 'FAIL', {q(I.M['no_chunks'])}, '{{}}' FROM d WHERE chunks = 0
UNION ALL SELECT doc, 15, 'FAIL', {q(I.M['chunk_bad'])}, faults FROM d WHERE faults IS NOT NULL
UNION ALL SELECT doc, 16, 'PASS', {q(I.M['chunk_ok'])}, {obj(chunks='chunks')} FROM d WHERE chunks > 0 AND faults IS NULL
UNION ALL SELECT doc, 17, 'WARN', {q(I.M['index_bad'])}, firsts FROM d WHERE gaps
UNION ALL SELECT doc, 18, 'FAIL', {q(I.M['empty_chunk'])}, blanks FROM d WHERE empty"""
ORACLES["recommend_heading_level"] = f"""WITH {TB}, {LEN}, d AS (SELECT doc, max(level) AS deep FROM heads GROUP BY doc), r AS (SELECT ls.doc, deep, deep > 1 AND (long + very_long) / chunks > 0.18 AS up, (very_short + short) / chunks > 0.35 AS down FROM ls JOIN d USING (doc))
SELECT doc AS book, (SELECT '{{' || string_agg('"' || level || '":' || n, ',' ORDER BY level) || '}}' FROM (SELECT level, count(*) AS n FROM heads h WHERE h.doc = r.doc GROUP BY level)) AS toc_level_counts,
 CASE WHEN up THEN '存在较多长 chunk，且 TOC 还有更深层级，可尝试 --max-chunk-heading-level ' || least(deep, 2) || '。' WHEN down THEN '短 chunk 比例偏高，可人工评估是否降低到 --max-chunk-heading-level 1。' ELSE '当前最细分块层级与 chunk 长度分布基本匹配。' END AS reason,
 1::INT AS "current", CASE WHEN up THEN least(deep, 2) ELSE 1 END::INT AS recommended, CASE WHEN up THEN 'consider_increase' WHEN down THEN 'consider_decrease' ELSE 'keep' END AS action, CASE WHEN NOT up AND down THEN 'low' ELSE 'medium' END AS confidence FROM r"""
ORACLES["recommend_profile"] = f"""WITH {SCORED}, {META}, s AS (SELECT doc_id, {_pick} AS top, {_told} AS told, list_sort([{', '.join(BOOK_PROFILES)}], 'DESC') AS l FROM sc), c AS (SELECT s.*, meta.profile AS cur, CASE WHEN l[1] >= 6 AND l[1] - l[2] >= 4 THEN 'high' WHEN l[1] >= 4 AND l[1] - l[2] >= 2 THEN 'medium' ELSE 'low' END AS sure FROM s JOIN meta USING (doc_id))
SELECT doc_id, cur AS "current", CASE WHEN sure = 'low' THEN cur ELSE top END AS recommended, sure AS confidence, CASE WHEN top = cur OR sure = 'low' THEN 'keep' ELSE 'consider_change' END AS action, top AS classifier_top, told AS scores,
 CASE WHEN sure = 'low' THEN '离线分类信号较弱，建议保持当前 profile。' WHEN top = cur THEN '当前 profile 与离线分类推荐一致。' ELSE '离线分类器更倾向 ' || top || '，建议确认是否应改用 --profile ' || top || '。' END AS reason FROM c"""
_SHORT = ORACLES["body_short_headings"].rsplit("WHERE ", 1)[1].replace("line", "text")
ORACLES["augment_headings"] = f"""WITH {flat(C.ZH.replace("|| text AS text", "|| text || chr(10) || '批判性思维的第' || n || '要素' AS text"))},
chapters AS (SELECT doc, idx, row_number() OVER (PARTITION BY doc ORDER BY idx)::INT AS ord FROM flat WHERE {like('text', H.CHAPTER)} AND {gate('text', 'textbook')})
SELECT f.doc AS book, max(c.ord) AS parent_ord, f.idx, f.text AS title, 2::INT AS level, f.page FROM flat f JOIN chapters c ON c.doc = f.doc AND c.idx < f.idx WHERE {_SHORT} GROUP BY f.doc, f.idx, f.text, f.page"""
ORACLES["locate_pages"] = f"""WITH {TB}, keyed AS (SELECT doc, idx, page, {key('text')} AS k FROM flat),
o AS (SELECT doc, ord, {key("CASE WHEN ord % 5 = 0 THEN title || ' and more than that' WHEN ord % 7 = 3 THEN '※' || substr(title, 2) ELSE title END")} AS t, greatest(1, page + ord % 3 - 1)::INT AS page FROM heads WHERE starts_with(title, '第')),
m AS (SELECT o.doc, o.ord, k.page, k.idx, CASE WHEN k.k = t THEN 1.0::DOUBLE WHEN starts_with(t, '※') THEN 2.0::DOUBLE * (length(t) - 1) / (2 * length(t)) ELSE 0.9::DOUBLE END AS sure
 FROM o JOIN keyed k ON k.doc = o.doc AND k.page BETWEEN o.page - 1 AND o.page + 2 AND (starts_with(k.k, left(t, 18)) OR starts_with(t, k.k) OR (starts_with(t, '※') AND k.k = '第' || substr(t, 2) AND length(t) >= 6))),
b AS (SELECT doc, ord, page, sure FROM m QUALIFY row_number() OVER (PARTITION BY doc, ord ORDER BY sure DESC, idx) = 1)
SELECT o.doc AS book, o.ord, coalesce(b.page, o.page)::INT AS page, CASE WHEN b.sure IS NULL THEN 'bookmark_page_fallback' WHEN b.sure = 1.0 THEN 'exact_normalized' WHEN b.sure = 0.9::DOUBLE THEN 'prefix_normalized' ELSE 'fuzzy_ratio' END AS method, coalesce(b.sure, 0.5)::DOUBLE AS confidence FROM o LEFT JOIN b USING (doc, ord)"""
# One heading after the other; what a line has in common with an altered title is known.
ORACLES["locate_headings_behind"] = f"""WITH RECURSIVE {TB}, keyed AS (SELECT doc, idx, page, {key('text')} AS k FROM flat),
o AS (SELECT doc, ord, row_number() OVER (PARTITION BY doc ORDER BY ord) AS n, {key("CASE ord % 4 WHEN 2 THEN '※' || substr(title, 2) WHEN 3 THEN 'Nowhere at all ' || ord ELSE title END")} AS t, CASE ord % 4 WHEN 2 THEN page + 5 WHEN 3 THEN page + 1 WHEN 0 THEN page END AS page FROM heads WHERE starts_with(title, '第')),
hit AS (SELECT o.doc, o.n, k.idx, k.page BETWEEN o.page - 1 AND o.page + 2 AS near, starts_with(k.k, left(t, 18)) AS sure FROM o JOIN keyed k ON k.doc = o.doc AND (starts_with(k.k, left(t, 18)) OR (starts_with(t, '※') AND k.k = '第' || substr(t, 2) AND length(t) >= 10))),
all_ AS (SELECT o.doc, o.n, o.ord, coalesce(min(h.idx) FILTER (h.near AND h.sure), min(h.idx) FILTER (h.near)) AS near, list(h.idx) FILTER (h.sure) AS sure, list(h.idx) FILTER (NOT h.sure) AS alike,
 any_value((SELECT min(k.idx) FROM keyed k WHERE k.doc = o.doc AND k.page >= o.page)) AS paged FROM o LEFT JOIN hit h ON h.doc = o.doc AND h.n = o.n GROUP BY o.doc, o.n, o.ord),
walk AS (SELECT DISTINCT doc, 0::BIGINT AS n, 0 AS ord, NULL::INT AS start, 0 AS cursor FROM o
 UNION ALL SELECT doc, n, ord, found AS start, greatest(cursor, coalesce(found + 1, 0)) AS cursor FROM (SELECT a.doc, a.n, a.ord, w.cursor, coalesce(a.near, list_min(list_filter(a.sure, lambda i: i >= w.cursor)), list_min(list_filter(a.alike, lambda i: i >= w.cursor)), a.paged)::INT AS found FROM walk w JOIN all_ a ON a.doc = w.doc AND a.n = w.n + 1))
SELECT doc AS book, ord::INT AS ord, start FROM walk WHERE n > 0"""
_more = "text || chr(10) || '批判性思维的第' || n || '要素' || chr(10) || '这一行不是标题。' || chr(10) || '批判思维小结之' || n % 4 || chr(10) || '这一行也不是。' || CASE WHEN n % 5 = 0 THEN chr(10) || '连续短标题甲' || n || chr(10) || '连续短标题乙' || n || chr(10) || '连续短标题丙' || n ELSE '' END AS text"
ORACLES["augment_headings_shared"] = f"""WITH RECURSIVE {flat(C.ZH.replace("|| text AS text", "|| " + _more))},
chapters AS (SELECT doc, idx, row_number() OVER (PARTITION BY doc ORDER BY idx)::INT AS ord FROM flat WHERE {like('text', H.CHAPTER)} AND {gate('text', 'textbook')}),
c AS (SELECT f.doc, max(c.ord) AS ord, f.idx, f.text FROM flat f JOIN chapters c ON c.doc = f.doc AND c.idx < f.idx WHERE {_SHORT} GROUP BY f.doc, f.idx, f.text),
cs AS (SELECT ch.doc, ch.ord, coalesce(list({{'i': c.idx, 't': c.text}} ORDER BY c.idx) FILTER (c.idx IS NOT NULL), []) AS l FROM chapters ch LEFT JOIN c ON c.doc = ch.doc AND c.ord = ch.ord GROUP BY ch.doc, ch.ord),
walk AS (SELECT DISTINCT doc, 0 AS ord, []::STRUCT(i INTEGER, t VARCHAR)[] AS kept, []::VARCHAR[] AS taken FROM chapters
 UNION ALL SELECT doc, ord, kept, list_concat(taken, list_transform(kept, lambda x: x.t)) FROM (SELECT doc, ord, taken, list_transform(list_filter(r, lambda x: len(list_filter(r, lambda y: y.r = x.r)) < 3)[1:16], lambda x: {{'i': x.i, 't': x.t}}) AS kept
  FROM (SELECT doc, ord, taken, list_transform(fresh, lambda x, k: {{'i': x.i, 't': x.t, 'r': x.i - k}}) AS r FROM (SELECT cs.doc, cs.ord, w.taken, list_filter(cs.l, lambda x: NOT list_contains(w.taken, x.t)) AS fresh FROM walk w JOIN cs ON cs.doc = w.doc AND cs.ord = w.ord + 1)))),
found AS (SELECT doc, ord, unnest(kept) AS x FROM walk)
SELECT doc AS book, ord::INT AS parent_ord, x.i::INT AS idx, x.t AS title, 'toc:auto:' || lpad((row_number() OVER (PARTITION BY doc ORDER BY ord, x.i))::VARCHAR, 6, '0') AS toc_id FROM found"""
ORACLES["source_files"] = "SELECT 'raw/p' || page_id || CASE page_id % 4 WHEN 0 THEN '.pdf' ELSE '.TXT' END AS path FROM pages WHERE page_id % 4 IN (0, 1)"
ORACLES["match_packs"] = "SELECT 'out/p' || page_id || '_noembedding.pack.jsonl' AS pack, 'p' || page_id AS stem, CASE WHEN page_id % 4 = 0 THEN 'raw/p' || page_id || '.pdf' END AS book FROM pages"
ORACLES["sample_text"] = f"WITH {C.ZH} SELECT doc AS book, sha256(string_agg(text, chr(10) ORDER BY page)) AS sample FROM book WHERE page <= 20 GROUP BY doc"
ORACLES["remove_heading_prefix"] = """SELECT doc_id, sha256(CASE doc_id % 3 WHEN 0 THEN regexp_replace(text, '\\n$', '') WHEN 1 THEN repeat('x' || chr(10), 20) || 'The Title Of It, and so much more' || chr(10) || text
 ELSE 'Intro line' || chr(10) || 'The Title Of It, and so much more' || chr(10) || text END) AS rest FROM documents"""
ORACLES["common_parent_path"] = "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE source || '/' || lang END AS path FROM documents"
