"""The registered queries in ANSI-style SQL, as DuckDB runs it.

Written from the rules, not from the plans: line rows, windows and grouped
string aggregates stand where the library works inside rows.
"""

from __future__ import annotations

from folioworks import fixed_values as fixed
from folioworks.plans.inputs import LINES_PER_PAGE, PARTS_PER_PAGE

NL = "chr(10)"
WS = "||".join(f"chr({ord(c)})" for c in fixed.WHITESPACE)
BULLET_CLASS = fixed.BULLETS + "\\-"
NA_LIST = ", ".join(f"'{w}'" for w in fixed.NA_WORDS)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[A-Za-z0-9_]+|[^\\sA-Za-z0-9_]'))"


def lines_of(pages: str, *keys: str, text: str = "text") -> str:
    """Line rows of a text column; only newlines occur in the given data."""
    k = ", ".join(keys)
    return f"""(SELECT {k}, line_no, line FROM (
        SELECT {k}, unnest(string_split({text}, {NL})) AS line,
               generate_subscripts(string_split({text}, {NL}), 1) - 1 AS line_no,
               len(string_split({text}, {NL})) AS n_lines
        FROM {pages}) WHERE NOT (line = '' AND line_no = n_lines - 1))"""


TEXT_PAGES = f"""
doc_lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), {NL})) AS line,
         generate_subscripts(string_split(coalesce(text, ''), {NL}), 1) - 1 AS line_no
  FROM documents),
cut AS (
  SELECT doc_id, source, CAST(line_no // {LINES_PER_PAGE} AS INTEGER) AS page_no,
         string_agg(line, {NL} ORDER BY line_no) AS text
  FROM doc_lines GROUP BY ALL),
text_pages AS (
  SELECT doc_id, source, page_no, CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS n_pages, text FROM cut)"""


def decorated(pages: str) -> str:
    body = f"replace(replace(text, ' the ', ' the' || {NL}), 'tion ', 'ti-' || {NL} || 'on ')"
    return f"""
  SELECT doc_id, page_no, n_pages,
    'ACME Quarterly ' || source || {NL} || {body} || {NL} || '• item ' || page_no || {NL} || '[x] done' || {NL}
    || '[ ] todo' || {NL} || 'Page ' || (page_no + 1) || ' of ' || n_pages || {NL} || page_no
    || {NL} || {NL} || {NL} || {NL} || 'Confidential do not distribute' AS text
  FROM {pages}"""


DECORATED = TEXT_PAGES + f", decorated_pages AS ({decorated('text_pages')})"

ROUTED = TEXT_PAGES + """, routed_pages AS (
  SELECT doc_id, page_no, n_pages,
    CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 AND page_no % 2 = 0 THEN 'x' ELSE text END AS native_text,
    CASE WHEN doc_id % 7 = 0 AND page_no = 1 THEN NULL WHEN doc_id % 5 = 0 THEN '' ELSE text END AS ocr_text,
    CASE WHEN doc_id % 5 = 0 THEN text END AS ocr_markdown,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE text END AS checked_text,
    text AS fallback_text
  FROM text_pages)"""


def probing(pages: str, text: str) -> str:
    return f"""sampled AS (
  SELECT * FROM (SELECT *, greatest(1, n_pages // 12) AS step FROM {pages})
  WHERE page_no % step = 0 AND page_no // step < 12),
probed AS (
  SELECT doc_id, max(n_pages) AS num_pages, count(*) AS sampled, sum(length({text})) AS sampled_chars,
         count(*) FILTER (length({text}) > 40) AS text_pages
  FROM sampled GROUP BY doc_id),
routed AS (
  SELECT *, text_pages / CAST(greatest(1, sampled) AS DOUBLE) AS text_page_ratio,
         CASE WHEN text_pages / CAST(greatest(1, sampled) AS DOUBLE) < 0.55 THEN 'ocr' ELSE 'non_ocr' END AS router
  FROM probed)"""


PROBE = ROUTED + ", " + probing("routed_pages", "native_text")


def edges(pages: str) -> str:
    return f"""
edge_rows AS (
  SELECT doc_id, page_no, line_no, {strip('line')} AS line FROM {lines_of(pages, 'doc_id', 'page_no', 'n_pages')}
  WHERE n_pages >= 3),
marked AS (
  SELECT *, line_no < 2 AND line <> '' AS is_top,
         line <> '' AND row_number() OVER (PARTITION BY doc_id, page_no, line <> '' ORDER BY line_no DESC) <= 2 AS is_bottom
  FROM edge_rows),
edge_counts AS (
  SELECT doc_id, line, count(*) FILTER (is_top) AS top_count, count(*) FILTER (is_bottom) AS bottom_count
  FROM marked WHERE is_top OR is_bottom GROUP BY doc_id, line),
page_counts AS (SELECT doc_id, max(n_pages) AS n FROM {pages} GROUP BY doc_id),
edge_lines AS (
  SELECT c.* FROM edge_counts c JOIN page_counts p USING (doc_id)
  WHERE greatest(top_count, bottom_count) / CAST(n AS DOUBLE) >= 0.45)"""


def stripped(pages: str) -> str:
    return edges(pages) + f""",
bare_lines AS (
  SELECT l.doc_id, l.page_no, string_agg(l.line, {NL} ORDER BY l.line_no) AS text
  FROM {lines_of(pages, 'doc_id', 'page_no', 'n_pages')} l
  WHERE {strip('l.line')} <> ''
    AND NOT EXISTS (SELECT 1 FROM edge_lines e WHERE e.doc_id = l.doc_id AND e.line = {strip('l.line')})
  GROUP BY l.doc_id, l.page_no),
bare_pages AS (
  SELECT p.doc_id, p.page_no, p.n_pages,
         CASE WHEN p.n_pages >= 3 THEN coalesce(b.text, '') ELSE p.text END AS text
  FROM {pages} p LEFT JOIN bare_lines b USING (doc_id, page_no))"""


def boiler(pages: str) -> str:
    return f"""
key_lines AS (
  SELECT doc_id, page_no, n_pages, line_no, regexp_replace({strip('line')}, '\\s+', ' ', 'g') AS line
  FROM {lines_of(pages, 'doc_id', 'page_no', 'n_pages')}
  WHERE n_pages >= 3 AND length({strip('line')}) >= 6),
boiler_lines AS (
  SELECT doc_id, line, count(DISTINCT page_no) AS page_count, min(page_no) AS first_page
  FROM key_lines GROUP BY doc_id, line HAVING count(DISTINCT page_no) / CAST(max(n_pages) AS DOUBLE) >= 0.5),
kept_lines AS (
  SELECT k.doc_id, k.page_no, string_agg(k.line, {NL} ORDER BY k.line_no) AS text
  FROM key_lines k ANTI JOIN boiler_lines b ON k.doc_id = b.doc_id AND k.line = b.line
  GROUP BY k.doc_id, k.page_no),
body_pages AS (
  SELECT p.doc_id, p.page_no, p.n_pages,
         CASE WHEN p.n_pages >= 3 THEN coalesce(k.text, '') ELSE p.text END AS text
  FROM {pages} p LEFT JOIN kept_lines k USING (doc_id, page_no))"""


def weld(x: str) -> str:
    ended = f"CASE WHEN {x} LIKE '%' || {NL} THEN left({x}, length({x}) - 1) ELSE {x} END"
    prev = f"split_part(acc, {NL}, -1)"
    return f"""list_reduce(string_split({ended}, {NL}), lambda acc, ln: CASE
      WHEN {prev} LIKE '%-' AND regexp_matches(ln, '^\\p{{Ll}}') THEN left(acc, length(acc) - 1) || ln
      WHEN length({prev}) < 120 AND NOT regexp_matches({strip(prev)}, '[.?!:;)]$')
           AND regexp_matches(ln, '^[\\p{{Ll}},;—–]')
        THEN left(acc, length(acc) - length({prev})) || rtrim({prev}, {WS}) || ' ' || ln
      ELSE acc || {NL} || ln END)"""


def bullets(x: str) -> str:
    return f"regexp_replace({x}, '(?m)^[\\t ]*[{BULLET_CLASS}]\\s*(.*)$', '- \\1', 'g')"


def checked(x: str) -> str:
    return f"regexp_replace({x}, '(?m)^[\\t ]*\\[(x|X)\\]\\s*', '- [x] ', 'g')"


def unchecked(x: str) -> str:
    return f"regexp_replace({x}, '(?m)^[\\t ]*\\[\\s*\\]\\s*', '- [ ] ', 'g')"


def labels(x: str) -> str:
    for pattern in fixed.PAGE_LABELS:
        x = f"regexp_replace({x}, '(?im){pattern}', '', 'g')"
    return x


def blanks(x: str) -> str:
    return f"regexp_replace({x}, '\\n{{3,}}', {NL} || {NL}, 'g')"


def chain(pages: str) -> str:
    return f"""{stripped(pages)},
{boiler('bare_pages')},
welded AS (SELECT doc_id, page_no, n_pages, {weld('text')} AS text FROM body_pages),
sliced AS (SELECT doc_id, page_no, n_pages, {unchecked(checked(bullets('text')))} AS slice FROM welded),
clean_pages AS (SELECT doc_id, page_no, n_pages, slice, {blanks(labels('slice'))} AS text FROM sliced)"""


CHAIN = DECORATED + "," + chain("decorated_pages")

PARTS = f"""
page_parts AS (
  SELECT p_brand AS doc_id, CAST(p_partkey // {PARTS_PER_PAGE} AS INTEGER) AS page_no, p_partkey, p_name, p_type,
         CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size AS VARCHAR) END AS size,
         replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS price,
         row_number() OVER (PARTITION BY p_brand, p_partkey // {PARTS_PER_PAGE} ORDER BY p_partkey) - 1 AS pos
  FROM part),
part_pages AS (SELECT doc_id, page_no, count(*) AS n FROM page_parts GROUP BY ALL)"""

RAW = PARTS + """,
raw_header AS (
  SELECT doc_id, page_no, 1 AS table_idx, c AS col_idx, CAST(c AS VARCHAR) AS value FROM part_pages, range(5) r(c)
  UNION ALL
  SELECT doc_id, page_no, 2, c, CAST(c AS VARCHAR) FROM part_pages, range(2) r(c)),
raw_cells AS (
  SELECT doc_id, page_no, 1 AS table_idx, 0 AS row_idx, c AS col_idx, CAST(NULL AS VARCHAR) AS value
  FROM part_pages, range(5) r(c)
  UNION ALL
  SELECT doc_id, page_no, 1, 1, c, ['  Name ', 'Type', 'Size ' || chr(10) || ' (mm)', 'Price', NULL][c + 1]
  FROM part_pages, range(5) r(c) WHERE page_no % 3 = 0
  UNION ALL
  SELECT doc_id, page_no, 1, pos + CASE WHEN page_no % 3 = 0 THEN 2 ELSE 1 END, c,
         ['  ' || p_name || chr(9), CASE WHEN page_no % 3 = 2 THEN lower(p_type) ELSE p_type END, size, price, NULL][c + 1]
  FROM page_parts, range(5) r(c)
  UNION ALL
  SELECT doc_id, page_no, 2, 0, c, [doc_id, CAST(n AS VARCHAR)][c + 1] FROM part_pages, range(2) r(c))"""

TABLE = "doc_id, page_no, table_idx"


def drop_empty(cells: str, header: str, tag: str) -> str:
    """Cells and names left after dropping null rows, then null columns."""
    return f"""
{tag}_filled AS (
  SELECT *, count(value) OVER (PARTITION BY {TABLE}, row_idx) AS in_row,
            count(value) OVER (PARTITION BY {TABLE}, col_idx) AS in_col FROM {cells}),
{tag}_header AS (
  SELECT {TABLE}, dense_rank() OVER (PARTITION BY {TABLE} ORDER BY col_idx) - 1 AS col_idx, value
  FROM {header} h SEMI JOIN (SELECT * FROM {tag}_filled WHERE in_col > 0) f USING (doc_id, page_no, table_idx, col_idx)),
{tag}_cells AS (
  SELECT {TABLE}, dense_rank() OVER (PARTITION BY {TABLE} ORDER BY row_idx) - 1 AS row_idx,
         dense_rank() OVER (PARTITION BY {TABLE} ORDER BY col_idx) - 1 AS col_idx, value
  FROM {tag}_filled WHERE in_row > 0 AND in_col > 0)"""


def shaped(cells: str, header: str, tag: str, rows: int = 2, cols: int = 2) -> str:
    big = f"""(SELECT {TABLE} FROM {cells} GROUP BY ALL
      HAVING max(row_idx) + 1 >= {rows} AND max(col_idx) + 1 >= {cols})"""
    return f"""
{tag}_header AS (SELECT * FROM {header} SEMI JOIN {big} b USING ({TABLE})),
{tag}_cells AS (SELECT * FROM {cells} SEMI JOIN {big} b USING ({TABLE}))"""


TITLE = "^[^A-Za-z]*([A-Z][a-z]*[^A-Za-z]+)*([A-Z][a-z]*)?$"


def promoted(tag: str, out: str) -> str:
    return f"""
{out}_words AS (
  SELECT {TABLE}, unnest(regexp_split_to_array({strip("string_agg(value, ' ' ORDER BY col_idx)")}, '\\s+')) AS w
  FROM {tag}_cells WHERE row_idx = 0 GROUP BY {TABLE}),
{out}_test AS (
  SELECT {TABLE}, count(*) FILTER (regexp_matches(w, '[A-Za-z]') AND
           (NOT regexp_matches(w, '[a-z]') OR regexp_matches(w, '{TITLE}'))) >= greatest(1, count(*) // 3) AS is_header
  FROM {out}_words GROUP BY {TABLE}),
{out}_header AS (
  SELECT h.doc_id, h.page_no, h.table_idx, h.col_idx, CASE WHEN t.is_header THEN coalesce(c.value, '') ELSE h.value END AS value
  FROM {tag}_header h JOIN {out}_test t USING ({TABLE})
  LEFT JOIN {tag}_cells c ON c.row_idx = 0 AND c.doc_id = h.doc_id AND c.page_no = h.page_no
       AND c.table_idx = h.table_idx AND c.col_idx = h.col_idx),
{out}_cells AS (
  SELECT c.doc_id, c.page_no, c.table_idx, c.row_idx - CASE WHEN t.is_header THEN 1 ELSE 0 END AS row_idx, c.col_idx, c.value
  FROM {tag}_cells c JOIN {out}_test t USING ({TABLE}) WHERE NOT (t.is_header AND c.row_idx = 0))"""


def named(tag: str, out: str) -> str:
    return f"""
{out}_header AS (SELECT {TABLE}, col_idx, {strip("regexp_replace(value, '\\s+', ' ', 'g')")} AS value FROM {tag}_header),
{out}_cells AS (SELECT * FROM {tag}_cells)"""


def dotted(tag: str, out: str) -> str:
    return f"""
{out}_numeric AS (
  SELECT {TABLE}, col_idx, coalesce(avg(CAST(regexp_full_match(value, '[\\d.,%-]+') AS INTEGER)), 0) > 0.8 AS is_numeric
  FROM {tag}_cells GROUP BY ALL),
{out}_header AS (SELECT * FROM {tag}_header),
{out}_cells AS (
  SELECT c.doc_id, c.page_no, c.table_idx, c.row_idx, c.col_idx,
         CASE WHEN n.is_numeric THEN replace(c.value, ',', '.') ELSE c.value END AS value
  FROM {tag}_cells c JOIN {out}_numeric n USING ({TABLE}, col_idx))"""


S1 = RAW + f""",
a_header AS (SELECT * FROM raw_header),
a_cells AS (SELECT {TABLE}, row_idx, col_idx, {strip('value')} AS value FROM raw_cells)"""
S2 = S1 + "," + drop_empty("a_cells", "a_header", "b")
S3 = S2 + "," + shaped("b_cells", "b_header", "c")
S4 = S3 + "," + promoted("c", "d")
S5 = S4 + "," + named("d", "e")
S6 = S5 + "," + dotted("e", "f")
S7 = S6 + "," + drop_empty("f_cells", "f_header", "g") + "," + shaped("g_cells", "g_header", "t")


def cells(steps: str, tag: str) -> str:
    return f"""WITH {steps}
SELECT {TABLE}, -1 AS row_idx, col_idx, value FROM {tag}_header
UNION ALL SELECT {TABLE}, row_idx, col_idx, value FROM {tag}_cells"""


SCORES = S7 + f""",
scores AS (
  SELECT c.doc_id, c.page_no, c.table_idx, r * k / (1 + 10 * empty / CAST(r * k AS DOUBLE)) * CASE WHEN all_named THEN 1.2 ELSE 1 END AS table_score,
         r * k / (1 + 10 * na / CAST(r * k AS DOUBLE)) AS csv_score
  FROM (SELECT {TABLE}, max(row_idx) + 1 AS r, max(col_idx) + 1 AS k,
               count(*) FILTER (value IS NULL) AS empty,
               count(*) FILTER (value IS NULL OR value IN ({NA_LIST})) AS na
        FROM t_cells GROUP BY ALL) c
  JOIN (SELECT {TABLE}, bool_and(coalesce(value, '') <> '') AS all_named FROM t_header GROUP BY ALL) h USING ({TABLE}))"""

RENDERED = S7 + f""",
grid_lines AS (
  SELECT {TABLE}, row_idx, col_idx, value FROM t_cells UNION ALL SELECT {TABLE}, -1, col_idx, value FROM t_header),
row_texts AS (
  SELECT {TABLE}, row_idx,
    string_agg(CASE WHEN regexp_matches(value, '[",\\r\\n]') THEN '"' || replace(value, '"', '""') || '"'
                    ELSE coalesce(value, '') END, ',' ORDER BY col_idx) AS csv,
    string_agg(CASE WHEN row_idx < 0 THEN '<th>' ELSE '<td>' END
               || replace(replace(replace(coalesce(value, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
               || CASE WHEN row_idx < 0 THEN '</th>' ELSE '</td>' END, '' ORDER BY col_idx) AS html,
    string_agg(replace(coalesce(value, ''), '|', '\\|'), ' | ' ORDER BY col_idx) AS md,
    count(*) AS n
  FROM grid_lines GROUP BY ALL)"""

# Candidates of three engines for every page with a kept table.
CANDIDATES = SCORES + """,
engine_docs AS (
  SELECT doc_id || '/' || page_no AS doc_id, page_no AS source_page, table_idx, csv_score,
         unnest([1, 2, 3]) AS rank FROM scores),
candidates AS (
  SELECT *, ['docling', 'markdown', 'camelot'][rank] AS engine FROM engine_docs
  WHERE rank = 2 OR (rank = 1 AND source_page % 4 = 0) OR (rank = 3 AND source_page % 5 <> 0)),
named_candidates AS (
  SELECT *, CASE engine WHEN 'markdown' THEN 'page_0001_table_' || lpad(CAST(table_idx AS VARCHAR), 2, '0')
            WHEN 'camelot' THEN 'camelot_lattice_' || lpad(CAST(table_idx AS VARCHAR), 2, '0')
            ELSE 'table_' || lpad(CAST(table_idx AS VARCHAR), 2, '0') END AS name FROM candidates),
engine_routes AS (
  SELECT doc_id || '/' || page_no AS doc_id, CASE WHEN page_no % 2 = 0 THEN 'ocr' ELSE 'non_ocr' END AS routed FROM part_pages),
allowed AS (
  SELECT c.* FROM named_candidates c JOIN engine_routes r USING (doc_id) WHERE engine <> 'markdown' OR routed = 'ocr'),
chosen AS (
  SELECT r.doc_id, coalesce(a.engine, 'docling') AS engine, coalesce(a.n, 0) AS count
  FROM engine_routes r LEFT JOIN (
    SELECT doc_id, rank, engine, count(*) AS n FROM allowed GROUP BY doc_id, rank, engine
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank) = 1) a USING (doc_id))"""


def language(docs: str, lang_docs: str) -> str:
    """Add-one trigram scores in whole millionths; profiles from ``lang_docs``."""
    grams = f"""list_transform(range(1, length(x) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])"""
    chars = "regexp_extract_all(lower(coalesce(text, '')), '(?s).') AS c, lower(coalesce(text, '')) AS x"
    return f"""
fit_grams AS (
  SELECT lang, gram, count(*) AS cnt FROM (
    SELECT lang, unnest({grams}) AS gram FROM (SELECT lang, {chars} FROM {lang_docs})) GROUP BY ALL),
vocabulary AS (SELECT count(DISTINCT gram) AS v FROM fit_grams),
langs AS (
  SELECT lang, CAST(round(ln(docs / CAST(sum(docs) OVER () AS DOUBLE)) * 1000000) AS BIGINT) AS prior,
         coalesce(total, 0) + v AS room
  FROM (SELECT lang, count(*) AS docs FROM {lang_docs} GROUP BY lang)
  LEFT JOIN (SELECT lang, sum(cnt) AS total FROM fit_grams GROUP BY lang) USING (lang), vocabulary),
weights AS (
  SELECT g.gram, l.lang,
         CAST(round(ln((coalesce(f.cnt, 0) + 1) / CAST(room AS DOUBLE)) * 1000000) AS BIGINT) AS w
  FROM (SELECT DISTINCT gram FROM fit_grams) g CROSS JOIN langs l
  LEFT JOIN fit_grams f ON f.gram = g.gram AND f.lang = l.lang),
tag_grams AS (
  SELECT doc_id, gram, count(*) AS cnt FROM (
    SELECT doc_id, unnest({grams}) AS gram FROM (SELECT doc_id, {chars} FROM {docs})) GROUP BY ALL),
lang_scores AS (
  SELECT g.doc_id, l.lang,
         sum(g.cnt * coalesce(w.w, CAST(round(ln(1 / CAST(room AS DOUBLE)) * 1000000) AS BIGINT))) AS score
  FROM tag_grams g CROSS JOIN langs l
  LEFT JOIN weights w ON w.gram = g.gram AND w.lang = l.lang
  GROUP BY ALL),
tags AS (
  SELECT doc_id, lang AS language FROM (
    SELECT d.doc_id, l.lang, coalesce(s.score, 0) + l.prior AS score
    FROM (SELECT DISTINCT doc_id FROM {docs}) d CROSS JOIN langs l
    LEFT JOIN lang_scores s ON s.doc_id = d.doc_id AND s.lang = l.lang)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)"""


CONTENT_ID = "left(sha256(text), 16)"

DOC_TEXTS = CHAIN + f""",
doc_texts AS (
  SELECT doc_id, string_agg(text, '' ORDER BY page_no) AS text, string_agg(slice, chr(12) ORDER BY page_no) AS slices,
         max(n_pages) AS n_pages
  FROM clean_pages GROUP BY doc_id),
starts AS (
  SELECT doc_id, page_no,
         coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_at
  FROM clean_pages),
doc_starts AS (SELECT doc_id, string_agg(CAST(CAST(start_at AS BIGINT) AS VARCHAR), ',' ORDER BY page_no) AS offsets FROM starts GROUP BY doc_id),
""" + probing("decorated_pages", "text")


def page_rule(rule) -> str:
    return f"WITH {DECORATED} SELECT doc_id, page_no, {rule('text')} AS text FROM decorated_pages"


ORACLES: dict[str, str] = {
    "content_id": f"SELECT doc_id, {CONTENT_ID} AS content_id FROM documents",
    "exact_dedup": f"""SELECT {CONTENT_ID} AS content_id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source,
        any_value(text) AS text FROM documents GROUP BY {CONTENT_ID}""",
    "page_table": f"WITH {TEXT_PAGES} SELECT doc_id, page_no, n_pages, text FROM text_pages",
    "html_pages": "SELECT page_id AS doc_id, 0 AS page_no, 1 AS n_pages, coalesce(html, '') AS html FROM pages",
    "page_cap": f"""WITH {TEXT_PAGES} SELECT doc_id, page_no, least(n_pages, 2) AS n_pages, text
        FROM text_pages WHERE page_no < 2""",
    "page_sample": f"WITH {PROBE} SELECT doc_id, page_no, n_pages, native_text AS text FROM sampled",
    "page_stats": f"WITH {ROUTED} SELECT doc_id, page_no, length(native_text) AS chars, 0 AS images FROM routed_pages",
    "probe": f"""WITH {PROBE} SELECT doc_id, num_pages, text_pages, round(text_page_ratio, 6) AS text_page_ratio,
        sampled, sampled_chars FROM routed""",
    "route": f"WITH {PROBE} SELECT doc_id, router FROM routed",
    "route_override": f"""WITH {PROBE},
        decided AS (
          SELECT doc_id, engine, available, router,
            CASE engine WHEN 'off' THEN false WHEN 'auto' THEN available AND router = 'ocr' ELSE available END AS use_ocr,
            CASE engine WHEN 'off' THEN 'ocr_disabled_by_flag'
              WHEN 'deepseek' THEN CASE WHEN available THEN 'forced_deepseek' ELSE 'deepseek_missing' END
              WHEN 'tesseract' THEN CASE WHEN available THEN 'tesseract_unavailable_used_deepseek' ELSE 'tesseract_unavailable' END
              ELSE CASE WHEN router = 'non_ocr' THEN 'router_non_ocr' WHEN available THEN 'router_ocr' ELSE 'ocr_engine_missing' END
            END AS route_reason
          FROM routed, (VALUES ('off'), ('deepseek'), ('tesseract'), ('auto')) e(engine), (VALUES (true), (false)) a(available))
        SELECT *, CASE WHEN use_ocr THEN 'ocr' ELSE 'non_ocr' END AS routed FROM decided""",
    "source_select": f"""WITH {PROBE}
        SELECT p.doc_id, p.page_no, CASE WHEN r.router = 'ocr' THEN p.fallback_text ELSE p.native_text END AS text, r.router AS routed
        FROM routed_pages p JOIN routed r USING (doc_id)""",
    "ocr_fallback": f"""WITH {ROUTED},
        failed AS (SELECT *, bool_or(ocr_text IS NULL) OVER (PARTITION BY doc_id) AS bad FROM routed_pages)
        SELECT doc_id, page_no, CASE WHEN bad THEN coalesce(fallback_text, '') ELSE ocr_text END AS text,
               CASE WHEN bad THEN 'fallback' ELSE 'primary' END AS engine FROM failed""",
    "ocr_response": f"""WITH {ROUTED} SELECT doc_id, page_no,
        {strip("coalesce(nullif(ocr_text, ''), nullif(ocr_markdown, ''), '')")} AS text FROM routed_pages""",
    "error_split": f"""WITH {ROUTED}
        SELECT doc_id, CASE WHEN bool_or(checked_text IS NULL) THEN 'page without text' ELSE 'ok' END AS status,
               CASE WHEN bool_or(checked_text IS NULL) THEN count(*) FILTER (checked_text IS NULL) ELSE count(*) END AS pages
        FROM routed_pages GROUP BY doc_id""",
    "line_split": f"SELECT doc_id, line_no, line FROM {lines_of('documents', 'doc_id')}",
    "edge_lines": f"WITH {DECORATED},{edges('decorated_pages')} SELECT doc_id, line, top_count, bottom_count FROM edge_lines",
    "strip_headers": f"WITH {DECORATED},{stripped('decorated_pages')} SELECT doc_id, page_no, text FROM bare_pages",
    "boiler_lines": f"""WITH {DECORATED},{boiler('decorated_pages')}
        SELECT doc_id, line, page_count, first_page FROM boiler_lines""",
    "drop_boiler": f"WITH {DECORATED},{boiler('decorated_pages')} SELECT doc_id, page_no, text FROM body_pages",
    "paragraph_weld": page_rule(weld),
    "bullets": page_rule(bullets),
    "checkbox_on": page_rule(checked),
    "checkbox_off": page_rule(unchecked),
    "page_labels": page_rule(labels),
    "blank_runs": page_rule(blanks),
    "token_count": f"SELECT doc_id, {tokens('text')} AS token_count FROM documents",
    "clean_chain": f"WITH {CHAIN} SELECT doc_id, page_no, slice, text FROM clean_pages",
    "concat_offsets": f"""WITH {DECORATED} SELECT doc_id, page_no, coalesce(sum(length(text)) OVER (
        PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS page_offset
        FROM decorated_pages""",
    "conversation_chain": f"""WITH turns AS (
          SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page_no, count(*) OVER (PARTITION BY conv_id) AS n_pages, text
          FROM conversations), {chain('turns')}
        SELECT doc_id, page_no, slice, text FROM clean_pages""",
    "language_tag": f"WITH {language('documents', 'documents').strip()} SELECT doc_id, language FROM tags",
    "md_tables": f"""WITH {PARTS},
        bodies AS (
          SELECT doc_id, page_no, count(*) AS n, string_agg('| ' || p_name || ' | ' || p_type || ' | ' || coalesce(size, '') || ' | ' || price
                 || ' |  |', {NL} ORDER BY pos) AS rows FROM page_parts GROUP BY ALL)
        SELECT doc_id, page_no, 1 AS table_idx,
               '| Name | Type | Size | Price | Note |' || {NL} || '|---|---|---:|---|---|' || {NL} || rows AS md FROM bodies
        UNION ALL SELECT doc_id, page_no, 2, '| Brand | Page |' || {NL} || '|:--|:-:|' FROM bodies
        UNION ALL SELECT doc_id, page_no, 3, '| Brand | Rows |' || {NL} || '|---|---|' || {NL} || '| ' || doc_id || ' | ' || n || ' |' FROM bodies""",
    "md_cells": f"""WITH {PARTS}
        SELECT doc_id, page_no, 1 AS table_idx, -1 AS row_idx, c AS col_idx, ['Name', 'Type', 'Size', 'Price', 'Note'][c + 1] AS value
        FROM part_pages, range(5) r(c)
        UNION ALL SELECT doc_id, page_no, 1, pos, c, [p_name, p_type, size, price, NULL][c + 1] FROM page_parts, range(5) r(c)
        UNION ALL SELECT doc_id, page_no, 2, -1, c, ['Brand', 'Page'][c + 1] FROM part_pages, range(2) r(c)
        UNION ALL SELECT doc_id, page_no, 3, -1, c, ['Brand', 'Rows'][c + 1] FROM part_pages, range(2) r(c)
        UNION ALL SELECT doc_id, page_no, 3, 0, c, [doc_id, CAST(n AS VARCHAR)][c + 1] FROM part_pages, range(2) r(c)""",
    "html_tables": f"""WITH {PARTS}
        SELECT doc_id, page_no, 1 AS table_idx, -1 AS row_idx, c AS col_idx, ['Name', 'Type <x>', 'Size'][c + 1] AS value
        FROM part_pages, range(3) r(c)
        UNION ALL SELECT doc_id, page_no, 1, pos, c, [p_name, p_type || ' & more', size][c + 1] FROM page_parts, range(3) r(c)
        UNION ALL SELECT doc_id, page_no, 2, -1, c, CAST(c AS VARCHAR) FROM part_pages, range(2) r(c)
        UNION ALL SELECT doc_id, page_no, 2, pos, c, [doc_id, p_name][c + 1] FROM page_parts, range(2) r(c)""",
    "cell_strip": cells(S1, "a"),
    "drop_empty": cells(S2, "b"),
    "min_shape": cells(S3, "c"),
    "header_test": f"WITH {S4} SELECT {TABLE}, is_header FROM d_test",
    "header_promote": cells(S4, "d"),
    "header_names": cells(S5, "e"),
    "numeric_cols": f"WITH {S4}, {dotted('d', 'n')} SELECT {TABLE}, col_idx, is_numeric FROM n_numeric",
    "comma_dot": cells(S6, "f"),
    "clean_tables": cells(S7, "t"),
    "table_score": f"WITH {SCORES} SELECT {TABLE}, round(table_score, 4) AS table_score FROM scores",
    "csv_score": f"WITH {SCORES} SELECT {TABLE}, round(csv_score, 4) AS csv_score FROM scores",
    "best_table": f"""WITH {SCORES} SELECT doc_id,
        'page_' || lpad(CAST(page_no + 1 AS VARCHAR), 4, '0') || '_table_' || lpad(CAST(table_idx AS VARCHAR), 2, '0') || '.csv' AS best_csv,
        round_even(csv_score, 3) AS best_score
        FROM scores WHERE csv_score > 0
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY csv_score DESC, page_no, table_idx) = 1""",
    "engine_cascade": f"WITH {CANDIDATES} SELECT doc_id, engine, count FROM chosen",
    "table_names": f"WITH {CANDIDATES} SELECT doc_id, engine, table_idx, name FROM named_candidates",
    "pass_union": f"""WITH {S7},
        {drop_empty('a_cells', 'a_header', 'l').strip()},
        {shaped('l_cells', 'l_header', 'm', 1, 1).strip()},
        {promoted('m', 'n').strip()},
        {dotted('n', 'o').strip()},
        {drop_empty('o_cells', 'o_header', 'p').strip()},
        {shaped('p_cells', 'p_header', 'q', 1, 1).strip()},
        passes AS (
          SELECT DISTINCT {TABLE}, 1 AS pass_no, 'lattice' AS flavor FROM t_cells
          UNION ALL SELECT DISTINCT {TABLE}, 2, 'stream' FROM q_cells)
        SELECT *, 'camelot_' || flavor || '_' || lpad(CAST(table_idx AS VARCHAR), 2, '0') AS name FROM passes""",
    "table_meta": f"""WITH {CANDIDATES}
        SELECT c.doc_id, 0 AS part_no, c.engine, CASE WHEN c.count = 0 AND c.engine = 'docling' THEN 'no layout' END AS error, c.count,
               coalesce(string_agg(CASE c.engine WHEN 'docling' THEN '0|' || a.name || '.html|' ELSE '1|-|' END || a.name || '.csv|'
                 || CASE c.engine WHEN 'markdown' THEN a.name || '.md' ELSE '-' END, ',' ORDER BY a.table_idx), '') AS items,
               arg_min(a.name || '.csv', a.table_idx) AS best_csv, round_even(max(a.csv_score), 3) AS best_score
        FROM chosen c LEFT JOIN allowed a ON a.doc_id = c.doc_id AND a.engine = c.engine
        GROUP BY c.doc_id, c.engine, c.count""",
    "table_csv": f"""WITH {RENDERED}
        SELECT doc_id, page_no, 'table_' || lpad(CAST(table_idx AS VARCHAR), 2, '0') AS name,
               string_agg(csv || {NL}, '' ORDER BY row_idx) AS csv,
               '<table><tbody>' || string_agg('<tr>' || html || '</tr>', '' ORDER BY row_idx) || '</tbody></table>' AS html,
               string_agg('| ' || md || ' |' || CASE WHEN row_idx < 0 THEN {NL} || repeat('|---', n) || '|' ELSE '' END,
                          {NL} ORDER BY row_idx) AS md
        FROM row_texts GROUP BY {TABLE}""",
    "bundle": f"""WITH {DOC_TEXTS}
        SELECT d.doc_id, 0 AS part_no, 1 AS n_parts, d.text, d.slices, s.offsets, 'non_ocr' AS routed, 'unknown' AS language,
               r.num_pages, round(r.text_page_ratio, 6) AS text_page_ratio,
               CASE WHEN r.router = 'ocr' THEN 'ocr_engine_missing' ELSE 'router_non_ocr' END AS route_reason,
               {tokens('d.text')} AS token_count
        FROM doc_texts d JOIN doc_starts s USING (doc_id) JOIN routed r USING (doc_id)""",
    "run_summary": f"""WITH {DOC_TEXTS}
        SELECT doc_id, 'out/' || doc_id AS out, 'non_ocr' AS routed, 'unknown' AS language, {tokens('text')} AS token_count
        FROM doc_texts""",
    "page_files": f"""WITH {CHAIN}
        SELECT doc_id, lpad(CAST(page_no + 1 AS VARCHAR), 4, '0') || '.txt' AS name, slice AS text FROM clean_pages""",
    "stream_ingest": f"SELECT doc_id AS source_id, {CONTENT_ID} AS doc_id, {tokens('text')} AS token_count FROM documents",
    "stream_dedup": f"SELECT DISTINCT {CONTENT_ID} AS doc_id FROM documents",
    "stream_pages": f"""SELECT conv_id AS doc_id, 0 AS part_no, count(*) AS n_pages,
        string_agg(text, {NL} ORDER BY turn) AS text FROM conversations GROUP BY conv_id""",
}

_UNIQUE = f"""
unique_docs AS (
  SELECT {CONTENT_ID} AS doc_id, min(doc_id) AS number, arg_min(source, doc_id) AS source, any_value(text) AS text
  FROM documents GROUP BY {CONTENT_ID})"""

_INGEST_PAGES = TEXT_PAGES.replace("FROM documents)", "FROM unique_docs)").replace("doc_id, source,", "doc_id, number, source,")

ORACLES["ingest_documents"] = f"""WITH {_UNIQUE}, {_INGEST_PAGES},
numbers AS (SELECT doc_id, number FROM unique_docs),
decorated_pages AS ({decorated('text_pages')}),
native_pages AS (
  SELECT p.doc_id, page_no, n_pages,
         CASE WHEN number % 4 = 0 THEN '' WHEN number % 4 = 1 AND page_no % 2 = 0 THEN 'x' ELSE text END AS text
  FROM decorated_pages p JOIN numbers USING (doc_id)),
{probing('native_pages', 'text')},
source_pages AS (
  SELECT n.doc_id, n.page_no, n.n_pages, CASE WHEN r.router = 'ocr' THEN d.text ELSE n.text END AS text
  FROM native_pages n JOIN decorated_pages d USING (doc_id, page_no) JOIN routed r USING (doc_id)),
{chain('source_pages')},
doc_texts AS (SELECT doc_id, string_agg(text, '' ORDER BY page_no) AS text FROM clean_pages GROUP BY doc_id),
page_starts AS (
  SELECT doc_id, text, CAST(coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_at
  FROM clean_pages),
marks AS (
  SELECT doc_id, CAST(sum(CAST(('0x' || substr(sha256(start_at || ':' || text), 1, 15)) AS BIGINT)) AS VARCHAR) AS text_fingerprint
  FROM page_starts GROUP BY doc_id),
{language('doc_texts', 'documents').strip()}
SELECT d.doc_id, 'out/' || d.doc_id AS out, r.router AS routed, t.language, {tokens('d.text')} AS token_count,
       r.num_pages, f.text_fingerprint
FROM doc_texts d JOIN routed r USING (doc_id) JOIN tags t USING (doc_id) JOIN marks f USING (doc_id)"""

ORACLES["bundle_long"] = ORACLES["bundle"]

ORACLES["docmeta"] = f"""SELECT doc_id, part_no, routed, language, offsets, num_pages, text_page_ratio, route_reason, token_count, 0 AS n_tables
FROM ({ORACLES["bundle"]})"""

ORACLES["stream_upsert"] = f"""WITH kept AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Changed. ' ELSE '' END || coalesce(text, '') AS text, 'x' AS source FROM documents),
{TEXT_PAGES.replace("FROM documents)", "FROM kept)")}, {chain('text_pages')},
doc_texts AS (SELECT doc_id, string_agg(text, '' ORDER BY page_no) AS text FROM clean_pages GROUP BY doc_id)
SELECT doc_id, text LIKE 'Changed. %' AS changed, length(text) AS chars FROM doc_texts"""

ORACLES["language_holdout"] = f"""WITH held_docs AS (
  SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, any_value(text) AS text FROM documents GROUP BY {CONTENT_ID}),
taught AS (SELECT * FROM held_docs WHERE doc_id % 5 <> 0), asked AS (SELECT * FROM held_docs WHERE doc_id % 5 = 0),
{language('asked', 'taught').strip()}
SELECT doc_id, lang, language FROM tags JOIN asked USING (doc_id)"""

_UNEVEN = f"""{ROUTED},
native_pages AS (
  SELECT doc_id, page_no, CASE WHEN doc_id % 6 = 4 THEN 1 ELSE n_pages END AS n_pages, native_text AS text
  FROM routed_pages WHERE doc_id % 6 <> 5 AND (doc_id % 6 <> 4 OR page_no = 0)),
ocr_pages AS (SELECT doc_id, page_no, n_pages, fallback_text AS text FROM routed_pages WHERE doc_id % 6 <> 3),
{probing('native_pages', 'text')},
ids AS (SELECT DISTINCT doc_id FROM routed_pages),
decided AS (
  SELECT doc_id, coalesce(num_pages, 0) AS num_pages, coalesce(text_page_ratio, 0) AS text_page_ratio,
    coalesce(router, 'ocr') AS router, coalesce(router, 'ocr') = 'ocr' AND doc_id % 6 <> 3 AS use_ocr,
    CASE WHEN router = 'non_ocr' THEN 'router_non_ocr' WHEN doc_id % 6 = 3 THEN 'ocr_engine_missing' ELSE 'router_ocr' END AS route_reason
  FROM ids LEFT JOIN routed USING (doc_id)),
source_pages AS (
  SELECT n.* FROM native_pages n JOIN decided d USING (doc_id) WHERE NOT d.use_ocr
  UNION ALL SELECT o.* FROM ocr_pages o JOIN decided d USING (doc_id) WHERE d.use_ocr)"""

ORACLES["uneven_sources"] = f"""WITH {_UNEVEN},
sizes AS (SELECT doc_id, count(*) AS pages, sum(length(text)) AS chars FROM source_pages GROUP BY doc_id)
SELECT doc_id, num_pages, round(text_page_ratio, 6) AS text_page_ratio, router, route_reason,
       CASE WHEN use_ocr THEN 'ocr' ELSE 'non_ocr' END AS routed, coalesce(pages, 0) AS pages, CAST(coalesce(chars, 0) AS BIGINT) AS chars
FROM decided LEFT JOIN sizes USING (doc_id)"""

ORACLES["uneven_bundle"] = f"""WITH {_UNEVEN}, {chain('source_pages')},
doc_texts AS (SELECT doc_id, string_agg(text, '' ORDER BY page_no) AS text, count(*) AS n_slices FROM clean_pages GROUP BY doc_id),
filled AS (
  SELECT d.doc_id, coalesce(t.text, '') AS text, CASE WHEN d.use_ocr THEN 'ocr' ELSE 'non_ocr' END AS routed, coalesce(t.n_slices, 0) AS n_slices
  FROM decided d LEFT JOIN doc_texts t USING (doc_id))
SELECT doc_id, text, routed, {tokens('text')} AS token_count, n_slices FROM filled"""

ORACLES["language_blocks"] = ORACLES["language_tag"]

_FILES = "SELECT doc_id || '.txt' AS name, coalesce(text, '') AS text FROM documents"
ORACLES["file_discovery"] = f"SELECT name, strlen(text) AS length, sha256(text) AS sha256, sha256(text)[1:16] AS doc_id FROM ({_FILES})"
ORACLES["stream_files"] = f"SELECT name, strlen(text) AS length, sha256(text) AS sha256 FROM ({_FILES})"
ORACLES["file_ranges"] = f"""SELECT name, strlen(text) AS length, CAST(greatest(1, ceil(strlen(text) / 1000)) AS INTEGER) AS pieces, text
FROM ({_FILES})"""

ORACLES["table_files"] = f"""WITH made AS ({ORACLES["table_csv"]}),
kinds AS (
  SELECT doc_id || '/tables/page_' || lpad(CAST(page_no + 1 AS VARCHAR), 4, '0') || '/' || name AS stem, unnest(['csv', 'html', 'md']) AS kind,
         unnest([csv, html, md]) AS content FROM made)
SELECT stem || '.' || kind AS file, strlen(content) AS length, sha256(content) AS sha256 FROM kinds"""

ORACLES["nested_tables"] = f"""WITH {PARTS},
bodies AS (SELECT doc_id, page_no, count(*) AS n, string_agg(p_name || p_type, '' ORDER BY pos) AS words FROM page_parts GROUP BY ALL)
SELECT doc_id, page_no, 1 AS table_idx, -1 AS row_idx, c AS col_idx, ['Key', 'Held'][c + 1] AS value FROM bodies, range(2) r(c)
UNION ALL SELECT doc_id, page_no, 1, 0, c, [doc_id, 'before ' || words || ' after'][c + 1] FROM bodies, range(2) r(c)
UNION ALL SELECT doc_id, page_no, 1, 1, c, ['last', CAST(n AS VARCHAR)][c + 1] FROM bodies, range(2) r(c)
UNION ALL SELECT doc_id, page_no, 2, -1, c, CAST(c AS VARCHAR) FROM bodies, range(2) r(c)
UNION ALL SELECT doc_id, page_no, 2, pos, c, [p_name, p_type][c + 1] FROM page_parts, range(2) r(c)
UNION ALL SELECT doc_id, page_no, 3, -1, 0, '0' FROM bodies
UNION ALL SELECT doc_id, page_no, 3, 0, 0, CAST(page_no AS VARCHAR) FROM bodies"""

ORACLES["error_channel"] = f"""WITH summary AS ({ORACLES["run_summary"]})
SELECT doc_id, 'done' AS stage, 'docling' AS engine, CASE WHEN doc_id % 5 = 0 THEN 'no layout' END AS error, token_count
FROM summary WHERE doc_id % 13 <> 0
UNION ALL SELECT doc_id, 'extract', NULL, 'ValueError: broken', NULL FROM documents WHERE doc_id % 13 = 0
UNION ALL SELECT doc_id, 'tables', 'docling', 'no layout', NULL FROM documents WHERE doc_id % 5 = 0"""

ORACLES["file_pages"] = f"SELECT doc_id, page_no, text FROM ({ORACLES['page_table']})"
