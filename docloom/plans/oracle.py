"""DuckDB SQL for the registered queries, to compare their results with.

The splitter is written here a second time, as relations: a text is cut level by level into stretches, runs
of stretches that fit form a group, and a recursive query walks each group from piece to piece.
"""

from __future__ import annotations

import re

from docloom.constants import FORMAT_SUFFIXES, MAX_CHARS, OVERLAP, REGISTRY_KEYS, WHITESPACE, WORDING
from docloom.plans import inputs
from docloom.plans.inputs import BASE, FORMAT, LATER, NAMESPACE, PATH, RUN_DATE, of


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WS = q(WHITESPACE)
LF = "chr(10)"
STEP = MAX_CHARS - OVERLAP


def duck(expression: str) -> str:
    """The few places where an input expression is spelled differently."""
    return expression.replace("AS STRING", "AS VARCHAR")


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


# --- the splitter ------------------------------------------------------------------------------------------------


def _level(p: str, n: int, sep: str, width: int) -> str:
    return f"""
{p}e{n} AS (
  SELECT k, lo, unnest(parts) AS elem, generate_subscripts(parts, 1) AS ord
  FROM (SELECT r.k, r.lo, string_split(substring(s.body, r.lo + 1, r.hi - r.lo), {sep}) AS parts
        FROM {p}r{n} r JOIN {p}src s ON r.k = s.k)),
{p}s{n} AS (
  SELECT *, lo + sum(len) OVER w - len AS off, lo + sum(len) OVER w AS off_end,
         sum(CASE WHEN len > {MAX_CHARS} THEN 1 ELSE 0 END) OVER w AS g
  FROM (SELECT k, lo, ord, length(elem) + CASE WHEN ord > 1 THEN {width} ELSE 0 END AS len FROM {p}e{n}) WHERE len > 0
  WINDOW w AS (PARTITION BY k, lo ORDER BY ord)),
{p}r{n + 1} AS (SELECT k, off::BIGINT AS lo, off_end::BIGINT AS hi FROM {p}s{n} WHERE len > {MAX_CHARS}),"""


def pieces(p: str, src: str) -> str:
    """CTEs that end in ``{p}out(k, i, s, e, content)`` for ``src`` giving ``(k, body)``."""
    levels = _level(p, 1, f"{LF} || {LF}", 2) + _level(p, 2, LF, 1) + _level(p, 3, "' '", 1)
    groups = " UNION ALL ".join(
        f"SELECT k, {n} AS lvl, lo, g, off::BIGINT AS off, off_end::BIGINT AS off_end FROM {p}s{n} WHERE len <= {MAX_CHARS}"
        for n in (1, 2, 3)
    )
    same = "a.k = b.k AND a.lvl = b.lvl AND a.lo = b.lo AND a.g = b.g"
    return f"""
{p}src AS MATERIALIZED ({src}),
{p}r1 AS (SELECT k, 0::BIGINT AS lo, length(body)::BIGINT AS hi FROM {p}src WHERE length(body) > 0),{levels}
{p}st AS MATERIALIZED ({groups}),
{p}en AS (SELECT a.*, b.off_end AS e FROM {p}st a ASOF JOIN {p}st b ON {same} AND a.off + {MAX_CHARS} >= b.off_end),
{p}fo AS (
  SELECT a.k, a.lvl, a.lo, a.g, a.off, a.e, greatest(a.e - {OVERLAP}, b.off_end - {MAX_CHARS}) AS x
  FROM {p}en a JOIN {p}st b ON {same} AND b.off = a.e),
{p}nx AS MATERIALIZED (SELECT a.*, b.off AS nxt FROM {p}fo a ASOF JOIN {p}st b ON {same} AND a.x <= b.off),
{p}ch AS (
  SELECT k, lvl, lo, g, min(off) AS off FROM {p}st GROUP BY ALL
  UNION ALL
  SELECT a.k, a.lvl, a.lo, a.g, b.nxt FROM {p}ch a JOIN {p}nx b ON {same} AND a.off = b.off),
{p}raw AS (
  SELECT a.k, a.off AS s, b.e FROM {p}ch a JOIN {p}en b ON {same} AND a.off = b.off
  UNION ALL
  SELECT k, lo + j * {STEP}, least(lo + j * {STEP} + {MAX_CHARS}, hi)
  FROM (SELECT *, unnest(range(0, 1 + ceil((hi - lo - {MAX_CHARS}) / {STEP})::BIGINT)) AS j FROM {p}r4)),
{p}txt AS (SELECT r.k, r.s, substring(t.body, r.s + 1, r.e - r.s) AS c FROM {p}raw r JOIN {p}src t ON r.k = t.k),
{p}out AS (
  SELECT k, (row_number() OVER (PARTITION BY k ORDER BY s) - 1)::INTEGER AS i,
         s + length(c) - length(ltrim(c, {WS})) AS s,
         s + length(c) - length(ltrim(c, {WS})) + length({strip("c")}) AS e,
         {strip("c")} AS content
  FROM {p}txt WHERE {strip("c")} <> '')"""


def with_pieces(p: str, src: str, select: str, more: str = "") -> str:
    return f"WITH RECURSIVE {pieces(p, src)}{more} {select}"


# --- inputs ------------------------------------------------------------------------------------------------------


def _sources(url: str = "url", path: str = PATH, namespace: str = NAMESPACE, fmt: str = FORMAT) -> str:
    return f"""SELECT page_id AS pos, concat('page', page_id) AS document_id, {of(url, 'page_id')} AS document_url,
  {of(path, 'page_id')} AS document_path, {of(namespace, 'page_id')} AS namespace, {of(fmt, 'page_id')} AS input_format
  FROM pages"""


SOURCES = _sources()
FILES = f"SELECT concat('{BASE}/', {of(PATH, 'doc_id')}) AS path, doc_id AS length FROM labels"
CHANGES = f"""SELECT doc_id AS pos, concat('page', doc_id) AS document_id,
  concat('https://changed.example.org/', doc_id) AS document_url, {of(PATH, 'doc_id')} AS document_path,
  concat('q', quality) AS namespace, {of(FORMAT, 'doc_id')} AS input_format FROM labels"""
PDF_TEXT = strip(f"coalesce({duck(inputs.PAGE_TEXT)}, '')")
PDF = f"""SELECT concat('pdf', conv_id) AS k, string_agg(t, {LF} || {LF} ORDER BY turn) AS body
  FROM (SELECT conv_id, turn, {PDF_TEXT} AS t FROM conversations) WHERE t <> '' GROUP BY conv_id"""
DOCS = "SELECT doc_id AS k, text AS body FROM documents"


def _records(out: str, docs: str = "documents", date: str = RUN_DATE) -> str:
    return f"""SELECT {of(NAMESPACE, 'd.doc_id')} AS namespace, concat('doc', o.k, ':chunk', o.i) AS _id,
  concat('doc', o.k) AS document_id, concat('https://example.org/', d.source, '/', o.k) AS document_url,
  '{date}' AS document_date, o.content AS chunk_content, CAST(NULL AS VARCHAR) AS chunk_section_id
  FROM {out} o JOIN {docs} d ON o.k = d.doc_id"""


# --- markdown ----------------------------------------------------------------------------------------------------

_LEVELS = range(1, 6)
MD_CTES = f"""
md_body AS (
  SELECT concat('md', conv_id) AS document_id, string_agg({duck(inputs.MARKDOWN)}, {LF} || {LF} ORDER BY turn) AS body
  FROM conversations GROUP BY conv_id),
md_line AS (
  SELECT document_id, {strip("raw")} AS line, no FROM (
    SELECT document_id, unnest(string_split(body, {LF})) AS raw, generate_subscripts(string_split(body, {LF}), 1) AS no FROM md_body)),
md_kind AS (
  SELECT *, CASE WHEN starts_with(line, '~~~') THEN 't' WHEN NOT starts_with(line, '```') THEN ''
                 WHEN contains(substring(line, 4), '```') THEN 'i' ELSE 'b' END AS kind FROM md_line),
md_fence AS (
  SELECT *, list_reduce(list_prepend('0', coalesce(list(kind) FILTER (WHERE kind <> '') OVER (PARTITION BY document_id ORDER BY no), [])),
    lambda s, k: CASE s WHEN '0' THEN CASE WHEN k = 'i' THEN '0' ELSE k END
                        WHEN 'b' THEN CASE WHEN k = 't' THEN 'b' ELSE '0' END ELSE CASE WHEN k = 't' THEN '0' ELSE 't' END END) <> '0' AS fenced
  FROM md_kind),
md_head AS (SELECT *, CASE WHEN fenced THEN 0 ELSE length(regexp_extract(line, '^(#{{1,5}}) ', 1)) END AS level FROM md_fence),
md_force AS (SELECT *, {", ".join(
    f"last_value(CASE WHEN level = {k} THEN no END IGNORE NULLS) OVER w AS p{k}, "
    f"last_value(CASE WHEN level = {k} THEN {strip(f'substring(line, {k + 1})')} END IGNORE NULLS) OVER w AS t{k}"
    for k in _LEVELS)}
  FROM md_head WINDOW w AS (PARTITION BY document_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
md_cont AS (
  SELECT document_id, no, line, greatest(0, {", ".join(f"coalesce(p{k}, 0)" for k in _LEVELS)}) AS sec,
    concat_ws('|', {", ".join(
        f"CASE WHEN p{k} > greatest(0, {', '.join(['0'] + [f'coalesce(p{j}, 0)' for j in range(1, k)])}) THEN t{k} END"
        for k in _LEVELS)}) AS section_id
  FROM md_force WHERE level = 0),
md_sec AS (
  SELECT document_id, sec, section_id,
    trim(regexp_replace(string_agg(line, {LF} ORDER BY no), '\\n{{3,}}', {LF} || {LF}, 'g'), {LF}) AS content
  FROM md_cont GROUP BY ALL HAVING content <> '')"""

# --- JSON --------------------------------------------------------------------------------------------------------

# width of one entry, entries that fit in a chunk
ENTRY_WIDTH = 25
PER_CHUNK = (MAX_CHARS - 1) // (ENTRY_WIDTH + 1)


def _json_entries() -> str:
    return f"""SELECT CAST(floor(o_orderkey / {inputs.ORDERS_PER_DOCUMENT}) AS BIGINT) AS doc_no, o_orderkey,
  {duck(inputs.ORDER_ENTRY)} AS entry FROM orders"""


def _json_chunks(fmt: str) -> str:
    return f"""SELECT concat('{fmt}', doc_no) AS document_id, i, concat('{{', string_agg(entry, ',' ORDER BY o_orderkey), '}}') AS content,
  false AS oversize
  FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY doc_no ORDER BY o_orderkey) - 1) / {PER_CHUNK}) AS INTEGER) AS i
        FROM ({_json_entries()}))
  GROUP BY doc_no, i"""


NESTED = f"""WITH o AS (SELECT concat('order', o_orderkey) AS document_id, o_orderkey % 50 = 0 AS large, {duck(inputs.MEMO)} AS memo,
    concat('"key":', o_orderkey, ',"status":"', o_orderstatus, '","tags":["', {inputs.TAGS[0]}, '","', {inputs.TAGS[1]}, '"]') AS head FROM orders)
  SELECT document_id, 0::INTEGER AS i, concat('{{"order":{{', head, CASE WHEN large THEN '' ELSE concat(',"memo":"', memo, '"') END, '}}}}') AS content,
    false AS oversize FROM o
  UNION ALL SELECT document_id, 1, concat('{{"order":{{"memo":"', memo, '"}}}}'), true FROM o WHERE large"""


def _broken(fmt: str, error: str) -> str:
    """``error`` has ``{at}`` for the place of the brace too many, counted from 0, and ``{column}`` for that from 1."""
    message = "concat(" + ", ".join({"{at}": "length(whole)", "{column}": "length(whole) + 1"}.get(x, q(x)) for x in re.split(r"({at}|{column})", error) if x) + ")"
    return f"""SELECT concat('{fmt}', doc_no) AS document_id, '{fmt}' AS input_format, {message} AS error
  FROM (SELECT doc_no, concat('{{', string_agg(entry, ',' ORDER BY o_orderkey), '}}') AS whole FROM ({_json_entries()}) GROUP BY doc_no)
  WHERE doc_no % 10 = 0"""


# --- text --------------------------------------------------------------------------------------------------------


def normalized(c: str) -> str:
    c = f"replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    for pattern, by in ((r"[\t\f\x0B]+", "' '"), (r" \n+", LF), (r"\n{3,}", f"{LF} || {LF}"), (" {2,}", "' '")):
        c = f"regexp_replace({c}, '{pattern}', {by}, 'g')"
    return strip(c)


#: References of the pages at hand and what they stand for, by code point; the ampersand comes last.
REFERENCES = {"copy": 169, "middot": 183, "quot": 34, "lt": 60, "gt": 62, "amp": 38}


def unescaped(c: str) -> str:
    for name, point in REFERENCES.items():
        c = f"replace({c}, '&{name};', chr({point}))"
    return c


def html_text(c: str) -> str:
    """Tag by tag: a page is cut at every ``<``; what stands behind the ``>`` of a piece is text, unless the piece opens a
    script, a style or a comment, whose content is taken out before."""
    hidden = c
    for begin, end in (("<script", "</script>"), ("<style", "</style>"), ("<!--", "-->")):
        # the parts behind each beginning, without what lies before its end
        rest = f"list_transform(string_split({hidden}, '{begin}')[2:], lambda p: substring(p, position('{end}' IN p) + {len(end)}))"
        hidden = f"array_to_string(list_prepend(string_split({hidden}, '{begin}')[1], {rest}), '<x>')"
    cut = f"string_split({hidden}, '<')"
    tail = f"list_transform({cut}[2:], lambda p: substring(p, position('>' IN p) + 1))"
    parts = f"list_transform(list_prepend({cut}[1], {tail}), lambda f: {strip(unescaped('f'))})"
    return normalized(unescaped(f"array_to_string(list_filter({parts}, lambda f: f <> ''), ' ')"))


def _clean(url: str) -> str:
    return f"trim({url})"


def _scheme(url: str) -> str:
    """What stands before the first colon, if nothing else that parts an address does."""
    head = f"split_part({_clean(url)}, ':', 1)"
    return f"CASE WHEN contains({_clean(url)}, ':') AND NOT regexp_matches({head}, '[/?#]') THEN {head} ELSE '' END"


def _behind(url: str) -> str:
    """The address behind its scheme, without query and fragment."""
    bare = f"split_part(split_part({_clean(url)}, '#', 1), '?', 1)"
    return f"CASE WHEN {_scheme(url)} <> '' THEN substring({bare}, length({_scheme(url)}) + 2) ELSE {bare} END"


def url_part(url: str, part: int) -> str:
    """2: scheme, 4: authority, 5: path."""
    behind = _behind(url)
    host = f"split_part(substring({behind}, 3), '/', 1)"
    return {
        2: _scheme(url),
        4: f"CASE WHEN starts_with({behind}, '//') THEN {host} ELSE '' END",
        5: f"CASE WHEN starts_with({behind}, '//') THEN substring({behind}, 3 + length({host})) ELSE {behind} END",
    }[part]


def url_path(url: str) -> str:
    path = f"({url_part(url, 5)})"
    last = f"string_split({path}, '/')[-1]"
    return f"concat(substring({path}, 1, length({path}) - length({last})), split_part({last}, ';', 1))"


def segments(path: str) -> str:
    return f"list_filter(string_split({path}, '/'), lambda s: s <> '' AND s <> '.')"


def basename(path: str) -> str:
    return f"coalesce({segments(path)}[-1], '')"


def is_txt(url: str) -> str:
    return f"ends_with(lower({basename(url_path(url))}), '.txt')"


def is_http(url: str) -> str:
    return f"(lower({url_part(url, 2)}) IN ('http', 'https') AND {url_part(url, 4)} <> '')"


def resolved(path: str) -> str:
    full = f"CASE WHEN starts_with({path}, '/') THEN {path} ELSE concat('{BASE}/', {path}) END"
    return f"concat('/', array_to_string({segments(full)}, '/'))"


def suffix(path: str) -> str:
    return f"lower(regexp_extract({basename(path)}, '^.+(\\.[^.]+)$', 1))"


# --- registry ----------------------------------------------------------------------------------------------------

KEY_OF = {column: key for key, column in REGISTRY_KEYS.items()}
BROKEN = _sources(inputs.BROKEN_URL, inputs.BROKEN_PATH, inputs.BROKEN_NAMESPACE, inputs.BROKEN_FORMAT)


def said(wording: str, *values: str) -> str:
    """A sentence of the fixed wording with SQL values filled in."""
    first, *others = WORDING[wording].split("{}")
    return f"concat({', '.join([q(first), *[x for value, text in zip(values, others, strict=True) for x in (value, q(text))]])})"


def _issues(check_files: bool) -> str:
    """Rows ``(pos, document_id, ord, rule, message)``, every rule written out as one SELECT."""
    fmt = strip("coalesce(input_format, '')")
    url, path, ns = "coalesce(document_url, '')", "coalesce(document_path, '')", "coalesce(namespace, '')"
    full = resolved(path)
    keys = sorted(KEY_OF.items(), key=lambda kv: kv[1])
    listed = ", ".join(f"CASE WHEN {c} IS NULL THEN {q(repr(k))} END" for c, k in keys)
    shown = lambda c: f"concat({q(chr(39))}, {c}, {q(chr(39))})"
    rules = [(" OR ".join(f"{c} IS NULL" for c, _ in keys), "missing_keys", said("missing_keys", f"concat_ws(', ', {listed})"))]
    for c, k in keys:
        rules.append((f"{c} IS NOT NULL AND {strip(c)} = ''", f"blank_{c}", said("blank", q(k))))
    unknown = f"{fmt} <> '' AND lower({fmt}) NOT IN ('markdown', 'text', 'pdf', 'json', 'yaml')"
    rules += [
        (f"{fmt} = ''", "format_required", said("format_required")),
        (unknown, "format_unknown", said("format_unknown", shown("input_format"))),
        (f"{url} <> '' AND NOT {is_http(url)}", "url_not_http", said("url_not_http", shown("document_url"))),
    ]
    if check_files:
        rules.append((f"{path} <> '' AND {full} NOT IN (SELECT path FROM ({FILES}))", "path_missing", said("path_missing", full)))
    for name, allowed in FORMAT_SUFFIXES.items():
        wrong = f"{path} <> '' AND lower({fmt}) = '{name}' AND {suffix(full)} NOT IN ({', '.join(map(q, allowed))})"
        rules.append((wrong, "suffix_mismatch", said(f"suffix_{name}", basename(full))))
    rules.append((f"{strip(ns)} = ''", "namespace_required", said("namespace_required")))
    return " UNION ALL ".join(
        f"SELECT pos, document_id, {n} AS ord, '{rule}' AS rule, concat(document_id, ': ', {message}) AS message FROM b WHERE {when}"
        for n, (when, rule, message) in enumerate(rules)
    )


def _coercion() -> str:
    name, bad = "concat('page', page_id)", "page_id % 9 IN (0, 1)"
    shown = of(inputs.ENTRY_KEY, "page_id")
    named = lambda text: f"concat({name}, ': ', {text})"
    rules = [
        (bad, "invalid_id", said("invalid_id", f"concat({q(chr(39))}, coalesce({shown}, ''), {q(chr(39))})")),
        ("page_id % 9 = 2", "not_a_mapping", named(said("not_a_mapping"))),
        ("page_id % 9 = 3", "missing_key", named(said("missing_key", q("document-url")))),
        ("page_id % 9 = 5", "not_a_string", named(said("not_a_string", q("document-path")))),
        ("page_id % 9 = 5", "missing_key", named(said("missing_key", q("pinecone-namespace")))),
        ("page_id % 9 = 4", "not_a_string", named(said("not_a_string", q("input-format")))),
    ]
    union = " UNION ALL ".join(
        f"SELECT page_id AS pos, {shown} AS document_id, {n} AS ord, '{rule}' AS rule, {message} AS message FROM pages WHERE {when}"
        for n, (when, rule, message) in enumerate(rules)
    )
    return _numbered(union)


def _numbered(union: str) -> str:
    return f"""SELECT pos, document_id, CAST(row_number() OVER (PARTITION BY pos ORDER BY ord) - 1 AS INTEGER) AS seq, rule, message
  FROM ({union})"""


LISTING = """SELECT document_id AS "Document", input_format AS "Format", namespace AS "Namespace", document_path AS "Path",
  document_url AS "URL" FROM s"""
_NAMES = ("Document", "Format", "Namespace", "Path", "URL")
WIDTHS = ", ".join(f'CAST(greatest(max(length("{c}")), {len(c)}) AS INTEGER) AS "{c}"' for c in _NAMES)
LINE = " || ' | ' || ".join(f"""rpad(l."{c}", w."{c}", ' ')""" for c in _NAMES)

# --- landing -----------------------------------------------------------------------------------------------------

LANDED_SOURCE = f"""SELECT s.document_id, s.input_format = 'text' AND NOT {is_txt('s.url')} AS convert, s.url, s.document_path, p.html
  FROM (SELECT page_id, concat('page', page_id) AS document_id, {of(FORMAT, 'page_id')} AS input_format,
               {of(PATH, 'page_id')} AS document_path, {of(inputs.LANDED_URL, 'page_id')} AS url FROM pages) s
  LEFT JOIN pages p ON p.url = s.url"""
TARGET = f"""CASE WHEN convert THEN concat('{BASE}/docs/', document_id, '.txt') ELSE {resolved('document_path')} END"""

_UNESCAPED_RAGGED = (
    "replace(replace(text, '. ', '. ' || chr(9) || chr(11) || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10) "
    "|| ' ' || chr(12) || chr(10)), ' de ', '  de' || chr(9) || ' ' || chr(10) || chr(10) || chr(10))"
)

# --- records -----------------------------------------------------------------------------------------------------

_JSON_FIELDS = ("_id", "document_id", "document_url", "document_date", "chunk_content")
RECORD = "concat('{', " + ", ',', ".join(f"'\"{c}\":', to_json({c})" for c in _JSON_FIELDS) + ", '}')"
INDENTED = (
    "concat('  {', chr(10), "
    + ", ',', chr(10), ".join(f"'    \"{c}\": ', to_json({c})" for c in _JSON_FIELDS)
    + ", chr(10), '  }')"
)
REVISED = """SELECT doc_id AS k, concat(lang, ': ', text) AS body FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels)"""
TWO_VERSIONS = (
    f"WITH RECURSIVE {pieces('o_', DOCS)}, {pieces('n_', REVISED)}, old AS ({_records('o_out')}), "
    f"new AS ({_records('n_out', date=LATER)}) "
)
REPLACED = """SELECT * FROM old WHERE (namespace, document_id) NOT IN (SELECT (namespace, document_id) FROM new)
  UNION ALL SELECT * FROM new"""

ORACLES = {
    "registry_scan": f"SELECT * FROM ({SOURCES}) WHERE pos % 9 IN (6, 7, 8)",
    "registry_coerce": _coercion(),
    "body_scan": f"""SELECT doc_id, CASE WHEN n_chars % 13 = 0 THEN NULL ELSE
      replace(replace(replace(text, ' la ', chr(13) || chr(10) || 'la' || chr(13)), chr(13) || chr(10), chr(10)), chr(13), chr(10)) END AS body
      FROM documents""",
    "page_scan": """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'text/html; Charset=UTF-8' WHEN page_id % 4 = 1 THEN 'text/html'
      ELSE 'text/html;charset=utf-8; v=1' END AS content_type, 'content-type,x-page' AS names, CAST(strlen(html) AS INTEGER) AS n_bytes FROM pages""",
    "pdf_page_assembly": f"SELECT k AS document_id, CAST(0 AS BIGINT) AS part_no, body FROM ({PDF})",
    "missing_bodies": f"""SELECT document_id, concat('{BASE}/', document_path) AS path FROM ({SOURCES})
      WHERE concat('{BASE}/', document_path) NOT IN (SELECT path FROM ({FILES}))""",
    "source_body_join": f"""SELECT document_id, input_format, f.path, f.length FROM ({SOURCES}) s
      JOIN ({FILES}) f ON f.path = concat('{BASE}/', s.document_path)""",
    "registry_validate": f"WITH b AS ({BROKEN}) " + _numbered(_issues(True)),
    "registry_error_report": f"""WITH b AS ({BROKEN}) SELECT document_id, CAST(count(*) AS INTEGER) AS n_issues,
      string_agg(concat('- ', message), {LF} ORDER BY ord) AS report FROM ({_issues(False)}) GROUP BY document_id""",
    "registry_listing": f"WITH s AS ({SOURCES}) {LISTING} ORDER BY 1",
    "listing_widths": f"WITH s AS ({SOURCES}) SELECT {WIDTHS} FROM ({LISTING})",
    "listing_lines": f"""WITH s AS ({SOURCES}), l AS ({LISTING}), w AS (SELECT {WIDTHS} FROM l),
      t AS (SELECT * FROM l UNION ALL SELECT {", ".join(map(q, _NAMES))}) SELECT {LINE.replace("l.", "t.")} AS line FROM t, w""",
    "listing_tabbed": f"SELECT concat_ws(chr(9), document_id, input_format, document_url) AS line FROM ({SOURCES}) ORDER BY pos",
    "select_all": SOURCES,
    "select_one": f"SELECT * FROM ({SOURCES}) WHERE document_id = 'page7'",
    "lookup_unknown": f"""SELECT concat('page', doc_id) AS document_id FROM labels
      WHERE concat('page', doc_id) NOT IN (SELECT document_id FROM ({SOURCES}))""",
    "registry_upsert": f"""WITH s AS ({SOURCES}), c AS ({CHANGES})
      SELECT * FROM s WHERE document_id NOT IN (SELECT document_id FROM c)
      UNION ALL
      SELECT coalesce(s.pos, (SELECT max(pos) FROM s) + 1 + c.pos), c.document_id, c.document_url, c.document_path, c.namespace, c.input_format
      FROM c LEFT JOIN s ON s.document_id = c.document_id""",
    "registry_remove": f"SELECT * FROM ({SOURCES}) WHERE document_id NOT IN (SELECT document_id FROM ({CHANGES}))",
    "registry_save": SOURCES,
    "registry_edit": f"""WITH s AS ({SOURCES}), c AS ({CHANGES}), u AS (
      SELECT * FROM s WHERE document_id NOT IN (SELECT document_id FROM c)
      UNION ALL
      SELECT coalesce(s.pos, (SELECT max(pos) FROM s) + 1 + c.pos), c.document_id, c.document_url, c.document_path, c.namespace, c.input_format
      FROM c LEFT JOIN s ON s.document_id = c.document_id)
      SELECT * FROM u WHERE document_id NOT IN (SELECT document_id FROM c WHERE pos % 4 = 1)""",
    "land_missing": """WITH s AS (SELECT page_id AS pos, html, CAST(floor(page_id / 2) AS BIGINT) AS shared FROM pages),
      body AS (SELECT shared, coalesce(min(CASE WHEN pos % 5 = 0 THEN concat('stored ', pos) END), arg_min(html, pos)) AS body FROM s GROUP BY shared)
      SELECT concat('page', pos) AS document_id, body.body FROM s JOIN body USING (shared)""",
    "ingest_report": f"""WITH RECURSIVE {pieces('o_', DOCS)}, {pieces('p_', PDF)},
      counted AS (SELECT concat('doc', k) AS document_id, count(*) AS n FROM o_out GROUP BY k
        UNION ALL SELECT k, count(*) FROM p_out GROUP BY k
        UNION ALL SELECT document_id, count(*) FROM ({_json_chunks('json')}) GROUP BY document_id),
      listed AS (SELECT concat('doc', doc_id) AS document_id, {strip('text')} = '' AS blank, false AS broken FROM documents
        UNION ALL SELECT DISTINCT concat('json', CAST(floor(o_orderkey / {inputs.ORDERS_PER_DOCUMENT}) AS BIGINT)), false,
          CAST(floor(o_orderkey / {inputs.ORDERS_PER_DOCUMENT}) AS BIGINT) % 10 = 0 FROM orders
        UNION ALL SELECT concat('pdf', conv_id), NOT bool_or({PDF_TEXT} <> ''), false FROM conversations GROUP BY conv_id)
      SELECT document_id, CASE WHEN broken THEN 'quarantined' WHEN blank THEN 'blank' ELSE 'chunked' END AS outcome,
        CASE WHEN broken OR blank THEN 0 ELSE n END AS n_chunks FROM listed LEFT JOIN counted USING (document_id)
      UNION ALL SELECT concat('none', doc_id), 'missing', 0 FROM labels""",
    "path_resolve": f"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN concat('/abs/', page_id, '/a.md')
      ELSE concat('{BASE}/docs/', page_id, '.md') END AS path, '.md' AS suffix FROM pages""",
    "html_to_text": f"SELECT page_id, {html_text('html')} AS text FROM pages",
    "whitespace_normalize": f"SELECT doc_id, {normalized(_UNESCAPED_RAGGED)} AS text FROM documents",
    "charset_infer": """SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat('iso-8859-', page_id % 9 + 1) WHEN 2 THEN 'utf-16'
      ELSE 'utf-8' END AS charset FROM pages""",
    "decode_ignore": "SELECT doc_id, text FROM documents",
    "url_parts": f"""WITH u AS (SELECT page_id, {of(inputs.URL_VARIANT, 'page_id')} AS url FROM pages)
      SELECT page_id, lower({url_part('url', 2)}) AS scheme, {url_part('url', 4)} AS authority, {url_path('url')} AS path,
        {basename(url_path('url'))} AS basename, {is_txt('url')} AS is_txt, {is_http('url')} AS is_http FROM u""",
    "landing_target": f"""WITH u AS (SELECT page_id, {of(inputs.URL_VARIANT, 'page_id')} AS url FROM pages)
      SELECT concat('page', page_id) AS document_id,
        CASE WHEN page_id % 5 = 1 AND NOT {is_txt('url')} THEN 'convert' ELSE 'raw' END AS mode,
        concat('{BASE}/', {of(PATH, 'page_id')}) AS target FROM u""",
    "landing_write": f"""SELECT {TARGET} AS path, CASE WHEN convert THEN {html_text('html')} ELSE html END AS body
      FROM ({LANDED_SOURCE}) WHERE html IS NOT NULL AND lower({url_part('url', 2)}) IN ('http', 'https')""",
    "run_status": f"""SELECT count(*) AS documents, count(*) FILTER (WHERE html IS NULL) AS failed,
      CAST(max(CASE WHEN html IS NULL THEN 3 ELSE 0 END) AS INTEGER) AS status FROM ({LANDED_SOURCE})""",
    "truncate": """SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE concat(substring(text, 1, 497), '...') END AS text
      FROM documents""",
    "section_id": f"""SELECT doc_id, concat(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN '|' ELSE lang || '|' END,
      {strip('source')}, '|', doc_id, '|', lang) AS section_id FROM documents""",
    "text_chunks": with_pieces("o_", DOCS, "SELECT k AS doc_id, i, s AS piece_start, e AS piece_end, content FROM o_out"),
    "sql_text_chunks": with_pieces("o_", DOCS, "SELECT k AS doc_id, i, s AS piece_start, e AS piece_end, content FROM o_out"),
    "large_file_chunks": with_pieces(
        "o_", f"""SELECT CAST(floor(doc_id / 50) AS BIGINT) AS k, string_agg(coalesce(text, '') || {LF} || {LF}, '' ORDER BY doc_id) AS body
        FROM documents GROUP BY 1""", "SELECT k AS file_no, CAST(i AS BIGINT) AS i, s AS piece_start, content FROM o_out"
    ),
    "text_chunks_short": f"""SELECT doc_id, length(text) > {MAX_CHARS} AS is_long,
      CASE WHEN length(text) <= {MAX_CHARS} THEN nullif({strip('text')}, '') END AS content FROM documents""",
    "text_chunks_grid": f"""WITH d AS (SELECT doc_id, CAST(floor(n_chars / 100) AS BIGINT) + 1 AS n FROM documents),
      c AS (SELECT doc_id, n, unnest(range(0, greatest(1, CAST(ceil((n - 1) / 16) AS BIGINT)))) AS i FROM d),
      l AS (SELECT doc_id, i, unnest(range(16 * i, least(n, 16 * i + 17))) AS k FROM c)
      SELECT doc_id, CAST(i AS INTEGER) AS i, string_agg(lpad(concat(doc_id, '_', k), 99, 'x'), {LF} ORDER BY k) AS content
      FROM l GROUP BY doc_id, i""",
    "record_build": with_pieces("o_", DOCS, _records("o_out")),
    "chunk_counts": with_pieces("o_", DOCS, "SELECT concat('doc', k) AS document_id, count(*) AS n_chunks FROM o_out GROUP BY k"),
    "pdf_chunks": with_pieces("o_", PDF, "SELECT k AS document_id, CAST(i AS BIGINT) AS i, content FROM o_out"),
    "md_sections": f"WITH {MD_CTES} SELECT document_id, section_id, CAST(0 AS BIGINT) AS part_no, content FROM md_sec",
    "md_chunks": f"""WITH RECURSIVE {MD_CTES}, {pieces('o_', "SELECT concat(document_id, '/', sec) AS k, content AS body FROM md_sec")}
      SELECT m.document_id, row_number() OVER (PARTITION BY m.document_id ORDER BY m.sec, o.i) - 1 AS i, m.section_id, o.content
      FROM o_out o JOIN md_sec m ON o.k = concat(m.document_id, '/', m.sec)""",
    "json_chunks": _json_chunks("json"),
    "yaml_chunks": _json_chunks("yaml"),
    "yaml_block_chunks": NESTED,
    "json_nested_chunks": NESTED,
    "json_quarantine": _broken("json", "Invalid JSON input: Extra data: line 1 column {column} (char {at})"),
    "yaml_quarantine": _broken("yaml", "Invalid YAML input: did not find expected <document start>\n  in \"<unicode string>\", line 1, column {column}"),
    "format_dispatch": f"""WITH RECURSIVE {pieces('o_', DOCS)}, {pieces('m_', '''SELECT doc_id AS k, array_to_string(
        list_transform(string_split(text, chr(10)), lambda l: trim(l, ''' + WS + ''')), chr(10)) AS body FROM documents WHERE doc_id % 4 = 3''')},
      c AS (SELECT k, count(*) AS n FROM o_out WHERE k % 4 <> 3 GROUP BY k UNION ALL SELECT k, count(*) FROM m_out GROUP BY k)
      SELECT CASE doc_id % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'text' WHEN 2 THEN 'pdf' ELSE 'markdown' END AS splitter,
        count(*) AS documents, CAST(sum(coalesce(n, 0)) AS BIGINT) AS chunks FROM documents LEFT JOIN c ON c.k = doc_id GROUP BY 1
      UNION ALL
      SELECT fmt, count(DISTINCT document_id), count(*) FROM (SELECT 'json' AS fmt, document_id FROM ({_json_chunks('json')})
        UNION ALL SELECT 'yaml', document_id FROM ({_json_chunks('yaml')})) GROUP BY fmt""",
    "record_json": with_pieces("o_", DOCS, f"SELECT _id, {RECORD} AS record FROM ({_records('o_out')})"),
    "record_bytes": with_pieces(
        "o_", DOCS, f"""SELECT namespace, count(*) AS records, CAST(sum(strlen({RECORD})) AS BIGINT) AS bytes
        FROM ({_records('o_out')}) GROUP BY namespace"""
    ),
    "record_array": with_pieces(
        "o_", DOCS, f"""SELECT '[' AS line UNION ALL SELECT ']' UNION ALL
        SELECT concat(CASE WHEN row_number() OVER (ORDER BY document_id COLLATE "C", len(_id), _id) = 1 THEN '' ELSE ',' || chr(10) END, {INDENTED})
        FROM ({_records('o_out')})"""
    ),
    "record_export": with_pieces("o_", DOCS, f"SELECT namespace, {RECORD} AS record FROM ({_records('o_out')})"),
    "array_index": with_pieces(
        "o_", DOCS, f"""SELECT document_id, CAST(split_part(_id, ':chunk', 2) AS BIGINT) AS i,
        CAST(2 + coalesce(sum(n + 3) OVER (ORDER BY document_id COLLATE "C", len(_id), _id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset,
        CAST(n AS BIGINT) AS n_bytes FROM (SELECT *, strlen({INDENTED}) AS n FROM ({_records('o_out')}))"""
    ),
    "ingest_stream": with_pieces(
        "o_", DOCS, f"""SELECT namespace, _id, document_id, chunk_content, NULL::VARCHAR AS error FROM ({_records('o_out')})
        WHERE CAST(substr(document_id, 4) AS BIGINT) % 11 <> 5
        UNION ALL SELECT NULL, NULL, concat('doc', doc_id), NULL, 'no source' FROM documents WHERE doc_id % 11 = 5"""
    ),
    "chunk_upsert": TWO_VERSIONS + """SELECT * FROM old WHERE (namespace, _id) NOT IN (SELECT (namespace, _id) FROM new)
      UNION ALL SELECT * FROM new""",
    "document_replace": TWO_VERSIONS + REPLACED,
    "namespace_delete": with_pieces("o_", DOCS, f"SELECT * FROM ({_records('o_out')}) WHERE namespace <> 'hot'"),
    "upsert_summary": with_pieces(
        "o_", DOCS, f"""SELECT namespace, n AS upserted_count, CAST(ceil(n / 64) AS BIGINT) AS batches,
        CAST(n - (ceil(n / 64) - 1) * 64 AS BIGINT) AS last_batch
        FROM (SELECT namespace, count(*) AS n FROM ({_records('o_out')}) GROUP BY namespace)"""
    ),
    "batch_plan": with_pieces(
        "o_", DOCS, """SELECT namespace, document_id, i,
        CAST(floor((row_number() OVER (PARTITION BY namespace ORDER BY document_id, i) - 1) / 64) AS BIGINT) AS batch_no
        FROM (SELECT """ + of(NAMESPACE, "k") + """ AS namespace, concat('doc', k) AS document_id, i FROM o_out)"""
    ),
    "table_create": TWO_VERSIONS + f"""SELECT namespace, document_date, count(*) AS chunks, CAST(sum(length(chunk_content)) AS BIGINT) AS characters
      FROM ({REPLACED}) WHERE namespace <> 'ns1' GROUP BY ALL""",
}
