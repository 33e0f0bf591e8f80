"""DuckDB SQL for the queries. Each text reads the same tables and states its result on its own
terms: masks, list functions and plain joins instead of the library's expressions."""

from __future__ import annotations

from treeloom import dims

NL = "chr(10)"

TEXT = "(SELECT concat(source, '/', doc_id, '.txt') AS file_path, source, lang, text AS content, doc_id FROM documents)"

BYTES = r"""
bytes AS (
  SELECT doc_id, doc_id % 8 AS kind,
    concat(source, '/f', doc_id, CASE doc_id % 8 WHEN 0 THEN '.png' WHEN 4 THEN '.pdf' WHEN 5 THEN '.bin'
      WHEN 6 THEN '.dat' WHEN 7 THEN '.json' ELSE '.txt' END) AS file_path,
    CASE doc_id % 8
      WHEN 0 THEN unhex('89504E470D0A1A0A') || encode(text)
      WHEN 2 THEN encode(text) || unhex('00')
      WHEN 3 THEN encode(text) || unhex('FF')
      WHEN 4 THEN encode('%PDF-' || text)
      WHEN 5 THEN encode(text) || unhex('00FF')
      WHEN 7 THEN encode(concat('{"id": ', doc_id, CASE WHEN doc_id % 16 = 7 THEN '}' ELSE '' END))
      ELSE encode(text) END AS data,
    text
  FROM documents)
"""

CODE = f"""
f AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, concat('mod', p_size) AS m,
    CASE p_partkey % 4 WHEN 2 THEN 'js' WHEN 3 THEN 'ts' ELSE 'py' END AS ext FROM part),
e AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey AND a.l_linenumber = 1),
i AS (
  SELECT src, string_agg(line, {NL} ORDER BY line) AS imports FROM (
    SELECT e.src,
      CASE WHEN s.ext <> 'py' THEN concat('import x from ', chr(39), t.m, '/part', t.k, chr(39), ';')
           WHEN t.k % 2 = 0 THEN concat('import ', t.m, '.part', t.k)
           ELSE concat('from ', t.m, '.part', t.k, ' import build') END AS line
    FROM e JOIN f s ON s.k = e.src JOIN f t ON t.k = e.dst) GROUP BY src),
code AS (
  SELECT k, m AS module_path, concat(m, '/part', k, '.', ext) AS file_path, ext,
    CASE ext WHEN 'py' THEN 'python' WHEN 'js' THEN 'javascript' ELSE 'typescript' END AS language,
    CASE WHEN ext = 'py' THEN concat_ws({NL},
      concat('\"""', p_name, ' module\"""'), imports, concat('from absent.part', k, ' import build'), concat('# ', p_brand), concat('class Part', k, '(Base):'),
      concat('    \"""', p_type, '\"""'), '    def size(self, scale=1):',
      '        return scale_by(self.raw(), scale)', 'def build(a, b):', '    \"""Build.\"""',
      concat('    # build ', p_brand), '    if a:', concat('        return Part', k, '(a).size(b)'), '    return merge(a, b)')
    ELSE concat_ws({NL}, concat('// ', p_brand), imports,
      concat('import x from ', chr(39), './part', k + 1, chr(39), ';'), concat('import x from ', chr(39), '../', m, '/part', k, chr(39), ';'),
      concat('import x from ', chr(39), 'absent/part', k, chr(39), ';'), concat('/* ', p_type, ' */'), 'function build(a, b) {{',
      '  if (a) {{ return merge(a, b); }}', '  return a.size(b);', '}}') END AS content
  FROM f LEFT JOIN i ON i.src = f.k)
""".replace('\\"', '"')


def listed(source: str, expression: str, column: str, with_: str = "") -> str:
    """Rows of a list expression with zero-based ord."""
    return f"""
    {with_} SELECT file_path, CAST(n - 1 AS BIGINT) AS ord, items[n] AS {column}
    FROM (SELECT file_path, items, unnest(generate_series(1, len(items))) AS n
          FROM (SELECT file_path, {expression} AS items FROM {source}) WHERE len(items) > 0)"""


PATTERNS = [
    ("EMAIL", r"[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("URL", r"https?://[^\s<>\"'']+"),
    ("IP", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    ("DATE", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("MONEY", r"[$€£] ?[0-9][0-9,]*(?:\.[0-9]+)?"),
    ("PROPER", r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+"),
]
ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
LABEL = "CASE " + " ".join(f"WHEN regexp_full_match(text, '{p}') THEN '{n}'" for n, p in PATTERNS) + " END"

# Markup with comments gone and the bodies of script and style elements emptied.
HTML = r"""
bare AS (
  SELECT concat(page_id, '.html') AS file_path, html,
    regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
      '(?is)<script([^>]*)>.*?</script>', '<script\1>', 'g'), '(?is)<style([^>]*)>.*?</style>', '<style\1>', 'g') AS body
  FROM pages)
"""

CSS = r"""
sheets AS (SELECT concat(page_id, '.html') AS file_path,
  array_to_string(regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1), chr(10)) AS sheet FROM pages)
"""

XML = """
xml AS (SELECT concat(event_id, '.xml') AS file_path, event_id, user_id, event_type FROM events)
"""


def _schema_check() -> str:
    line = """concat('{"file_path": "', source, '/', doc_id, '", "language": "text", ',
      CASE fault WHEN 1 THEN '' WHEN 2 THEN '"content": null, ' ELSE '"content": "x", ' END, '"analysis": ',
      CASE fault WHEN 3 THEN '{"imports": {}}' WHEN 4 THEN '{"lint_results": [], "complexity": 1.5}' WHEN 5 THEN '[]' ELSE '{}' END,
      ', "metadata": {"loc": 2.0, "size": ',
      CASE fault WHEN 6 THEN '1.5' WHEN 7 THEN '"9"' ELSE CAST(n_chars AS VARCHAR) END, '}', CASE fault WHEN 8 THEN '' ELSE '}' END)"""
    numbers = "('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE')"
    rules = []
    for path, required, allowed in dims.RECORD_RULES:
        kind = f"json_type(v, '$.{path}')"
        tests = []
        for name in allowed:
            if name == "integer":
                value = f"CAST(json_extract_string(v, '$.{path}') AS DOUBLE)"
                tests.append(f"(CASE WHEN {kind} IN {numbers} THEN {value} = floor({value}) ELSE FALSE END)")
            elif name == "number":
                tests.append(f"{kind} IN {numbers}")
            else:
                names = {"string": "VARCHAR", "object": "OBJECT", "array": "ARRAY", "null": "NULL"}
                tests.append(f"{kind} = '{names[name]}'")
        broken = f"CASE WHEN {kind} IS NULL THEN {str(required).upper()} ELSE NOT ({' OR '.join(tests)}) END"
        parent = path.rpartition(".")[0]
        if parent:
            broken = f"coalesce(json_type(v, '$.{parent}') = 'OBJECT', FALSE) AND {broken}"
        rules.append(f"CASE WHEN {broken} THEN '{path}' END")
    return f"""
    WITH d AS (SELECT *, doc_id % 9 AS fault FROM documents), l AS (SELECT doc_id, {line} AS line FROM d),
    p AS (SELECT doc_id, CASE WHEN json_valid(line) THEN line END AS v FROM l),
    c AS (SELECT doc_id, v, CASE WHEN v IS NULL THEN '$' ELSE concat_ws(',', {', '.join(rules)}) END AS violations FROM p)
    SELECT doc_id, violations,
      CASE WHEN coalesce(json_extract_string(v, '$.file_path'), '') = '' THEN 'path'
           WHEN violations <> '' THEN 'schema' END AS first_failure FROM c"""


def _resolution() -> str:
    """Brute force: every import against every file it may name. Relative ones name one path below the root."""
    extensions = ", ".join(f"'{e[1:]}'" for e in dims.IMPORT_EXTENSIONS)
    return f"""
    imp AS (
      SELECT file_path, module_path, unnest(CASE WHEN ext = 'py'
        THEN list_concat(regexp_extract_all(content, '(?m)^import (\\S+)$', 1), regexp_extract_all(content, '(?m)^from (\\S+) import', 1))
        ELSE regexp_extract_all(content, 'import x from ''([^'']+)''', 1) END) AS import_statement FROM code),
    stems AS (SELECT file_path AS dst, module_path AS dst_module, regexp_replace(file_path, '\\.[a-z]+$', '') AS stem
      FROM code WHERE ext IN ({extensions})),
    best AS (
      SELECT i.file_path, i.import_statement,
        first(s.dst ORDER BY (s.dst_module = i.module_path) DESC, s.dst_module, s.dst) AS resolved
      FROM imp i JOIN stems s ON CASE
        WHEN i.import_statement LIKE './%' THEN s.stem = concat(i.module_path, '/', i.import_statement[3:])
        WHEN i.import_statement LIKE '../%' THEN s.stem = i.import_statement[4:]
        ELSE s.stem = replace(i.import_statement, '.', '/') OR ends_with(s.stem, concat('/', replace(i.import_statement, '.', '/'))) END
      GROUP BY ALL),
    res AS (SELECT i.file_path, i.import_statement, b.resolved FROM imp i LEFT JOIN best b USING (file_path, import_statement))"""


_PY = f"WITH {CODE}, py AS (SELECT * FROM code WHERE ext = 'py')"
_JS = f"WITH {CODE}, js AS (SELECT * FROM code WHERE ext <> 'py')"
_PARAMS = r"array_to_string(list_transform(string_split({0}, ','), lambda p: regexp_extract(p, '^\s*(\w+)', 1)), ',')"
_PY_COMMENTS = f"list_filter(list_transform(string_split(content, {NL}), lambda l: trim(l)), lambda l: l[1] = '#')"
_JS_COMMENTS = r"list_transform(regexp_extract_all(content, '(?s)//[^\n]*|/\*.*?\*/'), lambda c: trim(regexp_replace(c, '^//|^/\*|\*/$', '', 'g')))"
_PY_IMPORTS = r"list_concat(regexp_extract_all(content, '(?m)^import (\S+)$', 1), regexp_extract_all(content, '(?m)^from (\S+) import', 1))"
_JS_IMPORTS = "regexp_extract_all(content, 'import x from ''([^'']+)''', 1)"
_LOC = f"len(string_split(content, {NL}))"
_CALLS = r"list_distinct(regexp_extract_all(regexp_replace({0}, '#[^\n]*', '', 'g'), '(\w+)\(', 1))"
_EDGES = f"""
    edges AS (
      SELECT file_path, 'size' AS caller, unnest({_CALLS.format("regexp_extract(content, '(?s)def size[^:]*:(.*?)ndef build'.replace('ndef', chr(10) || 'def'), 1)")}) AS callee FROM py
      UNION ALL
      SELECT file_path, 'build', unnest({_CALLS.format("regexp_extract(content, '(?s)def build[^:]*:(.*)$', 1)")}) FROM py)"""

ORACLES = {
    "codebase_stats": f"""
      WITH r AS (SELECT lang, source, len(string_split(text, {NL})) AS loc, strlen(text) AS size FROM documents)
      SELECT 'total' AS scope, CAST(NULL AS VARCHAR) AS key, count(*) AS files, CAST(sum(loc) AS BIGINT) AS loc, CAST(sum(size) AS BIGINT) AS size FROM r
      UNION ALL SELECT 'language', lang, count(*), CAST(sum(loc) AS BIGINT), CAST(sum(size) AS BIGINT) FROM r GROUP BY lang
      UNION ALL SELECT 'module', source, count(*), NULL, NULL FROM r GROUP BY source""",
    "loc_size": f"SELECT file_path, {_LOC} AS loc, strlen(content) AS size FROM {TEXT}",
    "content_hash": "SELECT md5(text) AS md5_hash, count(*) AS files FROM documents GROUP BY 1",
    "text_records": f"""
      SELECT file_path, concat(doc_id, '.txt') AS file_name, '.txt' AS extension, source AS module_path, 'text' AS handler,
        lang AS language, 'text/plain' AS file_type, content, {_LOC} AS loc, strlen(content) AS size, md5(content) AS md5_hash FROM {TEXT}""",
    "merged_records": f"""
      SELECT file_path, CASE WHEN doc_id % 4 = 0 THEN 'text' ELSE lang END AS language,
        CASE WHEN doc_id % 4 = 0 THEN md5(content || '!') ELSE md5(content) END AS md5_hash FROM {TEXT}""",
    "entity_rows": f"SELECT file_path, ord, text, {LABEL} AS label FROM (" + listed(TEXT, f"regexp_extract_all(content, '{ENTITY}')", "text") + ")",
    "validate_records": f"""
      SELECT doc_id, CASE WHEN doc_id % 7 = 1 THEN 'path' WHEN doc_id % 7 = 2 AND lang NOT IN ({', '.join(f"'{x}'" for x in dims.RECORD_LANGUAGES)}) THEN 'language'
        WHEN doc_id % 7 = 3 OR (content = '' AND doc_id % 7 <> 4) THEN 'content' WHEN doc_id % 7 = 5 THEN 'metadata' WHEN doc_id % 7 = 6 THEN 'schema' END AS first_failure,
        doc_id % 7 = 6 AS analysis_warning FROM {TEXT}""",
    "schema_check": _schema_check(),
    "doc_links": f"""
      SELECT file_path, source AS module_path, CASE WHEN url IS NULL THEN NULL WHEN doc_id % 2 = 0 THEN concat('new:', url) ELSE url END AS documentation
      FROM {TEXT} LEFT JOIN pages ON page_id = doc_id""",
    "doc_links_csv": f"""
      SELECT file_path, source AS module_path,
        CASE WHEN url IS NULL THEN NULL ELSE concat('see "', CASE WHEN doc_id % 2 = 0 THEN concat('new:', url) ELSE url END, '"', chr(10), 'and, more') END AS documentation
      FROM {TEXT} LEFT JOIN pages ON page_id = doc_id""",
    "cache_hits": f"""
      SELECT file_path, CASE WHEN doc_id % 3 = 0 THEN doc_id * 2 ELSE -1 END AS function_count, doc_id % 3 = 0 AS from_cache FROM {TEXT}""",
    "cache_delta": f"SELECT file_path FROM {TEXT} WHERE doc_id % 3 <> 0",
    "analysis_cache": f"""
      SELECT file_path, md5(content) AS hash, CAST(0 AS BIGINT) AS function_count, CAST(0 AS DOUBLE) AS comment_density,
        len(regexp_extract_all(content, '{ENTITY}')) AS n_entities FROM {TEXT}""",
    "file_type": f"""
      WITH {BYTES} SELECT file_path, CASE WHEN hex(data) LIKE '89504E470D0A1A0A%' THEN 'image/png' WHEN hex(data) LIKE '255044462D%' THEN 'application/pdf'
        WHEN kind IN (2, 3, 5) THEN 'application/octet-stream' WHEN kind = 7 THEN 'application/json' ELSE 'text/plain' END AS file_type FROM bytes""",
    "text_filter": f"""
      WITH {BYTES} SELECT file_path, kind NOT IN (0, 4, 5) AS is_text, kind IN (0, 4, 5) AS is_binary,
        CASE WHEN kind IN (1, 2, 6, 7) THEN md5(CASE kind WHEN 2 THEN text || chr(0) ELSE decode(CASE WHEN kind IN (1, 6, 7) THEN data END) END) END AS content_md5 FROM bytes""",
    "nul_filter": f"WITH {BYTES} SELECT file_path, regexp_matches(hex(data), '^(?:[0-9A-F]{{2}})*?00') AS has_nul FROM bytes",
    "skipped_files": f"""
      WITH {BYTES} SELECT CASE kind WHEN 5 THEN 'binary' WHEN 3 THEN 'undecodable' ELSE 'unparsable' END AS skip_reason, count(*) AS files
      FROM bytes WHERE kind IN (3, 5) OR (kind = 7 AND NOT json_valid(decode(CASE WHEN kind = 7 THEN data END))) GROUP BY 1""",
    "image_records": f"""
      WITH {BYTES} SELECT file_path, CASE kind WHEN 0 THEN 'image' ELSE 'document' END AS language, CAST(NULL AS VARCHAR) AS content,
        CAST(NULL AS BIGINT) AS loc, octet_length(data) AS size FROM bytes WHERE kind IN (0, 4)""",
    "default_records": f"""
      WITH {BYTES} SELECT file_path, 'unknown' AS language, CASE kind WHEN 5 THEN 'application/octet-stream' ELSE 'text/plain' END AS file_type,
        CASE kind WHEN 5 THEN 'binary' END AS skip_reason, CASE kind WHEN 5 THEN 0 ELSE len(string_split(text, {NL})) END AS loc,
        octet_length(data) AS size FROM bytes WHERE kind IN (5, 6)""",
    "html_tags": listed("bare", "list_transform(regexp_extract_all(body, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda t: lower(t))", "tag", f"WITH {HTML}"),
    "html_attributes": rf"""
      WITH {HTML}, el AS (SELECT file_path, unnest(regexp_extract_all(body, '<[a-zA-Z][^>]*>')) AS raw,
          unnest(generate_series(1, len(regexp_extract_all(body, '<[a-zA-Z][^>]*>')))) AS pos FROM bare),
      tagged AS (SELECT file_path, lower(regexp_extract(raw, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag, raw, pos FROM el),
      kept AS (SELECT file_path, tag, arg_max(raw, pos) AS raw FROM tagged GROUP BY file_path, tag),
      a AS (SELECT file_path, tag, unnest(regexp_extract_all(raw, '\s[a-zA-Z-]+="[^"]*"')) AS attr FROM kept)
      SELECT file_path, tag, regexp_extract(attr, '\s([a-zA-Z-]+)=', 1) AS name,
        replace(regexp_extract(attr, '="([^"]*)"', 1), '&amp;', '&') AS value FROM a""",
    "html_comments": listed("(SELECT concat(page_id, '.html') AS file_path, html FROM pages)", "regexp_extract_all(html, '(?s)<!--(.*?)-->', 1)", "comment"),
    "css_rules": listed("sheets", r"list_transform(regexp_extract_all(sheet, '([^{}]+)\{[^{}]*\}', 1), lambda s: trim(s))", "selector", f"WITH {CSS}"),
    "css_properties": rf"""
      WITH {CSS}, r AS (SELECT file_path, unnest(regexp_extract_all(sheet, '[^{{}}]+\{{[^{{}}]*\}}')) AS rule FROM sheets),
      p AS (SELECT file_path, trim(regexp_extract(rule, '^([^{{]+)', 1)) AS selector, list_filter(list_transform(string_split(regexp_extract(rule, '\{{(.*)\}}', 1), ';'), lambda d: lower(trim(string_split(d, ':')[1]))), lambda n: n <> '') AS props FROM r)
      SELECT file_path, selector, CAST(n - 1 AS BIGINT) AS ord, props[n] AS property FROM (SELECT *, unnest(generate_series(1, len(props))) AS n FROM p)""",
    "xml_tags": f"WITH {XML} SELECT file_path, CAST(n AS BIGINT) AS ord, CASE n WHEN 0 THEN 'Event' ELSE 'userRef' END AS tag FROM xml, generate_series(0, 2) AS s(n)",
    "xml_attributes": f"""
      WITH {XML} SELECT file_path, 'Event' AS tag, 'id' AS name, CAST(event_id AS VARCHAR) AS value FROM xml
      UNION ALL SELECT file_path, 'userRef', 'id', concat('x', user_id) FROM xml""",
    "json_data": "SELECT concat(event_id, '.json') AS file_path, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json(props) AS VARCHAR) AS data FROM events WHERE json_valid(props)",
    "json_keys": """
      SELECT key, CASE json_type(props, concat('$.', key)) WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(props, concat('$.', key)) END AS type, count(*) AS n
      FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY 1, 2""",
    "verify_jsonl": r"""
      WITH l AS (SELECT user_id, CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN regexp_replace(props, '\}$', '') ELSE props END AS line FROM events)
      SELECT concat('user', user_id) AS file, count(*) AS lines, count(*) FILTER (WHERE NOT json_valid(line)) AS bad_lines, bool_and(json_valid(line)) AS valid
      FROM l GROUP BY user_id""",
    "yaml_keys": """
      SELECT concat(p_partkey, '.yaml') AS file_path, CAST(n AS BIGINT) AS ord,
        ['key', 'name', 'brand', 'size', 'ready', 'tags', 'key'][n + 1] AS key,
        [CAST(p_partkey AS VARCHAR), p_name, p_brand, CAST(p_size AS VARCHAR), CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE '~' END, '', CAST(p_partkey + 1 AS VARCHAR)][n + 1] AS value,
        ['int', 'string', 'string', 'int', CASE WHEN p_partkey % 2 = 0 THEN 'bool' ELSE 'null' END, 'block', 'int'][n + 1] AS type
      FROM part, generate_series(0, 6) AS s(n)""",
    "yaml_data": "SELECT concat(p_partkey, '.yaml') AS file_path, p_partkey + 1 AS key, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN TRUE END AS ready FROM part",
    "md_outline": """
      SELECT concat(conv_id, '/', turn, '.md') AS file_path, CAST(n AS BIGINT) AS ord, CAST(n + 1 AS BIGINT) AS level,
        CASE n WHEN 0 THEN concat('Turn ', turn) ELSE concat('By ', role) END AS text FROM conversations, generate_series(0, 1) AS s(n)""",
    "md_links": "SELECT concat(conv_id, '/', turn, '.md') AS file_path, CAST(0 AS BIGINT) AS ord, concat('conversation ', conv_id) AS text, concat('../', conv_id, '/index.md') AS target FROM conversations",
    "dispatch": f"WITH {CODE} SELECT concat('.', ext) AS extension, language AS handler, count(*) AS files FROM code GROUP BY 1, 2",
    "module_path": f"WITH {CODE} SELECT file_path, module_path FROM code",
    "language_guess": f"WITH {CODE} SELECT file_path, language FROM code",
    "docstrings": rf"""
      {_PY} SELECT file_path, 'module' AS name, regexp_extract(content, '^\"\"\"(.*?)\"\"\"', 1) AS doc FROM py
      UNION ALL SELECT file_path, regexp_extract(content, 'class (\w+)', 1), regexp_extract(content, 'class \w+\(Base\):\n    \"\"\"(.*?)\"\"\"', 1) FROM py
      UNION ALL SELECT file_path, 'build', regexp_extract(content, 'def build[^\n]*:\n    \"\"\"(.*?)\"\"\"', 1) FROM py""".replace('\\"', '"'),
    "py_comments": listed("py", _PY_COMMENTS, "comment", _PY),
    "py_imports": listed("py", _PY_IMPORTS, "import_statement", _PY),
    "py_classes": rf"{_PY} SELECT file_path, regexp_extract(content, 'class (\w+)', 1) AS class_name, 'size' AS name, {_PARAMS.format(r'''regexp_extract(content, 'def size\(([^)]*)\)', 1)''')} AS params FROM py",
    "py_functions": rf"{_PY} SELECT file_path, regexp_extract(content, '(?m)^def (\w+)', 1) AS name, {_PARAMS.format(r'''regexp_extract(content, '(?m)^def \w+\(([^)]*)\)', 1)''')} AS params FROM py",
    "call_edges": f"{_PY}, {_EDGES} SELECT file_path, caller, callee FROM edges",
    "call_graph": f"{_PY}, {_EDGES} SELECT DISTINCT caller, callee FROM edges",
    "def_complexity": f"""
      {_PY} SELECT file_path, 'size' AS name, CAST(1 AS BIGINT) AS complexity FROM py
      UNION ALL SELECT file_path, 'build', 1 + len(regexp_extract_all(content, '(?m)^ +if ')) FROM py""",
    "complexity": rf"""
      WITH {CODE} SELECT file_path, len(regexp_extract_all(content, '(?m)^ *(?:def|function) \w')) + len(regexp_extract_all(content, '(?m)^ +if ')) AS complexity
      FROM code WHERE ext <> 'js'""",
    "js_functions": rf"""
      {_JS} SELECT file_path, CAST(0 AS BIGINT) AS ord, regexp_extract(content, 'function (\w+)', 1) AS name,
        {_PARAMS.format(r'''regexp_extract(content, 'function \w+\(([^)]*)\)', 1)''')} AS params FROM js""",
    "js_imports": listed("js", _JS_IMPORTS, "import_statement", _JS),
    "js_comments": listed("js", _JS_COMMENTS, "comment", _JS),
    "function_count": f"WITH {CODE} SELECT file_path, CAST(CASE WHEN ext <> 'ts' THEN 1 ELSE 0 END AS BIGINT) AS function_count FROM code",
    "comment_density": f"WITH {CODE} SELECT file_path, round(len(CASE WHEN ext = 'py' THEN {_PY_COMMENTS} ELSE {_JS_COMMENTS} END) / {_LOC}, 6) AS comment_density FROM code",
    "file_records": rf"""
      WITH {CODE} SELECT file_path, language, md5(content) AS md5_hash, {_LOC} AS loc, strlen(content) AS size,
        len(regexp_extract_all(content, '(?m)^class ')) AS n_classes, len(regexp_extract_all(content, '(?m)^(?:def|function) ')) AS n_functions,
        len(CASE WHEN ext = 'py' THEN {_PY_IMPORTS} ELSE {_JS_IMPORTS} END) AS n_imports,
        len(CASE WHEN ext = 'py' THEN {_PY_COMMENTS} ELSE {_JS_COMMENTS} END) AS n_comments,
        CAST(CASE WHEN ext = 'py' THEN 3 ELSE 0 END AS BIGINT) AS n_docstrings,
        CASE WHEN ext = 'js' THEN 0 ELSE len(regexp_extract_all(content, '(?m)^ *(?:def|function) \w')) + len(regexp_extract_all(content, '(?m)^ +if ')) END AS complexity,
        CAST(CASE WHEN ext <> 'ts' THEN 1 ELSE 0 END AS BIGINT) AS function_count,
        round(len(CASE WHEN ext = 'py' THEN {_PY_COMMENTS} ELSE {_JS_COMMENTS} END) / {_LOC}, 6) AS comment_density FROM code""",
    "import_resolution": f"WITH {CODE}, {_resolution()} SELECT file_path, import_statement, resolved FROM res",
    "unresolved_imports": f"WITH {CODE}, {_resolution()} SELECT file_path, import_statement FROM res WHERE resolved IS NULL",
    "dependency_graph": f"WITH {CODE}, {_resolution()} SELECT DISTINCT file_path AS src, resolved AS dst FROM res WHERE resolved IS NOT NULL",
    "dependency_nodes": f"WITH {CODE} SELECT DISTINCT file_path AS id, language FROM code",
    "lint_stats": """
      WITH l AS (SELECT l_partkey % 4 AS kind, concat(l_returnflag, l_linestatus) AS rule, l_linenumber AS c FROM lineitem)
      SELECT rule AS violation, count(*) AS n FROM l WHERE kind <> 1 GROUP BY 1
      UNION ALL SELECT concat('nested-', rule), count(*) FROM l WHERE kind = 3 GROUP BY 1
      UNION ALL SELECT 'error', CAST(sum(c) AS BIGINT) FROM l WHERE kind = 1
      UNION ALL SELECT 'warning', CAST(0 AS BIGINT)""",
}
