"""SQL that gives the rows of the queries in ``catalog``, written independently of them.

Data have ASCII white space only, so plain \\s serves here. Ordered lists are made by ordered aggregation.
"""

from __future__ import annotations

from loomspark.functions import text as T

SIZE, OVERLAP = 1000, 100


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# Fixed values, here and below: patterns, marks and lists of words are those of the text functions, written for SQL.
def _plain(x: str) -> str:
    out = f"coalesce({x}, '')"
    for pattern, replacement in (
        ("(?is)<img[^>]*>", " "),
        ("<[^>]+>", " "),
        (r"(?m)^#{1,6}\s*", ""),
        (r"\*\*\*([^\n]*?)\*\*\*", r"\1"),
        (r"\*\*([^\n]*?)\*\*", r"\1"),
        (r"\*([^\n]*?)\*", r"\1"),
        (r"`([^\n]*?)`", r"\1"),
        (r"(?s)```.*?```", ""),
        (r"\[([^\]]*)\]\([^\)]*\)", r"\1"),
        (r"!\[([^\]]*)\]\([^\)]*\)", r"\1"),
        (r"(?m)^\s*[-*+]\s*", ""),
        (r"(?m)^\s*\d+\.\s*", ""),
        (r"(?m)^>\s*", ""),
        (r"[\|]", " "),
        (r"(?m)^[-\s\|:]+$", ""),
        (" +", " "),
        (r"\n\s*\n\s*\n+", "\n\n"),
    ):
        out = f"regexp_replace({out}, {_q(pattern)}, {_q(replacement)}, 'g')"
    return _strip(out)


# A page's html with a table behind it, and the same with the table as markdown; by page in five forms. A nested table's cells are
# words of their cell; a table that isn't ended stays, and its tags go in cleaning.
def _tabled(bar: str) -> str:
    def lines(*rows: str) -> str:
        return " || chr(10) || ".join(["chr(10)", *rows, "chr(10)"])

    u = "trim(regexp_replace(url, '\\s+', ' ', 'g'))"
    forms = (
        lines("'| key | address |'", "'|---|---|'", f"'| ' || page_id || ' | ' || {u} || ' |'"),
        lines("'| k | v |'", "'|---|---|'", "'| ' || page_id || ' | x |'", f"'| ' || page_id || ' | ' || {u} || ' |'"),
        lines("'| ' || page_id || ' | ' || page_id || ' |'", "'|---|---|'", f"'| l | ' || {u} || ' |'"),
        lines("'| ' || page_id || ' | in one two out |'", "'|---|---|'"),
        lines(f"'| p{bar}|q |'", "'|---|'", "'| ' || page_id || ' |'") + " || '<table><tr><td>open'",
    )
    cases = " ".join(f"WHEN {k} THEN {form}" for k, form in enumerate(forms))
    return f"(html || CASE page_id % 5 {cases} END || ' end')"


def _answerless(x: str) -> str:
    for mark in ("答案[:：]", "回答[:：]", "Answer[:：]"):
        x = f"regexp_replace({x}, '(?is){mark}.*', '')"
    return f"trim({x}, ' ' || chr(9) || chr(13) || chr(10) || '。；;，,')"


def _thoughtless(x: str) -> str:
    return _strip(f"regexp_replace(regexp_replace({x}, '(?is)<think>.*?</think>', '', 'g'), '\\n\\s*\\n\\s*\\n+', {_q(chr(10) * 2)}, 'g')")


def _normal(x: str) -> str:
    return f"rtrim({_strip(f'''regexp_replace(lower(regexp_replace({x}, '^问题[0-9]+[:：]\\s*', '')), '\\s+', ' ', 'g')''')}, '?？.。！!,，')"


_RULES = {
    "long_enough": "length(content) >= 15",
    "asks": "(contains(content, '？') OR contains(content, '?'))",
    "no_heading": r"NOT regexp_matches(content, '^#+\s')",
    "no_category": "NOT regexp_matches(content, '^(复杂|中等|简单|关联|深度|事实)[^\\n]*问题')",
    "no_bracket": "NOT starts_with(content, '【')",
    "no_answer": "NOT (contains(content, '答案') OR contains(content, '解答') OR contains(content, 'Answer'))",
}
_VALID = "content <> '' AND " + " AND ".join(_RULES.values())

LINES = "lines AS (SELECT doc_id, i::INT AS rn, trim(x) AS content FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE length(trim(x)) >= 15)"
FIRSTS = f"firsts AS (SELECT doc_id, t, min(rn) AS rn FROM (SELECT doc_id, rn, {_normal('content')} AS t FROM lines) GROUP BY doc_id, t)"
_GRAMS = "list_distinct(list_transform(range(1, length(t)), lambda i: substring(t, i, 2)))"
_JACCARD = "len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))"
_SIMILAR = f"a.doc_id = b.doc_id AND a.rn < b.rn AND len(a.g) > 0 AND len(b.g) > 0 AND least(len(a.g), len(b.g)) >= 0.85 * greatest(len(a.g), len(b.g)) - 1e-9 AND {_JACCARD} >= 0.85"
KEPT = f"""{LINES}, {FIRSTS},
grams AS MATERIALIZED (SELECT doc_id, rn, {_GRAMS} AS g FROM firsts),
met AS (SELECT b.doc_id, b.rn, list(a.rn) AS earlier FROM grams a JOIN grams b ON {_SIMILAR} GROUP BY b.doc_id, b.rn),
steps AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rn) AS k FROM met),
walk AS (
  SELECT doc_id, 0::BIGINT AS k, []::INT[] AS gone FROM (SELECT DISTINCT doc_id FROM steps)
  UNION ALL
  SELECT w.doc_id, s.k, CASE WHEN len(list_filter(s.earlier, lambda e: NOT list_contains(w.gone, e))) > 0 THEN list_append(w.gone, s.rn) ELSE w.gone END
  FROM walk w JOIN steps s ON s.doc_id = w.doc_id AND s.k = w.k + 1
),
dropped AS (SELECT DISTINCT doc_id, unnest(gone) AS rn FROM walk),
kept AS (SELECT l.* FROM lines l JOIN firsts f USING (doc_id, rn) ANTI JOIN dropped d USING (doc_id, rn))"""

CHUNKS = f"""chunks AS (
  SELECT doc_id, i::INT AS chunk_index, n::INT AS total_chunks, substring(text, i * {SIZE - OVERLAP} + 1, {SIZE}) AS content,
         (i * {SIZE - OVERLAP})::INT AS start_position, least(i * {SIZE - OVERLAP} + {SIZE}, length(text))::INT AS end_position,
         coalesce('chunk-' || nullif(md5({_strip(f'substring(text, i * {SIZE - OVERLAP} + 1, {SIZE})')}), md5('')), doc_id || '_chunk_' || i) AS chunk_id
  FROM (SELECT doc_id, text, n, unnest(range(n)) AS i FROM (
    SELECT doc_id, text, CASE WHEN length(text) <= {SIZE} THEN 1 ELSE 1 + ceil((length(text) - {SIZE}) / {float(SIZE - OVERLAP)})::INT END AS n
    FROM documents WHERE {_strip('text')} <> '')))"""


def _entities(rows: str, keys: str, text: str) -> str:
    """keys, pos and name of the entities of each row, in order."""
    matched = " || ".join(f"regexp_extract_all({text}, {_q(p)})" for p in (r"[A-Z]{2,}\d+[A-Z]*", r"[A-Z]+\d+[A-Z0-9]*", r"[A-Z][A-Za-z0-9\-]{2,}"))
    edges = r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$"
    return f"""SELECT {keys}, (row_number() OVER (PARTITION BY {keys} ORDER BY o) - 1)::INT AS pos, name FROM (
    SELECT {keys}, name, min(o) AS o FROM (
      SELECT {keys}, m, regexp_replace(unnest(w), {_q(edges)}, '', 'g') AS name, generate_subscripts(w, 1) AS o
      FROM (SELECT {keys}, {matched} AS m, regexp_split_to_array({text}, '\\s+') AS w FROM {rows})
    ) WHERE list_contains(m, name) GROUP BY {keys}, name)"""


FOUND = f"{CHUNKS}, found AS MATERIALIZED ({_entities('chunks', 'doc_id, chunk_index, chunk_id', 'content')})"
PAIRS = f"""{FOUND}, relations AS (SELECT a.doc_id, a.chunk_index, a.chunk_id, a.pos, a.name AS source, b.name AS target, least(a.name, b.name) AS a, greatest(a.name, b.name) AS b
  FROM found a JOIN found b ON a.doc_id = b.doc_id AND a.chunk_index = b.chunk_index AND b.pos = a.pos + 1)"""
NODES = """nodes AS (SELECT doc_id, name AS entity_id, CASE WHEN regexp_matches(name, '^[A-Z]+[0-9]') THEN 'artifact' ELSE 'concept' END AS entity_type,
  count(DISTINCT chunk_id) AS n_chunks, min((chunk_index, pos)) AS first FROM found GROUP BY doc_id, name)"""
ENTITIES = f"""{NODES}, entities AS (SELECT * FROM (
  SELECT f.doc_id, f.chunk_index, f.chunk_id, f.name, n.entity_type, n.n_chunks, row_number() OVER (PARTITION BY f.doc_id, f.chunk_index ORDER BY n.first, f.name)::INT AS rank
  FROM found f JOIN nodes n ON n.doc_id = f.doc_id AND n.entity_id = f.name) WHERE rank <= 5)"""
_ENTITY_LINE = "'- 实体 ' || name || '（类型：' || entity_type || '）：named in ' || n_chunks || ' chunks'"
RELATIONS = """firsts AS (SELECT doc_id, a, b, min((chunk_index, pos)) AS first FROM relations GROUP BY doc_id, a, b),
own AS (SELECT doc_id, chunk_index, a, b, min((pos, source, target)) AS x FROM relations GROUP BY doc_id, chunk_index, a, b),
shown AS (SELECT * FROM (SELECT o.doc_id, o.chunk_index, x[2] AS source, x[3] AS target, row_number() OVER (PARTITION BY o.doc_id, o.chunk_index ORDER BY first, o.a, o.b)::INT AS rank
  FROM own o JOIN firsts f USING (doc_id, a, b)) WHERE rank <= 5)"""
_RELATION_LINE = "'- ' || source || ' ↔ ' || target || '：关键词 adjacent'"
RELATED = """sources AS (SELECT doc_id, name, chunk_id, min(chunk_index) AS o FROM found GROUP BY doc_id, name, chunk_id),
related AS (SELECT doc_id, chunk_index, related_id, row_number() OVER (PARTITION BY doc_id, chunk_index ORDER BY first, related_id)::INT AS place FROM (
  SELECT e.doc_id, e.chunk_index, s.chunk_id AS related_id, min((e.rank, s.o)) AS first
  FROM entities e JOIN sources s ON s.doc_id = e.doc_id AND s.name = e.name AND s.chunk_id <> e.chunk_id GROUP BY e.doc_id, e.chunk_index, s.chunk_id))"""
SNIPPETS = f"""texts AS (SELECT doc_id, chunk_id, min(content) AS content FROM chunks GROUP BY doc_id, chunk_id),
snippets AS (SELECT r.doc_id, r.chunk_index, r.place, r.related_id, '- 片段 ' || r.related_id || ': ' || substring(replace({_strip('t.content')}, chr(10), ' '), 1, 200) AS line
  FROM related r JOIN texts t ON t.doc_id = r.doc_id AND t.chunk_id = r.related_id WHERE r.place <= 2)"""


def _responses(numbered: str) -> str:
    """numbered: SQL that says whether the questions of a row have numbers."""
    head = f"(CASE WHEN {numbered} THEN '问题' || i || ': ' ELSE i || '. ' END)"
    said = f"list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), lambda x, i: {head} || x || CASE (i - 1) % 3 WHEN 0 THEN '？' WHEN 1 THEN '？答案：x' ELSE '' END)"
    return f"responses AS (SELECT doc_id, '<think>' || chr(10) || 'plan' || chr(10) || '</think>' || chr(10) || coalesce(array_to_string({said}, chr(10)), '') AS response FROM documents)"


# a look-ahead isn't to be had: question starts become marks, at which the text is split
_NUMBERED = f"""marked AS (SELECT doc_id, regexp_replace(chr(10) || {_thoughtless('response')}, '\\n\\s*问题([0-9]+)[:：]\\s*', chr(1) || '\\1' || chr(2), 'g') AS r FROM responses),
pieces AS (SELECT doc_id, unnest((string_split(r, chr(1)))[2:]) AS p, generate_subscripts((string_split(r, chr(1)))[2:], 1) AS i FROM marked),
numbered AS (SELECT doc_id, i - 1 AS ord, split_part(p, chr(2), 1)::INT AS question_index,
  {_answerless(_strip(f"regexp_replace(regexp_replace({_strip('split_part(p, chr(2), 2)')}, '^问题[:：]\\s*', ''), '\\n+', ' ', 'g')"))} AS content FROM pieces WHERE split_part(p, chr(2), 2) <> '')"""
_FIRST = f"""{_NUMBERED}, first AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1)::INT AS ord, question_index, content FROM numbered WHERE {_VALID})"""
_LISTED = f"""says AS (SELECT doc_id, {_thoughtless('response')} AS r FROM responses),
rows AS (SELECT doc_id, {_strip('unnest(string_split(r, chr(10)))')} AS line, generate_subscripts(string_split(r, chr(10)), 1) AS i FROM says),
asked AS (SELECT * FROM rows WHERE line <> '' AND NOT starts_with(line, '#') AND NOT starts_with(line, '【') AND NOT regexp_matches(line, '^(复杂|中等|简单|关联|深度|事实)[^\\n]*问题')
  AND (contains(line, '?') OR contains(line, '？') OR regexp_matches(line, '^(如何|什么|为什么|怎样|哪些|是否)'))),
cleaned AS (SELECT doc_id, i, {_answerless(r"regexp_replace(regexp_replace(line, '^[\d\.\-\*\s]+', ''), '^问题\d+[:：]\s*', '')")} AS content FROM asked),
listed AS (SELECT * FROM (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS ord, row_number() OVER (PARTITION BY doc_id ORDER BY i)::INT AS question_index, content
  FROM cleaned WHERE {_VALID}) WHERE question_index <= 10)"""
_BOTH = f"{_FIRST}, {_LISTED}, parsed AS (SELECT * FROM first UNION ALL SELECT l.* FROM listed l ANTI JOIN first f USING (doc_id))"


def _fitted(dim: int) -> str:
    v = f"list_transform(range(1, {dim + 1}), lambda i: coalesce(embedding[i]::DOUBLE, 0.0))"
    return f"SELECT vec_id, {dim} AS dim, round(list_reduce({v}, lambda a, b: a + b), 6) AS total, ({v})[{dim}] AS last FROM embeddings"


def _of_chunks(sql: str) -> str:
    """What is said of documents, said of chunks, whose key is the document's and the chunk's number in one."""
    return sql.replace("FROM documents", "FROM parts").replace("documents USING", "parts USING")


_ASKED = f"""{CHUNKS}, parts AS MATERIALIZED (SELECT doc_id * 100000 + chunk_index AS doc_id, chunk_id, content AS text FROM chunks),
{_of_chunks(_responses("true"))}, {_BOTH},
lines AS MATERIALIZED (SELECT p.doc_id // 100000 AS doc_id, (row_number() OVER (PARTITION BY p.doc_id // 100000 ORDER BY p.doc_id, p.ord))::INT AS rn, p.content, p.question_index, c.chunk_id
  FROM parsed p JOIN parts c USING (doc_id))"""
_ASKED_KEPT = KEPT.replace(LINES, _ASKED).replace("firsts AS (", "first_lines AS (").replace("firsts", "first_lines").replace("first_first_lines", "first_lines")

SQL = {
    "q_pipeline_e2e": f"WITH RECURSIVE {_ASKED_KEPT} SELECT doc_id::VARCHAR AS source_document, chunk_id AS source_chunk_id, question_index, content FROM kept",
    "q_dedup_greedy": f"WITH RECURSIVE {KEPT} SELECT doc_id, rn, content FROM kept",
    "q_dedup_exact": f"WITH {LINES}, {FIRSTS} SELECT doc_id, rn, md5(t) AS hash FROM firsts",
    "q_jaccard_pairs": f"WITH {LINES}, grams AS MATERIALIZED (SELECT doc_id, rn, {_GRAMS} AS g FROM (SELECT doc_id, rn, {_normal('content')} AS t FROM lines)) SELECT a.doc_id, a.rn AS earlier, b.rn FROM grams a JOIN grams b ON {_SIMILAR}",
    "q_dedup_stats": f"WITH RECURSIVE {KEPT} SELECT q AS questions, k AS kept, q - k AS removed FROM (SELECT (SELECT count(*) FROM lines) AS q, (SELECT count(*) FROM kept) AS k)",
    "q_markdown_to_plain": f"SELECT page_id, length(p) AS n_chars, md5(p) AS plain_md5 FROM (SELECT page_id, {_plain('html')} AS p FROM pages)",
    "q_markdown_to_plain_docs": f"SELECT doc_id, length(p) AS n_chars, md5(p) AS plain_md5 FROM (SELECT doc_id, {_plain('text')} AS p FROM documents)",
    "q_assemble_sections": f"""SELECT page_id, length(w) AS n_chars, md5(w) AS text_md5 FROM (SELECT page_id,
        CASE WHEN p <> '' THEN p || chr(10) || chr(10) ELSE '' END || '## 表格提取' || chr(10) || '| ' || url || ' |' || chr(10) || chr(10) || '## 图片OCR' || chr(10) || '[图片OCR] ' || url || ': a' || chr(10) || 'b' AS w
        FROM (SELECT page_id, url, {_plain('html')} AS p FROM pages))""",
    "q_clean_think": f"WITH {_responses('true')} SELECT doc_id, length(r) AS n_chars, md5(r) AS response_md5 FROM (SELECT doc_id, {_thoughtless('response')} AS r FROM responses)",
    "q_strip_answer": f"WITH {_responses('true')} SELECT doc_id, (i - 1)::INT AS line, {_answerless('x')} AS content FROM (SELECT doc_id, unnest(string_split(response, chr(10))) AS x, generate_subscripts(string_split(response, chr(10)), 1) AS i FROM responses)",
    "q_char_chunks": f"WITH {CHUNKS} SELECT doc_id, chunk_index, total_chunks, start_position, end_position, md5(content) AS content_md5 FROM chunks",
    "q_token_chunks": """WITH w AS (SELECT doc_id, regexp_extract_all(text, '\\s*\\S+') AS p FROM documents),
        k AS (SELECT doc_id, p, CASE WHEN len(p) <= 200 THEN 1 ELSE 1 + ceil((len(p) - 200) / 180.0)::INT END AS n FROM w WHERE len(p) > 0),
        c AS (SELECT doc_id, n, i, array_to_string(p[1 : i * 180], '') AS before, array_to_string(p[i * 180 + 1 : i * 180 + 200], '') AS own FROM (SELECT *, unnest(range(n)) AS i FROM k))
        SELECT doc_id, i::INT AS chunk_index, n::INT AS total_chunks, (length(before) + length(own) - length(s))::INT AS start_position, (length(before) + length(own))::INT AS end_position, md5(s) AS content_md5
        FROM (SELECT *, regexp_replace(own, '^\\s+', '') AS s FROM c)""",
    "q_chunk_ids": f"WITH {CHUNKS} SELECT doc_id, chunk_index, chunk_id FROM chunks",
    "q_shared_chunks": f"WITH {CHUNKS} SELECT chunk_id, count(DISTINCT doc_id) AS n_docs FROM chunks GROUP BY chunk_id HAVING count(DISTINCT doc_id) > 1",
    "q_valid_questions": f"WITH {_responses('true')}, {_NUMBERED} SELECT doc_id, ord::INT AS ord, ({_VALID}) AS accepted FROM numbered",
    "q_reject_reasons": f"WITH {_responses('true')}, {_NUMBERED} SELECT count(*) AS questions, {', '.join(f'count(*) FILTER (NOT ({r})) AS not_{n}' for n, r in _RULES.items())} FROM numbered",
    "q_parse_questions": f"WITH {_responses('true')}, {_BOTH} SELECT doc_id, ord, question_index, content FROM parsed",
    "q_fallback_parse": f"WITH {_responses('false')}, {_BOTH} SELECT doc_id, ord, question_index, content FROM parsed",
    "q_parse_with_fallback": f"WITH {_responses('doc_id % 2 = 0')}, {_BOTH} SELECT doc_id, ord, question_index, content FROM parsed",
    "q_extract_entities": f"WITH e AS ({_entities('documents', 'doc_id', 'text')}) SELECT d.doc_id, count(e.name)::INT AS n_entities, coalesce(string_agg(e.name, '|' ORDER BY e.pos), '') AS entities FROM documents d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id",
    "q_entity_nodes": f"WITH {FOUND}, {NODES} SELECT doc_id, entity_id, entity_type, n_chunks, first[1] AS first_chunk, first[2] AS first_pos FROM nodes",
    "q_relation_edges": f"WITH {PAIRS} SELECT doc_id, a, b, count(*)::DOUBLE AS weight, count(DISTINCT chunk_id) AS n_chunks FROM relations GROUP BY doc_id, a, b",
    "q_unknown_endpoints": f"WITH {PAIRS}, ends AS (SELECT doc_id, unnest([a, b]) AS entity_id, a || ' beside ' || b AS d FROM relations) SELECT doc_id, entity_id, 'UNKNOWN' AS entity_type, min(d) AS description FROM ends e WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.pos = 0 AND f.doc_id = e.doc_id AND f.name = e.entity_id) GROUP BY doc_id, entity_id",
    "q_node_merge": f"WITH {FOUND} SELECT name, string_agg(d, '<SEP>' ORDER BY d) AS description FROM (SELECT DISTINCT name, 'term in ' || lang AS d FROM found JOIN documents USING (doc_id)) GROUP BY name",
    "q_full_entities": f"WITH {FOUND} SELECT doc_id, count(*)::INT AS n, string_agg(name, '|' ORDER BY name) AS entity_names FROM (SELECT DISTINCT doc_id, name FROM found) GROUP BY doc_id",
    "q_full_relations": f"WITH {PAIRS} SELECT doc_id, count(*)::INT AS n, string_agg(a || '>' || b, '|' ORDER BY a, b) AS relation_pairs FROM (SELECT DISTINCT doc_id, a, b FROM relations) GROUP BY doc_id",
    "q_relation_chunks": f"WITH {PAIRS} SELECT doc_id, a || '<SEP>' || b AS pair, count(*)::INT AS n, string_agg(chunk_id, '|' ORDER BY chunk_id) AS chunk_ids FROM (SELECT DISTINCT doc_id, a, b, chunk_id FROM relations) GROUP BY doc_id, a, b",
    "q_context_entities": f"WITH {FOUND}, {ENTITIES} SELECT doc_id, chunk_index, rank, name, {_ENTITY_LINE} AS line FROM entities",
    "q_context_relations": f"WITH {PAIRS}, {RELATIONS} SELECT doc_id, chunk_index, rank, source, target, {_RELATION_LINE} AS line FROM shown",
    "q_related_chunks": f"WITH {FOUND}, {ENTITIES}, {RELATED} SELECT doc_id, chunk_index, related_id, place FROM related",
    "q_snippets": f"WITH {FOUND}, {ENTITIES}, {RELATED}, {SNIPPETS} SELECT doc_id, chunk_index, place, related_id, line FROM snippets",
    "q_prompt_context": f"""WITH {PAIRS}, {ENTITIES}, {RELATIONS}, {RELATED}, {SNIPPETS},
        e AS (SELECT doc_id, chunk_index, string_agg({_ENTITY_LINE}, chr(10) ORDER BY rank) AS l FROM entities GROUP BY ALL),
        r AS (SELECT doc_id, chunk_index, string_agg({_RELATION_LINE}, chr(10) ORDER BY rank) AS l FROM shown GROUP BY ALL),
        s AS (SELECT doc_id, chunk_index, string_agg(line, chr(10) ORDER BY place) AS l FROM snippets GROUP BY ALL),
        names AS (SELECT doc_id, chunk_index, name, min(o) AS o FROM (SELECT doc_id, chunk_index, name, rank AS o FROM entities UNION ALL SELECT doc_id, chunk_index, source, 98 + 2 * rank FROM shown UNION ALL SELECT doc_id, chunk_index, target, 99 + 2 * rank FROM shown) GROUP BY ALL),
        n AS (SELECT doc_id, chunk_index, string_agg(name, '|' ORDER BY o) AS l FROM names GROUP BY ALL),
        i AS (SELECT doc_id, chunk_index, string_agg(related_id, '|' ORDER BY place) AS l FROM related GROUP BY ALL)
        SELECT c.doc_id, c.chunk_index, md5({_strip("concat_ws(chr(10) || chr(10), '【相关实体信息】' || chr(10) || e.l, '【相关关系信息】' || chr(10) || r.l, '【知识图谱片段】' || chr(10) || s.l)")}) AS context_md5,
          coalesce(n.l, '') AS entities, c.chunk_id || coalesce('|' || i.l, '') AS chunk_ids
        FROM chunks c LEFT JOIN e USING (doc_id, chunk_index) LEFT JOIN r USING (doc_id, chunk_index) LEFT JOIN s USING (doc_id, chunk_index) LEFT JOIN n USING (doc_id, chunk_index) LEFT JOIN i USING (doc_id, chunk_index)""",
    "q_render_prompt": f"WITH {CHUNKS} SELECT doc_id, chunk_index, length(p) AS n_chars, md5(p) AS prompt_md5 FROM (SELECT doc_id, chunk_index, 'You ask questions.' || chr(10) || chr(10) || 'Ask 10 about ' || doc_id || ': ' || {_strip('content')} || ' [at ' || chunk_index || ']' AS p FROM chunks)",
    "q_history_flatten": """SELECT conv_id, length(p) AS n_chars, md5(p) AS prompt_md5 FROM (SELECT conv_id, coalesce(string_agg(CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: ' WHEN 'assistant' THEN 'Assistant: ' END || coalesce(text, '') || chr(10) || chr(10), '' ORDER BY turn), '') || 'User: go on' || chr(10) || chr(10) || 'Assistant:' AS p FROM conversations GROUP BY conv_id)""",
    "q_parse_source_ids": "SELECT doc_id, 3 AS n, lang || '/' || source || '/' || doc_id AS ids FROM documents",
    "q_questions_jsonl": f"""WITH {_responses('true')}, {_BOTH}, ents AS ({_entities('parsed', 'doc_id, ord', 'content')}),
        e AS (SELECT doc_id, ord, string_agg(name, '|' ORDER BY pos) FILTER (name <> 'Base') AS l FROM ents GROUP BY ALL)
        SELECT p.content, p.doc_id::VARCHAR AS source_document, 'chunk-' || p.doc_id AS source_chunk_id, p.question_index, false AS has_answer, 'chunk-' || p.doc_id AS chunk, 'Base' || coalesce('|' || e.l, '') AS entities, 'chunk-' || p.doc_id AS chunk_ids, true AS context_used
        FROM parsed p LEFT JOIN e USING (doc_id, ord)""",
    "q_doc_status": f"WITH {CHUNKS}, c AS (SELECT doc_id, count(*)::INT AS n, string_agg(chunk_id, '|' ORDER BY chunk_index) AS l FROM chunks GROUP BY doc_id) SELECT d.doc_id, CASE WHEN n > 0 THEN 'processed' ELSE 'empty' END AS status, length(text) AS content_length, substring(text, 1, 100) AS content_summary, coalesce(n, 0) AS chunks_count, l AS chunks_list FROM documents d LEFT JOIN c USING (doc_id)",
    "q_incremental_ingest": "SELECT doc_id, length(text) AS n_chars FROM documents ANTI JOIN labels USING (doc_id)",
    "q_list_domains": "SELECT stage, string_agg(domain, '|' ORDER BY domain) AS domains FROM (SELECT DISTINCT 'raw' AS stage, lang AS domain FROM documents UNION SELECT DISTINCT 'processed', source FROM documents) GROUP BY stage",
    "q_embedding_pad": _fitted(80),
    "q_embedding_truncate": _fitted(24),
    "q_cosine_topk": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) / (q.n * v.n) AS score FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
        SELECT query_id, rank, vec_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s WHERE score >= 0.2) WHERE rank <= 20""",
    "q_table_grid": f"SELECT page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (SELECT page_id, {_tabled(chr(92))} AS t FROM pages)",
    "q_markdown_tables": f"SELECT page_id, length(p) AS n_chars, md5(p) AS plain_md5 FROM (SELECT page_id, {_plain(_tabled(''))} AS p FROM pages)",
    "q_store_view": f"WITH {CHUNKS}, c AS (SELECT doc_id, count(*) AS n, sum(length(content))::BIGINT AS l FROM chunks GROUP BY doc_id) SELECT doc_id, CASE WHEN n > 0 THEN 'processed' ELSE 'empty' END AS status, coalesce(n, 0) AS n_chunks, coalesce(l, 0)::BIGINT AS chunk_chars FROM documents LEFT JOIN c USING (doc_id)",
    "q_record_nodes": f"WITH {FOUND} SELECT doc_id, name AS entity_id, 'concept' AS entity_type, 'said of ' || name AS description, md5(string_agg(chunk_id, '<SEP>' ORDER BY chunk_index)) AS sources_md5, min((chunk_index, pos))[1] AS first_chunk, min((chunk_index, pos))[2] AS first_pos FROM found GROUP BY doc_id, name",
    "q_record_edges": f"WITH {PAIRS} SELECT doc_id, min((chunk_index, pos, source, target))[3] AS source, min((chunk_index, pos, source, target))[4] AS target, 2.0::DOUBLE * count(*) AS weight, md5(string_agg(DISTINCT source || ' beside ' || target, '<SEP>' ORDER BY source || ' beside ' || target)) AS description_md5, 'near' AS keywords, md5(array_to_string(list_transform(list_sort(list_distinct(list((chunk_index, chunk_id)))), lambda x: x[2]), '<SEP>')) AS sources_md5, min((chunk_index, pos, source, target))[1] AS first_chunk FROM relations GROUP BY doc_id, a, b",
    "q_bad_records": f"WITH {CHUNKS} SELECT doc_id, unnest(['members', 'weight']) AS reason, count(*) AS n FROM chunks GROUP BY doc_id",
    "q_vector_store": f"WITH {CHUNKS}, t AS (SELECT chunk_id, min(content) AS content, bool_or(doc_id % 2 = 0) AS early FROM chunks GROUP BY chunk_id) SELECT count(*) AS n_chunks, 8 * count(*) AS n_values, (SELECT count(DISTINCT content) FROM t WHERE early) AS embedded_1, count(DISTINCT content) - (SELECT count(DISTINCT content) FROM t WHERE early) AS embedded_2, 0::BIGINT AS embedded_3 FROM t",
    "q_token_budget": f"""WITH {LINES}, l AS (SELECT doc_id, rn, (rn % 3)::INT AS kind, len(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> ''))::BIGINT AS tokens FROM lines),
        c AS (SELECT *, sum(tokens) OVER (PARTITION BY doc_id, kind ORDER BY rn) AS cum FROM l),
        a AS (SELECT doc_id, coalesce(sum(tokens) FILTER (kind = 0 AND cum <= 40), 0) AS used FROM c GROUP BY doc_id),
        b AS (SELECT c.doc_id, a.used, coalesce(sum(tokens) FILTER (kind = 1 AND cum <= 70 - a.used), 0) AS more FROM c JOIN a USING (doc_id) GROUP BY c.doc_id, a.used)
        SELECT doc_id, rn, kind, tokens FROM c JOIN b USING (doc_id) WHERE kind = 0 AND cum <= 40 OR kind = 1 AND cum <= 70 - used OR kind = 2 AND cum <= 100 - used - more""",
    "q_html_tables": """SELECT page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (SELECT page_id, html || chr(10) || chr(10) || '| key | address |' || chr(10) || '|---|---|' || chr(10) || '| ' || page_id || ' | ' || trim(regexp_replace(url, '\\s+', ' ', 'g')) || ' |' || chr(10) || '| last |  |' || chr(10) || chr(10) || 'y' AS t FROM pages)""",
    "q_concat_pages": "SELECT page_id % 10 AS document, count(*) AS pages, md5(coalesce(string_agg(x, chr(10) || chr(10) ORDER BY page_id) FILTER (x <> ''), '')) AS text_md5 FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '' ELSE html END AS x FROM pages) GROUP BY page_id % 10",
    "q_layout_tables": "SELECT page_id, CASE WHEN page_id % 4 < 3 THEN 2 ELSE 1 END AS n, CASE page_id % 4 WHEN 0 THEN html || '|' || url WHEN 1 THEN url || '|' || url WHEN 2 THEN 'c' || url || '|' || url ELSE url END AS tables FROM pages",
    "q_markdown_string": """SELECT page_id, md5(CASE page_id % 5 WHEN 0 THEN html WHEN 1 THEN 'm' || url WHEN 2 THEN 't' || url WHEN 3 THEN '{"other":"x"}' ELSE '' END) AS markdown_md5 FROM pages""",
    "q_node_names": "SELECT DISTINCT lang AS chunk_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 3 = 1 THEN 'n' || doc_id % 5 ELSE 'i' || doc_id % 7 END AS name FROM documents WHERE doc_id % 11 <> 2",
    "q_source_members": "SELECT doc_id, unnest(CASE WHEN lang = source THEN [lang, source] ELSE [lang, source, 'x' || doc_id % 3] END) AS chunk_id, generate_subscripts(CASE WHEN lang = source THEN [lang, source] ELSE [lang, source, 'x' || doc_id % 3] END, 1)::INT - 1 AS source_pos FROM documents",
    "q_store_stats": "SELECT count(*) AS file_count, md5(string_agg(name, '|' ORDER BY name)) AS files_md5, round(sum(n_chars) / 1048576, 6) AS size_mb FROM (SELECT 'f' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.json' WHEN 1 THEN '.graphml' ELSE '.txt' END AS name, n_chars FROM documents) WHERE NOT ends_with(name, '.txt')",
    "q_run_summary": "SELECT count(*) FILTER (n_regionkey < 3) AS succeeded, count(*) AS total, string_agg(n_name, '|' ORDER BY n_name) FILTER (n_regionkey >= 3) AS failed FROM nation",
    "q_upsert": "SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 7 = 0) UNION ALL SELECT doc_id, 9, 9 FROM documents WHERE doc_id % 7 = 0",
    "q_event_counts": "SELECT strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "q_embedding_float": "SELECT vec_id, round(list_reduce(list_transform(embedding, lambda x: (x::FLOAT)::DOUBLE), lambda a, b: a + b), 6) AS total FROM embeddings",
    "q_chunk_lookup": f"WITH {CHUNKS}, texts AS (SELECT chunk_id, min(content) AS content FROM chunks GROUP BY chunk_id) SELECT doc_id, c.chunk_id, md5(t.content) AS content_md5 FROM chunks c JOIN texts t USING (chunk_id) WHERE chunk_index = 0",
    "q_graph_context": f"""WITH {PAIRS}, {ENTITIES}, {RELATIONS}, {RELATED}, {SNIPPETS},
        directed AS (SELECT doc_id, a, b, min((chunk_index, pos, source, target)) AS d FROM relations GROUP BY doc_id, a, b),
        stored AS (SELECT s.doc_id, s.chunk_index, s.rank, d[3] AS source, d[4] AS target FROM shown s JOIN directed d ON d.doc_id = s.doc_id AND d.a = least(s.source, s.target) AND d.b = greatest(s.source, s.target)),
        e AS (SELECT doc_id, chunk_index, string_agg(name, '|' ORDER BY rank) AS names, string_agg({_ENTITY_LINE}, chr(10) ORDER BY rank) AS l FROM entities GROUP BY ALL),
        r AS (SELECT doc_id, chunk_index, string_agg({_RELATION_LINE}, chr(10) ORDER BY rank) AS l FROM stored GROUP BY ALL),
        s AS (SELECT doc_id, chunk_index, string_agg(line, chr(10) ORDER BY place) AS l FROM snippets GROUP BY ALL),
        i AS (SELECT doc_id, chunk_index, string_agg(related_id, '|' ORDER BY place) AS l FROM related GROUP BY ALL)
        SELECT c.doc_id, c.chunk_index, coalesce(e.names, '') AS entities, md5(coalesce('【相关实体信息】' || chr(10) || e.l, '')) AS entities_md5,
          md5({_strip("concat_ws(chr(10) || chr(10), '【相关实体信息】' || chr(10) || e.l, '【相关关系信息】' || chr(10) || r.l, '【知识图谱片段】' || chr(10) || s.l)")}) AS context_md5, c.chunk_id || coalesce('|' || i.l, '') AS chunk_ids
        FROM chunks c LEFT JOIN e USING (doc_id, chunk_index) LEFT JOIN r USING (doc_id, chunk_index) LEFT JOIN s USING (doc_id, chunk_index) LEFT JOIN i USING (doc_id, chunk_index)""",
}
