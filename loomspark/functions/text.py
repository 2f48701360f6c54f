"""Text operators as Column functions. All patterns run inside the JVM with Unicode classes and \\n as the only line end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html_tables import render_tables

#: Before every pattern: Unicode classes, and only \n ends a line.
FLAGS = "(?U)(?d)"

# The cleaning steps must be these, in this order, for equal results.
MARKDOWN_STEPS = (
    (r"(?is)<img[^>]*>", " "),
    (r"<[^>]+>", " "),
    (r"(?m)^#{1,6}\s*", ""),
    (r"\*\*\*(.*?)\*\*\*", "$1"),
    (r"\*\*(.*?)\*\*", "$1"),
    (r"\*(.*?)\*", "$1"),
    (r"`(.*?)`", "$1"),
    (r"(?s)```.*?```", ""),
    (r"\[([^\]]*)\]\([^\)]*\)", "$1"),
    (r"!\[([^\]]*)\]\([^\)]*\)", "$1"),
    (r"(?m)^\s*[-*+]\s*", ""),
    (r"(?m)^\s*\d+\.\s*", ""),
    (r"(?m)^>\s*", ""),
    (r"[\|]", " "),
    (r"(?m)^[-\s\|:]+$", ""),
    (r" +", " "),
    (r"\n\s*\n\s*\n+", "\n\n"),
)
# Fixed values, all lists and patterns up to LEAST_QUESTION: they must be these for equal results.
ANSWER_MARKS = ("答案[:：]", "回答[:：]", "Answer[:：]")
ANSWER_EDGES = " \t\r\n。；;，,"
QUESTION_ENDS = "?？.。！!,，"
QUESTION_WORDS = ("如何", "什么", "为什么", "怎样", "哪些", "是否")
CATEGORY_TITLE = r"^(复杂|中等|简单|关联|深度|事实).*问题"
ANSWER_WORDS = ("答案", "解答", "Answer")
ENTITY_PATTERNS = (r"[A-Z]{2,}\d+[A-Z]*", r"[A-Z]+\d+[A-Z0-9]*", r"[A-Z][A-Za-z0-9\-]{2,}")
TOKEN = r"(?<!\S)[^\s\w]*([A-Z]\S*\b)"
TOKEN_EDGES = ".,;:!?，。；：（）()[]{}\"'"
SOURCE_SEPARATOR = "<SEP>"
LEAST_QUESTION = 15


def sub(text: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(text, FLAGS + pattern, replacement)


#: What Unicode counts as white space, all of which is one place in UTF-16: what (?U)\\s matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space at its ends, which are looked at alone: a pattern would be tried at every space."""
    return F.btrim(text, F.lit(WHITE))


def filled(text: Column) -> Column:
    """Null for empty strings, which count as missing."""
    return F.nullif(text, F.lit(""))


def markdown_to_plain(text: Column) -> Column:
    """Tables are laid out first, while they have their tags; then the steps in order."""
    out = render_tables(F.coalesce(text, F.lit("")), escape=False)
    for pattern, replacement in MARKDOWN_STEPS:
        out = sub(out, pattern, replacement)
    return strip(out)


def clean_think(text: Column) -> Column:
    out = sub(F.coalesce(text, F.lit("")), r"(?is)<think>.*?</think>")
    return strip(sub(out, r"\n\s*\n\s*\n+", "\n\n"))


def strip_answer(text: Column) -> Column:
    for mark in ANSWER_MARKS:
        text = sub(text, rf"(?is){mark}.*")
    return F.btrim(text, F.lit(ANSWER_EDGES))


def snippet(text: Column, chars: int = 200) -> Column:
    return F.substring(F.replace(strip(text), F.lit("\n"), F.lit(" ")), 1, chars)


def dedup_normalise(text: Column) -> Column:
    out = F.lower(sub(text, r"^问题\d+[:：]\s*"))
    out = strip(sub(out, r"\s+", " "))
    return F.rtrim(out, F.lit(QUESTION_ENDS))


def addressed(text: Column) -> Column:
    """What of a text its chunk id is of."""
    return strip(F.replace(text, F.lit("\0"), F.lit("")))


def chunk_id(text: Column) -> Column:
    """Content-addressed; null for null and blank texts."""
    out = addressed(text)
    return F.when(out != "", F.concat(F.lit("chunk-"), F.md5(out.cast("binary"))))


def question_cleanup(text: Column) -> Column:
    out = sub(strip(text), r"^问题[:：]\s*")
    return strip_answer(strip(sub(out, r"\n+", " ")))


def fallback_cleanup(line: Column) -> Column:
    return strip_answer(sub(sub(line, r"^[\d\.\-\*\s]+"), r"^问题\d+[:：]\s*"))


def question_rules(text: Column) -> dict[str, Column]:
    """What an accepted question must fulfil, by rule."""
    asks = text.contains("？") | text.contains("?")
    return {
        "long_enough": F.length(text) >= LEAST_QUESTION,
        "asks": asks,
        "no_heading": ~text.rlike(FLAGS + r"^#+\s"),
        "no_category": ~text.rlike(FLAGS + CATEGORY_TITLE),
        "no_bracket": ~text.startswith("【"),
        "no_answer": ~(text.contains(ANSWER_WORDS[0]) | text.contains(ANSWER_WORDS[1]) | text.contains(ANSWER_WORDS[2])),
    }


def is_valid_question(text: Column) -> Column:
    out = F.coalesce(text, F.lit("")) != ""
    for rule in question_rules(text).values():
        out = out & rule
    return F.coalesce(out, F.lit(False))


def is_fallback_candidate(line: Column) -> Column:
    asks = line.contains("?") | line.contains("？")
    for word in QUESTION_WORDS:
        asks = asks | line.startswith(word)
    return (line != "") & ~line.startswith("#") & ~line.startswith("【") & ~line.rlike(FLAGS + CATEGORY_TITLE) & asks


def parse_source_ids(text: Column) -> Column:
    """Ids split at ; , and |, stripped, without empty ones."""
    return F.coalesce(F.filter(F.transform(F.split(text, r"[;,\|]"), strip), lambda x: x != ""), F.array().cast("array<string>"))


def split_sources(text: Column) -> Column:
    """Ids as the graph joins them, as an array."""
    return F.filter(F.split(text, SOURCE_SEPARATOR), lambda x: x != "")


def extract_entities(text: Column) -> Column:
    """Tokens in order, each once, that some entity pattern matches in full."""
    found = [F.regexp_extract_all(text, F.lit(FLAGS + p), F.lit(0)) for p in ENTITY_PATTERNS]
    # the first two have a digit behind a capital letter, which few texts have
    matched = F.when(text.rlike(FLAGS + r"[A-Z]\d"), F.concat(*found)).otherwise(found[-1])
    # all patterns begin with a letter of A-Z, so that only tokens that do can be matched; no edge of a token is in TOKEN_EDGES
    tokens = F.regexp_extract_all(text, F.lit(FLAGS + TOKEN), F.lit(1))
    return F.array_intersect(tokens, matched)


def bigrams(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?s)(?=(..))."), F.lit(1)))


def entity_line(name: Column, kind: Column, description: Column) -> Column:
    kind = F.when(filled(kind).isNotNull(), F.concat(F.lit("（类型："), kind, F.lit("）"))).otherwise("")
    return F.concat(F.lit("- 实体 "), name, kind, F.lit("："), F.coalesce(filled(description), F.lit("暂无详细描述")))


def relation_line(a: Column, b: Column, description: Column, keywords: Column) -> Column:
    said = F.coalesce(filled(description), F.concat(F.lit("关键词 "), filled(keywords)), F.lit("暂无详细描述"))
    return F.concat(F.lit("- "), a, F.lit(" ↔ "), b, F.lit("："), said)


def snippet_line(chunk: Column, text: Column) -> Column:
    return F.concat(F.lit("- 片段 "), chunk, F.lit(": "), text)


#: The headers of the sections of a context.
HEADERS = ("【相关实体信息】", "【相关关系信息】", "【知识图谱片段】")


def prompt_context(entities: Column, relations: Column, snippets: Column) -> Column:
    """The three arrays of lines as sections; empty ones are left out."""
    each = [F.when(F.size(x) > 0, F.concat(F.lit(h + "\n"), F.array_join(x, "\n"))) for h, x in zip(HEADERS, (entities, relations, snippets), strict=True)]
    return strip(F.concat_ws("\n\n", *each))


def render(template: str, **values: Column) -> Column:
    """The template with its fields put in all at once: braces in a value are never fields."""
    parts, rest = [], template
    while rest:
        found = min(((rest.find("{" + k + "}"), k) for k in values if "{" + k + "}" in rest), default=None)
        if found is None:
            parts.append(F.lit(rest))
            break
        at, key = found
        parts += [F.lit(rest[:at])] if at else []
        parts.append(values[key])
        rest = rest[at + len(key) + 2 :]
    return F.concat(*parts) if parts else F.lit("")


def with_system(system: Column, prompt: Column) -> Column:
    return F.when(filled(system).isNotNull(), F.concat(system, F.lit("\n\n"), prompt)).otherwise(prompt)


def assemble_document(plain: Column, markdown: Column, tables: Column, images: Column) -> Column:
    """Text, then tables, then image texts, as sections; blank ones are left out."""
    text = F.coalesce(filled(plain), markdown_to_plain(markdown))
    part = lambda head, xs: F.when(F.size(xs) > 0, F.concat(F.lit(head), F.array_join(xs, "\n\n")))
    each = [text, part("## 表格提取\n", tables), part("## 图片OCR\n", images)]
    return F.concat_ws("\n\n", *[F.when(strip(x) != "", x) for x in each])


#: The members of a layout result and of a page's result that are looked at, in this order.
TABLE_MEMBERS = ("res_html", "html", "cell_html")
MARKDOWN_MEMBERS = ("markdown", "md", "text")


def layout_tables(blocks: Column) -> Column:
    """Of each block of a layout result (an array of structs or maps with ``TABLE_MEMBERS``) the first html that isn't empty;
    blocks without any are left out."""
    one = lambda x: F.coalesce(*[filled(x[m]) for m in TABLE_MEMBERS])
    return F.filter(F.transform(F.coalesce(blocks, F.array()), one), lambda x: x.isNotNull())


def markdown_string(text: Column, members: Column) -> Column:
    """A page's markdown: a text as it is, else the first of ``MARKDOWN_MEMBERS`` in the map ``members``, else the map as JSON;
    empty where there is neither."""
    found = [F.try_element_at(members, F.lit(m)) for m in MARKDOWN_MEMBERS]
    return F.coalesce(text, *found, F.to_json(members), F.lit(""))


def image_text(path: Column, text: Column) -> Column:
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    return F.concat(F.lit("[图片OCR] "), path, F.lit(": "), F.array_join(lines, "\n"))
