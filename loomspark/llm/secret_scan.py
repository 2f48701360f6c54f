r"""Secret scans over a trigram inverted index, in DataFrame operations only.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must contain. One
pass over the texts makes the postings of the trigrams that some query names (lower-cased, one row per trigram
and text); postings are intersected per text, and only candidates of a rule are read again and verified with its
expression. Rules without mandatory trigrams (runs of hex digits) are verified on every text in the first pass.

Spans are code points, end exclusive, leftmost and non-overlapping per rule.

Defined cases: a null text is an empty one and has no spans; a null id is an id like any other; each row has its
own result, also where ids or whole rows repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as K
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import fresh, member_gate, settle

#: Two private-use characters: MARK bounds matches; one that is part of a text is read as OTHER, which no rule names.
MARK, OTHER = "\ue000", "\ue001"


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts if its ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    # of a run of fewer than 24 digits no part has 24, so the length is asked for within the expression
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


# ---- regular expression -> Boolean query over trigrams
# A query is True (no constraint), a trigram, or ("and" | "or", queries).


def _all_of(parts: list) -> object:
    flat = [x for x in dict.fromkeys(parts) if x is not True]
    return True if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _any_of(parts: list) -> object:
    if True in parts or not parts:
        return True
    needs = {p: {p} if isinstance(p, str) else set(p[1]) if p[0] == "and" else {p} for p in parts}
    flat = [p for p in needs if not any(needs[q] < needs[p] for q in needs)]  # what holds if another does adds nothing
    return flat[0] if len(flat) == 1 else ("or", tuple(flat))


def _of_strings(strings: set[str]) -> object:
    return _any_of([_all_of([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _few(node, most: int = 8) -> set[str] | None:
    """The strings that an item stands for, if they are few and known."""
    kind, value = node
    if kind is K.LITERAL:
        return {chr(value).lower()}
    if kind is K.IN and all(k is K.LITERAL for k, _ in value) and len(value) <= most:
        return {chr(v).lower() for _, v in value}
    if kind is K.SUBPATTERN:
        return _few_all(value[3], most)
    if kind is K.BRANCH:
        each = [_few_all(x, most) for x in value[1]]
        return None if None in each else set().union(*each)
    if kind in (K.MAX_REPEAT, K.MIN_REPEAT) and value[1] == 1:
        inner = _few_all(value[2], most)
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _few_all(nodes, most: int) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _few(node, most)
        if more is None or len(out) * len(more) > 64:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes) -> object:
    found, run = [], {""}
    for node in nodes:
        few = _few(node)
        if few is not None and len(run) * len(few) <= 64:
            run = {a + b for a in run for b in few}
            continue
        found.append(_of_strings(run))
        run = {""} if few is None else few
        kind, value = node
        if few is None and kind is K.SUBPATTERN:
            found.append(_query(value[3]))
        elif few is None and kind is K.BRANCH:
            found.append(_any_of([_query(x) for x in value[1]]))
        elif few is None and kind in (K.MAX_REPEAT, K.MIN_REPEAT) and value[0] >= 1:
            once = _few_all(value[2], 8)
            found.append(_query(value[2]) if once is None else _of_strings({x * min(value[0], 8) for x in once}))
    return _all_of([*found, _of_strings(run)])


def trigram_query(pattern: str) -> object:
    """True if no trigram is mandatory in a match of ``pattern``, else the query that its matches fulfil."""
    return _query(parser.parse(pattern))


def trigrams_of(query) -> list[str]:
    if query is True:
        return []
    return [query] if isinstance(query, str) else sorted({t for q in query[1] for t in trigrams_of(q)})


def _holds(query, have: str) -> Column:
    if isinstance(query, str):
        return F.array_contains(have, query)
    each = [_holds(q, have) for q in query[1]]
    out = each[0]
    for x in each[1:]:
        out = out & x if query[0] == "and" else out | x
    return out


# ---- spans


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once: as a lambda's variable it isn't evaluated again for each element of a list."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The list of what ``join`` makes of each value and all before it: in each round with what stands twice as far before, so that
    a list of n is gone through log2(n) times and nothing is appended to."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda s: s < F.size(values))
    return F.aggregate(steps, values, lambda acc, s: F.transform(acc, lambda x, i: F.when(i >= s, join(F.get(acc, i - s), x)).otherwise(x)))


def _spans(text: Column, rule: Rule, at: int) -> Column:
    """Array of (start, at, end, kind) of the matches of a rule that count: of the pieces between marks every second one is a match,
    and ends at the sum of the lengths so far."""
    none = F.array().cast("array<struct<start:bigint,at:int,end:bigint,kind:string>>")

    def found(pieces: Column) -> Column:
        ends = _running(F.transform(pieces, lambda x: F.length(x).cast("long")), lambda a, b: a + b)

        def one(x: Column, i: Column) -> Column:
            counts = F.length(F.regexp_extract(x["p"], rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)
            span = F.struct((x["e"] - F.length(x["p"])).alias("start"), F.lit(at).alias("at"), x["e"].alias("end"), F.lit(rule.kind).alias("kind"))
            return F.when((i % 2 == 1) & counts, span)

        return F.array_compact(F.transform(F.zip_with(pieces, ends, lambda p, e: F.struct(p.alias("p"), e.alias("e"))), one))

    marked = F.split(F.regexp_replace(text, rule.pattern, f"{MARK}$0{MARK}"), MARK, -1)
    return _bound(marked, lambda pieces: F.when(F.size(pieces) > 1, found(pieces)).otherwise(none))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(OTHER))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), text.alias("t"))


def trigram_postings(texts: DataFrame, trigrams: list[str]) -> Column:
    """The array of those ``trigrams`` that column ``low`` has."""
    return F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: id, h (a hash of the text), spans array<struct<start, at, end, kind>> in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted({t for q in queries for t in trigrams_of(q)})
    full = [(i, r) for i, r in enumerate(rules) if queries[i] is True]
    indexed = [(i, r) for i, r in enumerate(rules) if queries[i] is not True]

    base = _texts(docs, id_col, text_col)
    scanned = base.withColumn("low", F.lower("t")).select("id", "h", trigram_postings(base, wanted).alias("tris"), *[_spans(F.col("t"), r, i).alias(f"s{i}") for i, r in full])
    first = settle(scanned)

    postings = first.select(F.explode("tris").alias("tri"), "id", "h").distinct()
    have = postings.groupBy("id", "h").agg(F.collect_set("tri").alias("have"))  # no more than the queries name
    hit = have.select("id", "h", F.array_compact(F.array(*[F.when(_holds(queries[i], "have"), F.lit(i)) for i, _ in indexed])).alias("hits")).where(F.size("hits") > 0)
    hit = settle(hit.select(F.col("id").alias("hit_id"), F.col("h").alias("hit_h"), "hits"))

    again = member_gate(base, hit.select(F.col("hit_id").alias("id"), F.col("hit_h").alias("h")), ["id", "h"])
    none = F.array().cast("array<struct<start:bigint,at:int,end:bigint,kind:string>>")
    seen = again.join(hit, again["id"].eqNullSafe(hit["hit_id"]) & (again["h"] == hit["hit_h"]))
    verified = seen.select(
        "hit_id",
        "hit_h",
        F.concat(*[F.when(F.array_contains("hits", i), _spans(F.col("t"), r, i)).otherwise(none) for i, r in indexed]).alias("more"),
    ).where(F.size("more") > 0)
    verified = settle(verified.dropDuplicates(["hit_id", "hit_h"]))

    out = first.join(verified, first["id"].eqNullSafe(verified["hit_id"]) & (first["h"] == verified["hit_h"]), "left")
    return out.select(F.col("id").alias(id_col), "h", F.array_sort(F.concat(*[F.col(f"s{i}") for i, _ in full], F.coalesce("more", none))).alias("spans"))


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    said = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = [r.kind for r in RULES if r.base]
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(said(F.filter("spans", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    cut, all_spans = [], []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        cut.append(f"string_split(regexp_replace(t, '{pattern}', chr(57344) || '\\0' || chr(57344), 'g'), chr(57344)) AS p{i}")
        counts = f"length(regexp_extract(p{i}[i], '{pattern}', {r.group})) >= {r.least}"
        all_spans.append(
            f"list_transform(list_filter(range(2, len(p{i}) + 1, 2), lambda i: {counts}), lambda i: {{'s': coalesce(list_sum(list_transform(p{i}[1:i-1], lambda x: length(x))), 0)::BIGINT, 'at': {i}, 'e': coalesce(list_sum(list_transform(p{i}[1:i], lambda x: length(x))), 0)::BIGINT, 'k': '{r.kind}'}})"
        )
    joined = all_spans[0]
    for x in all_spans[1:]:
        joined = f"list_concat({joined}, {x})"
    said = lambda c: f"coalesce(array_to_string(list_transform({c}, lambda x: x.k || ':' || x.s || ':' || x.e), ','), '')"
    base = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
    counts = ", ".join(f"len(list_filter(spans, lambda x: x.k = '{r.kind}'))::BIGINT AS n_{r.kind}" for r in RULES if r.base)
    return f"""
WITH d AS (SELECT doc_id, replace(coalesce(text, ''), chr(57344), chr(57345)) AS t FROM documents),
c AS (SELECT doc_id, {', '.join(cut)} FROM d),
s AS (SELECT doc_id, list_sort({joined}) AS spans FROM c)
SELECT doc_id, {counts}, sha256({said(f'list_filter(spans, lambda x: x.k IN ({base}))')}) AS base_sha256, {said('spans')} AS spans FROM s
"""


OP3_SQL = _oracle()


#: Characters of the blocks that a text is cut into before what stands between its spans is put together.
CUT = 1000


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; spans that overlap have one mask together.

    A text with spans is cut into blocks once, and what stands between two spans comes from the blocks around it, so that
    neither the text's length nor what is done already counts again for each span."""
    key, other_id, other_key, spans, blocks, covered = fresh(docs, "_key", "_id", "_h", "_spans", "_blocks", "_covered")
    found = find_secrets(docs, id_col, text_col, rules).where(F.size("spans") > 0).dropDuplicates([id_col, "h"])
    found = settle(found.select(F.col(id_col).alias(other_id), F.col("h").alias(other_key), F.col("spans").alias(spans)))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = keyed.join(found, keyed[id_col].eqNullSafe(found[other_id]) & (keyed[key] == found[other_key]), "left")

    def merged(sorted_spans: Column) -> Column:
        """Spans that overlap as one: one begins where no span before reaches, and ends where the spans up to the next beginning reach."""

        def joined(all_spans: Column, reach: Column) -> Column:
            first = lambda i: F.when((i == 0) | (F.get(all_spans, i)["start"] >= F.get(reach, i - 1)), i)
            firsts = F.array_compact(F.transform(all_spans, lambda x, i: first(i)))
            end = lambda of, j: F.get(reach, F.coalesce(F.get(of, j + 1), F.size(all_spans)) - 1)
            return _bound(firsts, lambda of: F.transform(of, lambda i, j: F.struct(F.get(all_spans, i)["start"].alias("start"), end(of, j).alias("end"))))

        return _bound(sorted_spans, lambda x: _bound(_running(F.transform(x, lambda y: y["end"]), F.greatest), lambda reach: joined(x, reach)))

    # generators of one row: what the next expressions go through for each span is made once
    whole = F.when(F.col(spans).isNotNull(), F.struct(F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)).alias("blocks"), merged(F.array_sort(F.col(spans))).alias("covered")))
    rows = rows.select("*", F.explode(F.array(whole)).alias(blocks)).withColumn(covered, F.col(blocks)["covered"])

    def between(start, end):
        near = F.array_join(F.slice(F.col(blocks)["blocks"], (start / CUT).cast("int") + 1, ((end - start) / CUT).cast("int") + 2), "")
        return F.substr(near, (start % CUT + 1).cast("int"), (end - start).cast("int"))

    before = F.transform(covered, lambda x, i: between(F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(covered, i - 1)["end"]), x["start"]))
    rest = between(F.element_at(covered, -1)["end"], F.length(text_col).cast("long"))
    clean = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(F.array_join(F.concat(before, F.array(rest)), mask))
    return rows.withColumn(text_col, clean).select(*docs.columns)
