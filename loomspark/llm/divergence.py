r"""Source divergence audit: how much the words of each source of a language differ from those of every other one.

Within a language the kept terms are those in enough of its documents. Each source gives each kept term a smoothed share p, a
whole number of billionths, and a pair of sources differs by the sum over all kept terms of f(p, q) = floor((p - q)^2 / q).
Most terms are in few sources, so that sum isn't taken term by term. Each pair starts at V times f of the shares of zero counts,
as if no term were in either, and an inverted index of terms corrects it: a term that only one of the two has adds f of its
share against the other's share of a zero count, less f of zero counts, and as this depends on the share alone, terms of equal
share in a source are counted first; a term that both have, two entries of one posting list, adds what its f differs from these.
Corrections of the same pair are summed before they are exchanged. Terms that a source uses more than its language does are
ranked by f against the language's share in a window that keeps only the first ones before its exchange.

Counting words is done in Python over batches of bounded size, as counts of (language, source, term) with the number of documents
that hold the term; no text is exchanged, and a hot source sends as many rows as its tasks have distinct terms. Sources are joined
by their posting lists as rows, so that no list is gathered in a task. All arithmetic is of whole numbers.

Defined cases: null texts, languages and sources are empty strings; an empty language or source is one like any other; every row is
a document of its own, whatever its id and however often it is repeated; a source without terms, or without any text, is compared as
one whose counts are zero; a language without kept terms has pairs of value 0; one with a single source has no pairs; ties go to
the smaller item in bytes; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import give_back, settle, slices, small_batches

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Distinct (language, source, term) that a task counts before it sends them on, characters of a text above which its terms are
#: counted one by one, and rows of a batch.
ENTRIES, LONG, BATCH = 400_000, 4_000_000, 50_000
#: What shares are counted in.
UNIT = 1_000_000_000


def lowered(text: str) -> str:
    """The text with A to Z in lower case."""
    return text.encode().lower().decode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs)."""
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in counts.items():
            terms, held = list(n), docs[lang, source]
            for at in range(0, len(terms), BATCH):
                some = terms[at : at + BATCH]
                columns = [[lang] * len(some), [source] * len(some), some, [n[t] for t in some], [held[t] for t in some]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, [pa.string()] * 3 + [pa.int64()] * 2, strict=True)], names=["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    for batch in batches:
        for part, texts in slices(batch, "text"):
            for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts, strict=True):
                key = lang, source
                if len(text) <= LONG:
                    terms = _TERM.findall(lowered(text))
                    counts[key].update(terms)
                    docs[key].update(set(terms))
                else:
                    own = Counter(m[0] for m in _TERM.finditer(lowered(text)))
                    counts[key].update(own)
                    docs[key].update(list(own))
            if sum(map(len, counts.values())) >= ENTRIES:
                yield from out()
    yield from out()
    give_back()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it)."""
    small_batches(docs.sparkSession)
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    rows = named.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + terms)); null where there are no terms."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, F.when(terms > 0, (total + terms).cast("decimal(20,0)")))


def _f(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def postings(docs: DataFrame, min_docs: int = 3, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(groups, postings), both settled. Groups: gid, lang, source, terms (kept ones of the language), p0 (share of a zero count).
    Postings: lang, term, gid, p and p0 of the source, q (the language's share) of every kept term that a source holds."""
    of_term = W.partitionBy("lang", "term")
    held = term_counts(docs, lang_col, source_col, text_col)
    held = held.select("*", F.sum("docs").over(of_term).alias("in_docs"), F.sum("n").over(of_term).alias("in_lang"), F.row_number().over(of_term.orderBy("source")).alias("place"))
    kept = settle(held.where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "in_lang", (F.col("place") == 1).cast("long").alias("first")))
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    of_lang = W.partitionBy("lang")
    zero = F.lit(0).cast("long")
    groups = names.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("firsts", zero).alias("firsts"))
    groups = groups.select("*", F.sum("firsts").over(of_lang).alias("terms"), F.sum("total").over(of_lang).alias("lang_total"))
    groups = settle(groups.select(F.monotonically_increasing_id().alias("gid"), "*", _share(zero, F.col("total"), F.col("terms")).alias("p0")))
    own = kept.join(groups, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    return groups, settle(own.select("lang", "term", "gid", p.alias("p"), "p0", q.alias("q")))


def pair_values(groups: DataFrame, held: DataFrame) -> DataFrame:
    """a, b (gids of every ordered pair of sources of a language), lang, and the value of b for a."""
    side = groups.select("lang", "gid", "p0", "terms")
    # terms that a source holds, as if the other didn't: those of equal share at once
    alike = held.groupBy("lang", "gid", "p", "p0").agg(F.count("*").alias("c"))
    other = side.select("lang", F.col("gid").alias("h"), F.col("p0").alias("h0"))
    near = alike.join(other, "lang").where("gid <> h")
    forth = near.select(F.col("gid").alias("a"), F.col("h").alias("b"), (F.col("c") * (_f("p", "h0") - _f("p0", "h0"))).alias("d"))
    back = near.select(F.col("h").alias("a"), F.col("gid").alias("b"), (F.col("c") * (_f("h0", "p") - _f("h0", "p0"))).alias("d"))
    single = forth.unionByName(back).groupBy("a", "b").agg(F.sum("d").alias("d"))
    # terms that both hold
    x = held.select("lang", "term", F.col("gid").alias("x"), F.col("p").alias("xp"), F.col("p0").alias("x0"))
    y = held.select("lang", "term", F.col("gid").alias("y"), F.col("p").alias("yp"), F.col("p0").alias("y0"))
    both = (
        x.join(y, ["lang", "term"])
        .where("x < y")
        .groupBy("x", "y")
        .agg(
            F.sum(_f("xp", "yp") - _f("xp", "y0") - _f("x0", "yp") + _f("x0", "y0")).alias("forth"),
            F.sum(_f("yp", "xp") - _f("yp", "x0") - _f("y0", "xp") + _f("y0", "x0")).alias("back"),
        )
    )
    two = both.select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b"), F.col("forth").alias("d")), F.struct(F.col("y").alias("a"), F.col("x").alias("b"), F.col("back").alias("d")))).alias("r")).select("r.*")
    change = single.unionByName(two).groupBy("a", "b").agg(F.sum("d").alias("d"))
    pairs = side.select("lang", F.col("gid").alias("a"), F.col("p0").alias("a0"), "terms").join(side.select("lang", F.col("gid").alias("b"), F.col("p0").alias("b0")), "lang").where("a <> b")
    start = F.coalesce(F.col("terms") * _f("a0", "b0"), F.lit(0).cast("long"))
    return pairs.join(change, ["a", "b"], "left").select("lang", "a", "b", (start + F.coalesce("d", F.lit(0).cast("long"))).alias("value"))


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: in part 'pair' every other source of the language, in part 'term' the ``top`` terms
    that the source uses more than the language."""
    groups, held = postings(docs, min_docs, lang_col, source_col, text_col)
    name = groups.select("gid", "source")
    pairs = pair_values(groups, held).join(name.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b").withColumnRenamed("a", "gid")
    by = W.partitionBy("gid").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "gid", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
    terms = held.where("p > q").select("lang", "gid", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))
    terms = terms.select("*", F.row_number().over(by).alias("rank")).where(F.col("rank") <= top)
    return pairs.unionByName(terms).join(name, "gid").select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (gn.n::HUGEINT + v.v) AS p
  FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
), l AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(p.n) + 1) // (max(s.n)::HUGEINT + max(v.v)) AS q
  FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS n FROM gn GROUP BY lang) s USING (lang) GROUP BY lang, term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q
), both_parts AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts
) WHERE part = 'pair' OR rank <= 200
"""
