"""Entities and relations from a model's answers.

An answer is a list of records, one a line or between ``##``, each in parentheses with its members between ``<|>``:
``("entity"<|>name<|>type<|>description)`` and ``("relationship"<|>source<|>target<|>description<|>keywords<|>weight)``, up to
``<|COMPLETE|>``. Records that can't be read are rows with a reason. Those of the same entity or pair are merged; what an edge names
and no record describes becomes a node of unknown type. Descriptions that are too long together are put into a model's words group
by group, the results again, until they are short: a tree whose groups have a bounded number of descriptions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.sources.tables import discard, once, settled

from . import graph

# Marks of the record format.
MEMBERS, RECORDS, COMPLETE = "<|>", "##", "<|COMPLETE|>"

PROMPT = (
    "Name the entities of these types: {entity_types}; and how they are related. Write one record a line:\n"
    '("entity"<|>name<|>type<|>description)\n("relationship"<|>source<|>target<|>description<|>keywords<|>weight)\n'
    "and <|COMPLETE|> at the end.\n\nText:\n{text}"
)
SUMMARY = "Put into one description what is said here of {name}:\n\n{text}"


def extraction_prompts(chunks: DataFrame, entity_types: str, template: str = PROMPT) -> DataFrame:
    """``chunks`` with column prompt."""
    return chunks.withColumn("prompt", F.replace(F.lit(template.replace("{entity_types}", entity_types)), F.lit("{text}"), F.col("content")))


def _member(x: Column) -> Column:
    """A member without white space and quotes around it."""
    return T.strip(F.btrim(T.strip(x), F.lit("\"'")))


def _bare(x: Column) -> Column:
    """A record without the parentheses around it."""
    front = F.when(x.startswith("("), F.substring(x, 2, F.lit(1 << 30))).otherwise(x)
    return F.when(front.endswith(")"), F.left(front, F.length(front) - 1)).otherwise(front)


def parse_records(answers: DataFrame, response_col: str = "response") -> DataFrame:
    """doc_id, chunk_index, chunk_id, pos (from 0), kind, name, target, type, description, keywords, weight and reason of every record;
    reason is null where it can be read. Lines without members between marks are no records."""
    text = F.split_part(T.clean_think(F.col(response_col)), F.lit(COMPLETE), F.lit(1))
    pieces = F.filter(F.split(text, r"##|\n"), lambda x: F.contains(x, F.lit(MEMBERS)))
    rows = answers.select("doc_id", "chunk_index", "chunk_id", F.posexplode(pieces).alias("pos", "raw"))
    rows = once(rows.withColumn("raw", T.strip(F.col("raw"))), "inner", _bare(F.col("raw"))).drop("raw")
    rows = once(rows, "m", F.transform(F.split("inner", r"<\|>"), _member)).drop("inner")
    at = lambda k: F.get("m", k)
    # what several members ask for is made once, too
    weight = F.when(F.size("m") > 5, at(5)).otherwise("1").try_cast("double")
    rows = once(rows, "x", F.struct(F.lower(at(0)).alias("kind"), F.size("m").alias("n"), weight.alias("weight")))
    entity, relation, n, number = F.col("x.kind") == "entity", F.col("x.kind") == "relationship", F.col("x.n"), F.col("x.weight")
    reason = (
        F.when(~entity & ~relation, "kind")
        .when(entity & (n != 4) | relation & ~n.between(5, 6), "members")
        .when((at(1) == "") | relation & (at(2) == ""), "name")
        .when(relation & (at(1) == at(2)), "loop")
        .when(relation & (number.isNull() | F.isnan(number)), "weight")
    )
    rows = once(rows, "reason", reason)
    own = lambda x, when=F.lit(True): F.when(F.col("reason").isNull() & when, x)
    return rows.select(
        "doc_id", "chunk_index", "chunk_id", "pos", F.col("x.kind").alias("kind"), own(at(1)).alias("name"), own(at(2), relation).alias("target"),
        own(F.lower(at(2)), entity).alias("type"), own(at(3)).alias("description"), own(at(4), relation).alias("keywords"), own(number, relation).alias("weight"), "reason",
    )


def _joined(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(column), F.lit("")))), T.SOURCE_SEPARATOR)


def _sources() -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"]), T.SOURCE_SEPARATOR)


def record_edges(records: DataFrame) -> DataFrame:
    """Edges as they are stored, one a document and pair: its first direction, the sum of weights, and descriptions and keywords each
    once."""
    good = graph.canonical(records.where("reason IS NULL AND kind = 'relationship'").withColumnsRenamed({"name": "source"}))
    own = good.groupBy("doc_id", "a", "b").agg(
        F.min_by(F.struct("source", "target"), F.struct("chunk_index", "pos")).alias("x"), F.sum("weight").alias("weight"), _joined("description").alias("description"),
        _joined("keywords").alias("keywords"), _sources().alias("source_id"), F.min(F.struct("chunk_index", "pos")).alias("first"),
    )
    return own.select("doc_id", "x.source", "x.target", "weight", "description", "keywords", "source_id", F.col("first.chunk_index").alias("first_chunk"), F.col("first.pos").alias("first_pos"))


def record_nodes(records: DataFrame) -> DataFrame:
    """Nodes as they are stored, one a document and name: the type that most records give it (of equals the least), descriptions
    each once; and the endpoints of edges that no record describes, of unknown type, with their edges' descriptions."""
    good = records.where("reason IS NULL")
    said = lambda name, kind: F.struct(F.col(name).alias("name"), kind.alias("type"), F.nullif("description", F.lit("")).alias("d"))
    none = F.lit(None).cast("string")
    each = F.when(F.col("kind") == "entity", F.array(said("name", F.col("type")))).otherwise(F.array(said("name", none), said("target", none)))
    both = good.select("doc_id", "chunk_index", "chunk_id", "pos", F.explode(each).alias("x")).select("doc_id", "chunk_index", "chunk_id", "pos", "x.*")
    # rows are exchanged once, for both steps: by type, and then over the types of a name, which are few
    own = both.repartition("doc_id", "name").groupBy("doc_id", "name", "type").agg(
        F.count("*").alias("n"), F.collect_set("d").alias("d"), F.collect_set(F.struct("chunk_index", "chunk_id")).alias("sources"), F.min(F.struct("chunk_index", "pos")).alias("first"),
    )
    # an edge's description counts only where no record describes the node
    named = F.col("type").isNotNull()
    own = own.groupBy("doc_id", "name").agg(
        F.min(F.when(named, F.struct((-F.col("n")).alias("n"), "type")))["type"].alias("entity_type"), F.collect_list(F.when(named, F.col("d"))).alias("said"),
        F.collect_list(F.when(~named, F.col("d"))).alias("of_edges"), F.collect_list("sources").alias("sources"), F.min("first").alias("first"),
    )
    each_once = lambda x: F.array_sort(F.array_distinct(F.flatten(x)))
    about = each_once(F.when(F.col("entity_type").isNotNull(), F.col("said")).otherwise(F.col("of_edges")))
    ids = F.transform(each_once(F.col("sources")), lambda x: x["chunk_id"])
    return own.select(
        "doc_id", F.col("name").alias("entity_id"), F.coalesce("entity_type", F.lit(graph.UNKNOWN)).alias("entity_type"), F.array_join(about, T.SOURCE_SEPARATOR).alias("description"),
        F.array_join(ids, T.SOURCE_SEPARATOR).alias("source_id"), F.col("first.chunk_index").alias("first_chunk"), F.col("first.pos").alias("first_pos"),
    )


def shortened(rows: DataFrame, by: list[str], name: Column, ask: Callable[[DataFrame], DataFrame], most_chars: int, group: int) -> DataFrame:
    """``rows`` whose descriptions, joined by the separator, are longer than ``most_chars`` with a description in a model's words.

    Each round puts ``group`` neighbouring descriptions into one prompt; ``ask`` returns its rows with columns response and error. A
    group whose call fails is cut to its share. After the logarithm of their number in rounds one description is left of each."""
    if group < 2:
        raise ValueError("a group has two descriptions at least")
    long = F.length("description") > most_chars
    keyed = rows.select(*by, name.alias("_name"), "description").where(long)
    left = settled(keyed.select(*by, "_name", F.posexplode(F.split("description", T.SOURCE_SEPARATOR)).alias("place", "d")))
    done = []
    while not left.isEmpty():
        groups = left.groupBy(*by, "_name", F.floor(F.col("place") / group).alias("place")).agg(F.array_sort(F.collect_list(F.struct("place", "d"))).alias("x"))
        texts = F.array_join(F.transform("x", lambda x: x["d"]), "\n")
        prompt = F.replace(F.replace(F.lit(SUMMARY), F.lit("{name}"), F.col("_name")), F.lit("{text}"), F.col("_text"))
        asked = groups.select(*by, "_name", "place", texts.alias("_text")).withColumn("prompt", prompt)
        said = settled(ask(asked))
        new = said.select(*by, "_name", "place", F.coalesce(F.nullif(T.strip(F.col("response")), F.lit("")), F.substring("_text", 1, max(1, most_chars // group))).alias("d"))
        new = new.withColumn("many", F.count("*").over(W.partitionBy(*by)))  # a group's share of what was there before
        one = settled(new)
        done.append(one.where("many = 1").select(*by, F.substring("d", 1, most_chars).alias("_short")))
        before, left = left, settled(one.where("many > 1").select(*by, "_name", "place", "d"))
        discard(before)
    if not done:
        return rows
    short = done[0]
    for x in done[1:]:
        short = short.unionByName(x)
    same = short.withColumnsRenamed({c: f"_{c}" for c in by})
    on = [rows[c].eqNullSafe(same[f"_{c}"]) for c in by]
    return rows.join(same, on, "left").select(*[F.coalesce("_short", "description").alias("description") if c == "description" else F.col(c) for c in rows.columns])


def stub_records(names: Column) -> Column:
    """A repeatable answer about a text with these entities: each of them, those that follow each other related, and after them an
    entity without a description and a relation whose weight is no number."""
    entity = lambda x: F.concat(F.lit('("entity"<|>'), x, F.lit("<|>Concept<|>said of "), x, F.lit(")"))
    pair = lambda a, b: F.concat(F.lit('("relationship"<|>'), a, F.lit("<|>"), b, F.lit("<|>"), a, F.lit(" beside "), b, F.lit("<|>near<|>2)"))
    follow = F.transform(F.slice(names, 1, F.greatest(F.size(names) - 1, F.lit(0))), lambda x, i: pair(x, F.get(names, i + 1)))
    odd = F.array(F.lit('("entity"<|>broken)'), F.lit('("relationship"<|>x<|>y<|>z<|>w<|>heavy)'))
    return F.concat(F.lit("<think>names</think>"), F.array_join(F.concat(F.transform(names, entity), follow, odd), "##\n"), F.lit("##\n<|COMPLETE|> ignored<|>"))
