"""Graph context of chunks: capped entities, relations and snippets in a fixed order.

Graph order is (first chunk that names a record, place in it, name). Caps are row numbers, which the planner turns into
group limits below the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.sources.tables import discard, once, settled, shares

from . import graph

KEY = ["doc_id", "chunk_index"]


def _capped(rows: DataFrame, order: list, most: int, by: list[str] = KEY, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(name) <= most)


def words(text: Column) -> Column:
    """Tokens of a line: words between white space."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda x: x != "")).cast("long")


def budgeted(rows: DataFrame, by: list[str], order: list[str], budgets: dict[int, int], total: int, section: str = "kind", tokens: str = "tokens") -> DataFrame:
    """The first ``rows`` of each section in ``order`` whose tokens together are within its budget, for each key ``by``.

    Sections come in the order of their numbers. What one leaves of its budget is the next one's too, none goes beyond what is left of
    ``total``, and sections without a budget share that. The first row that doesn't fit ends its section. All sums run in windows
    of the key, so that rows are exchanged once."""
    own = W.partitionBy(*by, section).orderBy(*order)
    rows = rows.withColumn("_sum", F.sum(tokens).over(own))
    used, left = F.lit(0).cast("long"), F.lit(0).cast("long")
    keep = F.lit(False)
    numbers = sorted(budgets)
    for k in numbers:
        allowed = F.least(F.lit(budgets[k]) + left, F.lit(total) - used)
        rows = rows.withColumn(f"_keep{k}", (F.col(section) == k) & (F.col("_sum") <= allowed))
        rows = rows.withColumn(f"_used{k}", F.coalesce(F.sum(F.when(F.col(f"_keep{k}"), F.col(tokens))).over(W.partitionBy(*by)), F.lit(0)))
        left = F.lit(budgets[k]) + left - F.col(f"_used{k}")
        used = used + F.col(f"_used{k}")
        keep = keep | F.col(f"_keep{k}")
    rest = ~F.col(section).isin(numbers) & (F.sum(F.when(~F.col(section).isin(numbers), F.col(tokens)).otherwise(0)).over(W.partitionBy(*by).orderBy(section, *order)) <= F.lit(total) - used)
    rows = rows.withColumn("_rest", rest)
    return rows.where(keep | F.col("_rest")).drop("_sum", "_rest", *(f"_{x}{k}" for x in ("keep", "used") for k in numbers))


def context_entities(found: DataFrame, most: int = 5) -> DataFrame:
    """doc_id, chunk_index, chunk_id, rank, name, line: the first ``most`` distinct entities of each chunk in graph order.

    Rows are dealt by document once; what is known of an entity in its document comes from windows there."""
    rows = found.repartition(shares(found), "doc_id").groupBy(*KEY, "chunk_id", "name").agg(F.min("pos").alias("pos"))
    of_name = W.partitionBy("doc_id", "name")
    rows = rows.withColumn("nth", F.dense_rank().over(of_name.orderBy("chunk_id")))
    rows = rows.withColumns({"n_chunks": F.max("nth").over(of_name), "first": F.min(F.struct("chunk_index", "pos")).over(of_name)})
    about = F.concat(F.lit("named in "), F.col("n_chunks").cast("string"), F.lit(" chunks"))
    out = _capped(rows, ["first", "name"], most)
    return out.select(*KEY, "chunk_id", "rank", "name", T.entity_line(F.col("name"), graph.entity_type(F.col("name")), about).alias("line"))


def context_relations(relations: DataFrame, most: int = 5) -> DataFrame:
    """doc_id, chunk_index, rank, source, target, line: the first ``most`` relations of each chunk with both endpoints."""
    pairs = graph.canonical(relations.where(T.filled(F.col("source")).isNotNull() & T.filled(F.col("target")).isNotNull())).repartition("doc_id")
    pairs = pairs.withColumn("first", F.min(F.struct("chunk_index", "pos")).over(W.partitionBy("doc_id", "a", "b")))
    rows = pairs.groupBy(*KEY, "a", "b").agg(F.min(F.struct("pos", "source", "target")).alias("x"), F.min("first").alias("first"))
    out = _capped(rows, ["first", "a", "b"], most)
    line = T.relation_line(F.col("x.source"), F.col("x.target"), F.lit(None).cast("string"), F.lit("adjacent"))
    return out.select(*KEY, "rank", F.col("x.source").alias("source"), F.col("x.target").alias("target"), line.alias("line"))


def related_chunks(entities: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, chunk_index, related_id, place: other chunks of the kept entities, by entity and then by place, each once."""
    n = shares(found)
    sources = found.repartition(n, "doc_id", "name").groupBy("doc_id", "name", "chunk_id").agg(F.min("chunk_index").alias("at"))
    rows = entities.select(*KEY, F.col("chunk_id").alias("own"), "rank", "name").join(sources, ["doc_id", "name"]).where("chunk_id <> own")
    first = rows.repartition(n, *KEY).groupBy(*KEY, F.col("chunk_id").alias("related_id")).agg(F.min(F.struct("rank", "at")).alias("first"))
    return first.withColumn("place", F.row_number().over(W.partitionBy(*KEY).orderBy("first.rank", "first.at", "related_id"))).drop("first")


def snippets(related: DataFrame, chunks: DataFrame, most: int = 2, chars: int = 200) -> DataFrame:
    """doc_id, chunk_index, place, related_id, line. A related chunk without a text still takes its place. ``chunks`` has the
    content, or its snippet already."""
    # contents of an id differ in white space at their ends only, so that snippets go through the exchange, not whole contents
    short = F.col("snippet") if "snippet" in chunks.columns else T.snippet(F.col("content"), chars)
    texts = chunks.select("doc_id", F.col("chunk_id").alias("related_id"), short.alias("snippet")).repartition(shares(chunks), "doc_id", "related_id")
    texts = texts.groupBy("doc_id", "related_id").agg(F.min("snippet").alias("snippet"))
    rows = related.where(F.col("place") <= most).join(texts, ["doc_id", "related_id"]).where("snippet IS NOT NULL")
    return rows.select(*KEY, "place", "related_id", T.snippet_line(F.col("related_id"), F.col("snippet")).alias("line"))


def chunk_contexts(chunks: DataFrame, most_entities: int = 5, most_relations: int = 5, most_snippets: int = 2, snippet_chars: int = 200, tokens: tuple[int, int, int] | None = None) -> DataFrame:
    """doc_id, chunk_index, chunk_id, content, prompt_context, related_entities, related_chunk_ids of every chunk."""
    short = settled(described(chunks, snippet_chars))
    return with_known(short.select(*KEY, "chunk_id", "content"), known_of_chunks(short, most_entities, most_relations, most_snippets, tokens))


def described(chunks: DataFrame, snippet_chars: int = 200) -> DataFrame:
    """doc_id, chunk_index, chunk_id, content of chunks, their entities e and their snippet: what contexts are made from, to be settled
    with or without the contents, so that chunks are cut and their entities and snippets taken once."""
    return once(chunks, "e", T.extract_entities(F.col("content"))).select(*KEY, "chunk_id", "content", "e", T.snippet(F.col("content"), snippet_chars).alias("snippet"))


def known_of_chunks(short: DataFrame, most_entities: int = 5, most_relations: int = 5, most_snippets: int = 2, tokens: tuple[int, int, int] | None = None) -> DataFrame:
    """What ``with_known`` adds to chunks, from the settled table ``short`` (see ``described``), as a settled table."""
    found, relations = graph.mentions(short), graph.extracted_relations(short)
    entities = settled(context_entities(found, most_entities))
    return _known(entities, context_relations(relations, most_relations), related_chunks(entities, found), short, most_snippets, tokens)


def graph_contexts(chunks: DataFrame, nodes: DataFrame, edges: DataFrame, *most, **limits) -> DataFrame:
    """As ``chunk_contexts``, from a stored graph (see ``known_of_graph``)."""
    return with_known(chunks.select(*KEY, "chunk_id", "content"), known_of_graph(chunks, nodes, edges, *most, **limits))


def known_of_graph(chunks: DataFrame, nodes: DataFrame, edges: DataFrame, most_entities: int = 5, most_relations: int = 5, most_snippets: int = 2, snippet_chars: int = 200, tokens: tuple[int, int, int] | None = None) -> DataFrame:
    """As ``known_of_chunks``, from chunks and a stored graph: ``nodes`` (entity_id or entity_name or id, entity_type, description,
    source_id) and ``edges`` (source, target, description, keywords, source_id) that name the chunks they come from. Records are
    in the order of first_chunk and first_pos where the graph has these, then of names. Chunks that the graph doesn't know
    have an empty context."""
    at = lambda rows: [F.col(c) if c in rows.columns else F.lit(0) for c in ("first_chunk", "first_pos")]
    kept = lambda rows, *names: [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names]
    own = settled(chunks.select(*KEY, "chunk_id", T.snippet(F.col("content"), snippet_chars).alias("snippet")))
    by = ["doc_id"] if "doc_id" in nodes.columns else []
    sources = graph.with_sources(nodes)
    # an id that a record names twice, as a document may hold a chunk's text twice, counts where it comes first
    known = graph.named(sources).select(*by, "chunk_id", "name", F.struct(F.struct(*at(sources)).alias("first"), "source_pos", *kept(sources, "entity_type", "description")).alias("x"))
    named = settled(known.groupBy(*by, "chunk_id", "name").agg(F.min("x").alias("x")).select(*by, "chunk_id", "name", "x.*"))
    found = own.select(*KEY, "chunk_id").join(named, [*by, "chunk_id"])
    entities = _capped(found, ["first", "name"], most_entities).select(*KEY, "chunk_id", "rank", "name", T.entity_line(F.col("name"), F.col("entity_type"), F.col("description")).alias("line"))
    entities = settled(entities)
    ends = T.filled(F.col("source")).isNotNull() & T.filled(F.col("target")).isNotNull()
    linked = graph.with_sources(edges.where(ends))
    linked = linked.select(*by, "chunk_id", "source", "target", *kept(linked, "description", "keywords"), F.struct(*at(linked), F.least("source", "target"), F.greatest("source", "target")).alias("first")).distinct()
    pairs = _capped(own.select(*KEY, "chunk_id").join(linked, [*by, "chunk_id"]), ["first", "source"], most_relations)
    pairs = pairs.select(*KEY, "rank", "source", "target", T.relation_line(F.col("source"), F.col("target"), F.col("description"), F.col("keywords")).alias("line"))
    # the other chunks of an entity, in the order in which it names them
    known = named.select(*by, "name", F.col("chunk_id").alias("related_id"), "source_pos")
    rows = entities.join(known, [*by, "name"]).where("related_id <> chunk_id")
    first = rows.groupBy(*KEY, "related_id").agg(F.min(F.struct("rank", "source_pos")).alias("first"))
    related = first.withColumn("place", F.row_number().over(W.partitionBy(*KEY).orderBy("first", "related_id"))).drop("first")
    if not by:  # ids are those of contents, so that any document's chunk of an id has the text
        texts = own.groupBy("chunk_id").agg(F.min("snippet").alias("snippet"))
        short = related.where(F.col("place") <= most_snippets).select("doc_id", "related_id").distinct().join(texts, F.col("related_id") == F.col("chunk_id")).select("doc_id", "chunk_id", "snippet")
    else:
        short = own
    known = _known(entities, pairs, related, short, most_snippets, tokens)
    discard(own)
    discard(named)
    return known


def _known(entities: DataFrame, pairs: DataFrame, related: DataFrame, short: DataFrame, most_snippets: int, tokens: tuple[int, int, int] | None = None) -> DataFrame:
    """KEY, prompt_context, related_entities and related_ids of the chunks that have any, one row a key, as a settled table.

    Lines of entities (a settled table), relations and snippets are made one after the other, so that the exchanges of one are gone
    before the next, and are dealt by chunk at once, with a list of the related chunks. ``tokens`` are the budgets of entities, of
    relations, and of all lines together."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "related_id"))), lambda x: x["related_id"])
    related = settled(related.groupBy(*KEY).agg(ids.alias("ids")))
    nearest = related.select(*KEY, F.posexplode(F.slice("ids", 1, most_snippets)).alias("at", "related_id")).select(*KEY, (F.col("at") + 1).alias("place"), "related_id")
    pairs, texts = settled(pairs), settled(snippets(nearest, short, most_snippets))
    none = F.array().cast("array<string>")
    lines = lambda rows, kind, at, line, names: rows.select(*KEY, F.lit(kind).alias("kind"), at.alias("at"), line.alias("line"), names.alias("names"))
    rows = lines(entities, 0, F.col("rank"), F.col("line"), F.array("name"))
    rows = rows.unionByName(lines(pairs, 1, F.col("rank"), F.col("line"), F.array("source", "target")))
    rows = rows.unionByName(lines(texts, 2, F.col("place"), F.col("line"), none))
    rows = rows.unionByName(lines(related, -1, F.lit(0), F.lit(None).cast("string"), F.col("ids")))
    rows = rows.repartition(shares(short), *KEY)
    if tokens:  # the list of related chunks is a section of its own, of no tokens
        counted = rows.withColumn("tokens", F.when(F.col("kind") < 0, F.lit(0).cast("long")).otherwise(words(F.col("line"))))
        rows = budgeted(counted, KEY, ["at"], {-1: 0, 0: tokens[0], 1: tokens[1]}, tokens[2]).drop("tokens")
    gathered = rows.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("kind", "at", "line", "names"))).alias("x"))
    of = lambda kept, what: F.transform(F.filter("x", kept), lambda r: r[what])
    said = lambda kind: of(lambda r: r["kind"] == kind, "line")
    known = settled(
        gathered.select(
            *KEY,
            T.prompt_context(said(0), said(1), said(2)).alias("prompt_context"),
            F.array_distinct(F.flatten(of(lambda r: r["kind"] >= 0, "names"))).alias("related_entities"),
            F.flatten(of(lambda r: r["kind"] < 0, "names")).alias("related_ids"),
        )
    )
    for table in (entities, pairs, related, texts):
        discard(table)
    return known


def with_known(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """``rows`` (doc_id, chunk_index, chunk_id and more) with prompt_context, related_entities and related_chunk_ids of their chunks.
    As ``known`` is said to have a key once, a query that selects none of them reads nothing of it."""
    none, own = F.array().cast("array<string>"), F.array("chunk_id")
    if known is None:
        return rows.withColumns({"prompt_context": F.lit(""), "related_entities": none, "related_chunk_ids": own})
    full = rows.join(known.dropDuplicates(KEY), KEY, "left")
    return full.select(
        *rows.columns,
        F.coalesce("prompt_context", F.lit("")).alias("prompt_context"),
        F.coalesce("related_entities", none).alias("related_entities"),
        F.array_distinct(F.concat(own, F.coalesce("related_ids", none))).alias("related_chunk_ids"),
    )
