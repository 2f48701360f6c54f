"""Entity and relation tables of chunks, kept exploded: one row per mention, so that no entity gathers a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.sources.tables import once

UNKNOWN = "UNKNOWN"


def extracted(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_index, chunk_id and the entities e of each chunk in order, extracted once; chunks that have them already
    are passed on."""
    if "e" in chunks.columns:
        return chunks.select("doc_id", "chunk_index", "chunk_id", "e")
    return once(chunks, "e", T.extract_entities(F.col("content"))).select("doc_id", "chunk_index", "chunk_id", "e")


def mentions(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_index, chunk_id, name and pos (from 0) of the entities of each chunk."""
    return extracted(chunks).select("doc_id", "chunk_index", "chunk_id", F.posexplode("e").alias("pos", "name"))


def extracted_relations(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_index, chunk_id, pos, source and target: entities that follow each other in a chunk."""
    names = extracted(chunks)
    pairs = F.arrays_zip(F.slice("e", 1, F.greatest(F.size("e") - 1, F.lit(0))).alias("s"), F.slice("e", 2, F.greatest(F.size("e") - 1, F.lit(0))).alias("t"))
    return names.where(F.size("e") > 1).select("doc_id", "chunk_index", "chunk_id", F.posexplode(pairs).alias("pos", "p")).select("doc_id", "chunk_index", "chunk_id", "pos", F.col("p.s").alias("source"), F.col("p.t").alias("target"))


def canonical(relations: DataFrame) -> DataFrame:
    """Relations with their endpoints in binary order as a and b."""
    return relations.withColumns({"a": F.least("source", "target"), "b": F.greatest("source", "target")})


def entity_type(name: Column) -> Column:
    return F.when(name.rlike(r"^[A-Z]+\d"), "artifact").otherwise("concept")


def nodes(found: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per entity: type, in how many chunks, and where it is first named."""
    return found.groupBy(*by, "name").agg(F.countDistinct("chunk_id").alias("n_chunks"), F.min(F.struct("chunk_index", "pos")).alias("first")).select(*by, F.col("name").alias("entity_id"), entity_type(F.col("name")).alias("entity_type"), "n_chunks", F.col("first.chunk_index").alias("first_chunk"), F.col("first.pos").alias("first_pos"))


def edges(relations: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per undirected pair; the weight is the number of extractions merged in it."""
    return canonical(relations).groupBy(*by, "a", "b").agg(F.sum(F.lit(1.0)).alias("weight"), F.countDistinct("chunk_id").alias("n_chunks"))


def unknown_endpoints(node_rows: DataFrame, edge_rows: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Nodes for endpoints that no node row has: type UNKNOWN and an edge's description."""
    ends = edge_rows.select(*by, F.explode(F.array("a", "b")).alias("entity_id"), "description").groupBy(*by, "entity_id").agg(F.min("description").alias("description"))
    return ends.join(node_rows.select(*by, "entity_id"), [*by, "entity_id"], "left_anti").select(*by, "entity_id", F.lit(UNKNOWN).alias("entity_type"), "description")


def merged(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Texts of merged records, each distinct one once, joined by the separator in binary order."""
    return rows.groupBy(*by).agg(*[F.array_join(F.array_sort(F.collect_set(c)), T.SOURCE_SEPARATOR).alias(c) for c in columns])


def document_entities(found: DataFrame) -> DataFrame:
    """doc_id, entity_names (sorted) and count."""
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("name")).alias("entity_names")).withColumn("count", F.size("entity_names"))


def document_relations(relations: DataFrame) -> DataFrame:
    """doc_id, relation_pairs (sorted) and count."""
    pair = F.array("a", "b")
    return canonical(relations).groupBy("doc_id").agg(F.array_sort(F.collect_set(pair)).alias("relation_pairs")).withColumn("count", F.size("relation_pairs"))


def relation_chunks(relations: DataFrame) -> DataFrame:
    """doc_id, pair key, distinct chunk ids (sorted) and count."""
    key = F.concat("a", F.lit(T.SOURCE_SEPARATOR), "b")
    return canonical(relations).groupBy("doc_id", key.alias("pair")).agg(F.array_sort(F.collect_set("chunk_id")).alias("chunk_ids")).withColumn("count", F.size("chunk_ids"))


def with_sources(rows: DataFrame, source_col: str = "source_id") -> DataFrame:
    """One row per record and source chunk, from ids as the graph file joins them; records of a graph without ids have none."""
    if source_col not in rows.columns:
        rows = rows.withColumn(source_col, F.lit(None).cast("string"))
    return rows.select("*", F.posexplode(T.split_sources(F.col(source_col))).alias("source_pos", "chunk_id"))


def named(rows: DataFrame) -> DataFrame:
    """``rows`` with column name: the first of entity_id, entity_name and id that isn't empty. Rows without any are left out."""
    have = [T.filled(F.col(c).cast("string")) for c in ("entity_id", "entity_name", "id", "node_id") if c in rows.columns]
    return rows.withColumn("name", F.coalesce(*have)).where("name IS NOT NULL")


def named_nodes(rows: DataFrame, by: tuple[str, ...] = ("chunk_id",)) -> DataFrame:
    """As ``named``; of the rows of a chunk that share a name one stays."""
    return named(rows).dropDuplicates([*by, "name"])


def node_table(found: DataFrame) -> DataFrame:
    """Nodes as they are stored: by document entity_id, entity_type, description, source_id and where they first come."""
    sources = found.groupBy("doc_id", "name").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"]), T.SOURCE_SEPARATOR).alias("source_id"))
    rows = nodes(found).join(sources.withColumnRenamed("name", "entity_id"), ["doc_id", "entity_id"])
    about = F.concat(F.lit("named in "), F.col("n_chunks").cast("string"), F.lit(" chunks"))
    return rows.select("doc_id", "entity_id", "entity_type", about.alias("description"), "source_id", "first_chunk", "first_pos")


def edge_table(relations: DataFrame) -> DataFrame:
    """Edges as they are stored: by document source, target, weight, keywords, source_id and where they first come."""
    own = canonical(relations).groupBy("doc_id", "a", "b").agg(
        F.min_by(F.struct("source", "target"), F.struct("chunk_index", "pos")).alias("x"),
        F.min(F.struct("chunk_index", "pos")).alias("first"),
        F.sum(F.lit(1.0)).alias("weight"),
        F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"]), T.SOURCE_SEPARATOR).alias("source_id"),
    )
    return own.select("doc_id", "x.source", "x.target", "weight", F.lit(None).cast("string").alias("description"), F.lit("adjacent").alias("keywords"), "source_id", F.col("first.chunk_index").alias("first_chunk"), F.col("first.pos").alias("first_pos"))
