"""Vectors of a store's chunks, entities and relations, by the hash of what was embedded.

``sync`` compares the texts of the committed tables with those that vectors were made of: only texts whose hash has no vector yet
are embedded, whichever rows have them, and rows whose text has changed point to another vector from the next version on. It is a
batch of the store like any other; run again it finds nothing to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import models
from loomspark.functions import text as T
from loomspark.sources import store
from loomspark.sources.tables import members, settled

from . import graph


def embedded_texts(spark: SparkSession, at: str, now: store.View) -> DataFrame | None:
    """kind, id and text of what a store has vectors of: chunks, and entities and relations over all documents."""
    out = []
    chunks, nodes, edges = (store.stored(spark, at, t, now) for t in ("chunks", "nodes", "edges"))
    said = lambda c: F.array_join(F.array_sort(F.collect_set(c)), T.SOURCE_SEPARATOR)
    if chunks is not None:
        # of contents that share an id, as they differ in white space at their ends only, whichever a run finds first: the text is what the id is of
        text = F.coalesce(T.filled(T.addressed(F.col("content"))), F.col("content"))
        out.append(chunks.select(F.lit("chunk").alias("kind"), F.col("chunk_id").alias("id"), text.alias("text")))
    if nodes is not None:
        out.append(nodes.groupBy(F.col("entity_id").alias("id")).agg(said("description").alias("d")).select(F.lit("entity").alias("kind"), "id", F.concat_ws("\n", "id", "d").alias("text")))
    if edges is not None:
        pairs = graph.canonical(edges).groupBy("a", "b").agg(said("keywords").alias("k"), said("description").alias("d"))
        out.append(pairs.select(F.lit("relation").alias("kind"), F.concat("a", F.lit(T.SOURCE_SEPARATOR), "b").alias("id"), F.concat_ws("\n", "k", "a", "b", "d").alias("text")))
    if not out:
        return None
    rows = out[0]
    for x in out[1:]:
        rows = rows.unionByName(x)
    return rows


def references(spark: SparkSession, at: str, now: store.View) -> DataFrame | None:
    """kind, id and hash of the text that each row's vector is of, as the newest batch that has the row says."""
    rows = store.stored(spark, at, "vector_refs", now)
    return None if rows is None else rows.groupBy("kind", "id").agg(F.max_by("hash", F.struct("version", "hash")).alias("hash"))


def sync(spark: SparkSession, at: str, embedder: models.Embedder, dim: int, tries: int = models.EMBEDDING_TRIES) -> int:
    """Brings the vectors of the store up to its tables; returns how many texts were embedded."""
    while True:
        now = store.view(spark, at)
        rows = embedded_texts(spark, at, now)
        if rows is None:
            return 0
        hashed = rows.withColumn("hash", F.sha2(F.col("text").cast("binary"), 256))
        # texts stay where they are: of rows that share an id the one with the least hash counts
        light = hashed.groupBy("kind", "id").agg(F.min("hash").alias("hash"))
        refs = references(spark, at, now)
        if refs is not None:
            light = light.join(refs, ["kind", "id", "hash"], "left_anti")
        changed = settled(light)
        if changed.isEmpty():
            return 0
        batch = store.Batch(spark, at)
        new = changed.select("hash").distinct()
        have = store.stored(spark, at, "vectors", now)
        new = settled(new if have is None else new.join(have.select("hash"), "hash", "left_anti"))
        texts = members(hashed.select("hash", "text"), new, ["hash"]).join(new, "hash", "left_semi").dropDuplicates(["hash"])
        made = batch.write("vectors", models.embed(texts, embedder, dim, tries=tries).select("hash", "embedding"))
        batch.write("vector_refs", changed.select("kind", "id", "hash", F.lit(now.version + 1).alias("version")))
        if store.commit(spark, at, batch, now):
            return made.count()
        batch.leave()  # others came first: what they brought has vectors too, then


def vectors(spark: SparkSession, at: str, kind: str) -> DataFrame | None:
    """id and embedding of the rows of a kind."""
    now = store.view(spark, at)
    refs, have = references(spark, at, now), store.stored(spark, at, "vectors", now)
    if refs is None or have is None:
        return None
    one = have.groupBy("hash").agg(F.first("embedding").alias("embedding"))  # two writers may have made the same
    return refs.where(F.col("kind") == kind).join(one, "hash").select("id", "embedding")
