"""Ingest bookkeeping: status of documents, what is new, domains, store statistics, run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY_CHARS = 100


def doc_status(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """doc_id, status, content_length, content_summary, chunks_count and chunks_list (in order)."""
    listed = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))).alias("x")).select("doc_id", F.col("x.chunk_id").alias("chunks_list"))
    out = docs.select("doc_id", F.length("text").alias("content_length"), F.substring("text", 1, SUMMARY_CHARS).alias("content_summary")).join(listed, "doc_id", "left")
    count = F.coalesce(F.when(F.col("chunks_list").isNotNull(), F.size("chunks_list")), F.lit(0))
    return out.select("doc_id", F.when(count > 0, "processed").otherwise("empty").alias("status"), "content_length", "content_summary", count.alias("chunks_count"), "chunks_list")


def not_yet_ingested(docs: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.join(done.select(key).distinct(), key, "left_anti")


def upsert(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the rows of ``new`` in place of those with the same keys."""
    return base.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def stage_domains(stages: dict[str, DataFrame], domain_col: str = "domain") -> DataFrame:
    """stage and the sorted domains it has."""
    out = None
    for stage, rows in stages.items():
        one = rows.select(F.lit(stage).alias("stage"), F.col(domain_col).cast("string").alias("domain")).where("domain IS NOT NULL").distinct()
        out = one if out is None else out.unionByName(one)
    return out.groupBy("stage").agg(F.array_sort(F.collect_set("domain")).alias("domains"))


def store_stats(files: DataFrame) -> DataFrame:
    """Count, sorted names and megabytes of the store files of a listing (path, length)."""
    name = F.element_at(F.split("path", "/"), -1)
    own = files.select(name.alias("name"), "length").where(F.col("name").endswith(".json") | F.col("name").endswith(".graphml"))
    return own.agg(F.count("*").alias("file_count"), F.array_sort(F.collect_list("name")).alias("files"), (F.coalesce(F.sum("length"), F.lit(0)) / 1048576).alias("size_mb"))


def run_summary(steps: DataFrame) -> DataFrame:
    """From (step, ok): succeeded, total, failed steps in order."""
    return steps.agg(F.count_if("ok").alias("succeeded"), F.count("*").alias("total"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("step")))).alias("failed"))
