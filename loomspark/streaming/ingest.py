"""Continuous ingest: new files become chunks and status rows, each document once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomspark.operators import chunking
from loomspark.sources import store


def document_stream(spark: SparkSession, path: str) -> DataFrame:
    """document_id and text of text files as they arrive."""
    rows = spark.readStream.text(path, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True)
    return rows.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("doc_id"), F.col("value").alias("text"))


def start_ingest(documents: DataFrame, at: str, checkpoint: str, size: int = 60_000, overlap: int = 3_000) -> StreamingQuery:
    """Adds documents to the store ``at`` as they come: chunks and status; those that it has already are skipped, from
    whatever checkpoint they come again."""

    def one(batch: DataFrame, number: int) -> None:
        store.add(batch, at, lambda docs: chunking.char_chunks(docs, size, overlap), with_graph=False)

    return documents.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Events per type and window with a watermark; runs on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
