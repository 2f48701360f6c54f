"""Chunking: overlapping windows of characters or of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.config import Chunking
from loomspark.functions import text as T
from loomspark.functions.models import Tokenizer, load_tokenizer
from loomspark.sources.tables import once


def chunks_of(docs: DataFrame, settings: Chunking, id_col: str = "doc_id", text_col: str = "text", tokenizer: Tokenizer | None = None) -> DataFrame:
    """Windows of tokens where the settings ask for them and there is a tokenizer, else of characters. Blank texts have none."""
    c = settings
    if c.use_token_chunking:
        tokenizer = tokenizer or load_tokenizer(c.tokenizer_file, c.tokenizer_pattern)
        if tokenizer is not None:
            return token_chunks(docs, tokenizer, c.chunk_token_size, c.chunk_overlap_token_size, id_col, text_col)
    return char_chunks(docs, c.max_chunk_size, c.overlap_size, id_col, text_col)


def char_chunks(docs: DataFrame, size: int = 60_000, overlap: int = 3_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per window: id, chunk_id, content, start_position, end_position, chunk_index, total_chunks.

    The number of windows is known from the length alone, so windows are generated without a loop. Blank texts have none.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap has to be smaller than size")
    step = size - overlap
    text = docs.select(F.col(id_col), F.col(text_col).alias("_t")).where(T.strip(F.coalesce(F.col(text_col), F.lit(""))) != "").withColumn("_n", F.length("_t"))
    # one pass cuts the text into steps; a window is a step and what follows it, so that none counts from the text's start
    steps = F.when(F.col("_n") <= size, F.array("_t")).otherwise(F.regexp_extract_all("_t", F.lit(f"(?s).{{1,{step}}}"), F.lit(0)))
    total = F.when(F.col("_n") <= size, 1).otherwise(1 + F.ceil((F.col("_n") - size) / step)).cast("int")
    cut = once(text, "_s", steps).drop("_t").withColumn("total_chunks", total)
    window = lambda i: F.substring(F.array_join(F.slice("_s", i + 1, F.lit(-(-size // step))), ""), 1, size)
    windows = cut.select(id_col, "_n", "total_chunks", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("total_chunks") - 1), window)).alias("chunk_index", "content"))
    start = F.col("chunk_index") * step
    out = windows.select(id_col, "content", start.alias("start_position"), F.least(start + size, F.col("_n")).alias("end_position"), "chunk_index", "total_chunks")
    fallback = F.concat(F.col(id_col).cast("string"), F.lit("_chunk_"), F.col("chunk_index").cast("string"))
    return out.withColumn("chunk_id", F.coalesce(T.chunk_id(F.col("content")), fallback))


def token_chunks(docs: DataFrame, tokenizer: Tokenizer, size: int = 1200, overlap: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows of tokens of an injected tokenizer; contents are stripped and empty ones dropped, positions are exact."""
    if not 0 <= overlap < size:
        raise ValueError("overlap has to be smaller than size")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch.id, batch.text, strict=True):
                spans = tokenizer.spans(text or "")
                found, at = [], 0
                while at < len(spans):
                    a, b = spans[at][0], spans[min(at + size, len(spans)) - 1][1]
                    content = text[a:b].strip()
                    if content:
                        a += len(text[a:b]) - len(text[a:b].lstrip())
                        found.append((content, a, a + len(content)))
                    if at + size >= len(spans):
                        break
                    at += size - overlap
                out += [(key, c, a, b, i, len(found)) for i, (c, a, b) in enumerate(found)]
            yield pd.DataFrame(out, columns=["id", "content", "start_position", "end_position", "chunk_index", "total_chunks"])

    out = source.mapInPandas(rows, f"id {kind}, content string, start_position int, end_position int, chunk_index int, total_chunks int")
    return out.withColumn("chunk_id", T.chunk_id(F.col("content"))).withColumnRenamed("id", id_col)
