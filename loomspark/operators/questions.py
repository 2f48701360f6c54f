"""Questions from model responses: parsing, validation, fallback, record assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.sources.tables import once

#: Fixed value: how a numbered question starts and ends.
NUMBERED = r"(?s)问题(\d+)[:：]\s*(.+?)(?=\n\s*问题\d+[:：]|$)"


#: Where the next numbered question starts, and what one has; and a start without any content, after which the
#: next one belongs to it.
NEXT = r"\n\s*(?=问题\d+[:：])"
ONE = r"(?s)问题(\d+)[:：]\s*(.+)"
EMPTY = r"问题\d+[:：]\s*\n\s*问题\d+[:：]"


def numbered_questions(response: Column) -> Column:
    """Array of (number, content) of the numbered questions of a cleaned response, before validation.

    The response is split where questions start, in one pass. Only where a question has no content, so that the next start
    is its content, the expression that looks ahead from every character says what is what."""
    part = lambda p, i: F.regexp_extract(p, T.FLAGS + ONE, i)
    split = F.transform(F.split(response, T.FLAGS + NEXT), lambda p: F.struct(part(p, 1).alias("n"), part(p, 2).alias("c")))
    fast = F.filter(split, lambda x: x["n"] != "")
    pattern = F.lit(T.FLAGS + NUMBERED)
    slow = F.arrays_zip(F.regexp_extract_all(response, pattern, F.lit(1)).alias("n"), F.regexp_extract_all(response, pattern, F.lit(2)).alias("c"))
    both = F.when(response.rlike(T.FLAGS + EMPTY), slow).otherwise(fast)
    return F.transform(both, lambda x: F.struct(x["n"].cast("int").alias("number"), T.question_cleanup(x["c"]).alias("content")))


def line_questions(response: Column, most: int) -> Column:
    """Array of (number, content) of at most ``most`` accepted lines, numbered by acceptance."""
    lines = F.filter(F.transform(F.split(response, "\n"), T.strip), T.is_fallback_candidate)
    good = F.slice(F.filter(F.transform(lines, T.fallback_cleanup), T.is_valid_question), 1, most)
    return F.transform(good, lambda x, i: F.struct((i + 1).cast("int").alias("number"), x.alias("content")))


def parse_responses(responses: DataFrame, keys: list[str], response_col: str = "response", most: int = 10) -> DataFrame:
    """keys, ord (place in the response, from 0), question_index and content. Lines are looked at only where no
    numbered question was accepted; only they are capped."""
    cleaned = once(responses.select(*keys, F.col(response_col).alias("_t")), "_r", T.clean_think(F.col("_t"))).drop("_t")
    numbered = once(cleaned, "_n", numbered_questions(F.col("_r")))
    first = once(numbered, "_f", F.filter("_n", lambda x: T.is_valid_question(x["content"])))
    chosen = first.withColumn("_q", F.when(F.size("_f") > 0, F.col("_f")).otherwise(line_questions(F.col("_r"), most)))
    return chosen.select(*keys, F.posexplode("_q").alias("ord", "_x")).select(*keys, "ord", F.col("_x.number").alias("question_index"), F.col("_x.content").alias("content"))


def question_records(questions: DataFrame) -> DataFrame:
    """The records of the question file from (document_id, source_chunk_id, question_index, content, base_entities,
    base_chunk_ids). Keys of metadata that have no value are null, which the JSON writer leaves out. The random id and
    the time are added last, by ``stamped``."""
    full = lambda x: F.when(F.size(x) > 0, x)
    entities = F.array_distinct(F.concat(F.coalesce("base_entities", F.array().cast("array<string>")), T.extract_entities(F.col("content"))))
    own = F.when(T.filled(F.col("source_chunk_id")).isNotNull(), F.array("source_chunk_id")).otherwise(F.array().cast("array<string>"))
    chunks = F.array_distinct(F.concat(own, F.coalesce("base_chunk_ids", F.array().cast("array<string>"))))
    used = F.when((F.size("base_entities") > 0) | (F.size("base_chunk_ids") > 1), F.lit(True))
    meta = F.struct(
        F.lit(False).alias("has_answer"),
        T.filled(F.col("source_chunk_id")).alias("lightrag_chunk_id"),
        full(entities).alias("related_entities"),
        full(chunks).alias("related_chunk_ids"),
        used.alias("knowledge_context_used"),
    )
    return questions.select("content", F.col("document_id").alias("source_document"), "source_chunk_id", "question_index", meta.alias("metadata"))


def stamped(records: DataFrame) -> DataFrame:
    """Adds the random question id and the time, which no comparison can hold on to."""
    return records.select(F.expr("uuid()").alias("question_id"), *records.columns, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"))


def per_document_order(questions: DataFrame, key: str, order: list[str]) -> DataFrame:
    return questions.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(*order)))
