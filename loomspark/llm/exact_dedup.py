"""Exact dedup by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

Rows whose length no other row has are done at the first step; of the others those whose prefix hash no row of the same
length shares at the second; only texts of groups that survive both are read again and hashed as a whole. Texts never
travel in these steps: the exchanges carry lengths and hashes. Two rows of text with equal SHA-256 and equal length count
as equal.

Defined cases: a null text is an empty one; empty texts are equal to each other; a null id takes part like any
other and is larger than every id when the row that stays is chosen; rows that share an id count as often as
they occur and get one result each (of those that also share their text ``drop_copies`` leaves one); an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import discard, fresh, member_gate, settle, without

#: Characters of the prefix whose hash is the second step.
PREFIX_CHARS = 256


def normalised(text: str | Column) -> Column:
    """The text with each run of ASCII white space as one space."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _first(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """id, len, head (and ``more`` of the normalised text t) of every row."""
    base = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("t"))
    return settle(base.select("id", F.length("t").alias("len"), F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("head"), *more))


def _alive(first: DataFrame) -> DataFrame:
    """len and head that rows share: of the lengths that rows share the prefix hashes that rows share."""
    lengths = settle(first.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len"))
    heads = first.join(lengths, "len", "left_semi").groupBy("len", "head").agg(F.count("*").alias("n"))
    return settle(heads.where("n > 1").select("len", "head"))


def _groups(full: DataFrame) -> DataFrame:
    """len, sha, keep_id and group_size of the texts that rows share; a table of its own, so that both sides of a join with it
    are read as they are and a hot group can be split."""
    return settle(full.groupBy("len", "sha").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))


def _survivors(docs: DataFrame, first: DataFrame, alive: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, len, head, sha of the rows that share length and prefix hash: a bit map of their ids, of fixed size, decides which
    texts are read as a whole, and a join which of these count."""
    left = first.join(alive, ["len", "head"], "left_semi").select("id")
    base = member_gate(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), left, ["id"], bits=24)
    again = base.select("id", normalised("text").alias("t"))
    hashed = again.select("id", F.length("t").alias("len"), F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("head"), F.sha2("t", 256).alias("sha"))
    return settle(hashed.join(alive, ["len", "head"], "left_semi"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, keep_id (the smallest id of its group), group_size, kept.

    With ``digest`` each row also has ``text_sha256`` of its normalised text: as all texts are asked for their hash, they are
    hashed in the first pass, and the steps say which hashes are compared.
    """
    if digest:
        first = _first(docs, id_col, text_col, F.sha2("t", 256).alias("sha"))
        alive = _alive(first)
        groups = _groups(first.join(alive, ["len", "head"], "left_semi"))
        out = first.join(groups, ["len", "sha"], "left")
    else:
        first = _first(docs, id_col, text_col)
        alive = _alive(first)
        full = _survivors(docs, first, alive, id_col, text_col)
        groups = _groups(full)
        none = F.lit(None).cast("long")
        single = first.join(alive, ["len", "head"], "left_anti").select("id", F.col("id").alias("keep_id"), none.alias("group_size"))
        out = full.join(groups, ["len", "sha"], "left").select("id", "keep_id", "group_size").unionByName(single)
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return out.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        *([F.col("sha").alias("text_sha256")] if digest else []),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of rows of equal texts one with the smallest id, with all its columns; of those that share this id too, any one.

    Rows are told apart by id and the hash of the whole text. Of the texts only those are exchanged whose ids are in a bit map
    of what goes, where the list of that is too large to broadcast."""
    first = _first(docs, id_col, text_col)
    alive = _alive(first)
    full = _survivors(docs, first, alive, id_col, text_col)
    groups = _groups(full)
    copies = full.join(groups, ["len", "sha"]).select("id", "sha", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))
    odd = settle(copies.groupBy("id", "sha", "kept").agg(F.count("*").alias("n")).where("NOT kept OR n > 1"))
    for table in (first, alive, full, groups):
        discard(table)
    (sha,) = fresh(docs, "_text_sha")
    made = {sha: F.sha2(normalised(text_col), 256)}
    named = lambda df: df.select(F.col("id").alias(id_col), F.col("sha").alias(sha))
    rest = without(docs, named(odd), [id_col, sha], made)
    if not odd.where("kept").isEmpty():  # what stays of several rows that are alike
        again = named(odd.where("kept")).select(F.col(id_col).alias("_same_id"), F.col(sha).alias("_same_sha"))
        near = member_gate(docs, odd.where("kept").select(F.col("id").alias(id_col)), [id_col]).withColumns(made)
        alike = near.join(again, near[id_col].eqNullSafe(again["_same_id"]) & (near[sha] == again["_same_sha"]), "left_semi")
        rest = rest.unionByName(alike.dropDuplicates([id_col, sha]).select(*docs.columns))
    return rest


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"), digest=True)


OP8_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM t)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM h
"""
