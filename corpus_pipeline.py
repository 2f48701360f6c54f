"""From documents to packed training sequences, in five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
``run`` writes what a stage returns to the shared folder and gives the next one what it reads there.

Defined cases, as the operators have them: null and empty texts stay but for exact copies of each other and are one piece each;
a row with a null id is scored, deduplicated by its text, linked with nothing and packed; of rows that repeat whole one stays;
rows that share an id are each judged by their own text; empty tables give empty results (without labels nothing is toxic); more
columns of any name are passed on up to packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import exact_dedup, ngram_join, packing, secret_scan, toxicity
from loomspark.llm.common import is_held_out, settle

#: A document goes if its toxicity score is as high: what op5 predicts toxic doesn't stay.
REJECT_AT = toxicity.PREDICTED_AT
#: Distinct words of a block of packing: fewer than by itself, as executors still hold memory of the stages before.
BLOCK_WORDS = 80_000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under ``REJECT_AT`` stay; labels of the held-out fold are not learnt from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, "toxic", ~is_held_out("doc_id", 4, 2))
    return toxicity.drop_toxic(docs, model, at_least=REJECT_AT)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles of Jaccard similarity 0.8 or more the one with the smallest doc_id stays."""
    return ngram_join.drop_near_copies(docs, words=5, percent=80)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    clean = secret_scan.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), block_words=BLOCK_WORDS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("secret_scan", secret_scan_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a genetic algorithm have no SQL; tests hold the run against a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
