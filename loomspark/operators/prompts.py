"""Prompts for chunks and flattened chat histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as T


def chunk_prompts(chunks: DataFrame, template: str, system: str, questions_per_chunk: int, id_col: str = "doc_id") -> DataFrame:
    """``chunks`` (content, prompt_context, id) with column prompt. The system text goes in as it is, unrendered."""
    human = T.render(template, text=T.strip(F.col("content")), prompt_context=F.coalesce("prompt_context", F.lit("")), questions_per_chunk=F.lit(str(questions_per_chunk)), document_id=F.col(id_col).cast("string"))
    return chunks.withColumn("prompt", T.with_system(F.lit(system), human))


#: How turns are written out.
ROLES = (("system", "System"), ("user", "User"), ("assistant", "Assistant"))


def flatten_history(turns: DataFrame, prompt: str | Column, conv_col: str = "conv_id") -> DataFrame:
    """conv_id and prompt: the turns in order, then the new prompt; turns of other roles are left out."""
    said = None
    for role, title in ROLES:
        this = F.col("role") == role
        line = F.concat(F.lit(f"{title}: "), F.coalesce("text", F.lit("")), F.lit("\n\n"))
        said = F.when(this, line) if said is None else said.when(this, line)
    rows = turns.select(conv_col, "turn", said.alias("line"))
    joined = rows.groupBy(conv_col).agg(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("turn", "line")))).alias("x"))
    last = F.lit(prompt) if isinstance(prompt, str) else prompt
    return joined.select(conv_col, F.concat(F.array_join("x.line", ""), F.lit("User: "), last, F.lit("\n\nAssistant:")).alias("prompt"))
