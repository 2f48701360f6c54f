"""Vector operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import settled

#: Vectors and queries of a block.
VECTORS, QUERIES = 4096, 1024


def fit_dimension(vector: Column, dim: int) -> Column:
    """The vector cut or padded with zeros to ``dim`` components; null becomes zeros."""
    kind = "array<double>"
    zeros = F.array_repeat(F.lit(0.0), dim)
    return F.slice(F.concat(F.coalesce(vector.cast(kind), F.array().cast(kind)), zeros), 1, dim)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows (id, v, norm) packed into blocks of about ``size``: width, block, ids and matrix; vectors of a width together."""
    counts = settled(rows.groupBy(F.size("v").alias("width")).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks")))
    dealt = rows.withColumn("width", F.size("v")).join(counts, "width").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"width": [key[0]], name: [key[1]], f"{name}_ids": [part.id.to_numpy(np.int64)], f"{name}_rows": [(np.stack(part.v.to_numpy()) / part.norm.to_numpy()[:, None]).tobytes()]})

    return settled(dealt.groupBy("width", "block").applyInPandas(pack, f"width int, {name} int, {name}_ids array<long>, {name}_rows binary"))


def cosine_top_k(queries: DataFrame, vectors: DataFrame, k: int, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, id and score of the k nearest by cosine of at least ``threshold``, the query itself left out.

    ``queries`` is a stated set; it meets all vectors of its width in blocks, a matrix product for each pair of blocks, which
    gives k rows a query at most.
    """
    value = F.col(vector_col).cast("array<double>")
    scaled = lambda df: df.select(F.col(id_col).cast("long").alias("id"), value.alias("v"), F.sqrt(dot(value, value)).alias("norm")).where("norm > 0")
    q, v = _blocks(scaled(queries), QUERIES, "q"), _blocks(scaled(vectors), VECTORS, "v")

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tile in batch.itertuples():
                a, b = (np.frombuffer(x, np.float64).reshape(-1, tile.width) for x in (tile.q_rows, tile.v_rows))
                ids = np.asarray(tile.v_ids)
                scores = a @ b.T
                for at, own in enumerate(np.asarray(tile.q_ids).tolist()):
                    row = scores[at]
                    some = np.flatnonzero((row >= threshold) & (ids != own))
                    if len(some) > k:
                        least = np.partition(row[some], len(some) - k)[len(some) - k]
                        some = some[row[some] >= least]  # ties with the last one too
                    some = some[np.lexsort((ids[some], -row[some]))[:k]]
                    yield pd.DataFrame({"query_id": own, "id": ids[some], "score": row[some]})

    # each query block meets the vector blocks of its width one by one, so that the pairs are dealt by vector block
    many = v.groupBy("width").agg(F.max("v").alias("last"))
    pairs = q.join(F.broadcast(many), "width").withColumn("v", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
    found = pairs.join(v, ["width", "v"]).mapInPandas(best, "query_id long, id long, score double")
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("r"), "id", "score")))
    top = found.groupBy("query_id").agg(F.slice(order, 1, k).alias("x")).select("query_id", F.posexplode("x").alias("i", "x"))
    return top.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), "x.score")
