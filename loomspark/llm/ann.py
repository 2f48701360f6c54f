"""Approximate nearest neighbours: stable projections in kd-trees, with a chi-square stopping test.

Vectors are scaled to length one, where the largest cosine is the smallest distance, and projected by a Gaussian (that
is 2-stable) matrix to half their dimensions, ``DIMENSIONS`` at most. The top of one kd-tree over the projections, fitted on
a bounded sample, deals all vectors into cells; each cell has a tree of its own over all its vectors (several, where it holds
more than ``SHARD``), which is built once and kept as a row of a table. A query reads a tree's leaves in the order of their boxes'
distances, takes its neighbours in order of their projected distance and verifies them on the original vectors. The squared projected distance of a pair over its squared
true distance follows a chi-square law, so a query stops at the first neighbour further out than any vector as near as its
k-th best would have shown up at with probability ``SURE``.

A query is searched in its own cell first. By the same test it then goes to those other cells only whose boxes are not too
far for the k-th best that it has found; the best k of all its cells are merged. Queries of a hot cell go in blocks. Scores
equal to 12 digits are ties, which the smaller id wins. Of vectors of the same direction only the k + 1 rows with the smallest
ids are indexed, as no other can be among the k best of any row.

Defined cases: vectors that are null, empty, of zero length or that hold null or non-finite components take no part,
neither do rows with a null id; of rows that share an id the one with the smallest vector counts; vectors of different
lengths have no cosine and are not each other's neighbours, whatever lengths there are; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import discard, settle, small_batches

#: Dimensions of a projection at most (even), vectors of a tree, of a leaf, and queries of a block.
DIMENSIONS, SHARD, LEAF, BLOCK = 32, 16_384, 32, 2048
#: Vectors on which the cells are fitted, and cells at most; a cell that holds more than ``SHARD`` vectors has several trees.
SAMPLE, CELLS = 16_384, 4096
#: Leaves that are read at first, and projected neighbours that are verified before the test is asked again.
FIRST_LEAVES, STEP = 2, 64
#: Probability with which a vector as near as the k-th best would have shown up before a query stops.
SURE = 0.9
#: Scores are ranked in whole units of this.
UNIT = 1e-12


def chi_square(x: float, dimensions: int) -> float:
    """The chi-square distribution function, for even dimensions."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(dimensions // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def chi_square_bound(p: float, dimensions: int) -> float:
    low, high = 0.0, 10.0 * dimensions + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dimensions) < p else (low, mid)
    return high


def dimensions_of(width: int) -> int:
    """An even number of dimensions, half the width where that is less than ``DIMENSIONS``."""
    return max(2, min(DIMENSIONS, width // 4 * 2))


def projection(width: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, width]).normal(size=(width, dimensions_of(width)))


def units_of(scores: np.ndarray) -> np.ndarray:
    return np.rint(scores / UNIT)


def reach_of(scores: np.ndarray | float, bound: float) -> np.ndarray | float:
    """The squared projected distance beyond which a query stops, by the cosine of its k-th best; a little more, so that what
    ties with it is not cut off by rounding."""
    return bound * (2 - 2 * scores + 4 * UNIT) + 1e-9


@dataclass
class Splits:
    """The top of a kd-tree: node i splits ``axis[i]`` at ``value[i]``; its children are 2 i + 1 and 2 i + 2."""

    depth: int
    axis: np.ndarray
    value: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, depth: int) -> "Splits":
        axis, value = np.zeros(2**depth, np.int64), np.zeros(2**depth)
        parts = {0: points}
        for node in range(2**depth - 1):
            part = parts.pop(node)
            if len(part):
                axis[node] = int((part.max(0) - part.min(0)).argmax())
                value[node] = np.median(part[:, axis[node]])
            below = part[:, axis[node]] < value[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[below], part[~below]
        return cls(depth, axis, value)

    def cells(self, points: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] >= self.value[node])
        return node - (2**self.depth - 1)


class Tree:
    """A kd-tree with its points in leaf order and the boxes and spans of its leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        depth = max(0, math.ceil(math.log2(max(1, len(points)) / leaf)))
        order, spans = np.arange(len(points)), [(0, len(points))]
        for _ in range(depth):
            halves = []
            for a, b in spans:
                part = points[order[a:b]]
                mid = (b - a) // 2
                if mid:
                    axis = int((part.max(0) - part.min(0)).argmax())
                    order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
                halves += [(a, a + mid), (a + mid, b)]
            spans = [s for s in halves if s[1] > s[0]]
        self.order, self.spans = order, np.array(spans, np.int64).reshape(-1, 2)
        self.low, self.high = (np.array([f(points[order[a:b]], axis=0) for a, b in spans]) for f in (np.min, np.max))


def box_gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to boxes (columns)."""
    out = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        p = points[:, k : k + 1]
        gap = np.maximum(np.maximum(low[None, :, k] - p, p - high[None, :, k]), 0)
        out += gap * gap
    return out


@dataclass
class Found:
    """What a query found in a tree: rows (in tree order), scores, and how many rows were verified and leaves read."""

    rows: np.ndarray
    scores: np.ndarray
    verified: int
    leaves: int


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, points: np.ndarray, queries: np.ndarray, projected: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int, bound: float) -> Iterator[tuple[int, Found]]:
    """For each query its number and the k best of a tree. ``kth`` is the score of the k-th best found elsewhere (-inf: none): what
    lies beyond its reach isn't looked at.

    Leaves are read in the order of their boxes' distances, twice as many each time; their points wait by projected distance. A point
    that no unread leaf can come before is the next projected neighbour and is verified; until there are k, so that the test has
    something to go by, the nearest of those that wait are verified too. Nothing beyond the reach of the k-th best so far is read or
    verified any more: the test is asked after each ``STEP`` points and before each leaf."""
    lanes = max(1, (1 << 20) // max(1, len(tree.spans)))
    for lo in range(0, len(queries), lanes):
        boxes = box_gaps(projected[lo : lo + lanes], tree.low, tree.high)
        for i in range(len(boxes)):
            yield lo + i, _one_search(tree, vectors, ids, points, queries[lo + i], projected[lo + i], own[lo + i], kth[lo + i], k, bound, boxes[i])


def _one_search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, points: np.ndarray, query: np.ndarray, at: np.ndarray, own: int, kth: float, k: int, bound: float, boxes: np.ndarray) -> Found:
    order = np.argsort(boxes, kind="stable")
    end = float(reach_of(kth, bound)) if np.isfinite(kth) else np.inf
    read, many, verified = 0, FIRST_LEAVES, 0
    wait_rows, wait_gaps = np.empty(0, np.int64), np.empty(0)
    best_at, best = np.empty(0, np.int64), np.empty(0)
    while True:
        if read < len(order) and boxes[order[read]] <= end:
            some = order[read : read + many]
            some = some[boxes[some] <= end]
            rows = np.concatenate([np.arange(a, b) for a, b in tree.spans[some]])
            gaps = ((points[rows] - at) ** 2).sum(1)
            wait_rows, wait_gaps = np.concatenate([wait_rows, rows]), np.concatenate([wait_gaps, gaps])
            by = np.argsort(wait_gaps, kind="stable")
            wait_rows, wait_gaps = wait_rows[by], wait_gaps[by]
            read, many = read + len(some), 2 * many
        ahead = boxes[order[read]] if read < len(order) else np.inf
        done = 0
        while done < len(wait_rows) and wait_gaps[done] <= end and (wait_gaps[done] <= ahead or len(best) < k or ahead > end):
            step = min(STEP, max(1, int(np.searchsorted(wait_gaps[done:], end, "right"))))
            rows = wait_rows[done : done + step]
            done, verified = done + len(rows), verified + len(rows)
            rows = rows[ids[rows] != own]
            best_at, best = np.concatenate([best_at, rows]), np.concatenate([best, vectors[rows] @ query])
            if len(best) > k:
                top = np.lexsort((ids[best_at], -units_of(best)))[:k]
                best_at, best = best_at[top], best[top]
            if len(best) >= k:
                end = min(end, float(reach_of(best.min(), bound)))
        wait_rows, wait_gaps = wait_rows[done:], wait_gaps[done:]
        if (read >= len(order) or boxes[order[read]] > end) and (not len(wait_rows) or wait_gaps[0] > end):
            top = np.lexsort((ids[best_at], -units_of(best)))[:k]
            return Found(best_at[top], best[top], verified, read)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array<double>, largest component one) of the rows that take part."""
    kind = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = kind.where(fine).groupBy("id").agg(F.min("v").alias("v"))
    top = F.array_max(F.transform("v", F.abs))  # what is a multiple of another becomes equal to it
    return rows.select("id", F.zip_with("v", F.array_repeat(top, F.size("v")), lambda x, t: x / t).alias("v"))


def _units(column: pd.Series) -> np.ndarray:
    out = np.stack(column.to_numpy()).astype(np.float64)
    top = np.abs(out).max(1, keepdims=True)
    out = out / top  # components may be tiny or huge
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _dealt(rows: DataFrame, main: int, splits: Splits) -> DataFrame:
    """id, width, cell and v: vectors of the width ``main`` by the splits, those of each other width in one cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            width = batch.v.map(len).to_numpy()
            cell = np.zeros(len(batch), np.int64)
            if (width == main).any():
                cell[width == main] = splits.cells(_units(batch.v[width == main]) @ projection(main))
            yield pd.DataFrame({"id": batch.id, "width": width, "cell": cell, "v": batch.v})

    return rows.select("id", "v").mapInPandas(run, "id long, width int, cell int, v array<double>")


_INDEX = "width int, cell int, part int, ids binary, vectors binary, points binary, low binary, high binary, spans binary, box_low array<double>, box_high array<double>"
_FOUND = "query_id long, vec_id long, score double, units long, verified long"


def _index(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id")
    units = _units(rows.v)
    points = units @ projection(units.shape[1])
    tree = Tree(points)
    data = {"ids": rows.id.to_numpy()[tree.order].astype(np.int64), "vectors": units[tree.order], "points": points[tree.order], "low": tree.low, "high": tree.high, "spans": tree.spans}
    return pd.DataFrame({"width": [int(key[0])], "cell": [int(key[1])], "part": [int(key[2])], **{name: [x.tobytes()] for name, x in data.items()}, "box_low": [points.min(0)], "box_high": [points.max(0)]})


def _search_block(k: int, sure: float):
    def run(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": [], "units": [], "verified": []}
        if len(index) and len(queries):
            one = index.iloc[0]
            width, dims = int(one.width), dimensions_of(int(one.width))
            read = lambda name, kind=np.float64: np.frombuffer(one[name], kind)
            ids, vectors, points = read("ids", np.int64), read("vectors").reshape(-1, width), read("points").reshape(-1, dims)
            tree = Tree.__new__(Tree)
            tree.low, tree.high, tree.spans = read("low").reshape(-1, dims), read("high").reshape(-1, dims), read("spans", np.int64).reshape(-1, 2)
            units, own = _units(queries.v), queries.id.to_numpy()
            for q, one in search(tree, vectors, ids, points, units, units @ projection(width), own, queries.kth.to_numpy(float), k, chi_square_bound(sure, dims)):
                out["query_id"] += [own[q]] * len(one.rows)
                out["vec_id"] += ids[one.rows].tolist()
                out["score"] += one.scores.tolist()
                out["units"] += units_of(one.scores).astype(np.int64).tolist()
                out["verified"] += [one.verified] * len(one.rows)
        return pd.DataFrame(out)

    return run


def _searched(index: DataFrame, asked: DataFrame, k: int, sure: float) -> DataFrame:
    """What the queries ``asked`` (id, v, kth, width, cell) find in all trees of their cells."""
    key = ["width", "cell", "part"]
    parts = settle(index.select(*key))
    asked = settle(asked.join(parts, ["width", "cell"]))
    blocks = asked.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = settle(blocks)
    tiles = index.join(blocks, key).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    asked_by = asked.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    found = settle(tiles.groupBy(*key, "block").cogroup(asked_by.groupBy(*key, "block")).applyInPandas(_search_block(k, sure), _FOUND))
    for table in (parts, asked, blocks):
        discard(table)
    return found


def _best(found: DataFrame, k: int) -> DataFrame:
    """query_id and the k best found as an array of (r, vec_id, score)."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("units")).alias("r"), "vec_id", "score")))  # k of each tree
    return found.groupBy("query_id").agg(F.slice(order, 1, k).alias("best"))


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest of each row for which ``is_query`` holds."""
    small_batches(vectors.sparkSession)
    rows = settle(usable(vectors, id_col, vector_col))
    of_copies = F.row_number().over(W.partitionBy("v").orderBy("id"))
    indexed = settle(rows.withColumn("nth", of_copies).where(F.col("nth") <= k + 1).drop("nth"))
    width = indexed.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    main, n = (width.w, width["count"]) if width else (1, 0)
    depth = min(int(math.log2(CELLS)), max(0, math.ceil(math.log2(max(1, n) / shard))))
    splits = Splits(0, np.zeros(1, np.int64), np.zeros(1))
    if depth:
        sample = indexed.where(F.size("v") == main).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
        splits = Splits.fit(_units(sample.v) @ projection(main), depth)

    dealt = settle(_dealt(indexed, main, splits))
    parts = settle(dealt.groupBy("width", "cell").agg(F.ceil(F.count("*") / shard).cast("int").alias("parts")))
    placed = dealt.join(parts, ["width", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    index = settle(placed.groupBy("width", "cell", "part").applyInPandas(_index, _INDEX))

    # its own cell, then the other ones whose boxes its k-th best still reaches
    queries = settle(_dealt(rows.where(is_query), main, splits))
    none = F.lit(float("-inf"))
    found = _searched(index, queries.withColumn("kth", none), k, sure)
    if depth:
        cells, low, high = _boxes(index.where(F.col("width") == main), dimensions_of(main))
        first = _best(found, k).select(F.col("query_id").alias("id"), F.when(F.size("best") >= k, F.element_at("best", -1)["score"]).otherwise(none).alias("kth"))
        known = queries.where(F.col("width") == main).join(first, "id", "left").select("id", "v", F.coalesce("kth", none).alias("kth"), "cell")
        asked = _routed(known, cells, low, high, main, chi_square_bound(sure, dimensions_of(main)))
        found = found.unionByName(_searched(index, asked, k, sure))
    ranked = _best(found, k).select("query_id", F.posexplode("best").alias("i", "x"))
    for table in (rows, indexed, dealt, parts, index, queries):
        discard(table)
    return ranked.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def _boxes(index: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells, at most ``CELLS``, and the boxes around the boxes of their trees."""
    each = index.select("cell", F.posexplode(F.arrays_zip("box_low", "box_high")).alias("axis", "x"))
    got = each.groupBy("cell", "axis").agg(F.min("x.box_low").alias("low"), F.max("x.box_high").alias("high")).toPandas().sort_values(["cell", "axis"])
    return got.cell.to_numpy()[::dimensions], got.low.to_numpy().reshape(-1, dimensions), got.high.to_numpy().reshape(-1, dimensions)


def _routed(known: DataFrame, cells: np.ndarray, low: np.ndarray, high: np.ndarray, width: int, bound: float) -> DataFrame:
    """A row for each query and cell, other than its own, whose box is within the reach of the query's k-th best."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            limit = np.where(np.isfinite(batch.kth), reach_of(np.where(np.isfinite(batch.kth), batch.kth, 0), bound), np.inf)
            near = box_gaps(_units(batch.v) @ projection(width), low, high) <= limit[:, None]
            near &= cells[None, :] != batch.cell.to_numpy()[:, None]
            for i in range(0, len(batch), 32):
                q, c = np.nonzero(near[i : i + 32])
                yield pd.DataFrame({"id": batch.id.to_numpy()[q + i], "v": batch.v.to_numpy()[q + i], "kth": batch.kth.to_numpy()[q + i], "width": width, "cell": cells[c]})

    return known.mapInPandas(run, "id long, v array<double>, kth double, width int, cell int")


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
