"""Quality classifier: random Fourier features, ridge regression by normal equations, isotonic calibration.

Statistics of a document (lengths, shares of character classes, repetition, entropy) are standardised and mapped to
random Fourier features, whose inner products approximate a Gaussian kernel. Each partition of the training rows sums
its part of the normal equations, one task adds up the parts, and the driver solves for the ridge weights. Scores are
calibrated by isotonic regression on labelled rows kept apart.

It is fitted on at most ``TRAIN_ROWS`` labelled rows; scoring reads every row once and shuffles nothing.

Defined cases: null and empty texts are scored by the statistics of an empty text; without labels of both classes
every score is the share of label 1 (0.5 without any); rows that repeat and null ids each have a result; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.sources.tables import read_table

from .common import discard, is_held_out, labelled_sample, settle, slices, small_batches

#: Labelled rows that the classifier learns from, at most; Fourier features; ridge.
TRAIN_ROWS, FEATURES, RIDGE = 20_000, 256, 1e-2

_CLASS = np.zeros((256, 8))
for _i, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), range(128, 256), (32,), (10,), b".,;:?'\"()-", b"!#$%&*+/<=>@[\\]^_`{|}~")):
    _CLASS[list(_chars), _i] = 1.0


def statistics(text: str) -> list[float]:
    """The statistics of one document; zeros for an empty one."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * 20
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(np.float64)
    share = counts / len(data)
    classes = share @ _CLASS
    seen = share[share > 0]
    tally = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        (len(data) - counts[[9, 10, 11, 12, 13, 32]].sum()) / len(words),
        *classes.tolist(),
        float(-(seen * np.log2(seen)).sum()),
        len(tally) / len(words) ** 0.75,
        max(tally.values()) / len(words),
        sum(v for v in tally.values() if v > 1) / len(words),
        len(set(lines)) / len(lines),
        np.log1p(len(data) / len(lines)),
        (counts[46] + counts[33] + counts[63]) / len(words),
        counts[44] / len(words),
        1.0,
    ]


@dataclass
class Model:
    mean: np.ndarray
    std: np.ndarray
    spread: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    prior: float

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8) @ self.spread + self.phase
        return np.hstack([np.cos(z) * (2 / len(self.phase)) ** 0.5, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), self.prior)
        raw = self.raw(x)
        # a small slope keeps the order of rows that calibration ties
        return np.clip(0.998 * np.interp(raw, self.knots, self.values) + 0.002 / (1 + np.exp(-np.clip(4 * raw - 2, -30, 30))), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the non-decreasing fit by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + top[0], blocks[-1][1] + top[1], blocks[-1][2] + top[2]]
    return np.array([b[2] / b[1] for b in blocks]), np.array([(b[0] + 0.5 * (i > 0)) / (b[1] + (1.0 if i > 0 else 0.5)) if len(blocks) > 1 else b[0] / b[1] for i, b in enumerate(blocks)])


def _statistics_of(sample: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array([list(map(float, statistics(x))) for x in texts], pa.list_(pa.float64()))], names=["id", "y", "x"])

    return sample.mapInArrow(rows, sample.select("id", "y").schema.add("x", T.ArrayType(T.DoubleType())))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(docs: DataFrame, labels: DataFrame, label: str, learn, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_ROWS, seed: int = 7) -> Model:
    small_batches(docs.sparkSession)
    known = settle(_statistics_of(labelled_sample(docs, labels, label, learn, most, id_col, text_col)))
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    width = len(statistics(""))
    rng = np.random.default_rng(seed)
    moments = known.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v"), F.stddev_pop("v")).collect() if n else []
    mean, std = np.zeros(width), np.ones(width)
    for i, m, s in moments:
        mean[i], std[i] = m, max(s, 1e-6)
    model = Model(mean, std, rng.normal(size=(width, FEATURES)) / (width**0.5 * 0.7), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.empty(0), np.empty(0), ones / n if n else 0.5)
    if not 0 < ones < n:
        return model
    apart = F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(4)) == 0
    balance = n / (2 * ones), n / (2 * (n - ones))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            z, y = model.features(_matrix(batch.column("x"))), batch.column("y").to_numpy().astype(np.float64)
            w = np.where(y > 0, *balance)[:, None]
            a += z.T @ (w * z)
            b += z.T @ (w[:, 0] * y)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((FEATURES + 1) ** 2), np.zeros(FEATURES + 1)
        for batch in batches:
            for x, y in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = a + np.frombuffer(x.as_py()), b + np.frombuffer(y.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])

    # partitions sum their rows, one task sums the partitions' sums, the driver gets one row
    parts = known.where(~apart).mapInArrow(sums, "a binary, b binary")
    whole = parts.repartition(1).mapInArrow(added, "a binary, b binary").first()
    a, b = np.frombuffer(whole.a).reshape(FEATURES + 1, -1), np.frombuffer(whole.b)
    model.weights = np.linalg.solve(a + RIDGE * n / 1000 * np.eye(len(b)), b)
    held = known.where(apart).select("x", "y").toPandas()  # a quarter of the bounded sample
    if held.y.nunique() < 2:
        held = known.select("x", "y").toPandas()
    discard(known)
    model.knots, model.values = isotonic(model.raw(np.stack(held.x)), held.y.to_numpy().astype(float))
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = source.select(id_col).schema.add("score", "double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(np.array([statistics(x) for x in texts])), pa.float64())], names=schema.names)

    return source.mapInArrow(rows, schema)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = is_held_out("doc_id", 3, 1)
    scored = score_documents(docs, fit(docs, labels, "quality", ~held))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
