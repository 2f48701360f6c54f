"""Toxicity: a support vector machine over a gappy subsequence kernel with Nystrom landmarks.

The kernel of two words sums over the subsequences of three characters that they share, each weighted by a decay per
character that its occurrence skips; word edges are characters too. Inserted or changed characters therefore lower
the kernel only a little. Landmarks are words from labelled sentences: pivoted Cholesky picks the varied ones among
those that mark toxic sentences, and frequent ones stand for the rest. The machine is trained on the kernel with the
landmarks (Nystrom features), each word once for either label, weighted by the root of that label's documents it is
in; each round adds the words of non-toxic sentences that it takes for toxic. As every
Nystrom feature is linear in the subsequence weights, the decision function folds into one weight per subsequence,
so that a word costs the same whatever the number of landmarks. Runs of single characters ("i d i o t") also count as
a word. A logistic fit on labelled documents kept apart turns the decisions of a text's words (the largest ones and
how many are positive) into its score.

It is fitted on at most ``TRAIN_ROWS`` labelled documents; scoring reads every row once and shuffles nothing.

Where no word marks toxic sentences beyond chance, as with few labels or insults that are each spelt differently, the most
surprising words stand in for those that do, as far as they are like each other.

Defined cases: null and empty texts have the lowest score; without labels of both classes, or without any word that is
more frequent in toxic sentences, every score is the share of label 1 (0 without any); rows that repeat and null ids each have
a result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.sources.tables import read_table

from .common import discard, fresh, give_back, is_held_out, labelled_sample, settle, slices, small_batches

#: Labelled documents that the classifier learns from, at most; landmarks of toxic and of other words.
TRAIN_ROWS, TOXIC_LANDMARKS, OTHER_LANDMARKS = 12_000, 128, 64
#: Words that the machine is fitted on, at most: marking toxic sentences, usual in others, taken for toxic by mistake
#: (a round); marking words among which varied landmarks are sought. Scoring looks at all words.
SURE_WORDS, USUAL_WORDS, HARD_WORDS, VARIED_AMONG = 4000, 3000, 2000, 1500
#: With fewer labelled documents kept apart only the largest decisions count, not how many there are.
ENOUGH = 300
#: Documents that a word has to be in to tell anything, where any word reaches the bound of chance.
LEAST_DOCUMENTS = 3
#: Weight of a skipped character, the widest span of a subsequence, and the characters of a word looked at together.
DECAY, SPAN, LONGEST = 0.6, 6, 24
#: A text counts as toxic if its score is as high.
PREDICTED_AT = 0.3
#: Words whose decisions a task keeps.
KEPT = 300_000

_LIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e"})
_EDGES = re.compile(r"^[^\w@$!|€]+|[^\w@$]+$")
_SPACED = re.compile(r"(?<!\S)(?:[^\W_][\s.*_-]{1,2}){3,}[^\W_](?!\S)")
ALPHABET = 64  # 0 is no character of a word, 1 and 2 are its edges, 3 to 28 are a to z, the others share the rest
_CODES = np.zeros(0x10000, np.uint8)
for _c in range(0x10000):
    _s = chr(_c)
    if "a" <= _s <= "z":
        _CODES[_c] = 3 + _c - 97
    elif _s.isalpha():
        _CODES[_c] = 29 + _c * 7919 % (ALPHABET - 29)
_CODES[1], _CODES[2] = 1, 2
_STEPS = [(i, j) for i in range(1, SPAN - 1) for j in range(1, SPAN - i)]


def plain(word: str) -> str:
    """A word without what surrounds it, look-alikes as letters."""
    out = _EDGES.sub("", word)
    return out if out.isalpha() else out.translate(_LIKE)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, n) arrays of the subsequence at each occurrence (0: none, no word has it) and of its weight, and each
    word's norm: the root of its squared occurrence weights. Scaling words by any norm of their own keeps a kernel a
    kernel, and this one needs no search for subsequences that occur twice."""
    marked = ["\x01" + w[:LONGEST] + "\x02" for w in words]
    width = max(map(len, marked), default=3)
    text = "".join([w.ljust(width, "\0") for w in marked])
    codes = _CODES[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)].reshape(len(words), width).astype(np.int32)
    some = codes > 0
    found, weight = [], []
    for i, j in _STEPS:
        if i + j < width:
            whole = some[:, : width - i - j] & some[:, i : width - j] & some[:, i + j :]
            key = (codes[:, : width - i - j] * ALPHABET + codes[:, i : width - j]) * ALPHABET + codes[:, i + j :]
            found.append(key * whole)
            weight.append(whole * np.float32(DECAY ** (i + j - 2)))
    found, weight = np.hstack(found), np.hstack(weight)
    return found, weight, np.sqrt(np.maximum(np.einsum("ij,ij->i", weight, weight), 1e-12))


def _decide(words: list[str], weights: np.ndarray) -> np.ndarray:
    found, weight, norm = subsequences(words)
    return np.einsum("ij,ij->i", weights[found], weight) / norm


def _dense(words: list[str]) -> np.ndarray:
    """Scaled subsequence vectors over the subsequences that the words have; for a bounded list of words."""
    found, weight, norm = subsequences(words)
    keys, at = np.unique(found, return_inverse=True)
    out = np.zeros((len(words), len(keys)))
    np.add.at(out, (np.repeat(np.arange(len(words)), found.shape[1]), at.reshape(-1)), weight.reshape(-1))
    return out / norm[:, None]


def words_of(text: str) -> set[str]:
    low = text.lower()
    parts = low.split()
    words = set(parts)
    if sum(len(w) == 1 for w in words) >= 2:
        words.update("".join(c for c in m if c.isalnum()) for m in _SPACED.findall(low))
    return words


def pieces(word: str) -> list[str]:
    """A long word in overlapping parts."""
    return [word] if len(word) <= LONGEST else [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


#: Summary of a text without words.
NOTHING = (-3.0, -3.0, -3.0, 0.0, 0.0, 0.0, 0.0)


@dataclass
class Model:
    weights: np.ndarray | None  # one per subsequence
    offset: float
    prior: float
    logistic: np.ndarray | None = None  # of a text's summary; the last one is the constant

    def decisions(self, words: list[str]) -> np.ndarray:
        parts = [pieces(plain(w)) for w in words]
        flat = [p for x in parts for p in x]
        order = sorted(range(len(flat)), key=lambda i: len(flat[i]))  # words of like length share a width
        got = np.empty(len(flat), np.float32)
        for i in range(0, len(order), 4096):
            some = order[i : i + 4096]
            got[some] = _decide([flat[k] for k in some], self.weights)
        ends = np.cumsum([len(x) for x in parts])
        return np.maximum.reduceat(got, np.append(0, ends[:-1])) - self.offset

    def summaries(self, texts: Iterable[str], kept: dict[str, float]) -> list[list[float]]:
        """Of each text the three largest decisions, how many pass two bounds, and how many there are."""
        each = [words_of(x) for x in texts]
        new = list({w for x in each for w in x if w not in kept})
        if len(kept) + len(new) > KEPT:
            kept.clear()
            new = list({w for x in each for w in x})
        if new:
            kept.update(zip(new, self.decisions(new).tolist(), strict=True))
        out = []
        for x in each:
            if not x:
                out.append(list(NOTHING))
                continue
            d = np.fromiter(map(kept.__getitem__, x), np.float32, len(x))
            top = np.sort(d if len(d) <= 3 else np.partition(d, len(d) - 3)[-3:])[::-1]
            top = np.append(top, [-3.0, -3.0])[:3]
            some, many = int((d > 0).sum()), int((d > 0.5).sum())
            out.append([*np.clip(top, -3, 3).tolist(), np.log1p(some), np.log1p(many), np.log1p(len(d)), some / len(d)])
        return out

    def score(self, summaries: np.ndarray) -> np.ndarray:
        if self.logistic is None:
            return np.full(len(summaries), self.prior)
        return 1 / (1 + np.exp(-np.clip(summaries @ self.logistic[:-1] + self.logistic[-1], -30, 30)))


def _vocabulary(sample: DataFrame) -> DataFrame:
    """word, and in how many toxic and other sample documents it is."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out = [(p, y) for x, y in zip(texts, part.column("y").to_pylist(), strict=True) for p in {p for w in words_of(x) for p in pieces(plain(w))}]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([y for _, y in out], pa.int32())], names=["word", "y"])

    return sample.mapInArrow(rows, "word string, y int").where("word <> ''").groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))


def _alike(sure: pd.DataFrame, usual: pd.DataFrame) -> pd.DataFrame:
    """The rows of ``sure`` whose words are more like each other than nearly all usual ones are, the most alike first."""
    if not len(sure) or not len(usual):
        return sure
    weights = np.zeros(ALPHABET**3)
    for words, sign in ((sure.word, 1), (usual.word, -1)):
        found, weight, norm = subsequences(words.tolist())
        weights += sign * np.bincount(found.reshape(-1), (weight / norm[:, None]).reshape(-1), ALPHABET**3) / len(words)
    weights[0] = 0
    least = np.quantile(_decide(usual.word.tolist(), weights), 0.95)
    sure = sure.assign(like=_decide(sure.word.tolist(), weights)).sort_values(["like", "word"], ascending=[False, True])
    return (sure[sure.like > least] if (sure.like > least).any() else sure).drop(columns="like").reset_index(drop=True)


def _pivots(vectors: np.ndarray, most: int) -> list[int]:
    """Pivoted Cholesky: each next pivot is the word that those before it represent least."""
    left, basis, out = np.square(vectors).sum(1), np.zeros((len(vectors), 0)), []
    for _ in range(min(most, len(vectors))):
        at = int(left.argmax())
        if left[at] < 1e-3:
            break
        column = (vectors @ vectors[at] - basis @ basis[at]) / left[at] ** 0.5
        basis = np.hstack([basis, column[:, None]])
        left = np.maximum(left - column**2, 0)
        left[at] = 0
        out.append(at)
    return out


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Newton steps on its support vectors."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    keep = np.eye(x1.shape[1]) * ridge
    keep[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        inside = y * (x1 @ w) < 1
        c = cost[inside, None] * x1[inside]
        new = np.linalg.solve(keep + c.T @ x1[inside], c.T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], float(-w[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str, learn, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_ROWS, rounds: int = 3) -> Model:
    small_batches(docs.sparkSession)
    sample = settle(labelled_sample(docs, labels, label, learn, most, id_col, text_col))
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    none = Model(None, 0.0, ones / n if n else 0.0)
    if not 0 < ones < n:
        return none
    apart = F.pmod(F.xxhash64(F.col("id"), F.lit(3)), F.lit(4)) == 0
    n_toxic, n_other = (max(1, x) for x in sample.where(~apart).agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first())
    rates = {"rt": F.col("toxic") / n_toxic, "rn": F.col("other") / n_other}
    # n times the divergence of a word's toxic share from the overall one: the logarithm of how unlikely chance makes it
    both, share = F.col("toxic") + F.col("other"), n_toxic / (n_toxic + n_other)
    part = lambda x, of: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / both / of)).otherwise(0.0)
    surprise = part("toxic", share) + part("other", 1 - share)
    vocabulary = settle(_vocabulary(sample.where(~apart)).withColumns(rates).withColumn("surprise", surprise).repartition(16))
    # a word marks toxic texts if by chance not even one of all words would surprise as much
    n_words = vocabulary.where(both >= LEAST_DOCUMENTS).count()
    marks_toxic = f"toxic >= {LEAST_DOCUMENTS} AND surprise >= {float(np.log(max(n_words, 10)))} AND rt >= 2.5 * rn"
    sure = vocabulary.where(marks_toxic).orderBy(F.desc("surprise"), "word").limit(SURE_WORDS).toPandas()
    usual = vocabulary.where("rt < 1.5 * rn").orderBy(F.desc("other"), "word").limit(USUAL_WORDS).toPandas()
    if not len(sure):  # few labels, or each spelling in few documents
        marks_toxic = "rt >= 2.5 * rn"
        sure = vocabulary.where(marks_toxic).orderBy(F.desc("surprise"), F.xxhash64("word"), "word").limit(SURE_WORDS).toPandas()
        sure = _alike(sure, usual)
    if not len(sure):
        return none
    rest = vocabulary.where(f"other > 0 AND NOT ({marks_toxic})")

    marks = sure.word.head(VARIED_AMONG).tolist()
    varied = [marks[i] for i in _pivots(_dense(marks), TOXIC_LANDMARKS // 2)]
    landmarks = list(dict.fromkeys(marks[: TOXIC_LANDMARKS // 2] + varied)) + usual.word.head(OTHER_LANDMARKS).tolist()
    found, weight, norm = subsequences(landmarks)
    keys = np.unique(found[found > 0])  # only what landmarks have counts; column 0 is for all else
    column = np.zeros(ALPHABET**3, np.int32)
    column[keys] = np.arange(1, len(keys) + 1)
    table = np.zeros((len(landmarks), len(keys) + 1))
    for i in range(len(landmarks)):
        np.add.at(table[i], column[found[i]], weight[i])
    table[:, 0] = 0
    table /= norm[:, None]
    values, vectors = np.linalg.eigh(table @ table.T)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T

    def kernel(words: list[str]) -> np.ndarray:
        out = []
        for i in range(0, len(words), 512):
            found, weight, norm = subsequences(words[i : i + 512])
            at = column[found]
            out.append(np.stack([np.einsum("ij,ij->i", row[at], weight) for row in table], 1) / norm[:, None])
        return np.concatenate(out)

    columns = ["word", "toxic", "other"]
    sure["sure"], usual["sure"] = True, False
    words = pd.concat([sure[[*columns, "sure"]], usual[[*columns, "sure"]]]).drop_duplicates("word")
    model = none
    for turn in range(rounds):
        x = kernel(words.word.tolist()) @ root
        x = np.vstack([x, x])
        y = np.append(np.ones(len(words)), -np.ones(len(words)))
        # roots, so that neither a few very frequent words nor very many rare ones decide alone; what no document of
        # the sample shows is still possible
        toxic, other = words.toxic.to_numpy(float), words.other.to_numpy(float) * n_toxic / n_other
        cost = np.append(np.sqrt(np.where(words.sure, toxic, 0.002 * toxic)), np.sqrt(other) + 0.05)
        for sign in (1, -1):
            cost[y == sign] *= 2000 / cost[y == sign].sum()
        w, offset = _machine(x, y, cost, 0.2)
        weights = np.zeros(ALPHABET**3, np.float32)
        weights[keys] = ((root @ w) @ table)[1:]
        model = Model(weights, offset, ones / n)
        if turn + 1 < rounds:

            def rows(batches: Iterator[pd.DataFrame], model: Model = model) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    yield batch.assign(d=model.decisions(batch.word.tolist()))

            hard = rest.select(*columns).mapInPandas(rows, "word string, toxic long, other long, d double").where("d > -0.3").orderBy(F.desc("d"), "word").limit(HARD_WORDS).toPandas()
            words = pd.concat([words, hard[columns].assign(sure=False)]).drop_duplicates("word")

    held = _summaries_of(sample.where(apart), model).toPandas()  # a quarter of the bounded sample
    if held.y.nunique() < 2:
        held = _summaries_of(sample, model).toPandas()
    for table in (sample, vocabulary):
        discard(table)
    model.logistic = _logistic(np.stack(held.d), held.y.to_numpy().astype(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights of the columns of ``x`` and a constant, by damped Newton steps on standardised columns."""
    mean, std = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.hstack([(x - mean) / std, np.ones((len(x), 1))])
    if len(y) < ENOUGH:
        z[:, 3:-1] = 0
    keep = np.full(z.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * w)
        size = np.abs(step).max()
        w = w + step * min(1.0, 2 / max(size, 1e-9))
        if size < 1e-8:
            break
    return np.append(w[:-1] / std, w[-1] - (w[:-1] * mean / std).sum())


def _summaries_of(rows: DataFrame, model: Model, keep: tuple[str, ...] = ("y",), score: str = "", text_col: str = "text") -> DataFrame:
    """``keep`` and the summary d (or the score, under the given name) of the text."""
    source = rows.select(*dict.fromkeys([*keep, text_col]))
    schema = source.select(*keep).schema
    schema = schema.add(score, "double") if score else schema.add("d", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, float] = {}
        for batch in batches:
            for part, texts in slices(batch, text_col):
                got = model.summaries(texts, kept) if model.weights is not None else [list(NOTHING)] * len(texts)
                out = pa.array(model.score(np.array(got)), pa.float64()) if score else pa.array([[float(v) for v in x] for x in got], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*map(part.column, keep), out], names=schema.names)
        kept.clear()
        give_back()

    return source.mapInArrow(run, schema)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    small_batches(docs.sparkSession)
    return _summaries_of(docs, model, (id_col,), "score", text_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score less, with all their columns; texts are scored where they are read."""
    small_batches(docs.sparkSession)
    (name,) = fresh(docs, "_toxicity")
    return _summaries_of(docs, model, tuple(docs.columns), name, text_col).where(F.col(name) < at_least).drop(name)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = is_held_out("doc_id", 4, 2)
    scored = score_documents(docs, fit(docs, labels, "toxic", ~held))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICTED_AT).cast("int").alias("predicted"))
