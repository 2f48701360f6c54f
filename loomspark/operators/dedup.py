"""Greedy near-duplicate removal in order, within each document.

A row is dropped if its normalised text equals that of a kept row, or if the Jaccard similarity of its character bigrams
with some kept row is at least the threshold; similarity to a dropped row doesn't count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from loomspark.functions import text as T
from loomspark.sources.tables import discard, members, once, settled, small_batches, without


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


#: Rows of a key that are near each other in size and meet as they are; of more, those that agree in a part of their bigrams.
FEW = 64


def _parted(signed: DataFrame, key: str, threshold: float) -> DataFrame:
    """key, rn, n, sig, label, upper, part and part_hash: where rows meet that may be similar.

    Similar sets are of the same size band or of neighbouring ones; a row is under its own band's label and, as the larger one,
    under the label below. The bigrams of a row are dealt into parts by hash, one more of them than two similar sets may have
    differences, so that these agree in a part as a whole. Where few rows share a label one part without any bigram does. Rows of
    a band are counted by key and band, and only these counts, a few a key, are looked at key by key."""
    step = -math.log(threshold - 1e-9)
    near = W.partitionBy(key).orderBy("band")
    rows = signed.select(key, "rn", "n", "sig", F.floor(F.log(F.col("n").cast("double")) / step).cast("int").alias("band"))
    beside = {"own": (0, 0), "above": (1, 1), "below": (-1, -1)}
    counts = rows.groupBy(key, "band").agg(F.count("*").alias("size")).withColumns({name: F.coalesce(F.sum("size").over(near.rangeBetween(*frame)), F.lit(0)) for name, frame in beside.items()})
    counts = settled(counts.where("own > 1 OR above > 0 OR below > 0").select(F.col(key).alias("_key"), F.col("band").alias("_band"), "own", "above", "below"))
    rows = rows.join(counts, rows[key].eqNullSafe(counts["_key"]) & (F.col("band") == F.col("_band")))
    most = lambda b: F.floor(F.exp((b + 1) * step) + 1e-6)
    one = lambda label, upper, many: F.struct(label.alias("label"), F.lit(upper).alias("upper"), many.alias("many"))
    lower, upper = one(F.col("band"), False, F.col("own") + F.col("above")), one(F.col("band") - 1, True, F.col("own") + F.col("below"))
    labels = F.array_compact(F.array(F.when((F.col("own") > 1) | (F.col("above") > 0), lower), F.when(F.col("below") > 0, upper)))
    placed = settled(rows.select(key, "rn", "n", "sig", F.explode(labels).alias("l")).select(key, "rn", "n", "sig", "l.label", "l.upper", "l.many"))
    # one part without any bigram; or as many as the label asks for, for which alone bigrams are read again
    whole = placed.where(F.col("many") <= FEW).select(key, "rn", "n", "sig", "label", "upper", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("part_hash"))
    parts = (F.floor((1 - threshold) / (1 + threshold) * (most(F.col("label")) + most(F.col("label") + 1)) + 1e-6) + 1).cast("long")
    crowded = placed.where(F.col("many") > FEW)
    if crowded.isEmpty():
        return whole
    near = members(signed, settled(crowded.select(key, "rn").distinct()), [key, "rn"])
    dealt = crowded.withColumn("parts", parts).join(near.select(key, "rn", "g"), [key, "rn"])
    # a part without a bigram is a part too
    each = F.concat(F.transform("g", lambda x: F.struct(F.pmod(F.xxhash64(x), F.col("parts")).alias("part"), F.xxhash64(x).alias("h"))), F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda i: F.struct(i.alias("part"), F.lit(0).cast("long").alias("h"))))
    dealt = dealt.select(key, "rn", "n", "sig", "label", "upper", F.explode(each).alias("x"))
    return whole.unionByName(dealt.groupBy(key, "rn", "n", "sig", "label", "upper", F.col("x.part").alias("part")).agg(F.bit_xor(F.col("x.h")).alias("part_hash")))


#: Characters whose bigrams are sorted at once.
AT_ONCE = 1 << 20


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct bigrams, as numbers, of texts of two characters or more, one text after the other; where each begins among them,
    and each one's parity signature: a bit changes with every bigram that falls on it."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    pairs = (text[:-1] << 42) + (points[:-1] << 21) + points[1:]
    pairs = np.sort(pairs[text[:-1] == text[1:]])
    pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))]
    starts = np.searchsorted(pairs >> 42, np.arange(len(texts)))
    numbers = pairs & ((1 << 42) - 1)
    bits = np.left_shift(np.int64(1), (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)).astype(np.int64))
    return numbers, starts, np.bitwise_xor.reduceat(bits, starts)


def _signed(rows: DataFrame, key: str) -> DataFrame:
    """key, rn, the distinct bigrams g of t as numbers, n of them, and their parity signature sig. A text's bigrams are a sort of
    its numbers: as strings and lambdas they took half of the time of all pairs."""
    small_batches(rows.sparkSession)
    source = rows.where(F.length("t") >= 2).select(key, "rn", "t")
    fields = StructType([*source.schema.fields[:2]]).add("g", ArrayType(LongType())).add("n", IntegerType()).add("sig", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("t").to_pylist(), 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= AT_ONCE):
                    chars += len(texts[end])
                    end += 1
                numbers, starts, sig = _grams(texts[at:end])
                ends = np.append(starts, len(numbers)).astype(np.int32)
                own = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([own.column(key), own.column("rn"), pa.ListArray.from_arrays(ends, numbers), pa.array(np.diff(ends)), pa.array(sig)], names=[key, "rn", "g", "n", "sig"])
                at = end

    return source.mapInArrow(run, fields)


def similar_pairs(rows: DataFrame, key: str, threshold: float) -> DataFrame:
    """key, rn and earlier (rn of an earlier row of the key) of the pairs whose bigrams have a Jaccard similarity of at
    least ``threshold``, from (key, rn, t), as a settled table. Rows meet only under labels of their size, where these are long in
    equal parts, and a parity signature (two differ in no more bits than there are bigrams in one set only) rules out nearly all
    pairs before sets are compared: the pairs that are made grow with those that are alike, not with the square of a document's
    rows. No group is of a key as a whole."""
    signed = settled(_signed(rows, key))
    parted = _parted(signed, key, threshold).repartition(key, "label", "part", "part_hash")  # one exchange for both sides
    a, b = (parted.select(key, "label", "part", "part_hash", *[F.col(c).alias(f"{p}_{c}") for c in ("rn", "n", "sig", "upper")]) for p in "ab")
    apart, total = F.bit_count(F.col("a_sig").bitwiseXOR(F.col("b_sig"))), F.col("a_n") + F.col("b_n")
    may = (F.least("a_n", "b_n") >= threshold * F.greatest("a_n", "b_n") - 1e-9) & (apart * (1 + threshold) <= total * (1 - threshold) + 1e-9)
    met = a.hint("merge").join(b, [key, "label", "part", "part_hash"]).where((F.col("a_rn") < F.col("b_rn")) & ~(F.col("a_upper") & F.col("b_upper")) & may)
    near = settled(met.select(key, F.col("a_rn").alias("earlier"), F.col("b_rn").alias("rn")).distinct())
    some = settled(near.select(key, F.explode(F.array("rn", "earlier")).alias("rn")).distinct())
    grams = settled(members(signed.select(key, "rn", "g"), some, [key, "rn"]))
    pairs = near.join(grams.withColumnRenamed("g", "b_g"), [key, "rn"]).join(grams.select(key, F.col("rn").alias("earlier"), F.col("g").alias("a_g")), [key, "earlier"])
    out = settled(pairs.where(jaccard(F.col("a_g"), F.col("b_g")) >= threshold).select(key, "rn", "earlier"))
    for table in (signed, near, some, grams):
        discard(table)
    return out


#: Pairs of a key above which its rows are decided in rounds, not one after the other.
WALK = 200_000


def _walked(pairs: DataFrame, key: str) -> DataFrame:
    """key and rn of the rows that an earlier kept row is similar to, for keys of few pairs; each row's pairs are looked at once."""
    fields = pairs.select(key, "rn").schema
    names = fields.names

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gone, at, lost = None, set(), None, False
        out: list[tuple] = []
        for batch in batches:
            for k, rn, earlier in zip(*(batch.column(c).to_pylist() for c in (key, "rn", "earlier")), strict=True):
                if k != now or rn != at:
                    now, gone, at, lost = k, (gone if k == now else set()), rn, False
                if not lost and earlier not in gone:
                    lost = True
                    gone.add(rn)
                    out.append((k, rn))
            if out:
                kinds = batch.schema.field(key).type, batch.schema.field("rn").type
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out = []

    return pairs.select(key, "rn", "earlier").repartition(key).sortWithinPartitions(key, "rn", "earlier").mapInArrow(rows, fields)


def _dropped(pairs: DataFrame, key: str, walk: int | None = None) -> DataFrame:
    """key and rn of the rows that an earlier kept row is similar to, as a settled table.

    Keys of few pairs are walked through, many in a task. Of the others, rounds: a row that no undecided earlier row is similar to
    is kept, the later ones that are similar to it go, and the pairs of what goes with it. These joins go by key and row, so that a
    key of very many rows is dealt over all tasks. A pair is read once a round; in random order the rounds grow with the logarithm of
    the rows, and what is few at last is walked through. (Lines that are each similar to the one before only would take as many rounds
    as half of them: such a chain is decided in order whatever one does.)"""
    walk = WALK if walk is None else walk
    by = [key, "rn"]
    hot = settled(pairs.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > walk).select(key))
    if hot.isEmpty():
        return settled(_walked(pairs, key))
    gone = [_walked(pairs.join(hot, key, "left_anti"), key)]
    left = settled(pairs.join(hot, key, "left_semi"))
    while True:
        later = left.select(key, F.col("rn").alias("earlier")).distinct()
        lost = settled(left.join(later, [key, "earlier"], "left_anti").select(*by).distinct())
        gone.append(lost)
        rest = left.join(lost, by, "left_anti").join(lost.withColumnRenamed("rn", "earlier"), [key, "earlier"], "left_anti")
        left, before = settled(rest), left
        discard(before)
        n = left.count()
        if n <= walk:
            break
    if n:
        gone.append(_walked(left, key))
    out = settled(reduce(DataFrame.unionByName, gone))
    for table in (*gone[1:-1], hot, left):
        discard(table)
    return out


def greedy_dedup(rows: DataFrame, key: str, text_col: str, threshold: float = 0.85) -> DataFrame:
    """The kept rows of ``rows`` (key, rn, text and more), all columns."""
    others = [c for c in rows.columns if c not in (key, "rn")]
    normal = once(rows, "t", T.dedup_normalise(F.col(text_col)))
    # of equal texts only the first can be kept, whatever happens to it
    keep = settled(normal.groupBy(key, "t").agg(F.min("rn").alias("rn"), F.min_by(F.struct(*others), "rn").alias("x")))
    pairs = similar_pairs(keep.select(key, "rn", "t"), key, threshold)
    dropped = _dropped(pairs, key)
    discard(pairs)
    return without(keep.select(key, "rn", *[F.col(f"x.{c}").alias(c) for c in others]), dropped, [key, "rn"])
