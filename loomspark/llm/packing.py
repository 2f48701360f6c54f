"""Best-fit packing by a grouping genetic algorithm on islands with elite migration.

Texts become token pieces in one pass without a shuffle. Pieces of full length are sequences of their own; the
others are dealt by hash into shards of a bounded number of pieces. On each shard several islands evolve
packings from random ones (pieces in random order, each put where it fits best): crossover injects whole well-filled bins of
one parent into the other, removes the bins that hold duplicates, and puts the displaced pieces where they fit best, longest
first; mutation dissolves the emptiest bins. An island rests when no packing can have fewer bins. Between epochs the elite of
each island moves to the next one. The pieces of bins that stay too empty are dealt anew over fewer shards, until one shard
holds them or most of a level's pieces are in such bins, which others of their kind then fill no better.

A text is what the tokenizer library makes of it, without added special tokens: the names of special tokens inside a text
are these tokens.

Defined cases: a null text is an empty one and is one piece (the end id); a null id is passed on; repeated rows
each have pieces of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .bpe import BLOCK_LENGTH, BLOCK_WORDS, NONE, _Numbers, replay
from .common import give_back, settle, slices, small_batches

#: Pieces of a shard, islands of each, epochs, packings on an island, generations of an epoch and children of each.
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS, CHILDREN = 16_384, 2, 3, 6, 4, 3
#: Bins filled less than this are dealt anew.
WEAK = 0.97


# ---- tokens


def _byte_chars() -> list[str]:
    """The characters that stand for bytes: printable Latin-1 ones for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordRanks:
    """The merges of a vocabulary whose words end in a suffix, as ``replay`` takes them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + end] for c in chars], np.int32)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.order = keys[order], order.astype(np.int32)

    def start(self, data: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = self.inner[data]
        out[last] = self.last[data[last]]
        return out

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.order[at], NONE)


@lru_cache(maxsize=2)
def word_ranks(path: str) -> WordRanks:
    return WordRanks(path)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def special_names(path: str) -> tuple[str, ...]:
    """The names of special tokens, lower-cased: a text that holds one goes to the tokenizer whole."""
    with open(path, encoding="utf-8") as file:
        return tuple(token["content"].lower() for token in json.load(file).get("added_tokens", ()))


@lru_cache(maxsize=1)
def latin_words():
    """Finds the words of lower-case Latin-1 text, as the tokenizer's own pattern does."""
    import re

    import regex

    of = lambda name: "".join(re.escape(chr(i)) for i in range(256) if regex.match(name, chr(i)))
    letters, digits, spaces = of(r"\p{L}"), of(r"\p{N}"), of(r"\s")
    pattern = f"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{digits}]|[^{spaces}{letters}{digits}]+"
    return re.compile(pattern.encode("latin-1")).findall


class TokenBlock:
    """Texts as numbers of their strings between white space, each distinct string encoded once.

    That holds for texts in Latin-1, where normalisation is lower-casing; any other text, and any with the name of a special
    token, goes to the tokenizer whole.
    """

    def __init__(self, path: str, most: int = BLOCK_WORDS):
        self.path, self.numbers, self.texts, self.length, self.most = path, _Numbers(), [], 0, most

    def add(self, text: str) -> None:
        low = text.lower()
        try:
            parts = None if "µ" in low or any(name in low for name in special_names(self.path)) else low.encode("latin-1").split()
        except UnicodeEncodeError:
            parts = None
        if parts is None:
            ids = tokenizer(self.path).encode(text, add_special_tokens=False).ids
            self.texts.append(np.array(ids, "<u4").tobytes())
            self.length += len(ids)
        else:
            self.texts.append(np.fromiter(map(self.numbers.__getitem__, parts), np.int32, len(parts)))
            self.length += len(parts)

    @property
    def full(self) -> bool:
        return len(self.numbers) >= self.most or self.length >= BLOCK_LENGTH

    def encode(self) -> None:
        find, words = latin_words(), _Numbers()
        flat, ends = array("i"), array("i")
        for part in self.numbers:
            core = part.rstrip(b".,;:!?")
            if core.decode("latin-1").isalpha():  # letters, and marks that stay together
                flat.append(words[core])
                if len(core) < len(part):
                    flat.append(words[part[len(core) :]])
            else:
                flat.extend(map(words.__getitem__, find(part)))
            ends.append(len(flat))
        self.numbers = None
        ids, counts = replay([w.decode("latin-1").encode() for w in words], word_ranks(self.path))
        stops = np.cumsum(counts) * 4
        data = ids.astype("<u4").tobytes()
        each = [data[a:b] for a, b in zip((stops - counts * 4).tolist(), stops.tolist(), strict=True)]
        self.parts, at = [], 0
        for end in ends:
            self.parts.append(each[flat[at]] if end == at + 1 else b"".join([each[i] for i in flat[at:end]]))
            at = end

    def ids(self, at: int) -> bytes:
        text = self.texts[at]
        return text if isinstance(text, bytes) else b"".join(map(self.parts.__getitem__, text.tolist()))


def token_pieces(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32. Blocks of fewer words take less memory and more time."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    step = size * 4

    def done(block: TokenBlock, keys: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        block.encode()
        ids, rows = pa.concat_arrays(keys), []
        for i in range(len(block.texts)):
            data = block.ids(i) + end
            rows += [(i, k, k * size, (min(len(data), (k + 1) * step) - k * step) // 4, zlib.crc32(data[k * step : (k + 1) * step])) for k in range(-(-len(data) // step))]
            if len(rows) >= 4096 or i + 1 == len(block.texts):
                at, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))], names=["id", "piece", "start", "length", "ids_crc32"])
                rows = []

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys = TokenBlock(path, block_words), []
        for batch in batches:
            for part, texts in slices(batch, "text"):
                keys.append(part.column("id"))
                for x in texts:
                    block.add(x)
                if block.full:
                    yield from done(block, keys)
                    block, keys = TokenBlock(path, block_words), []
        if keys:
            yield from done(block, keys)
        block = None
        give_back()

    return source.mapInArrow(make, f"id {kind}, piece int, start long, length long, ids_crc32 long")


# ---- packing of one shard


def best_fit(order: list[int], lengths: list[int], bins: np.ndarray, rooms: list[int], size: int) -> None:
    """Puts each piece of ``order`` into the fullest bin that has room, or a new one; ``bins`` and ``rooms`` change."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    mask = 0
    for b, room in enumerate(rooms):
        by_room[room].append(b)
        mask |= 1 << room
    for x in order:
        n = lengths[x]
        if fits := mask >> n:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b = size, len(rooms)
            rooms.append(size)
        rooms[b] = room = room - n
        by_room[room].append(b)
        mask |= 1 << room
        bins[x] = b


def _loads(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths).astype(np.int64)


def _worth(bins: np.ndarray, lengths: np.ndarray, size: int) -> tuple:
    """Fewer bins first, then the more unequal fill."""
    loads = _loads(bins, lengths)
    return len(loads), -float(np.square(loads / size).sum())


def _refit(bins: np.ndarray, loose: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Numbers the bins of the pieces that aren't ``loose`` anew and best-fits the loose ones."""
    out = np.zeros(len(bins), np.int64)
    rooms: list[int] = []
    if not loose.all():
        _, out[~loose] = np.unique(bins[~loose], return_inverse=True)
        rooms = (size - _loads(out[~loose], lengths[~loose])).tolist()
    order = np.flatnonzero(loose)
    order = order[np.argsort(-lengths[order], kind="stable")]
    best_fit(order.tolist(), lengths.tolist(), out, rooms, size)
    return out


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    loads = _loads(b, lengths)
    well = (loads >= np.median(loads)) & (rng.random(len(loads)) < 0.5)
    injected = well[b]
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[injected]] = True
    child = np.where(injected, b + len(hit), a)
    return _refit(child, hit[a] & ~injected, lengths, size)


def mutation(a: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    loads = _loads(a, lengths)
    emptiest = np.argsort(loads, kind="stable")[: max(2, len(loads) // 50)]
    loose = np.zeros(len(loads), bool)
    loose[emptiest] = True
    loose[rng.integers(0, len(loads), max(1, len(loads) // 50))] = True
    return _refit(a, loose[a], lengths, size)


def founders(lengths: np.ndarray, size: int, rng: np.random.Generator, n: int) -> list[np.ndarray]:
    """Random packings: pieces in random order, each put where it fits best."""
    out = []
    for _ in range(n):
        bins = np.zeros(len(lengths), np.int64)
        best_fit(rng.permutation(len(lengths)).tolist(), lengths.tolist(), bins, [], size)
        out.append(bins)
    return out


def evolve(herd: list[np.ndarray], lengths: np.ndarray, size: int, rng: np.random.Generator, generations: int = GENERATIONS) -> list[np.ndarray]:
    least = -(-int(lengths.sum()) // size)
    worth = lambda x: _worth(x, lengths, size)
    herd = sorted(herd, key=worth)[:POPULATION]
    for _ in range(generations):
        if worth(herd[0])[0] <= least:
            break  # no packing has fewer bins
        for _ in range(CHILDREN):
            i, j = sorted(rng.integers(0, len(herd), 2))
            child = crossover(herd[i], herd[j], lengths, size, rng) if i != j else mutation(herd[i], lengths, size, rng)
            herd.append(child)
        herd = sorted(herd, key=worth)[:POPULATION]
    return herd


# ---- islands

_STATE = "shard long, island int, place int, bins binary"


def _epoch(size: int, seed: int):
    def run(key: tuple, items: pd.DataFrame, herd: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("uid")
        lengths = items.length.to_numpy()
        rng = np.random.default_rng([seed, int(key[0]), int(key[1])])
        now = [np.frombuffer(x, np.int32).astype(np.int64) for x in herd.sort_values("place").bins] if len(herd) else founders(lengths, size, rng, POPULATION)
        now = evolve(now, lengths, size, rng)
        give_back()
        return pd.DataFrame({"shard": key[0], "island": key[1], "place": range(len(now)), "bins": [x.astype(np.int32).tobytes() for x in now]})

    return run


def _placed(size: int):
    def run(key: tuple, items: pd.DataFrame, herd: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("uid")
        lengths = items.length.to_numpy()
        best = min((np.frombuffer(x, np.int32).astype(np.int64) for x in herd.bins), key=lambda x: _worth(x, lengths, size))
        order = np.argsort(best, kind="stable")
        ends = np.cumsum(lengths[order])
        bins = best[order]
        begins = np.searchsorted(bins, bins, side="left")
        offset = ends - lengths[order] - (ends - lengths[order])[begins]
        return pd.DataFrame({"uid": items.uid.to_numpy()[order], "length": lengths[order], "shard": key[0], "bin": bins, "fill": _loads(best, lengths)[bins], "offset": offset})

    return run


def pack(items: DataFrame, size: int = 4096, shard: int = SHARD, level: int = 0) -> DataFrame:
    """For items (uid long, length long <= size): uid, sequence_id, offset."""
    n = items.count()
    shards = max(1, -(-n // shard))
    spark = items.sparkSession
    dealt = settle(items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard")))
    isles = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    herd = spark.createDataFrame([], _STATE)
    for epoch in range(EPOCHS):
        herd = settle(isles.groupBy("shard", "island").cogroup(herd.groupBy("shard", "island")).applyInPandas(_epoch(size, epoch), _STATE))
        elite = herd.where("place < 2").withColumns({"island": F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"), "place": F.col("place") + POPULATION})
        herd = herd.unionByName(elite) if epoch + 1 < EPOCHS else herd.where("place = 0")
    placed = settle(dealt.groupBy("shard").cogroup(herd.groupBy("shard")).applyInPandas(_placed(size), "uid long, length long, shard long, bin long, fill long, offset long"))
    weak = placed.where(F.col("fill") < WEAK * size).select("uid", "length")
    again = shards > 1 and 2 * weak.count() < n  # each level has less than half of the pieces of the one before
    kept = placed.where(F.col("fill") >= WEAK * size) if again else placed
    out = kept.select("uid", ((F.lit(level).cast("long") * (1 << 56)) + F.col("shard") * (1 << 24) + F.col("bin")).alias("sequence_id"), "offset")
    return out.unionByName(pack(weak, size, shard, level + 1)) if again else out


def pack_documents(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = settle(token_pieces(docs, path, size, end_id, id_col, text_col, block_words).withColumn("uid", F.monotonically_increasing_id()))
    full = pieces.where(F.col("length") >= size).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    rest = pieces.where(F.col("length") < size)
    rest = rest.join(pack(rest.select("uid", "length"), size), "uid")
    return full.unionByName(rest).drop("uid").withColumnRenamed("id", id_col)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
