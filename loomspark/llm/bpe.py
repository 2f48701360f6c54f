"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The words (matches of the splitting pattern) of a whole block of the corpus, each once, are laid out as one array
of byte tokens. An inverted index leads from a pair's rank to the positions where that pair stands; merges are
applied in rank order to all positions of all words at once, and only the neighbours of merged positions are
looked at again. Texts are then put together from their words.

A block is what one task reads, cut only where its distinct words or its words in all pass a bound. Merges never
cross words, so any division into blocks gives the same ids; nothing is shuffled or broadcast, and a lost task is
run again by itself.

Defined cases: a null text is an empty one and has no ids; a null id is passed on; repeated rows each have a
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.sources.tables import read_table

from .common import give_back, slices, small_batches

#: Bounds of a block: distinct words and words in all (4 bytes each).
BLOCK_WORDS, BLOCK_LENGTH = 300_000, 8_000_000
NONE = np.int32(1 << 30)


class Ranks:
    """The rank file of a vocabulary: token bytes by id and, for each pair of ids that can merge, the merged id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens: list[bytes] = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        merged = {}
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    merged[a << 32 | b] = i
        self.pairs = np.array(sorted(merged), np.int64)
        self.merged = np.array([merged[k] for k in self.pairs.tolist()], np.int32)
        self.made = np.arange(len(self.tokens), dtype=np.int32)  # the id that a merge of each rank makes

    def start(self, data: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The ids before any merge; ``last`` are the positions that end a word."""
        return self.byte[data]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], NONE)


@lru_cache(maxsize=2)
def ranks_at(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def _finders(pattern: str, path: str) -> tuple[Callable, Callable]:
    """What splits a text into words: one for texts of Latin-1 characters, one for any text.

    The second leaves out of a Unicode class what the encoding library, built on an older edition of Unicode,
    does not count to it; the library is asked by a pattern of that class over all characters.
    """
    import regex
    import tiktoken

    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    exact = pattern
    for name in sorted(set(regex.findall(r"\\p\{\w+\}", pattern))):
        asked = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks_at(path).ids, special_tokens={})
        newer = set(regex.findall(name, everything)) - set(asked.decode_bytes(asked.encode_ordinary(everything)).decode())
        if newer:
            exact = exact.replace(name, f"[{name}--[{''.join(sorted(newer))}]]")
    return regex.compile(pattern).findall, regex.compile(exact, regex.V1).findall


def _one_word(word: bytes, ranks: Ranks) -> np.ndarray:
    """The lowest pair first, the leftmost of equals, one merge at a time."""
    ids = ranks.start(np.frombuffer(word, np.uint8), np.array([len(word) - 1]))
    while len(ids) > 1:
        rank = ranks.rank(ids[:-1], ids[1:])
        at = int(rank.argmin())
        if rank[at] == NONE:
            break
        ids = np.concatenate([ids[:at], ranks.made[rank[at] : rank[at] + 1], ids[at + 2 :]])
    return ids


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in one array, and how many each word has. Words are not empty."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    token = ranks.start(np.frombuffer(b"".join(words), np.uint8), first + sizes - 1)
    after = np.arange(1, total + 1, dtype=np.int32)
    before = np.arange(-1, total - 1, dtype=np.int32)
    after[first + sizes - 1] = -1
    before[first] = -1
    alive = np.ones(total, bool)
    here = np.full(total, NONE, np.int32)  # the rank of the pair that starts at a position

    index: dict[int, list[np.ndarray]] = {}
    ahead: list[int] = []

    def note(rank: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        lows = np.append(0, cuts)
        for r, lo, hi in zip(rank[lows].tolist(), lows.tolist(), np.append(cuts, len(rank)).tolist(), strict=True):
            if r in index:
                index[r].append(at[lo:hi])
            else:
                index[r] = [at[lo:hi]]
                heapq.heappush(ahead, r)

    left = np.flatnonzero(after >= 0).astype(np.int32)
    rank = ranks.rank(token[left], token[left + 1])
    here[left] = rank
    if (some := rank < NONE).any():
        note(rank[some], left[some])
    odd: list[np.ndarray] = []  # where a merge made a pair of a lower rank than its own
    while ahead:
        r = heapq.heappop(ahead)
        at = index.pop(r)
        at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
        at = at[here[at] == r]
        if len(at) > 1:  # of overlapping pairs every second one, from the left
            chained = np.append(False, after[at[:-1]] == at[1:])
            if chained.any():
                n = np.arange(len(at))
                start = np.maximum.accumulate(np.where(chained, 0, n))
                at = at[(n - start) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        behind = after[gone]
        token[at] = ranks.made[r]
        after[at] = behind
        alive[gone] = False
        here[gone] = NONE
        here[at] = NONE
        has = behind >= 0
        before[behind[has]] = at[has]
        front = before[at]
        a = np.concatenate([at[has], front[front >= 0]])
        if not len(a):
            continue
        rank = ranks.rank(token[a], token[after[a]])
        here[a] = rank
        some = rank < NONE
        if some.any():
            rank, a = rank[some], a[some]
            if (low := rank < r).any():
                odd.append(a[low])
            note(rank, a)

    counts = np.add.reduceat(alive, first, dtype=np.int64) if total else np.zeros(0, np.int64)
    ids = token[alive]
    if odd:  # then the order within a word may matter; these words are encoded one merge at a time
        where = np.unique(np.searchsorted(first, np.concatenate(odd), side="right") - 1)
        each = np.split(ids, np.cumsum(counts)[:-1])
        for w in where.tolist():
            each[w] = _one_word(words[w], ranks)
            counts[w] = len(each[w])
        ids = np.concatenate(each)
    return ids, counts


class _Numbers(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Block:
    """Texts as lists of word numbers, with the ids of each distinct word."""

    def __init__(self, pattern: str, path: str):
        (self.find, self.find_any), self.ranks = _finders(pattern, path), ranks_at(path)
        self.numbers, self.texts, self.length = _Numbers(), [], 0

    def add(self, text: str) -> None:
        try:
            text.encode("latin-1")
            words = self.find(text)
        except UnicodeEncodeError:
            words = self.find_any(text)
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.length += len(words)

    @property
    def full(self) -> bool:
        return len(self.numbers) >= BLOCK_WORDS or self.length >= BLOCK_LENGTH

    def encode(self) -> None:
        words = [w.encode() for w in self.numbers]
        whole = [self.ranks.ids.get(w) for w in words]
        ids, counts = replay([w for w, i in zip(words, whole, strict=True) if i is None], self.ranks)
        known = np.array([i is not None for i in whole], bool)
        self.counts = np.ones(len(words), np.int64)
        self.counts[~known] = counts
        self.starts = np.cumsum(self.counts) - self.counts
        self.ids = np.empty(int(self.counts.sum()), np.int32)
        self.ids[self.starts[known]] = [i for i in whole if i is not None]
        self.ids[np.repeat(~known, self.counts)] = ids

    def ids_of(self, numbers: np.ndarray) -> np.ndarray:
        n = self.counts[numbers]
        shift = self.starts[numbers] - (np.cumsum(n) - n)
        return self.ids[np.repeat(shift, n) + np.arange(int(n.sum()))]


def decode(ids: np.ndarray, path: str) -> bytes:
    return b"".join(map(ranks_at(path).tokens.__getitem__, ids.tolist()))


def _per_block(path: str, pattern: str, make: Callable[[Block], Callable[[np.ndarray], tuple]], types: list[pa.DataType], names: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys = Block(pattern, path), []

        def done() -> Iterator[pa.RecordBatch]:
            block.encode()
            of = make(block)
            ids = pa.concat_arrays(keys)
            for at in range(0, len(block.texts), 256):
                each = list(zip(*map(of, block.texts[at : at + 256]), strict=True))
                yield pa.RecordBatch.from_arrays([ids.slice(at, 256), *(pa.array(v, t) for v, t in zip(each, types, strict=True))], names=names)

        for batch in batches:
            for part, texts in slices(batch, "text"):
                keys.append(part.column("id"))
                for x in texts:
                    block.add(x)
                if block.full:
                    yield from done()
                    block, keys = Block(pattern, path), []
        if keys:
            yield from done()
        block = None
        give_back()

    return rows


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source, source.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids`` array<int> of every row."""
    source, kind = _source(docs, id_col, text_col)
    rows = _per_block(path, pattern, lambda block: lambda numbers: (block.ids_of(numbers),), [pa.list_(pa.int32())], ["id", "ids"])
    return source.mapInArrow(rows, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with column ``bytes``: what its ids stand for."""
    names = encoded.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [decode(np.asarray(x or [], np.int32), path) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, "bytes"])

    return encoded.mapInArrow(rows, T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())]))


def encoding_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text, decodes its ids and returns id, n_tokens, ids_sha256 and decoded_sha256."""
    source, kind = _source(docs, id_col, text_col)

    def make(block: Block) -> Callable[[np.ndarray], tuple]:
        said = [",".join(map(str, x)) for x in (block.ids[s : s + n].tolist() for s, n in zip(block.starts.tolist(), block.counts.tolist(), strict=True))]

        def of(numbers: np.ndarray) -> tuple:
            ids = block.ids_of(numbers)
            return len(ids), hashlib.sha256(",".join(map(said.__getitem__, numbers.tolist())).encode()).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()

        return of

    rows = _per_block(path, pattern, make, [pa.int64(), pa.string(), pa.string()], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return source.mapInArrow(rows, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoding_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
