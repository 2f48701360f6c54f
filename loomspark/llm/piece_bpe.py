"""Encoding and decoding by a piece vocabulary (BPE over characters with byte fallback), through a merge-type prefix table.

What merging adjacent pieces by their scores makes of a text cut off after any character ends in one certain piece, and what
stands before that piece is what merging makes of the text cut off before it. So a table of the last piece of each prefix says
all. An automaton of all pieces gives those that end at a position, the longest first; of these the last piece is the one that
is compatible with the last piece before it: merging the two's characters gives just these two pieces. Whether it does is told
by the merges inside the two, taken in the order in which they happen, and those across the seam that could come first; answers
are kept by pair. Ids are read off the table from the end. The table takes time in proportion to a text's length, whatever its words.

Texts are cut at white space and their distinct words, in blocks of bounded size, where else no piece reaches over; the distinct
parts of a block have one table. Merges never cross a cut, so that any division into blocks gives the same ids; nothing is
shuffled or broadcast, and a lost task is run again by itself. A vocabulary whose pieces hold white space behind other characters
has whole texts as words.

Defined cases: a null text is an empty one and has only the end id; a null id is passed on; repeated rows each have a result; an
empty table gives an empty result; other columns are ignored, whatever their names. A text's own U+2581 is decoded as a space,
as the library does.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.sources.tables import read_table

from .common import give_back, slices, small_batches

#: What stands for a space in pieces.
SPACE = "▁"
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*").findall
#: Bounds of a block: characters of distinct words, and words in all; and the parts of words that a worker knows from blocks before.
BLOCK_CHARS, BLOCK_LENGTH, KNOWN = 6_000_000, 8_000_000, 400_000


class Pieces:
    """A piece vocabulary: the ids of pieces, their scores, and which of them merging makes of their own characters."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end, self.unknown = model.eos_id(), model.unk_id()
        every = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in every]
        self.byte = {int(self.text[i][1:-1], 16): i for i in every if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.silent = {i for i in every if model.is_control(i)}
        odd = self.silent | set(self.byte_of) | {self.unknown}
        self.ids = {self.text[i]: i for i in every if i not in odd}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.compatible = _Compatible(self)
        self.whole = {p: i for p, i in self.ids.items() if self.merged(p)[0] == [p]}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.whole.items():
            self.automaton.add_word(p, (len(p) - 1, i))
        self.automaton.make_automaton()
        held = {c for p in self.ids for c in p}
        self.apart = next(c for c in map(chr, range(0x110000)) if c not in held)
        self.spaced = all(SPACE not in p.lstrip(SPACE) for p in self.ids)  # no piece reaches over the place before white space
        self.parts = self._cuts(held) if self.spaced else lambda text: [text]
        self.known: dict[str, list[int]] = {}

    def _cuts(self, held: set[str]) -> Callable[[str], list[str]]:
        """What takes a text apart where no merge can cross: at ASCII characters that no piece holds, before white space, and
        between a letter and those ASCII signs that follow a letter in no piece."""
        follow = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        signs = [chr(c) for c in range(128) if not chr(c).isalpha()]
        loose = "".join(re.escape(c) for c in signs if c not in held)
        stops = "".join(re.escape(c) for c in signs if c in held and c not in follow)
        return re.compile(rf"[{self.apart}{loose}]|{SPACE}*[^\W\d_]+(?![^{SPACE}{loose}{stops}{self.apart}])|{SPACE}*[^{SPACE}{loose}{self.apart}]+|{SPACE}+").findall

    def words(self, text: str) -> list[str]:
        """The words of a text, each without the space before it."""
        if not text:
            return []
        if not self.spaced:
            return [text]
        if SPACE in text or "  " in text or text[0] == " ":
            return [w[1:] for w in _WORDS(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def merged(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What merging makes of a short text: the best score first, the leftmost of equals; and after each merge its score and
        the first and last piece."""
        parts, steps = list(text), []
        while len(parts) > 1:
            pairs = [(self.score[p], -k) for k, p in enumerate(map("".join, zip(parts, parts[1:], strict=False))) if p in self.score]
            if not pairs:
                break
            score, k = max(pairs)
            parts[-k : 2 - k] = [parts[-k] + parts[1 - k]]
            steps.append((score, parts[0], parts[-1]))
        return parts, steps

    def steps(self, i: int) -> tuple[str, str, list[tuple[float, str, str]]]:
        """First and last character of piece i, and its merges."""
        p = self.text[i]
        return p[0], p[-1], self.merged(p)[1]


class _Compatible(dict):
    """Whether merging the characters of pieces a and b, key a << 20 | b, gives a and b again."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.score, self.steps = pieces.score, lru_cache(maxsize=None)(pieces.steps)

    def __missing__(self, key: int) -> bool:
        _, left, a = self.steps(key >> 20)
        right, _, b = self.steps(key & 0xFFFFF)
        i = j = 0
        fits = True
        while True:
            across = self.score.get(left + right)
            next_a = a[i][0] if i < len(a) else None
            next_b = b[j][0] if j < len(b) else None
            # of equal scores the leftmost: within a, across, within b
            if across is not None and (next_a is None or across > next_a) and (next_b is None or across >= next_b):
                fits = False
                break
            if next_a is not None and (next_b is None or next_a >= next_b):
                left = a[i][2]
                i += 1
            elif next_b is not None:
                right = b[j][1]
                j += 1
            else:
                break
        self[key] = fits
        return fits


@lru_cache(maxsize=2)
def pieces_at(path: str) -> Pieces:
    return Pieces(path)


def last_pieces(text: str, pieces: Pieces) -> list[int]:
    """For each prefix of ``text``, by its length, the id of its last piece; -1 for the empty one and where a character ends that
    no piece holds."""
    last = [-1] * (len(text) + 1)
    compatible, done = pieces.compatible, -1
    for end, (more, i) in pieces.automaton.iter(text):
        if end != done:
            before = last[end - more]
            if before < 0 or compatible[before << 20 | i]:
                last[end + 1] = i
                done = end
    return last


def read_back(text: str, last: list[int], start: int, end: int, pieces: Pieces) -> list[int]:
    """The ids of ``text[start:end]``, from the end of the table to its start."""
    ids, names, byte = [], pieces.text, pieces.byte
    while end > start:
        i = last[end]
        if i >= 0:
            ids.append(i)
            end -= len(names[i])
        else:
            end -= 1
            ids += [byte.get(b, pieces.unknown) for b in reversed(text[end].encode())]
    ids.reverse()
    return ids


def decode(ids: list[int], pieces: Pieces, first: bool = True) -> bytes:
    """The text of ids in UTF-8; ``first`` takes away the space that encoding puts before a text."""
    out = bytearray()
    for i in ids:
        if i in pieces.byte_of:
            out.append(pieces.byte_of[i])
        elif i == pieces.unknown:
            out += " ⁇ ".encode()
        elif i not in pieces.silent:
            out += pieces.text[i].replace(SPACE, " ").encode()
    out = bytes(out[1:] if first and out[:1] == b" " else out)
    return out.decode("utf-8", "replace").encode()


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.chars += len(word)
        return n


class Block:
    """Texts as lists of word numbers, with the ids of each distinct word."""

    def __init__(self, path: str):
        self.pieces, self.numbers, self.texts, self.length = pieces_at(path), _Numbers(), [], 0
        self.numbers.chars = 0

    def add(self, text: str) -> None:
        words = self.pieces.words(text)
        self.texts.append(list(map(self.numbers.__getitem__, words)))
        self.length += len(words)

    @property
    def full(self) -> bool:
        return self.numbers.chars >= BLOCK_CHARS or self.length >= BLOCK_LENGTH

    def encode(self) -> None:
        pieces = self.pieces
        whole, known = pieces.whole, pieces.known
        words = [pieces.parts(SPACE + w.replace(" ", SPACE)) for w in self.numbers]
        rest = list(dict.fromkeys(p for parts in words for p in parts if p not in whole and p not in known))
        text = pieces.apart.join(rest)
        last, at, new = last_pieces(text, pieces), 0, {}
        for p in rest:
            new[p] = read_back(text, last, at, at + len(p), pieces)
            at += len(p) + 1
        self.ids = [[i for p in parts for i in ((whole[p],) if p in whole else known[p] if p in known else new[p])] for parts in words]
        if len(known) < KNOWN:
            known.update(new)


def _per_block(path: str, make: Callable[[Block], Callable[[list[int]], tuple]], types: list[pa.DataType], names: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys = Block(path), []

        def done() -> Iterator[pa.RecordBatch]:
            gc.disable()  # many small lists and no cycles
            try:
                block.encode()
                of = make(block)
            finally:
                gc.enable()
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
                    block, keys = Block(path), []
        if keys:
            yield from done()
        block = None
        give_back()

    return rows


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source, source.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids`` array<int> of every row, the end id last."""
    source, kind = _source(docs, id_col, text_col)

    def make(block: Block) -> Callable[[list[int]], tuple]:
        return lambda numbers: ([i for n in numbers for i in block.ids[n]] + [block.pieces.end],)

    rows = _per_block(path, make, [pa.list_(pa.int32())], ["id", "ids"])
    return source.mapInArrow(rows, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(encoded: DataFrame, path: str, ids_col: str = "ids", as_col: str = "decoded") -> DataFrame:
    """``encoded`` with column ``as_col``: the text that its ids stand for."""
    names = encoded.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_at(path)
        for batch in batches:
            out = [decode(x or [], pieces).decode() for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, as_col])

    return encoded.mapInArrow(rows, T.StructType([*encoded.schema.fields, T.StructField(as_col, T.StringType())]))


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text, decodes its ids and returns id, n_tokens, ids_sha256 and decoded_sha256. The ids of each distinct word
    are decoded once: no character lies in two words."""
    source, kind = _source(docs, id_col, text_col)

    def make(block: Block) -> Callable[[list[int]], tuple]:
        said = [" ".join(map(str, x)) for x in block.ids]
        sizes = list(map(len, block.ids))
        means = [decode(x, block.pieces, first=False) for x in block.ids]
        end = str(block.pieces.end)

        def of(numbers: list[int]) -> tuple:
            text = b"".join(map(means.__getitem__, numbers))
            ids = " ".join([*map(said.__getitem__, numbers), end])
            return sum(map(sizes.__getitem__, numbers)) + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text[1:] if text[:1] == b" " else text).hexdigest()

        return of

    rows = _per_block(path, make, [pa.int64(), pa.string(), pa.string()], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return source.mapInArrow(rows, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op13_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoding_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
