"""The calls that are not relational: text generation, embeddings, tokenisation and page extraction.

Each is a protocol with a deterministic offline stand-in. Errors are data: a call that fails yields (None, message), so
that one bad row doesn't fail the job.
"""

from __future__ import annotations

import hashlib
import logging
import random
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from . import calls
from .calls import generation_delay  # noqa: F401


class Responder(Protocol):
    def respond(self, prompt: str, system: str) -> str: ...


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float] | None]: ...


class Tokenizer(Protocol):
    def spans(self, text: str) -> list[tuple[int, int]]: ...


class Extractor(Protocol):
    def pages(self, content: bytes) -> list[dict]: ...


def first_filled(value: object, *members: tuple[str, ...]) -> str:
    """The first string that isn't empty at one of the paths ``members`` of nested mappings."""
    for path in members:
        found = value
        for name in path:
            found = found.get(name) if isinstance(found, dict) else None
        if isinstance(found, str) and found:
            return found
    return ""


def table_htmls(result: object) -> list[str]:
    """The html of the tables of an extractor's layout result: a list of blocks, one block, or html as it is."""
    blocks = result if isinstance(result, list) else [] if result is None else [result]
    found = [x if isinstance(x, str) else first_filled(x, ("res", "html"), ("html",), ("cell_html",)) for x in blocks]
    return [x for x in found if x]


def markdown_of(result: object) -> str:
    """The markdown of an extractor's page: nothing, a text, or a mapping that has it in one of its members."""
    if result is None or isinstance(result, str):
        return result or ""
    return first_filled(result, ("markdown",), ("md",), ("text",)) or str(result)


class WhitespaceTokenizer:
    """Words between white space."""

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in re.finditer(r"\S+", text)]


class TiktokenTokenizer:
    """Tokens of a rank file, by their characters."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern

    def spans(self, text: str) -> list[tuple[int, int]]:
        import base64

        import tiktoken

        if not hasattr(self, "_encoding"):
            with open(self.path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
            self._encoding = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        _, starts = self._encoding.decode_with_offsets(self._encoding.encode_ordinary(text))
        return list(zip(starts, [*starts[1:], len(text)], strict=True))

    def __getstate__(self) -> dict:
        return {"path": self.path, "pattern": self.pattern}


def load_object(name: str):
    """What ``module:object`` names; of a class an instance."""
    import importlib

    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute)
    return found() if isinstance(found, type) else found


def load_tokenizer(path: str, pattern: str) -> Tokenizer | None:
    """The tokenizer of a rank file; none, with a warning, where its library or its file can't be loaded."""
    try:
        import tiktoken  # noqa: F401

        found = TiktokenTokenizer(path, pattern)
        found.spans("a")
        return found
    except (ImportError, OSError, ValueError) as error:
        logging.getLogger(__name__).warning("no tokenizer (%s): windows are of characters", error)
        return None


def with_retry(call: Callable[[], object], tries: int, delay: Callable[[int], float], sleep: Callable[[float], None] = time.sleep):
    """The result of ``call``; the last error if every try fails."""
    for turn in range(tries):
        try:
            return call()
        except Exception:
            if turn + 1 == tries:
                raise
            sleep(delay(turn))


#: Seconds before the next try: of generation while building the graph, and of embeddings.
GENERATION_TRIES, EMBEDDING_TRIES = 5, 3


def embedding_delay(turn: int) -> float:
    return min(10.0, 1.0 * 2**turn)


def respond(prompts: DataFrame, responder: Responder, prompt_col: str = "prompt", system_col: str | None = None, tries: int = 1) -> DataFrame:
    """``prompts`` with columns response and error, one call per row."""
    return calls.respond(prompts, responder, prompt_col, system_col, calls.Calls(tries=tries))


def fallback_embedding(text: str, dim: int) -> list[float]:
    """Repeatable pseudo-random values in (-1, 1), seeded by the text's SHA-256."""
    rng = random.Random(int(hashlib.sha256(text.encode()).hexdigest(), 16))
    return [rng.uniform(-1, 1) for _ in range(dim)]


def fallback_embeddings(texts: Column, dim: int) -> Column:
    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: fallback_embedding(x or "", dim))

    return run(texts)


def embed(rows: DataFrame, embedder: Embedder, dim: int, text_col: str = "text", tries: int = EMBEDDING_TRIES) -> DataFrame:
    """``rows`` with column embedding array<float> of fixed length; texts that fail get the fallback."""
    from loomspark.operators.vectors import fit_dimension

    schema = types.StructType([*rows.schema.fields, types.StructField("_e", types.ArrayType(types.DoubleType()))])

    def one(embedder: Embedder, text: str) -> list[float] | None:
        try:
            return with_retry(lambda: embedder.embed([text]), tries, embedding_delay)[0]
        except Exception:
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [x or "" for x in batch[text_col]]
            try:
                got = with_retry(lambda texts=texts: embedder.embed(texts), tries, embedding_delay)
            except Exception:  # one text can fail a whole call: each gets tries of its own
                got = [one(embedder, x) for x in texts]
            yield batch.assign(_e=[v if v is not None else fallback_embedding(t, dim) for v, t in zip(got, texts, strict=True)])

    return rows.mapInPandas(run, schema).withColumn("embedding", fit_dimension(F.col("_e"), dim).cast("array<float>")).drop("_e")


def stub_response(text: Column, numbered: bool = True) -> Column:
    """A repeatable answer to a prompt about ``text``: a thought, then a line per line of the text that is a question,
    a question with an answer, or none, in turn."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    ending = lambda i: F.when(F.pmod(i, F.lit(3)) == 0, "？").when(F.pmod(i, F.lit(3)) == 1, "？答案：x").otherwise("")
    head = (lambda i: F.concat(F.lit("问题"), (i + 1).cast("string"), F.lit(": "))) if numbered else (lambda i: F.concat((i + 1).cast("string"), F.lit(". ")))
    said = F.transform(lines, lambda x, i: F.concat(head(i), x, ending(i)))
    return F.concat(F.lit("<think>\nplan\n</think>\n"), F.array_join(said, "\n"))
