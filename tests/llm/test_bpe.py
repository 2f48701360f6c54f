import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks_at(PATH).ids, special_tokens={})


def encoded(texts):
    block = bpe.Block(P.PATTERN, PATH)
    for x in texts:
        block.add(x)
    block.encode()
    return [block.ids_of(x).tolist() for x in block.texts]


def mixed(n):
    rng = random.Random(n)
    kinds = [lambda: chr(rng.randint(32, 126)), lambda: chr(rng.randint(0xA0, 0x2FFF)), lambda: chr(rng.randint(0x4E00, 0x9FFF)), lambda: chr(rng.randint(0x1F300, 0x1F9FF)), lambda: "a", lambda: " ", lambda: "\n"]
    return ["".join(rng.choice(kinds)() for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_as_the_library(encoding):
    texts = ["", "a" * 5000, " " * 300 + "b", "aaaaabababab" * 50, "It's they'll <|endoftext|>", "೜뛶 ՘", *mixed(800)]
    for text, ids in zip(texts, encoded(texts), strict=True):
        assert ids == encoding.encode_ordinary(text)
        assert bpe.decode(np.array(ids, int), PATH) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks_at(PATH).ids, special_tokens={})
    assert encoded([text]) == [own.encode_ordinary(text)]


def test_words_that_leave_rank_order():
    ranks = bpe.ranks_at(PATH)
    words = [w.encode() for w in ("thethethe", "zzzzzzzz", "abcabcabc", "éèéèé", "mississippi")]
    ids, counts = bpe.replay(words, ranks)
    at = 0
    for w, n in zip(words, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == bpe._one_word(w, ranks).tolist()
        at += n


def test_rows(spark, encoding, monkeypatch):
    texts = [None, "", *mixed(60)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x y", 1), (None, "x y", 1)], "doc_id long, text string, n_tokens int").repartition(3)
    out = bpe.encode(df, PATH, P.PATTERN)
    for r in bpe.decoded(out, PATH).where("doc_id IS NOT NULL").collect():
        assert r.ids == encoding.encode_ordinary(texts[r.doc_id] or "") and bytes(r.bytes) == (texts[r.doc_id] or "").encode()
    assert out.where("doc_id IS NULL").count() == 2
    assert bpe.encoding_digests(df.limit(0), PATH, P.PATTERN).count() == 0


def test_block_bounds_do_not_matter(monkeypatch):
    texts = mixed(50)
    whole = encoded(texts)
    assert [encoded([x])[0] for x in texts] == whole
