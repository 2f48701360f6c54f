import random

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.llm import piece_bpe

PATH = P.path("piece_bpe_32k.model")
BITS = ["▁", " ", "  ", "   ", "a", "e", "th", "The", "ing", "tion", "\n", "\t", "\x00", "é", "ß", "ﬁ", "가", "́", "中", "文", "😀", "0", "12", ".", ",", "<", "|", ">", "<s>", "<0x41>", "�"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(texts):
    block = piece_bpe.Block(PATH)
    for x in texts:
        block.add(x)
    block.encode()
    return [[i for n in numbers for i in block.ids[n]] + [block.pieces.end] for numbers in block.texts]


def mixed(n, length=40):
    rng = random.Random(n)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, length))) for _ in range(n)]


def test_as_the_library(model):
    pieces = piece_bpe.pieces_at(PATH)
    texts = ["", " ", "a" * 20_000, " " * 333 + "b ", "thethethe" * 900, "中" * 500, "\x00\n" * 50, *mixed(3000)]
    for text, ids in zip(texts, encoded(texts), strict=True):
        assert ids == model.encode(text, add_eos=True), text[:80]
        assert piece_bpe.decode(ids, pieces).decode() == model.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert encoded([text]) == [sentencepiece.SentencePieceProcessor(model_file=PATH).encode(text, add_eos=True)]


def test_pairs_are_compatible_where_merging_gives_them_again():
    pieces, rng = piece_bpe.pieces_at(PATH), random.Random(5)
    some = rng.sample(sorted(pieces.whole.values()), 3000) + [pieces.ids["▁" * n] for n in range(2, 17) if "▁" * n in pieces.ids]
    for _ in range(6000):
        a, b = rng.choice(some), rng.choice(some)
        x, y = pieces.text[a], pieces.text[b]
        assert pieces.compatible[a << 20 | b] == (pieces.merged(x + y)[0] == [x, y]), (x, y)


def test_the_table_says_how_every_prefix_ends(model):
    pieces = piece_bpe.pieces_at(PATH)
    for text in ("▁thingstionally", "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁a", "▁unbelievable😀ness"):
        last = piece_bpe.last_pieces(text, pieces)
        for n in range(1, len(text) + 1):
            ids = model.encode(text[1:n].replace("▁", " "))
            if n > 1:
                assert last[n] == (ids[-1] if ids[-1] in pieces.whole.values() else -1)


def test_rows(spark, model):
    texts = [None, "", *mixed(80)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x y", 1), (None, "x y", 1)], "doc_id long, text string, n_tokens int").repartition(3)
    out = piece_bpe.decoded(piece_bpe.encode(df, PATH), PATH)
    for r in out.where("doc_id IS NOT NULL").collect():
        assert r.ids == model.encode(texts[r.doc_id] or "", add_eos=True) and r.decoded == model.decode(r.ids)
    assert out.where("doc_id IS NULL").count() == 2
    assert piece_bpe.encoding_digests(df.limit(0), PATH).count() == 0


def test_digests(spark, model):
    import hashlib

    texts = [None, "", " a  b", "Über\n\nden  Fluß ▁ x", *mixed(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in piece_bpe.encoding_digests(df, PATH).collect():
        ids = model.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_block_bounds_do_not_matter(monkeypatch):
    texts = mixed(60)
    whole = encoded(texts)
    monkeypatch.setattr(piece_bpe, "KNOWN", 0)
    piece_bpe.pieces_at(PATH).known.clear()
    assert [encoded([x])[0] for x in texts] == whole
