import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from loomspark.llm import packing as K

PATH = P.path("word_bpe_49k.json")
TEXTS = [None, "", "Hello, World's 12 don't", "tout à fait ÉÀ ß µ", "日本語 text <|endoftext|>", "a <|endoftext|> b", "x<|StartOfText|><|endoftext|>", "<|endoftext", "word " * 9000, "İstanbul ΣΑΣ", " x\x1cy\x85z", "a" * 3000]


def test_ids_as_the_library():
    rng = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("ab cdé ÉÑ12,.'s!?\n") for _ in range(60)) for _ in range(300)]
    own = Tokenizer.from_file(PATH)  # as the library reads it
    assert own.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    block = K.TokenBlock(PATH)
    for t in texts:
        block.add(t)
    block.encode()
    for i, t in enumerate(texts):
        assert np.frombuffer(block.ids(i), "<u4").tolist() == own.encode(t, add_special_tokens=False).ids, t[:50]


def check(rows, size, texts):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= size
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in texts:
        ids = np.array(Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want = [(k, k * size, len(ids[k * size : (k + 1) * size]), zlib.crc32(ids[k * size : (k + 1) * size].tobytes())) for k in range(-(-len(ids) // size))]
        assert set(want) <= set(by[i])
    return len(at)


def test_documents(spark):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (2, TEXTS[2])]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, shard string")
    got = K.pack_documents(df, PATH, 512).collect()
    check(got, 512, rows)
    assert sum(r.doc_id == 2 for r in got) == 2
    assert K.pack_documents(df.limit(0), PATH).count() == 0


def test_packing_is_tight_over_shards(spark):
    rng = random.Random(1)
    lengths = [rng.choice([rng.randint(1, 60), rng.randint(40, 99), 50]) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    got = K.pack(items, 100, shard=700).collect()
    assert sorted(r.uid for r in got) == list(range(3000))
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + lengths[r.uid]
    assert max(at.values()) <= 100
    one = np.zeros(3000, np.int64)
    K.best_fit(np.argsort(-np.array(lengths), kind="stable").tolist(), lengths, one, [], 100)
    assert len(at) <= (one.max() + 1) * 1.01


def test_levels_go_on_at_full_size(spark, monkeypatch):
    """Pieces of full production size, dealt over several levels."""
    rng = random.Random(2)
    lengths = [rng.choice([rng.randint(1, 400), rng.randint(300, 4095), 2049]) for _ in range(4000)]
    seen, real = [], K.pack
    monkeypatch.setattr(K, "pack", lambda items, size, shard, level=0: (seen.append(level), real(items, size, shard, level))[1])
    got = real(spark.createDataFrame(list(enumerate(lengths)), "uid long, length long"), 4096, 250).collect()
    assert sorted(r.uid for r in got) == list(range(4000)) and len(seen) >= 1
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + lengths[r.uid]
    assert max(at.values()) <= 4096
    assert len(at) <= 1.02 * max(sum(lengths) / 4096, sum(x > 2048 for x in lengths))


def test_pieces_that_no_bin_shares_end(spark):
    items = spark.createDataFrame([(i, 60) for i in range(900)], "uid long, length long")
    assert K.pack(items, 100, shard=100).select("sequence_id").distinct().count() == 900


def test_crossover_makes_the_packing(monkeypatch):
    """Random packings are far from the bound; evolution reaches it, and without crossover it doesn't."""
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 700, 1500), rng.integers(300, 4096, 1500)])
    least = -(-int(lengths.sum()) // 4096)
    bins = lambda herd: min(len(K._loads(x, lengths)) for x in herd)
    first = K.founders(lengths, 4096, np.random.default_rng(1), K.POPULATION)
    with_it = K.evolve(first, lengths, 4096, np.random.default_rng(2), K.EPOCHS * K.GENERATIONS)
    monkeypatch.setattr(K, "crossover", lambda a, b, *_: a.copy())
    without_it = K.evolve(first, lengths, 4096, np.random.default_rng(2), K.EPOCHS * K.GENERATIONS)
    print(f"bound {least}, founders {bins(first)}, evolved {bins(with_it)}, without crossover {bins(without_it)}")
    assert bins(with_it) < bins(without_it) <= bins(first) and bins(with_it) <= 1.01 * least


@pytest.mark.parametrize("seed", range(4))
def test_operators_keep_packings_valid(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 100, 300)
    herd = K.founders(lengths, 100, rng, 4)
    first = min(K._worth(x, lengths, 100) for x in herd)
    for x in (K.crossover(herd[0], herd[1], lengths, 100, rng), K.mutation(herd[2], lengths, 100, rng), *K.evolve(herd, lengths, 100, rng, 5)):
        loads = K._loads(x, lengths)
        assert loads.sum() == lengths.sum() and loads.max() <= 100 and loads.min() > 0
    assert min(K._worth(x, lengths, 100) for x in K.evolve(herd, lengths, 100, rng, 5)) <= first
