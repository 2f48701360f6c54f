import random
import re

import numpy as np

from loomspark.llm import ngram_join as N


def brute(rows, words, percent):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = set(zip(*[w[k:] for k in range(words)], strict=False)) if len(w) >= words else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows, bases = [], [rng.choices(vocabulary, k=rng.choice([3, 5, 12, 40, 120, 300])) for _ in range(25)]
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words += passage
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words).replace("w1", rng.choice(["w1", "W1"]))))
    return rows + [(n, ""), (n + 1, None), (n + 2, " \n "), (n + 3, "one two"), (n + 4, "One  two"), (n + 5, "two one")]


def test_against_brute_force(spark):
    for seed, words, percent in ((1, 4, 85), (2, 5, 80)):
        rows = corpus(seed)
        df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_components(df, words=words, percent=percent).collect()}
        assert got == brute(rows, words, percent)


def test_blocks_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    rows = corpus(3, 120)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_components(spark.createDataFrame(rows, "doc_id long, text string"), words=4, percent=85).collect()}
    assert got == brute(rows, 4, 85)


def test_sets_that_share_a_name_are_told_apart(spark, monkeypatch):
    rows = corpus(8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    namings, real = [], N._named_sets
    monkeypatch.setattr(N, "_named_sets", lambda *a: namings.append(real(*a)) or namings[-1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_components(df, words=4, percent=85, name_bits=11).collect()}
    assert namings[0][2].clash and got == brute(rows, 4, 85)


def test_small_blocks_of_texts_and_hashes_that_many_hold(spark, monkeypatch):
    monkeypatch.setattr(N, "TEXT_BLOCK", 3000)
    monkeypatch.setattr(N, "BUCKET", 500)
    monkeypatch.setattr(N, "OFTEN", 4)
    monkeypatch.setattr(N, "FEW_SETS", 10)
    rows = corpus(4, 120)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=5, percent=80).collect()}
    assert got == brute(rows, 5, 80)


def test_groups_about_the_threshold(spark, monkeypatch):
    """Groups whose members are 79, 80 and 81 % alike: all links are found, and no more of them leave the tiles than sets came."""
    rng, rows = random.Random(5), []
    for group, share in enumerate((79, 80, 81)):
        own = (100 - share) * 200 // (100 + share)  # distinct words at the end of each
        for i in range(60):
            rows.append((group * 100 + i, " ".join([f"g{group}w{k}" for k in range(200 - own + rng.randint(-6, 6))] + [f"o{group}i{i}k{k}" for k in range(own)])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_components(spark.createDataFrame(rows, "doc_id long, text string"), words=5, percent=80).collect()}
    want = brute(rows, 5, 80)
    assert got == want
    assert 3 < len({c for _, c in want.values()}) < 180


def test_a_tile_gives_fewer_links_than_sets():
    import pyarrow as pa

    n, m = 40, 30
    common = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rng = np.random.default_rng(1)
    sets = [np.unique(np.concatenate([common, rng.integers(1 << 40, 1 << 62, k % 2 * n).astype(np.uint64)])) for k in range(m)]
    data = {"tok": [9] * m, "low": [0] * m, "i": [0] * m, "kind": [0] * m, "j": [0] * m, "side": [0] * m, "id": list(range(m)), "n": [len(s) for s in sets], "comp": list(range(m)), "sig": [N.signature(s, 512) for s in sets], "hashes": [s.tobytes() for s in sets], "toks": [[9, 11]] * m}
    batch = pa.table(data).to_batches()
    links = [r for b in N._link_rows(80)(iter(batch)) for r in b.to_pylist()]
    assert 0 < len(links) < m
    data["toks"] = [[5, 9]] * m  # all pairs belong to an earlier list
    assert not [r for b in N._link_rows(80)(iter(pa.table(data).to_batches())) for r in b.to_pylist()]


def test_text_ids_repeated_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [("b", text), ("b", text), ("a", "else " * 30), ("a", text + " end"), ("c", ""), ("c", None), ("d", text)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.near_components(df).collect())
    assert got == [("a", 1, "a"), ("a", 97, "a"), ("b", 96, "a"), ("b", 96, "a"), ("c", 0, "c"), ("c", 0, "c"), ("d", 96, "a")]
    left = sorted((r.doc_id, r.text or "") for r in N.drop_near_copies(df).collect())
    assert left == [("a", "else " * 30), ("a", text + " end"), ("c", ""), ("c", "")]
    twice = df.where("doc_id = 'b'")
    assert [(r.doc_id, r.text) for r in N.drop_near_copies(twice).collect()] == [("b", text)]


def test_signature_never_loses_a_link():
    rng = np.random.default_rng(0)
    for n in (1, 5, 60, 700):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for drop in range(0, n // 5 + 1, max(1, n // 20)):
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 62, drop).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                bits = min(N.signature_bits(len(a)), N.signature_bits(len(b)))
                ones = N._ones(N._stacked([N.signature(a, N.signature_bits(len(a)))], bits), N._stacked([N.signature(b, N.signature_bits(len(b)))], bits))
                assert N.passing(np.array([len(a)]), np.array([len(b)]), ones, 85)[0, 0]
                assert set(a[: N.prefix_length(len(a), 85)]) & set(b[: N.prefix_length(len(b), 85)])


def test_drop_keeps_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(3, text, "x"), (1, text + " end", "y"), (2, "else " * 30, "z"), (None, text, "n")], "doc_id long, text string, root string")
    got = N.drop_near_copies(df)
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} == {1, 2, None}


def test_empty_table(spark):
    assert N.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
