import math

import numpy as np
from pyspark.sql import functions as F

from loomspark.llm import ann


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24)) + 1.5 * rng.normal(size=(12, 24))[rng.integers(0, 12, 1500)]
    x[700:710] = x[699]
    rows = [(i, v.tolist(), "l") for i, v in enumerate(x)]
    rows += [(9001, None, ""), (9002, [0.0] * 24, ""), (9003, [math.nan] + [1.0] * 23, ""), (9004, [math.inf] + [1.0] * 23, ""), (9005, [None] + [1.0] * 23, ""), (9006, [1.0], ""), (None, [1.0] * 24, ""), (9007, [], ""), (5, x[5].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0, shard=400).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    assert sorted(got) == list(range(0, 1500, 50))
    for q, found in got.items():
        found.sort()
        s = u @ u[q]
        s[q] = -9
        true = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s[v] - score) < 1e-12 for _, v, score in found)
        assert [v for _, v, _ in found] == sorted((v for _, v, _ in found), key=lambda v: (-round(s[v], 12), v))
        hits += len(set(true.tolist()) & {v for _, v, _ in found})
    assert hits / (5 * len(got)) >= 0.9
    assert [v for _, v, _ in got[700]] == [699, 701, 702, 703, 704]


def test_of_many_copies_the_smallest_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2500, 16))
    copies = rng.permutation(2500)[:1000]
    x[copies[:500]] = x[copies[0]]  # equal
    x[copies[500:]] = x[copies[500]] * rng.uniform(0.1, 9, 500)[:, None]  # equal to rounding
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for group in (copies[:500], copies[500:]):
        asked = sorted(group.tolist())[::60]
        got = {}
        for r in ann.nearest(df, F.col("id").isin(asked)).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
        for q in asked:
            assert [got[q][i] for i in range(1, 6)] == [i for i in sorted(group.tolist()) if i != q][:5]


def found_in(x, ids, asked, k=5, sure=ann.SURE, kth=-math.inf):
    """What ``search`` finds in one tree over the rows of x."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    points = x @ ann.projection(x.shape[1])
    tree = ann.Tree(points)
    got = ann.search(tree, x[tree.order], ids[tree.order], points[tree.order], x[asked], points[asked], ids[asked], np.full(len(asked), kth), k, ann.chi_square_bound(sure, points.shape[1]))
    return {q: (ids[tree.order][one.rows].tolist(), one.scores, one.verified, one.leaves / len(tree.spans)) for q, one in got}


def test_ties_are_cut_by_id():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16))
    x[:500] = x[0]
    ids = rng.permutation(600)
    at, score, *_ = found_in(x, ids, np.array([0]))[0]
    assert at == [i for i in sorted(ids[:500].tolist()) if i != ids[0]][:5]
    assert np.allclose(score, 1)


def test_fewer_are_verified_the_more_there_are():
    """Directions without any structure, where the stopping test prunes and boxes of many dimensions hardly do."""
    shares, leaves = [], []
    for n in (2_000, 8_000, 32_000):
        x = np.random.default_rng(n).normal(size=(n, 64))
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        asked = np.arange(0, n, n // 100)
        got = found_in(x, np.arange(n), asked)
        hits = 0
        for q, a in enumerate(asked):
            s = u @ u[a]
            s[a] = -9
            hits += len(set(np.argsort(-s)[:5].tolist()) & set(got[q][0]))
        shares.append(np.mean([got[q][2] for q in got]) / n)
        leaves.append(np.mean([got[q][3] for q in got]))
        print(f"{n} vectors: {shares[-1]:.3f} verified, {leaves[-1]:.3f} of the leaves read, recall {hits / 5 / len(asked):.3f}")
        assert hits / 5 / len(asked) >= 0.9
    # of fewer dimensions boxes leave out most
    x = np.random.default_rng(1).normal(size=(32_000, 16))
    low = np.mean([one[3] for one in found_in(x, np.arange(32_000), np.arange(0, 32_000, 400)).values()])
    print(f"16 components: {low:.3f} of the leaves read")
    assert low < 0.8
    assert shares[0] < 0.4 and shares == sorted(shares, reverse=True) and shares[2] < 0.7 * shares[0]


def test_clusters_are_pruned_by_boxes():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32))
    x = centres[np.arange(8000) % 40] + 0.05 * rng.normal(size=(8000, 32))
    asked = np.arange(0, 8000, 200)
    got = found_in(x, np.arange(8000), asked)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q, a in enumerate(asked):
        s = u @ u[a]
        s[a] = -9
        hits += len(set(np.argsort(-s)[:5].tolist()) & set(got[q][0]))
    print(f"clusters: {np.mean([x[2] for x in got.values()]):.0f} of 8000 verified, {np.mean([x[3] for x in got.values()]):.3f} of the leaves read, recall {hits / 5 / len(asked):.3f}")
    assert hits / 5 / len(asked) >= 0.9
    assert max(x[2] for x in got.values()) <= 512 and np.mean([x[3] for x in got.values()]) < 0.2
    # what is known from elsewhere is a bound too
    assert not found_in(-x, np.arange(8000), np.array([3]), kth=1.0)[0][2] > 5


def test_one_leaf_and_many_give_the_same():
    """Leaves decide what is read, not what is found, but for what the test lets go."""
    x = np.random.default_rng(12).normal(size=(3000, 12))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    points = u @ ann.projection(12)
    asked = np.arange(0, 3000, 50)
    found = []
    for leaf in (3000, 16):
        tree = ann.Tree(points, leaf)
        o = tree.order
        found.append({q: (set(o[one.rows].tolist()), one.leaves / len(tree.spans)) for q, one in ann.search(tree, u[o], o, points[o], u[asked], points[asked], asked, np.full(len(asked), -math.inf), 5, ann.chi_square_bound(0.9999, points.shape[1]))})
    assert all(found[0][q][0] == found[1][q][0] for q in found[0])
    assert np.mean([x for _, x in found[1].values()]) < 1


def test_widths_do_not_mix(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, rng.normal(size=5).tolist()) for i in range(60)] + [(2000, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0, shard=50).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert sorted(got) == [*range(0, 300, 50), 1000, 1050]
    assert all(len(v) == 5 and {x // 1000 for x in v} == {q // 1000} for q, v in got.items())


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (50, [1e-200, 1e-200])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.nearest(df, F.col("id") % 50 == 0).collect())
    assert got == [(0, 1, 50, round(0.5**0.5, 9)), (0, 2, 1, 0.0), (50, 1, 0, round(0.5**0.5, 9)), (50, 2, 1, round(0.5**0.5, 9))]
    assert ann.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_chi_square():
    assert abs(ann.chi_square(ann.chi_square_bound(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(ann.chi_square_bound(0.95, 8) - 15.507) < 1e-3


def test_tree_and_splits_hold_every_point():
    points = np.random.default_rng(1).normal(size=(900, 8))
    tree = ann.Tree(points, 32)
    assert sorted(tree.order.tolist()) == list(range(900)) and tree.spans[:, 1].max() == 900
    assert max(b - a for a, b in tree.spans.tolist()) <= 32
    gaps = ann.box_gaps(points[tree.order], tree.low, tree.high)
    for leaf, (a, b) in enumerate(tree.spans.tolist()):
        assert (gaps[a:b, leaf] == 0).all()
    cells = ann.Splits.fit(points[:200], 3).cells(points)
    assert set(cells.tolist()) == set(range(8))
