import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import quality, toxicity
from loomspark.llm.common import is_held_out


def auc(pairs):
    rank = {}
    order = sorted(pairs)
    for s in {s for s, _ in pairs}:
        at = [i for i, (x, _) in enumerate(order) if x == s]
        rank[s] = sum(at) / len(at)
    ones = [rank[s] for s, y in pairs if y]
    n = len(pairs) - len(ones)
    return (sum(ones) - len(ones) * (len(ones) - 1) / 2) / (len(ones) * n)


def words(rng, n):
    return " ".join("".join(rng.choice("aeiou") + rng.choice("bdlmnrst") for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(900):
        text, toxic, good = words(rng, rng.randint(20, 90)), 0, 1
        if i % 6 == 0:
            for bad in rng.sample(["zwuckel", "krompf", "vexnar"], 2):
                form = rng.choice([bad, bad + rng.choice(["e", "ig", "s"]), bad[:3] + rng.choice("*-.") + bad[3:], bad.upper()])
                at = rng.randrange(len(text))
                text = text[:at] + f" {form} " + text[at:]
            toxic = 1
        if i % 5 == 0:
            text, good = " ".join(w + rng.choice(["$$$", "###", "!!"]) for w in text.split()), 0
        docs.append((i, text, "en", "s"))
        labels.append((i, good, toxic))
    docs += [(1000, None, "en", "s"), (1001, "", "en", "s"), (None, docs[0][1], "en", "s"), (5, docs[5][1], "en", "s"), (1002, "long " * 60_000, "en", "s"), (1003, "a z w u c k e l b", "en", "s")]
    labels += [(None, 1, 1), (7, None, None), (5000, 0, 1)]
    return spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, lang string, source string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels if i is not None and i < 900 and q is not None}


@pytest.mark.parametrize(("module", "label", "at", "parts", "part"), [(toxicity, "toxic", 1, 4, 2), (quality, "quality", 0, 3, 1)])
def test_held_out_rows_are_ranked(spark, tables, module, label, at, parts, part):
    docs, labels, truth = tables
    held = is_held_out("doc_id", parts, part)
    got = module.score_documents(docs, module.fit(docs, labels, label, ~held)).withColumn("held", held).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert auc([(r.score, truth[r.doc_id][at]) for r in got if r.held and r.doc_id in truth]) >= 0.95
    by = {r.doc_id: r.score for r in got}
    assert len({round(r.score, 12) for r in got if r.doc_id == 5}) == 1
    if module is toxicity:
        assert by[1000] == by[1001] < 0.3 < by[1003]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_without_labels(spark, tables, module):
    docs, labels, _ = tables
    model = module.fit(docs, labels.limit(0), "toxic", F.lit(True))
    assert {r.score for r in module.score_documents(docs.limit(5), model).collect()} == {0.0 if module is toxicity else 0.5}
    one = module.fit(docs, labels.where("toxic = 0"), "toxic", F.lit(True))
    assert {r.score for r in module.score_documents(docs.limit(5), one).collect()} == {0.0}
    assert module.score_documents(docs.limit(0), model).count() == 0


def test_insults_each_spelt_differently(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(600):
        text, toxic = words(rng, 40), int(i % 5 == 0)
        if toxic:
            bad = list("zwuckelkrompf")
            for _ in range(3):
                bad.insert(rng.randrange(1, len(bad)), rng.choice("qxyjv"))
            text += f" {''.join(bad)} " + words(rng, 5)
        docs.append((i, text))
        labels.append((i, toxic))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = is_held_out("doc_id", 4, 2)
    got = toxicity.score_documents(docs, toxicity.fit(docs, labels, "toxic", ~held)).where(held).collect()
    assert auc([(r.score, int(r.doc_id % 5 == 0)) for r in got]) >= 0.85
    caught = [sum(r.score >= toxicity.PREDICTED_AT for r in got if (r.doc_id % 5 == 0) == y) / sum((r.doc_id % 5 == 0) == y for r in got) for y in (True, False)]
    assert caught[0] >= 0.7 and caught[1] <= 0.25


def test_drop_toxic_keeps_columns(spark, tables):
    docs, labels, truth = tables
    kept = toxicity.drop_toxic(docs, toxicity.fit(docs, labels, "toxic", F.lit(True)))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and {1000, 1001, None} - {None} <= set(ids)
    assert sum(truth[i][1] for i in ids if i in truth) <= 8 and sum(1 - truth[i][1] for i in set(ids) if i in truth) >= 740


def kernel(a, b):
    """The kernel by its definition."""
    from itertools import combinations

    def vector(w):
        codes = [toxicity._CODES[min(ord(c), 0xFFFF)] for c in "\x01" + w + "\x02"]
        out, squares = {}, 0.0
        for i, j, k in combinations(range(len(codes)), 3):
            if k - i < toxicity.SPAN and codes[i] and codes[j] and codes[k]:
                key, weight = (codes[i], codes[j], codes[k]), toxicity.DECAY ** (k - i - 2)
                out[key] = out.get(key, 0) + weight
                squares += weight**2
        return out, squares**0.5

    (x, m), (y, n) = vector(a), vector(b)
    return sum(v * y.get(s, 0) for s, v in x.items()) / (m * n)


def test_kernel_by_definition():
    some = ["idiot", "idi*ot", "id-iot", "banana", "bananana", "a", "émile"]
    got = toxicity._dense(some)
    assert np.allclose(got @ got.T, [[kernel(a, b) for b in some] for a in some], atol=1e-5)
    assert kernel("idiot", "idi*ot") > 0.5 > kernel("idiot", "banana")


def test_normal_equations_against_numpy(spark, tables):
    """The fit's weights are those of the ridge regression over all its rows at once."""
    docs, labels, truth = tables
    model = quality.fit(docs, labels, "quality", F.col("doc_id") < 900)
    rows = docs.join(labels.where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id").where("doc_id < 900").select("doc_id", "text", "quality", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("apart")).collect()
    y_all = np.array([r.quality for r in rows])
    x = np.array([quality.statistics(r.text) for r in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.std[:-1], np.maximum(x.std(0), 1e-6)[:-1])
    z, y = model.features(x[[not r.apart for r in rows]]), np.array([r.quality for r in rows if not r.apart], float)
    w = np.where(y > 0, len(y_all) / (2 * y_all.sum()), len(y_all) / (2 * (len(y_all) - y_all.sum())))
    want = np.linalg.solve((z * w[:, None]).T @ z + quality.RIDGE * len(y_all) / 1000 * np.eye(z.shape[1]), z.T @ (w * y))
    assert np.allclose(model.weights, want, atol=1e-6)


def test_fourier_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(1)
    n = len(quality.statistics(""))
    model = quality.Model(np.zeros(n), np.ones(n), rng.normal(size=(n, 20_000)) / (n**0.5 * 0.7), rng.uniform(0, 2 * np.pi, 20_000), np.zeros(20_001), np.empty(0), np.empty(0), 0.5)
    x = rng.normal(size=(12, n))
    z = model.features(x)[:, :-1]
    far = np.square(x[:, None] - x[None]).sum(2)
    assert np.abs(z @ z.T - np.exp(-far / (2 * n * 0.49))).max() < 0.05


@pytest.mark.parametrize("module", [toxicity, quality])
def test_clashing_columns(spark, tables, module):
    docs, labels, _ = tables
    some = docs.limit(20)
    model = module.fit(docs, labels, "quality", F.lit(True))
    want = sorted((r.doc_id or -1, round(r.score, 9)) for r in module.score_documents(some, model).collect())
    odd = some.withColumns({c: F.lit("x") for c in ("id", "y", "x", "held_out", "predicted", "d", "_id", "_toxicity")})
    assert sorted((r.doc_id or -1, round(r.score, 9)) for r in module.score_documents(odd, model).collect()) == want


def test_landmarks_give_the_exact_machine():
    """With all words as landmarks the machine is that of the exact kernel, on explicit subsequence vectors."""
    rng = random.Random(6)
    some = list(dict.fromkeys(["idiot", "idi*ot", "moron", "mo.ron", "banana", "bandana", *words(rng, 40).split()]))
    y = np.array([1.0 if w[:2] in ("id", "mo") else -1.0 for w in some])
    exact = toxicity._dense(some)
    values, vectors = np.linalg.eigh(exact @ exact.T)
    near = exact @ exact.T @ (vectors / np.sqrt(np.maximum(values, 1e-9)) @ vectors.T)
    decisions = []
    for x in (exact, near):
        w, offset = toxicity._machine(x, y, np.ones(len(y)) * 10, 0.2)
        decisions.append(x @ w - offset)
    assert np.allclose(*decisions, atol=1e-3) and (np.sign(decisions[0]) == y).all()
    # folded into one weight per subsequence, it scores words as the exact kernel does
    x, keys = exact, np.unique(toxicity.subsequences(some)[0])
    w, offset = toxicity._machine(x, y, np.ones(len(y)) * 10, 0.2)
    weights = np.zeros(toxicity.ALPHABET**3, np.float32)
    weights[keys] = w
    weights[0] = 0
    model = toxicity.Model(weights, offset, 0.5)
    assert np.allclose(model.decisions(some), x @ w - offset, atol=1e-3)


def test_isotonic():
    x = np.array([3.0, 1.0, 2.0, 4.0])
    knots, values = quality.isotonic(x, np.array([1.0, 0.0, 1.0, 0.0]))
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all()
