import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from loomspark.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term int, n int, gid int, value string"


def plain(rows, min_docs=3, top=200):
    """Every pair of sources over every kept term, one by one. Rows are (text, lang, source)."""
    docs = defaultdict(list)
    for text, lang, source in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        docs[lang or ""].append((source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))))
    out = set()
    for lang, own in docs.items():
        held = Counter(t for _, c in own for t in c)
        kept = [t for t, n in held.items() if n >= min_docs]
        counts = {s: Counter() for s, _ in own}
        for s, c in own:
            counts[s].update({t: n for t, n in c.items() if held[t] >= min_docs})

        def share(c, t):
            return 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept))

        whole = sum(counts.values(), Counter())
        for s, c in counts.items():
            pairs = [(-sum((share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept), o.encode(), o) for o, d in counts.items() if o != s]
            terms = [(-((share(c, t) - share(whole, t)) ** 2 // share(whole, t)), t.encode(), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, values in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(values)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, 2, 3, "x") for i, (t, lang, s) in enumerate(rows)], SCHEMA)


def result(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["The", "the", "THE", "naïve", "Ärger", "ärger", "x1y", "中文", "q", "zebra", "don't", "O", "o"] + [f"w{chr(97 + k)}" for k in range(12)]
    return [
        (
            rng.choice([None, "", " 12 ", " ".join(rng.choices(words, k=rng.randint(1, 30)))]) if rng.random() < 0.3 else " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(1, 40))),
            rng.choice(["en", "en", "de", None, ""]),
            rng.choice(["a", "b", "B", "é", None, "", "hot", "hot", "hot"]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_as_one_by_one(spark, seed):
    rows = some_rows(seed, 120)
    rows += rows[:5] * 2  # repeated rows
    assert result(divergence.divergence(frame(spark, rows).repartition(3))) == plain(rows)


def test_few_first_terms(spark):
    rows = some_rows(9, 150)
    assert result(divergence.divergence(frame(spark, rows), min_docs=2, top=3)) == plain(rows, 2, 3)


def test_sources_without_terms_and_languages_without_kept_terms(spark):
    rows = [("one two", "en", "a"), ("one", "en", "b"), ("one", "en", "c"), (None, "en", "none"), ("1 2 3", "en", "digits"), ("alone", "fr", "x"), ("other", "fr", "y"), ("single", "es", "z")]
    got = result(divergence.divergence(frame(spark, rows)))
    assert got == plain(rows)
    assert ("fr", "x", "pair", "y", 0, 1) in got and not [r for r in got if r[0] == "es"]


def test_bounds_do_not_matter(spark, monkeypatch):
    rows = some_rows(4, 60)
    table = frame(spark, rows).select("text", "lang", "source").toArrow().to_batches()
    whole = Counter()
    for b in divergence._counted(iter(table)):
        for r in b.to_pylist():
            whole.update({(r["lang"], r["source"], r["term"], k): r[k] for k in ("n", "docs")})
    monkeypatch.setattr(divergence, "ENTRIES", 1)
    monkeypatch.setattr(divergence, "LONG", 10)
    monkeypatch.setattr(divergence, "BATCH", 2)
    cut = Counter()
    for b in divergence._counted(iter(table)):
        for r in b.to_pylist():
            cut.update({(r["lang"], r["source"], r["term"], k): r[k] for k in ("n", "docs")})
    assert cut == whole


def test_empty(spark):
    assert divergence.divergence(frame(spark, [])).count() == 0


def test_sql(spark):
    rows = some_rows(6, 100)
    con = duckdb.connect()
    con.register("documents", frame(spark, rows).toPandas())
    got = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({divergence.OP12_SQL})").fetchall()
    assert set(got) == plain(rows)
