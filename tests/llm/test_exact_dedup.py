import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomspark.llm.common import components, member_gate, stars
from loomspark.llm.exact_dedup import PREFIX_CHARS, drop_copies, exact_groups

TEXTS = [(5, "a  b"), (2, "a\tb"), (9, "a b "), (3, None), (4, ""), (7, "x" * 5000 + "1"), (8, "x" * 5000 + "2"), (6, "x" * 5000 + "1"), (None, "a b"), (1, " ")]


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, 0) for i, t in TEXTS], "doc_id long, text string, keep_id int")
    got = sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in exact_groups(df, digest=True).collect()), key=str)
    assert got == brute(TEXTS)
    assert sorted((tuple(r)[:4] for r in exact_groups(df).collect()), key=str) == sorted((x[:4] for x in brute(TEXTS)), key=str)


def test_drop_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(i, t, "k") for i, t in TEXTS], "doc_id long, text string, len string")
    got = drop_copies(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == {i for i, _, _, kept, _ in brute(TEXTS) if kept}


def test_drop_with_ids_that_repeat(spark):
    same = "p" * (PREFIX_CHARS * 2)
    rows = [(1, "twice"), (1, "twice"), (1, "twice "), (1, "twice\n"), (2, "twice"), (None, "no id"), (None, "no id"), (3, "own"), (5, same + "a"), (4, same + "a"), (5, same + "b"), (5, same + "b")]
    got = drop_copies(spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, _text_sha string"))
    assert got.columns == ["doc_id", "text", "_text_sha"]
    assert sorted((r.doc_id or 0, r.text.strip()[:5] + r.text.strip()[-1]) for r in got.collect()) == [(0, "no idd"), (1, "twicee"), (1, "twicee"), (3, "ownn"), (4, "pppppa"), (5, "pppppb")]


def test_long_equal_prefixes_differ(spark):
    same = "p" * (PREFIX_CHARS * 3)
    df = spark.createDataFrame([(1, same + "a"), (2, same + "b"), (3, same + "a")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id) for r in exact_groups(df).collect()} == {(1, 1), (2, 2), (3, 1)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_groups(empty, digest=True).count() == 0
    assert drop_copies(empty).count() == 0


def test_gate_loses_no_member(spark):
    keys = spark.range(500).select((F.col("id") * 7).alias("k"))
    got = member_gate(spark.range(5000).select(F.col("id").alias("k")), keys, ["k"], bits=16)
    kept = {r.k for r in got.collect()}
    assert {7 * i for i in range(500)} & set(range(5000)) <= kept and len(kept) < 1500


@pytest.mark.parametrize("find", [stars, components])
def test_components(spark, find):
    edges = [(1, 2), (2, 3), (10, 11), (12, 11), (20, 20), (3, 1)] + [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)]
    got = {r.node: r.root for r in find(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 231)}
    assert {k: v for k, v in got.items() if k != 20} == want
