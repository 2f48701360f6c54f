import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_what_is_predicted_toxic_goes(spark, tmp_path, monkeypatch):
    from loomspark.llm import toxicity

    spark.createDataFrame([(1, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([(1, "a text"), (2, "another")], "doc_id long, text string")
    for score, left in ((0.29, 2), (0.3, 0), (0.45, 0)):
        monkeypatch.setattr(toxicity, "fit", lambda *_, score=score: toxicity.Model(None, 0.0, score))
        assert corpus_pipeline.toxicity_stage(spark, docs, str(tmp_path)).count() == left


def test_stages(spark, tmp_path):
    from loomspark.llm import exact_dedup, secret_scan

    base = " ".join(f"w{i % 97}x{i}" for i in range(300))
    rows = [(i, f"{base} {i}" if i in (1, 2) else f"text {i} " + " ".join(f"v{i}y{k}" for k in range(40)), "en", "s") for i in range(1, 60)]
    rows += [(60, rows[9][1], "en", "s"), (61, "password=abcdef123 " + " ".join(f"own{k}" for k in range(60)), "en", "s"), (62, None, "en", "s")]
    rows += [(100 + i, f"text {100 + i} " + " ".join(f"v{100 + i}y{k}" for k in range(40)) + " grumfex blotzig you", "en", "s") for i in range(30)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, int(r[0] >= 100)) for r in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert ids["toxicity"] == set(range(1, 63))
    assert ids["exact_dedup"] == ids["toxicity"] - {60}
    assert ids["ngram_join"] == ids["exact_dedup"] - {2}
    assert ids["secret_scan"] == ids["ngram_join"] == ids["packing"]
    for n in ("toxicity", "exact_dedup", "ngram_join", "secret_scan"):
        assert seen[n].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    masked = seen["secret_scan"].where("doc_id = 61").first()
    assert masked.text.startswith("[secret] ") and masked.n_chars == len(masked.text)
    assert exact_dedup.exact_groups(seen["ngram_join"]).where("not kept").count() == 0
    assert secret_scan.find_secrets(seen["secret_scan"]).where("size(spans) > 0").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(ids["packing"])


def plain_run(rows, model):
    """The pipeline by its definition, over (doc_id, text) with distinct ids: what is left, and its pieces."""
    from test_ngram_join import brute

    from loomspark.llm import secret_scan

    left = [(i, t) for i, t in rows if model.score(np.array(model.summaries([t or ""], {})))[0] < corpus_pipeline.REJECT_AT]
    first = {}
    for i, t in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    left = [(i, t) for i, t in left if i in set(first.values())]
    groups = brute(left, 5, 80)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    clean = {}
    for i, t in left:
        spans = sorted((m.start(), m.end()) for r in secret_scan.RULES for m in re.finditer(r.pattern, t or "") if len(m[r.group]) >= r.least)
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += (t or "")[at:a] + "[secret]"
            at = max(at, b)
        clean[i] = t if not spans else out + t[at:]
    pieces = set()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in clean.items():
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        pieces |= {(i, k, k * 4096, len(ids[k * 4096 : (k + 1) * 4096]), zlib.crc32(ids[k * 4096 : (k + 1) * 4096].tobytes())) for k in range(-(-len(ids) // 4096))}
    return pieces


def test_run_against_a_plain_one(spark, tmp_path):
    import random

    from loomspark.llm import toxicity
    from loomspark.llm.common import is_held_out

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bdlmnrst") for _ in range(rng.randint(1, 4)))
    rows, toxic = [], {}
    for i in range(420):
        text = [word() for _ in range(rng.randint(8, 80))]
        toxic[i] = int(i % 7 == 0)
        if toxic[i]:
            for bad in rng.sample(["zwuckel", "krompf", "vexnar"], 2):
                text.insert(rng.randrange(len(text)), bad)
        if i % 10 == 3:
            text.append("token=abcdef123456 " + "0123456789abcdef" * 2)
        if i % 5 == 1 and rows:
            text = (rng.choice(rows)[1] or "none").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                text[rng.randrange(len(text))] = word()
        rows.append((i, rng.choice([" ", "  "]).join(text)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a <|endoftext|> b"), (904, "long words " * 5000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    model = toxicity.fit(docs, labels, "toxic", ~is_held_out("doc_id", 4, 2))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == plain_run(rows, model)
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 4096


def test_odd_rows_and_names(spark, tmp_path):
    """Null ids, repeated rows and ids, and columns named as the operators' own."""
    text = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    rows = [(None, text), (None, text), (1, text), (1, text), (1, other), (2, other + " end"), (3, None), (3, None), (4, "")]
    names = ["id", "h", "t", "rep", "n", "sig", "_key", "_id", "_text_sha", "kept", "piece"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame([(*r, *names) for r in rows], schema)
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", *names]
    left = lambda name: sorted((r.doc_id or 0, (r.text or "")[-3:]) for r in seen[name].collect())
    assert left("toxicity") == sorted((i or 0, (t or "")[-3:]) for i, t in rows)
    assert left("exact_dedup") == [(1, "v59"), (1, "w59"), (2, "end"), (3, "")]
    assert left("ngram_join") == left("secret_scan") == [(1, "v59"), (1, "w59"), (3, "")]
    assert sorted(r.doc_id for r in seen["packing"].collect()) == [1, 1, 3]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
