import json
import os

import pytest
from pyspark.sql import functions as F

from loomspark import cli
from loomspark.config import Chunking, Settings, load_settings
from loomspark.functions import models
from loomspark.operators import chunking
from loomspark.sources import files, store, tables
from loomspark.streaming import ingest as stream

GRAPH = """<?xml version='1.0' encoding='utf-8'?>
<graphml><key id="d0" for="node" attr.name="entity_type" attr.type="string"/><key id="d1" for="edge" attr.name="weight" attr.type="double"/>
<graph edgedefault="undirected"><node id="A"><data key="d0">artifact</data></node><node id="B"/>
<edge source="B" target="A"><data key="d1">2.0</data></edge></graph></graphml>"""


def test_texts_and_stores(spark, tmp_path):
    (tmp_path / "t" / "sub").mkdir(parents=True)
    (tmp_path / "t" / "sub" / "one.v2.txt").write_text("line\n二", encoding="utf-8")
    (tmp_path / "t" / "blank.txt").write_text(" \n")
    (tmp_path / "t" / "x.md").write_text("no")
    (tmp_path / "t" / "p.pdf").write_bytes(b"%PDF")
    rows = files.text_documents(spark, str(tmp_path / "t")).collect()
    assert [(r.document_id, r.text) for r in rows] == [("one.v2", "line\n二")]
    assert [r.document_id for r in files.pdf_files(spark, str(tmp_path / "t")).collect()] == ["p"]
    (tmp_path / "g.graphml").write_text(GRAPH)
    nodes, edges = files.graphml(spark, str(tmp_path / "g.graphml"))
    assert {(r.node_id, r.entity_type) for r in nodes.collect()} == {("A", "artifact"), ("B", None)}
    assert [(r.source, r.target, r.weight) for r in edges.collect()] == [("B", "A", "2.0")]
    (tmp_path / "k.json").write_text(json.dumps({"A<SEP>B": {"chunk_ids": ["c"], "count": 1}}))
    assert [(r.key, r.chunk_ids, r["count"]) for r in files.key_value_store(spark, str(tmp_path / "k.json"), files.STORES["relation_chunks"]).collect()] == [("A<SEP>B", ["c"], 1)]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    (tmp_path / "working/processed/d1").mkdir(parents=True)
    (tmp_path / "working/processed/d1/a.txt").write_text("A Spindle-Motor of the GSK980 controller is wired here\nAnother line of the same text that is long", encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps({"chunking": {"max_chunk_size": 100, "overlap_size": 10}, "unknown": 1}))
    assert load_settings(None) == Settings() and load_settings("c.json").chunking.max_chunk_size == 100
    assert cli.main(["--list-domains"]) == 0 and "processed: d1" in capsys.readouterr().out
    assert cli.main(["-s", "2", "-s", "3", "-d", "d1"]) == 0
    lines = [json.loads(x) for f in (tmp_path / "working/output/d1").rglob("*.jsonl") for x in f.read_text(encoding="utf-8").splitlines()]
    assert lines and all({"question_id", "content", "metadata", "created_at"} <= set(x) for x in lines)
    assert spark.read.parquet(str(tmp_path / "working/graph/d1/nodes")).count() >= 2
    assert cli.main(["-s", "3", "-i", "nowhere"]) == 1


def test_stream_takes_each_document_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("first")
    for text in ("second", "third"):
        stream.start_ingest(stream.document_stream(spark, str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination()
        (tmp_path / f"in/{text}.txt").write_text(text)
    stream.start_ingest(stream.document_stream(spark, str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "cp2")).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "store/doc_status")).collect()) == ["a", "second", "third"]
    chunks = sorted((r.doc_id, r.content) for r in spark.read.parquet(str(tmp_path / "store/chunks")).collect())
    assert chunks == [("a", "first"), ("second", "second"), ("third", "third")]


def test_store_adds_what_is_new(spark, tmp_path):
    at = str(tmp_path / "store")
    docs = spark.createDataFrame([("a", "The GSK980 drives a Spindle here"), ("b", "Another GSK980 text"), ("a", "twice")], "doc_id string, text string")
    assert store.add(docs.where("text <> 'twice'"), at, chunking.char_chunks) == 2
    assert store.add(docs, at, chunking.char_chunks) == 0
    assert store.add(docs.unionByName(docs.select(F.lit("c").alias("doc_id"), F.lit("Lathe-Nine").alias("text")).limit(1)), at, chunking.char_chunks) == 1
    assert {t: store.stored(spark, at, t).count() for t in ("chunks", "doc_status")} == {"chunks": 3, "doc_status": 3}
    assert {(r.doc_id, r.entity_id) for r in store.stored(spark, at, "nodes").collect()} >= {("a", "GSK980"), ("b", "GSK980"), ("c", "Lathe-Nine")}
    assert store.stored(spark, at, "nothing") is None


TABLES = ["chunks", "entities", "nodes", "edges", "node_chunk", "doc_status"]


def counts(spark, at):
    return {t: {(r.doc_id, r.n) for r in store.stored(spark, at, t).groupBy("doc_id").agg(F.count("*").alias("n")).collect()} for t in TABLES}


@pytest.mark.parametrize("after", range(1, len(TABLES) + 2))
def test_a_run_that_fails_leaves_nothing_to_read(spark, tmp_path, monkeypatch, after):
    """A failure after each write, or before the commit; then a run with other documents too."""
    at, real = str(tmp_path / "store"), store._write
    docs = lambda *names: spark.createDataFrame([(n, f"The GSK980 drives a Spindle-{n} here") for n in names], "doc_id string, text string")
    store.add(docs("z"), at, chunking.char_chunks)
    before = counts(spark, at)
    written = []

    def failing(rows, path):
        real(rows, path)
        written.append(path)
        if len(written) == after:
            raise OSError("lost")

    monkeypatch.setattr(store, "_write", failing)
    if after > len(TABLES):
        monkeypatch.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        store.add(docs("a", "b"), at, chunking.char_chunks)
    monkeypatch.undo()
    assert counts(spark, at) == before
    assert store.add(docs("a", "b", "c"), at, chunking.char_chunks) == 3
    whole = str(tmp_path / "whole")
    store.add(docs("z", "a", "b", "c"), whole, chunking.char_chunks)
    assert counts(spark, at) == counts(spark, whole)
    assert store.vacuum(spark, at, older_s=0) == min(after, len(TABLES)) and counts(spark, at) == counts(spark, whole)


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """One commits others' documents while this one writes, then one of the same documents."""
    at, real = str(tmp_path / "store"), store.publish
    docs = lambda *names: spark.createDataFrame([(n, f"The GSK980 drives a Spindle-{n} here") for n in names], "doc_id string, text string")
    others, taken = [("x",), ("b", "y")], []

    def late(spark_, at_, now):
        if others and not taken:
            taken.append(1)
            store.add(docs(*others.pop(0)), at, chunking.char_chunks)
            taken.clear()
        return real(spark_, at_, now)

    monkeypatch.setattr(store, "publish", late)
    assert store.add(docs("a"), at, chunking.char_chunks) == 1  # after x
    assert store.add(docs("b", "c"), at, chunking.char_chunks) == 1  # b was added meanwhile
    assert {d for d, _ in counts(spark, at)["doc_status"]} == set("abcxy") and counts(spark, at)["chunks"] == {(d, 1) for d in "abcxy"}


def test_many_threads_lose_no_batch(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    at = str(tmp_path / "store")
    docs = lambda k: spark.createDataFrame([(f"d{k}", "one text"), ("same", "in all")], "doc_id string, text string")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: store.add(docs(k), at, chunking.char_chunks, with_graph=False), range(6)))
    assert sorted(r.doc_id for r in store.stored(spark, at, "doc_status").collect()) == sorted(["same", *(f"d{k}" for k in range(6))])


def test_a_view_stays_as_it_was(spark, tmp_path):
    at = str(tmp_path / "store")
    docs = lambda *names: spark.createDataFrame([(n, f"text {n}") for n in names], "doc_id string, text string")
    for n in "abc":
        store.add(docs(n), at, chunking.char_chunks, with_graph=False)
    old = store.view(spark, at)
    chunks = store.stored(spark, at, "chunks", old)
    assert store.compact(spark, at).version == 4
    store.add(docs("d"), at, chunking.char_chunks, with_graph=False)
    assert chunks.count() == 3 and store.stored(spark, at, "chunks").count() == 4
    assert len(store.view(spark, at).batches) == 2 and store.vacuum(spark, at, older_s=0, versions=1) == 6
    assert store.stored(spark, at, "chunks").count() == 4


class StubExtractor:
    """Pages of a file whose bytes are a JSON list of pages."""

    @staticmethod
    def pages(content):
        return json.loads(content)


def test_three_steps(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)
    spark.sparkContext.addPyFile(__file__)  # workers import the extractor from it
    line = "A Spindle-Motor of the GSK980 controller is wired to the Main-Board here"
    for domain, name in (("d1", "one"), ("d1", "two"), ("d2", "three")):
        at = tmp_path / "working/raw" / domain
        at.mkdir(parents=True, exist_ok=True)
        pages = [{"plain": f"{line}, says {name}", "tables": [{"res": {"html": "<table><tr><td>k</td></tr></table>"}}]}, {"plain": "", "markdown": {"md": f"**Bold** {name}"}, "images": ["an image text"]}]
        (at / f"{name}.pdf").write_text(json.dumps(pages))
    (tmp_path / "c.json").write_text(json.dumps({"chunking": {"max_chunk_size": 60, "overlap_size": 10}}))
    assert cli.main(["-c", "c.json", "--extractor", "test_sources:StubExtractor"]) == 0
    texts = {r.document_id: r.text for r in files.text_documents(spark, str(tmp_path / "working/processed")).collect()}
    assert set(texts) == {"one", "two", "three"} and f"{line}, says one" in texts["one"] and "| k |" in texts["one"] and "an image text" in texts["one"]
    assert store.stored(spark, str(tmp_path / "working/graph"), "doc_status").count() == 3
    questions = lambda: [json.loads(x) for f in (tmp_path / "working/output").rglob("*.jsonl") for x in f.read_text(encoding="utf-8").splitlines()]
    first = questions()
    assert {q["document"] if "document" in q else q.get("source_document") for q in first} and any(q["metadata"].get("knowledge_context_used") for q in first)
    # again: nothing is added twice; a domain by name is found where the first step wrote it
    assert cli.main(["-c", "c.json", "-s", "2", "-s", "3"]) == 0
    assert store.stored(spark, str(tmp_path / "working/graph"), "doc_status").count() == 3 and len(questions()) == len(first)
    assert cli.main(["--list-domains"]) == 0 and "processed: d1, d2" in capsys.readouterr().out
    assert cli.main(["-c", "c.json", "-s", "2", "-d", "d1"]) == 0
    assert store.stored(spark, str(tmp_path / "working/graph/d1"), "doc_status").count() == 2
    # a graph file takes the place of the store
    (tmp_path / "g.graphml").write_text(GRAPH)
    assert cli.main(["-c", "c.json", "-s", "3", "--graph", "g.graphml"]) == 0
    assert not any(q["metadata"].get("knowledge_context_used") for q in questions())
    assert cli.main(["-s", "1", "-i", "c.json", "--extractor", "x:y"]) == 1
    (tmp_path / "UP.PDF").write_text(json.dumps([{"plain": "Up"}]))
    assert cli.main(["-s", "1", "-i", "UP.PDF", "-o", "up", "--extractor", "test_sources:StubExtractor"]) == 0
    assert [r.document_id for r in files.text_documents(spark, str(tmp_path / "up")).collect()] == ["UP"]


def test_files_have_their_names(spark, tmp_path):
    at = tmp_path / "out"
    rows = [("d1", "one.v2", 2, "second"), ("d1", "one.v2", 1, "first 日"), ("d2", "a/b", 1, "x"), ("d2", ".hidden", 1, "y"), ("d1", "100%", 1, None)]
    records = spark.createDataFrame(rows, "domain string, source_document string, question_index int, content string").repartition(4)
    files.write_questions(records, str(at))
    found = {str(f.relative_to(at)): [json.loads(x) for x in f.read_text(encoding="utf-8").splitlines()] for f in at.rglob("*") if f.is_file()}
    assert set(found) == {"d1/one.v2_questions.jsonl", "d2/a%2Fb_questions.jsonl", "d2/%2Ehidden_questions.jsonl", "d1/100%25_questions.jsonl"}
    assert found["d1/one.v2_questions.jsonl"] == [{"source_document": "one.v2", "question_index": 1, "content": "first 日"}, {"source_document": "one.v2", "question_index": 2, "content": "second"}]
    assert found["d1/100%25_questions.jsonl"] == [{"source_document": "100%", "question_index": 1}]
    files.write_questions(records.where("source_document = 'a/b'").withColumn("content", F.lit("new")), str(at))
    assert json.loads((at / "d2/a%2Fb_questions.jsonl").read_text())["content"] == "new" and (at / "d1/one.v2_questions.jsonl").exists()
    texts = spark.createDataFrame([("d", "a.b", "text\nof it "), ("d", "x/y_%", "other"), ("d", "_z", "third"), ("d", "数控 a+b", "fourth")], "domain string, document_id string, text string")
    files.write_texts(texts, str(tmp_path / "texts"))
    assert {(r.document_id, r.text) for r in files.text_documents(spark, str(tmp_path / "texts")).collect()} == {("a.b", "text\nof it "), ("x/y_%", "other"), ("_z", "third"), ("数控 a+b", "fourth")}


def test_a_job_that_fails_leaves_no_files(spark, tmp_path):
    at = tmp_path / "out"
    bad = F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.lit("x"))
    rows = spark.range(100).select(F.concat(F.lit("f"), (F.col("id") % 10).cast("string")).alias("source_document"), F.col("id").alias("question_index"), bad.cast("string").alias("content"))
    with pytest.raises(Exception, match="no"):
        files.write_questions(rows, str(at))
    assert not at.exists() or not [f for f in at.rglob("*") if f.is_file()]
    files.write_questions(rows.where("id <> 77"), str(at))
    assert len([f for f in at.rglob("*") if f.is_file()]) == 10 and not (at / "_temporary").exists()
    assert sum(len(f.read_text().splitlines()) for f in at.rglob("*.jsonl")) == 99


def test_tokenizer_by_config(spark, caplog):
    docs = spark.createDataFrame([("a", "one two three four five six"), ("b", " ")], "doc_id string, text string")
    c = Chunking(chunk_token_size=4, chunk_overlap_token_size=1, max_chunk_size=10, overlap_size=2)
    got = sorted((r.chunk_index, r.content) for r in chunking.chunks_of(docs, c, tokenizer=models.WhitespaceTokenizer()).collect())
    assert got == [(0, "one two three four"), (1, "four five six")]
    assert {r.content for r in chunking.chunks_of(docs, c).collect()} == {r.content for r in chunking.char_chunks(docs, 10, 2).collect()}
    assert "windows are of characters" in caplog.text
    ranks = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    if os.path.exists(ranks):
        loaded = models.load_tokenizer(ranks, c.tokenizer_pattern)
        assert [r.content for r in chunking.chunks_of(docs, Chunking(chunk_token_size=3, chunk_overlap_token_size=0), tokenizer=loaded).orderBy("chunk_index").collect()][0] == "one two three"


def test_event_windows(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:01:00' AS ts, 'x' AS event_type UNION ALL SELECT timestamp'2024-01-01 00:04:00', 'x' UNION ALL SELECT timestamp'2024-01-01 00:06:00', 'x'")
    assert sorted(r.n for r in stream.event_counts(df).collect()) == [1, 2]


def test_chunks_of_stored_texts_share_ids(spark):
    df = spark.createDataFrame([(1, "same"), (2, " same ")], "doc_id int, text string")
    assert chunking.char_chunks(df).select("chunk_id").distinct().count() == 1


def test_members_are_never_left_out(spark, monkeypatch):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("k"))
    keys = tables.settled(df.where("id % 100 = 7").select("k", "id"))
    got = tables.members(df, keys, ["k", "id"])
    assert got.join(keys, ["k", "id"]).count() == 200 and got.count() < 4000
    monkeypatch.setattr(tables, "MOST_BITS", 6)
    assert tables.members(df, keys, ["k", "id"]).join(keys, ["k", "id"]).count() == 200


def test_small_tables_are_dealt_over_the_cores(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    got = tables.read_table(spark, str(tmp_path), "t")
    assert got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and got.count() == 1000
    monkeypatch.setattr(tables, "SHARE", 0)
    assert tables.read_table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1


def test_what_is_made_once_is_made_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        calls.add(1)
        return x

    rows = tables.once(spark.range(10).select(F.col("id").cast("string").alias("x")), "y", counted("x"))
    assert rows.where(F.length("y") > 0).select("y", F.concat("y", "y").alias("z"), F.upper("y").alias("u")).count() == 10
    assert len(rows.where(F.length("y") > 0).select("y", F.concat("y", "y").alias("z"), F.upper("y").alias("u")).collect()) == 10
    assert calls.value <= 20
