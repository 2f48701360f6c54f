import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from loomspark import cli
from loomspark.functions import calls, models
from loomspark.operators import chunking, embedding, extraction
from loomspark.sources import store


def test_in_order_and_at_once():
    now, most, lock = [0], [0], threading.Lock()

    def call(x):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05 if x % 3 else 0.01)
        with lock:
            now[0] -= 1
        return x * x

    def seconds(n):
        start = time.perf_counter()
        assert [(i, r, e) for i, r, e in calls.in_order(range(96), call, calls.Calls(in_flight=n))] == [(i, i * i, None) for i in range(96)]
        return time.perf_counter() - start

    one = seconds(1)
    assert most[0] == 1
    assert seconds(16) * 8 < one and most[0] == 16


def test_no_more_are_taken_than_are_in_flight():
    taken = []

    def items():
        for i in range(50):
            taken.append(i)
            yield i

    for i, _, _ in calls.in_order(items(), lambda x: x, calls.Calls(in_flight=4)):
        assert len(taken) <= i + 6


def test_tries_limits_and_rate():
    seen = []

    def call(x):
        seen.append(x)
        if x == "slow":
            time.sleep(2)
        if x == "never" or x == "twice" and seen.count("twice") < 2:
            raise ValueError("not now")
        return x

    got = {i: (r, e) for i, r, e in calls.in_order(["slow", "twice", "never", "fine"], call, calls.Calls(4, 0.2, 3, lambda turn: 0.01))}
    assert got["fine"] == ("fine", None) and got["twice"] == ("twice", None)
    assert got["slow"][0] is None and "TimeoutError" in got["slow"][1] and seen.count("slow") == 3
    assert got["never"] == (None, "ValueError: not now") and seen.count("never") == 3
    start = time.perf_counter()
    assert len(list(calls.in_order(range(11), lambda x: x, calls.Calls(8, per_second=50)))) == 11
    assert time.perf_counter() - start >= 0.19


class Counting:
    """Answers with the prompt in upper case and leaves a file for each call; fails where it is told to."""

    def __init__(self, at, fail=""):
        self.at, self.fail = at, fail

    def respond(self, prompt, system):
        from uuid import uuid4

        with open(f"{self.at}/{uuid4().hex}", "w") as out:
            out.write(prompt)
        if self.fail and prompt.startswith(self.fail):
            raise ValueError("no")
        return f"{system}{prompt.upper()}"


class Dying(Counting):
    """Fails a whole task once, after some calls."""

    def respond(self, prompt, system):
        answer = super().respond(prompt, system)
        if len(os.listdir(self.at)) == 30 and not os.path.exists(f"{self.at}-died"):
            open(f"{self.at}-died", "w").close()
            time.sleep(0.3)
            raise SystemExit("killed")
        return answer


def made(at):
    return [open(f"{at}/{f}").read() for f in os.listdir(at)]


def test_answers_are_kept(spark, tmp_path):
    spark.sparkContext.addPyFile(__file__)
    log = str(tmp_path / "log")
    os.mkdir(log)
    rows = [(i, f"p{i % 20}") for i in range(60)] + [(60, None), (61, "bad one")]
    df = spark.createDataFrame(rows, "id int, prompt string").withColumn("key", F.lit("x"))
    at = str(tmp_path / "answers")
    got = {r.id: (r.response, r.error) for r in calls.answered(df, Counting(log, "bad"), at).collect()}
    assert got[7] == ("P7", None) and got[47] == ("P7", None) and got[60] == ("", None) and got[61] == (None, "ValueError: no")
    assert sorted(made(log)) == sorted(["", "bad one", *(f"p{i}" for i in range(20))])
    again = {r.id: r.response for r in calls.answered(df, Counting(log), at).collect()}
    assert again[61] == "BAD ONE" and again[7] == "P7" and len(made(log)) == 23  # only what failed
    other = calls.answered(df.limit(1), Counting(log), at, model="another").collect()
    assert other[0].response == "P0" and len(made(log)) == 24
    assert calls.answered(df.limit(0), Counting(log), at).count() == 0


def test_a_task_that_runs_again_repeats_no_answered_call(spark, tmp_path):
    """A run that dies in the middle leaves a journal; the next one asks for the rest only."""
    spark.sparkContext.addPyFile(__file__)
    log = str(tmp_path / "log")
    os.mkdir(log)
    df = spark.createDataFrame([(f"p{i}",) for i in range(100)], "prompt string")
    at = str(tmp_path / "answers")
    one = calls.Calls(in_flight=4)
    try:
        calls.answered(df, Dying(log), at, calls=one)
    except Exception:
        pass  # the local master doesn't run tasks again
    got = {r.prompt: r.response for r in calls.answered(df, Dying(log), at, calls=one).collect()}
    assert got == {f"p{i}": f"P{i}" for i in range(100)}
    said = made(log)
    assert len(set(said)) == 100 and len(said) <= 100 + 4  # no more than were in flight


def test_respond_keeps_rows_and_order(spark):
    class Picky:
        def respond(self, prompt, system):
            if prompt == "bad":
                raise ValueError("no")
            return prompt + system

    rows = spark.createDataFrame([(i, "bad" if i % 7 == 3 else f"p{i}", "s") for i in range(40)], "id int, prompt string, system string").coalesce(1)
    got = calls.respond(rows, Picky(), system_col="system").collect()
    assert [r.id for r in got] == list(range(40))
    assert all((r.response, r.error) == ((None, "ValueError: no") if r.id % 7 == 3 else (f"p{r.id}s", None)) for r in got)


RESPONSE = """<think>("entity"<|>thought<|>x<|>y)</think>
("entity"<|>"Alpha"<|>Person<|>the first)##("entity"<|>Beta<|>place<|>)
("relationship"<|>Beta<|>Alpha<|>knows<|>"friend"<|>2.5)
("relationship"<|>Alpha<|>Gamma<|>sees<|>near)
("entity"<|><|>person<|>no name) ("x")
("relationship"<|>Alpha<|>Alpha<|>self<|>k<|>1)
("thing"<|>a<|>b<|>c)
words without members
<|COMPLETE|>("entity"<|>Late<|>person<|>after the end)"""


def test_records(spark):
    rows = [(1, 0, "c0", RESPONSE), (1, 1, "c1", '("entity"<|>Alpha<|>person<|>again)##("entity"<|>Alpha<|>robot<|>the first)##("relationship"<|>Alpha<|>Beta<|>knows<|>kin<|>1)'), (2, 0, "c2", None), (2, 1, "c3", "")]
    records = extraction.parse_records(spark.createDataFrame(rows, "doc_id int, chunk_index int, chunk_id string, response string"))
    bad = sorted(r.reason for r in records.where("reason IS NOT NULL").collect())
    assert bad == ["kind", "loop", "name"]
    nodes = {r.entity_id: r for r in extraction.record_nodes(records).collect()}
    assert set(nodes) == {"Alpha", "Beta", "Gamma"}
    assert (nodes["Alpha"].entity_type, nodes["Alpha"].description, nodes["Alpha"].source_id) == ("person", "again<SEP>the first", "c0<SEP>c1")
    assert (nodes["Beta"].entity_type, nodes["Beta"].description) == ("place", "")
    assert (nodes["Gamma"].entity_type, nodes["Gamma"].description, nodes["Gamma"].first_chunk) == ("UNKNOWN", "sees", 0)
    edges = {(r.source, r.target): r for r in extraction.record_edges(records).collect()}
    assert set(edges) == {("Beta", "Alpha"), ("Alpha", "Gamma")}
    assert (edges["Beta", "Alpha"].weight, edges["Beta", "Alpha"].keywords, edges["Beta", "Alpha"].source_id) == (3.5, "friend<SEP>kin", "c0<SEP>c1")


def test_long_descriptions_are_put_together_in_groups(spark):
    asked = []

    def ask(prompts):
        asked.append(prompts.count())
        return prompts.withColumns({"response": F.when(F.col("entity_id") != "lost", F.concat(F.lit("S"), F.length("prompt").cast("string"))), "error": F.lit(None).cast("string")})

    rows = [(1, "long", "<SEP>".join(f"description {i}" for i in range(30)), "k"), (1, "short", "one<SEP>two", "k"), (2, "lost", "<SEP>".join("x" * 50 for _ in range(9)), "k")]
    df = spark.createDataFrame(rows, "doc_id int, entity_id string, description string, other string")
    got = {r.entity_id: r.description for r in extraction.shortened(df, ["doc_id", "entity_id"], F.col("entity_id"), ask, 100, 4).collect()}
    assert got["short"] == "one<SEP>two" and got["long"].startswith("S") and 0 < len(got["lost"]) <= 100
    assert asked == [8 + 3, 2 + 1, 1]  # groups of four: 30, 8, 2 and 9, 3 descriptions


class Embedding:
    """Fallback vectors; a file for each text."""

    def __init__(self, at):
        self.at = at

    def embed(self, texts):
        from uuid import uuid4

        for x in texts:
            with open(f"{self.at}/{uuid4().hex}", "w") as out:
                out.write(x)
        return [models.fallback_embedding(x, 4) for x in texts]


def test_contents_of_one_id_are_embedded_once(spark, tmp_path):
    spark.sparkContext.addPyFile(__file__)
    log, at = str(tmp_path / "log"), str(tmp_path / "store")
    os.mkdir(log)
    for k in range(6):  # they differ in white space at their ends, so that their hashes come in any order
        docs = spark.createDataFrame([(k, " " * k + "The same words of all of them" + "\n" * (k % 3))], "doc_id long, text string")
        store.add(docs, at, chunking.char_chunks, with_graph=False)
        assert embedding.sync(spark, at, Embedding(log), 4) == (0 if k else 1)
    assert len(made(log)) == 1 and embedding.vectors(spark, at, "chunk").count() == 1


def test_vectors_by_what_was_embedded(spark, tmp_path):
    spark.sparkContext.addPyFile(__file__)
    log, at = str(tmp_path / "log"), str(tmp_path / "store")
    os.mkdir(log)
    docs = lambda *names: spark.createDataFrame([(n, f"The GSK980 drives a Spindle-{n} here") for n in names], "doc_id string, text string")
    assert embedding.sync(spark, at, Embedding(log), 4) == 0
    store.add(docs("Aaa", "Bbb"), at, chunking.char_chunks)
    first = embedding.sync(spark, at, Embedding(log), 4)
    assert first == len(made(log)) == len(set(made(log))) and first > 4
    assert embedding.sync(spark, at, Embedding(log), 4) == 0 and len(made(log)) == first
    before = {r.id: list(r.embedding) for r in embedding.vectors(spark, at, "entity").collect()}
    assert {"GSK980", "Spindle-Aaa", "Spindle-Bbb"} <= set(before)
    # another document says more of an entity: its vector is another one, those of the others stay
    new = docs("Ccc").withColumn("text", F.concat("text", F.lit(" "), F.lit("x" * 60_000), F.lit(" and GSK980 once more")))
    store.add(new, at, lambda d: chunking.char_chunks(d, 30_000, 10))
    again = embedding.sync(spark, at, Embedding(log), 4)
    after = {r.id: list(r.embedding) for r in embedding.vectors(spark, at, "entity").collect()}
    assert len(made(log)) == first + again and after["GSK980"] != before["GSK980"] and after["Spindle-Aaa"] == before["Spindle-Aaa"]
    texts = {r.id: r.text for r in embedding.embedded_texts(spark, at, store.view(spark, at)).where("kind = 'entity'").collect()}
    assert all(after[i] == pytest.approx(models.fallback_embedding(x, 4)) for i, x in texts.items())


class Model:
    """Records for prompts that ask for them, questions for others."""

    def respond(self, prompt, system):
        if "<|COMPLETE|>" in prompt:
            return '("entity"<|>Lathe<|>machine<|>turns)##("entity"<|>Drill<|>machine<|>bores)##("relationship"<|>Lathe<|>Drill<|>stands by<|>shop<|>1)<|COMPLETE|>'
        return "问题1: Which parts does the lathe of the workshop turn today?"

    def embed(self, texts):
        return [[float(len(x))] for x in texts]


def test_models_from_the_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    spark.sparkContext.addPyFile(__file__)
    (tmp_path / "working/processed").mkdir(parents=True)
    (tmp_path / "working/processed/a.txt").write_text("The Lathe stands by the Drill")
    (tmp_path / "c.json").write_text(json.dumps({"vectors": {"dim": 2}, "graph_calls": {"tries": 1}}))
    args = ["-c", "c.json", "--responder", "test_calls:Model", "--embedder", "test_calls:Model"]
    assert cli.main([*args, "-s", "2", "-s", "3"]) == 0
    graph = str(tmp_path / "working/graph")
    assert {r.entity_id for r in store.stored(spark, graph, "nodes").collect()} == {"Lathe", "Drill"}
    assert {r.id for r in embedding.vectors(spark, graph, "relation").collect()} == {"Drill<SEP>Lathe"}
    lines = [json.loads(x) for f in (tmp_path / "working/output").rglob("*.jsonl") for x in f.read_text(encoding="utf-8").splitlines()]
    assert [x["content"] for x in lines] == ["Which parts does the lathe of the workshop turn today?"]
    assert cli.main([*args, "-s", "2", "-s", "3"]) == 0  # answers are kept where questions are written anew
