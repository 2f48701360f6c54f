import random
import re
import time

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.config import Chunking, Settings
from loomspark.functions import html_tables, models
from loomspark.functions import text as T
from loomspark.operators import chunking, context, dedup, extraction, graph, ingest, prompts, questions, vectors
from loomspark.plans.pipeline import questions_of
from loomspark.sources import tables


def literal_dedup(rows, threshold):
    def norm(t):
        return " ".join(t.lower().split()).rstrip("?？.。！!,，")

    def grams(t):
        return {t[i : i + 2] for i in range(len(t) - 1)}

    kept, hashes = [], set()
    for rn, text in rows:
        t = norm(text)
        if t in hashes:
            continue
        g = grams(t)
        if any(g and k and len(g & k) / len(g | k) >= threshold for _, k in kept):
            continue
        kept.append((rn, g))
        hashes.add(t)
    return [rn for rn, _ in kept]


@pytest.mark.parametrize("seed", range(3))
def test_greedy_dedup_as_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = []
    for doc in range(8):
        base = "".join(rng.choice("abcdefgh ") for _ in range(40))
        for rn in range(30):
            t = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 6])):
                t[rng.randrange(len(t))] = rng.choice("abcdefgh")
            rows.append((doc, rn, rng.choice(["", "x", "?", "".join(t), "".join(t) + "？"]), "more"))
    for threshold in (0.85, 0.6):
        df = spark.createDataFrame(rows, "doc long, rn int, text string, note string")
        once = dedup.greedy_dedup(df, "doc", "text", threshold)
        assert set(once.columns) == set(df.columns)
        got = sorted((r.doc, r.rn) for r in once.collect())
        assert got == sorted((d, rn) for d in range(8) for rn in literal_dedup([(r[1], r[2]) for r in rows if r[0] == d], threshold))
        assert dedup.greedy_dedup(once, "doc", "text", threshold).count() == len(got)


def test_char_chunks_cover(spark):
    texts = ["", "  ", "a" * 10, "b" * 11, "c" * 95, "日" * 37, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in chunking.char_chunks(df, 10, 3).collect():
        got.setdefault(r.doc_id, []).append((r.chunk_index, r.start_position, r.end_position, r.content, r.total_chunks))
    assert set(got) == {2, 3, 4, 5}
    for i, found in got.items():
        want, at = [], 0
        while True:
            end = min(at + 10, len(texts[i]))
            want.append((len(want), at, end, texts[i][at:end]))
            if end == len(texts[i]):
                break
            at = end - 3
        assert sorted(x[:4] for x in found) == want and {x[4] for x in found} == {len(want)}
    with pytest.raises(ValueError):
        chunking.char_chunks(df, 10, 10)


def test_token_chunks(spark):
    df = spark.createDataFrame([(1, "a b\nc  d e"), (2, " "), (3, None)], "doc_id int, text string")
    got = sorted((r.chunk_index, r.content, r.start_position, r.end_position, r.total_chunks) for r in chunking.token_chunks(df, models.WhitespaceTokenizer(), 2, 1).collect())
    assert got == [(0, "a b", 0, 3, 4), (1, "b\nc", 2, 5, 4), (2, "c  d", 4, 8, 4), (3, "d e", 7, 10, 4)]


def test_parse_and_fallback(spark):
    good = "这个数控系统的主轴报警应该如何处理呢？"
    rows = [
        (1, f"<think>x</think>问题1: {good}\n问题3：{good}答案：y\n问题4: 短？"),
        (2, f"1. {good}\n# {good}\n如何处理这个没有问号的主轴报警问题呢呢呢\n问题1: 短？"),
        (3, ""),
        (4, "\n".join(f"- {good}{i}?" for i in range(14))),
    ]
    got = {}
    for r in questions.parse_responses(spark.createDataFrame(rows, "k int, response string"), ["k"]).collect():
        got.setdefault(r.k, []).append((r.ord, r.question_index, r.content))
    assert sorted(got[1]) == [(0, 1, good), (1, 3, good)]
    assert sorted(got[2]) == [(0, 1, good)] and 3 not in got
    assert [x[1] for x in sorted(got[4])] == list(range(1, 11))


def test_records_leave_out_what_is_missing(spark, tmp_path):
    df = spark.createDataFrame([("d", "", 1, "plain text?", [], []), ("d", "c", 2, "about GSK980?", ["Base"], ["c", "e"])], "document_id string, source_chunk_id string, question_index int, content string, base_entities array<string>, base_chunk_ids array<string>")
    said = sorted(r[0] for r in questions.question_records(df).select(F.to_json("metadata")).collect())
    assert said == ['{"has_answer":false,"lightrag_chunk_id":"c","related_entities":["Base","GSK980"],"related_chunk_ids":["c","e"],"knowledge_context_used":true}', '{"has_answer":false}']
    assert {"question_id", "created_at"} <= set(questions.stamped(questions.question_records(df)).columns)


def test_graph_and_context(spark):
    chunks = spark.createDataFrame([(1, 0, "c0", "Alpha Beta Gamma"), (1, 1, "c1", "Beta Alpha Delta Beta"), (1, 2, "c2", "nothing here"), (2, 0, "c0", "Alpha Zeta")], "doc_id int, chunk_index int, chunk_id string, content string")
    found, relations = graph.mentions(chunks), graph.extracted_relations(chunks)
    edges = {(r.doc_id, r.a, r.b): r.weight for r in graph.edges(relations).collect()}
    assert edges == {(1, "Alpha", "Beta"): 2.0, (1, "Beta", "Gamma"): 1.0, (1, "Alpha", "Delta"): 1.0, (2, "Alpha", "Zeta"): 1.0}
    rows = {(r.doc_id, r.chunk_index): r for r in context.chunk_contexts(chunks, 2, 1, 2, 200).collect()}
    first = rows[1, 1]
    assert first.related_entities == ["Alpha", "Beta"] and first.related_chunk_ids == ["c1", "c0"]
    assert first.prompt_context.endswith("【知识图谱片段】\n- 片段 c0: Alpha Beta Gamma")
    assert rows[1, 2].prompt_context == "" and rows[1, 2].related_chunk_ids == ["c2"]
    assert sorted(graph.document_relations(relations).where("doc_id = 1").first().relation_pairs) == [["Alpha", "Beta"], ["Alpha", "Delta"], ["Beta", "Gamma"]]
    missing = graph.unknown_endpoints(graph.nodes(found.where("pos = 0")), graph.canonical(relations).withColumn("description", F.lit("d")))
    assert {(r.doc_id, r.entity_id) for r in missing.collect()} == {(1, "Gamma"), (1, "Delta"), (2, "Zeta")}
    merged = graph.merged(spark.createDataFrame([("n", "b"), ("n", "a"), ("n", "b")], "name string, d string"), ["name"], ["d"]).first()
    assert merged.d == "a<SEP>b"


def test_settled_tables_leave_no_exchanges(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    exchanges = lambda: set(re.findall(r"shuffle_\d+_\d+", disk.getAllBlocks().toString()))
    before, df = exchanges(), spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    table, until = tables.settled(df), time.time() + 10
    while exchanges() - before and time.time() < until:
        time.sleep(0.2)
    assert not exchanges() - before
    assert sorted(table.collect()) == sorted(df.collect())


def test_questions_meet_their_context_after_deduplication(spark, monkeypatch):
    texts = ["Alpha begins the first line here\nBeta has the second line\nGamma has a line\nAlpha and Beta close it", "Delta stands alone in this text\nno name\nnot one\nAlpha Zeta of another row"]
    docs = spark.createDataFrame([(1, texts[0] * 3), (1, texts[1]), (2, texts[0]), (2, texts[0]), (None, texts[1])], "doc_id int, text string")
    seen, dedupe = [], dedup.greedy_dedup
    monkeypatch.setattr(dedup, "greedy_dedup", lambda rows, *how: seen.append(rows.columns) or dedupe(rows, *how))
    records = questions_of(docs, Settings(chunking=Chunking(use_token_chunking=False, max_chunk_size=120, overlap_size=10)))
    got = records.select("source_document", "source_chunk_id", "content", "metadata.*").collect()
    assert len(seen) == 1 and not {"prompt_context", "related_entities", "related_chunk_ids"} & set(seen[0])
    # of each question: what the context of a chunk of its document and id says
    known = {}
    for r in context.chunk_contexts(chunking.char_chunks(docs, 120, 10)).collect():
        known.setdefault((r.doc_id and str(r.doc_id), r.chunk_id), []).append((r.related_entities, r.related_chunk_ids))
    assert {r.source_document for r in got} == {"1", "2", None} and any(r.knowledge_context_used for r in got)
    for r in got:
        assert any((r.related_entities or [])[: len(names)] == names and r.related_chunk_ids == ids for names, ids in known[r.source_document, r.source_chunk_id]), r
    # a query that reads nothing of contexts doesn't join them
    joined = lambda df: "prompt_context" in (plan := df._jdf.queryExecution().optimizedPlan().toString()) or "LeftOuter, ((doc_id" in plan or "related_ids" in plan
    assert joined(records) and not joined(records.select("source_document", "content"))


def test_without_passes_on_what_is_not_in_the_keys(spark):
    rows = tables.settled(spark.createDataFrame([(k, n) for k in (1, 2, None) for n in range(50)], "k int, n int"))
    keys = tables.settled(rows.where("n % 3 = 0"))
    kept = tables.without(rows, keys, ["k", "n"])
    assert sorted(kept.collect(), key=str) == sorted(rows.join(keys, ["k", "n"], "left_anti").collect(), key=str)
    assert tables.without(rows, keys.where("n < 0"), ["k", "n"]).count() == 150


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None)], "vec_id int, embedding array<double>")
    fit = {r.vec_id: list(r.v) for r in df.select("vec_id", vectors.fit_dimension(F.col("embedding"), 2).alias("v")).collect()}
    assert fit == {1: [1.0, 2.0], 2: [0.0, 0.0]}
    assert models.fallback_embedding("x", 4) == models.fallback_embedding("x", 4) and max(map(abs, models.fallback_embedding("y", 200))) < 1

    class Half:
        def embed(self, texts):
            return [[1.0] if t == "ok" else None for t in texts]

    got = {r.text: list(r.embedding) for r in models.embed(spark.createDataFrame([("ok",), ("no",)], "text string"), Half(), 2).collect()}
    assert got["ok"] == [1.0, 0.0] and got["no"] == pytest.approx(models.fallback_embedding("no", 2), rel=1e-6)


def test_responder_errors_are_rows(spark):
    class Picky:
        def respond(self, prompt, system):
            if "bad" in prompt:
                raise RuntimeError("no")
            return prompt.upper()

    got = {r.prompt: (r.response, r.error) for r in models.respond(spark.createDataFrame([("a",), ("bad",)], "prompt string"), Picky()).collect()}
    assert got == {"a": ("A", None), "bad": (None, "RuntimeError: no")}


@given(st.integers(1, 6), st.integers(0, 6))
def test_retry(tries, fails):
    calls, waits = [], []

    def call():
        calls.append(1)
        if len(calls) <= fails:
            raise ValueError
        return "done"

    if fails >= tries:
        with pytest.raises(ValueError):
            models.with_retry(call, tries, models.generation_delay, waits.append)
    else:
        assert models.with_retry(call, tries, models.generation_delay, waits.append) == "done"
    assert waits == [5.0 * 2**i for i in range(min(fails, tries - 1))]


def test_tables_history_and_status(spark):
    assert html_tables.table_markdown("<table><tr><th>a<th>b</th></tr><tr><td>1</td></tr></table>") == "| a | b |\n|---|---|\n| 1 |  |"
    turns = spark.createDataFrame([(1, 1, "assistant", "y"), (1, 0, "user", "x"), (1, 2, "tool", "z")], "conv_id int, turn int, role string, text string")
    assert prompts.flatten_history(turns, "go").first().prompt == "User: x\n\nAssistant: y\n\nUser: go\n\nAssistant:"
    docs = spark.createDataFrame([(1, "abc"), (2, " ")], "doc_id int, text string")
    got = {r.doc_id: (r.status, r.chunks_count) for r in ingest.doc_status(docs, chunking.char_chunks(docs)).collect()}
    assert got == {1: ("processed", 1), 2: ("empty", 0)}
    up = ingest.upsert(docs, spark.createDataFrame([(2, "new"), (3, "x")], docs.schema), ["doc_id"])
    assert {(r.doc_id, r.text) for r in up.collect()} == {(1, "abc"), (2, "new"), (3, "x")}
    steps = ingest.run_summary(spark.createDataFrame([(1, True), (2, False)], "step int, ok boolean")).first()
    assert (steps.succeeded, steps.total, steps.failed) == (1, 2, [2])
    stats = ingest.store_stats(spark.createDataFrame([("/a/x.json", 1048576), ("/a/y.graphml", 1048576), ("/a/z.txt", 5)], "path string, length long")).first()
    assert (stats.file_count, stats.files, stats.size_mb) == (2, ["x.json", "y.graphml"], 2.0)


def test_jaccard_is_symmetric(spark):
    a, b = T.bigrams(F.col("a")), T.bigrams(F.col("b"))
    row = spark.createDataFrame([("night", "nacht")], "a string, b string").select(dedup.jaccard(a, b).alias("x"), dedup.jaccard(b, a).alias("y")).first()
    assert row.x == row.y == 1 / 7


def test_split_questions_as_the_lazy_expression(spark):
    rng = random.Random(4)
    parts = ["问题1: ", "问题2：", "问题33:", "问题:", "\n", "\n\n", " ", "这是什么?", "text 问题7: x", "答案: y", "a long question it is?"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(400)] + [(900, None), (901, "问题1:\n问题2: x\n问题3: y")]
    df = spark.createDataFrame(rows, "i int, r string").withColumn("r", T.clean_think(F.col("r")))
    pattern = F.lit(T.FLAGS + questions.NUMBERED)
    lazy = F.transform(F.arrays_zip(F.regexp_extract_all("r", pattern, F.lit(1)).alias("n"), F.regexp_extract_all("r", pattern, F.lit(2)).alias("c")), lambda x: F.struct(x["n"].cast("int").alias("number"), T.question_cleanup(x["c"]).alias("content")))
    got = df.select("i", questions.numbered_questions(F.col("r")).alias("a"), lazy.alias("b")).collect()
    assert any(r.a for r in got) and all(r.a == r.b for r in got)


def test_long_texts_are_cut_once(spark):
    text = "".join(chr(97 + i % 26) for i in range(1_000_003)) + "𝒳日"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    for size, overlap in ((1000, 100), (1000, 900), (60_000, 3_000)):
        got = chunking.char_chunks(df, size, overlap).orderBy("chunk_index").collect()
        assert all(text[r.start_position : r.end_position] == r.content for r in got) and got[-1].end_position == len(text) and len(got) == got[0].total_chunks


@pytest.mark.parametrize("threshold", [0.5, 0.85, 0.95])
def test_pairs_against_all_pairs(spark, threshold):
    rng = random.Random(7)
    rows = [(d, i, "".join(rng.choice("abcdef") for _ in range(rng.choice([0, 1, 2, 3, 9, 30])))) for d in range(3) for i in range(60)]
    rows += [(9, i, "x" * 3 + "abcdefghijklmnopqrstuvwxyz" + "".join(rng.sample("0123456789", rng.randint(0, 4)))) for i in range(40)]
    grams = {(d, i): {t[k : k + 2] for k in range(len(t) - 1)} for d, i, t in rows}
    want = {(d, j, i) for (d, i), a in grams.items() for (e, j), b in grams.items() if d == e and i < j and a and b and len(a & b) / len(a | b) >= threshold}
    got = dedup.similar_pairs(spark.createDataFrame(rows, "doc int, rn int, t string"), "doc", threshold).collect()
    assert {(r.doc, r.rn, r.earlier) for r in got} == want and len(got) == len(want)


def test_budgets_pass_on_what_is_left(spark):
    rng = random.Random(4)
    rows = [(k, kind, at, rng.randint(1, 9)) for k in range(30) for kind in range(4) for at in range(rng.randint(0, 6))]
    budgets, total = {0: 12, 1: 10}, 34
    want = set()
    for key in range(30):
        left = used = 0
        for kinds in ((0,), (1,), (2, 3)):
            budget = budgets.get(kinds[0], total)
            allowed = min(budget + left, total - used)
            spent = 0
            for k, kind, at, n in sorted(r for r in rows if r[0] == key and r[1] in kinds):
                if spent + n > allowed:
                    break
                spent += n
                want.add((k, kind, at))
            left, used = budget + left - spent, used + spent
    df = spark.createDataFrame(rows, "k int, kind int, at int, tokens long").repartition(3)
    got = context.budgeted(df, ["k"], ["at"], budgets, total)
    assert got.columns == df.columns and {(r.k, r.kind, r.at) for r in got.collect()} == want


@st.composite
def grids(draw):
    """(html, texts by row and column): cells that span rows and columns of a grid, with and without their end tags."""
    height, width = draw(st.integers(1, 6)), draw(st.integers(1, 6))
    grid: list[list] = [[None] * width for _ in range(height)]
    html = ["<table>"]
    for r in range(height):
        html.append(draw(st.sampled_from(["<tr>", "<TR class='x'>"])))
        for c in range(width):
            if grid[r][c] is not None:
                continue
            across, down = draw(st.integers(1, 3)), draw(st.integers(1, 3))
            across = next((k for k in range(across) if c + k >= width or grid[r][c + k] is not None), across)
            down = min(down, height - r)
            text = draw(st.sampled_from(["", "x", "a b", "p|q", "1.5", "日本", f"c{r}.{c}"]))
            for y in range(r, r + down):
                for x in range(c, c + across):
                    grid[y][x] = text
            tag, past = draw(st.sampled_from(["td", "th"])), draw(st.booleans()) and r + down == height
            spans = (f" colspan={across}" if across > 1 else "") + (f' rowspan="{down + 7 * past}"' if down + past > 1 else "")
            html.append(f"<{tag}{spans}> {text.replace(' ', draw(st.sampled_from([' ', '<br>', chr(10)])))} {draw(st.sampled_from(['', f'</{tag}>']))}")
        html.append(draw(st.sampled_from(["", "</tr>"])))
    return "".join(html) + "</table>", grid


@given(grids())
def test_tables_are_laid_out_on_a_grid(drawn):
    html, grid = drawn
    assert html_tables.table_grid(html) == grid


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<td>a<td>b<tr><td>c", [["a", "b"], ["c", ""]]),
        ("<table><tr><td rowspan=0>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td></tr></table>", [["a", "b"], ["a", "c"], ["a", "d"]]),
        ("<table><tr><td colspan=x>a<td rowspan=-1>b</table>", [["a", "b"]]),
        ("<table><thead><tr><th>h</thead><tbody><tr><td>b</tbody></table>", [["h"], ["b"]]),
        ("<table><tr><td>a<table><tr><td>in</td></tr><tr><td>ner</td></tr></table>z</td><td>q</td></tr></table>", [["a in ner z", "q"]]),
        ("<table><caption>no</caption><tr><td>&lt;x&gt; &amp;<script>no</script></td></tr></table>", [["<x> &"]]),
        ("<table></table>", []),
    ],
)
def test_tables_of_odd_markup(html, want):
    assert html_tables.table_grid(html) == want


def test_tables_in_texts():
    one, md = "<table><tr><td>a</td></tr></table>", "\n\n| a |\n|---|\n\n"
    assert html_tables.with_tables(f"x{one}y{one}z") == f"x{md}y{md}z"
    assert html_tables.with_tables(f"<table><tr><td>open {one}") == f"<table><tr><td>open {md}"
    assert html_tables.with_tables(f"{one}</table> <tablex> </table>") == f"{md}</table> <tablex> </table>"
    assert html_tables.with_tables("<table>only text</table>") == "\n\n only text \n\n"


def test_only_texts_with_a_table_leave_the_jvm(spark):
    rows = [("plain " * 50, "p"), (None, "n"), ("a <TABLE><tr><td>1|2</td><td>**b**</td></tr></TABLE> c", "t")]
    df = spark.createDataFrame(rows, "x string, k string")
    got = {r.k: r.y for r in df.select("k", T.markdown_to_plain(F.col("x")).alias("y")).collect()}
    assert got == {"p": ("plain " * 50).strip(), "n": "", "t": "a \n\n 1 2 b \n\n c"}


@pytest.mark.parametrize("walk", [0, 40])
def test_rounds_drop_what_the_walk_drops(spark, walk):
    """A hot key of 4,000 rows in random order and small ones; no more than 30 rounds."""
    rng = random.Random(walk)
    pairs = {(1, *sorted(rng.sample(range(4000), 2), reverse=True)) for _ in range(9000)} | {(k, *sorted(rng.sample(range(12), 2), reverse=True)) for k in range(2, 40) for _ in range(9)}
    want, gone = set(), set()
    for k, rn, earlier in sorted(pairs):
        if (k, earlier) not in gone:
            gone.add((k, rn))
            want.add((k, rn))
    df = spark.createDataFrame(sorted(pairs), "doc long, rn int, earlier int").repartition(4)
    tables, settled, counted = [], dedup.settled, []
    dedup.settled = lambda t: tables.append(1) or settled(t)
    try:
        got = [tuple(r) for r in dedup._dropped(df, "doc", walk).collect()]
        counted.append(len(tables))
    finally:
        dedup.settled = settled
    assert len(got) == len(set(got)) and set(got) == want
    assert (counted[0] - 3) / 2 <= 30


def test_greedy_dedup_of_null_and_hot_keys(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(60))
    rows = []
    for rn in range(500):
        t = list(base)
        for _ in range(rng.choice([0, 1, 4, 9, 20])):
            t[rng.randrange(len(t))] = rng.choice("abcdefgh")
        rows.append((1 if rn % 5 else 2, rn, "".join(t)))
    df = spark.createDataFrame(rows, "doc long, rn int, text string")
    got = sorted((r.doc, r.rn) for r in dedup.greedy_dedup(df, "doc", "text").collect())
    assert got == sorted((d, rn) for d in (1, 2) for rn in literal_dedup([(r[1], r[2]) for r in rows if r[0] == d], 0.85))


def test_top_k_over_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(vectors, "VECTORS", 64)
    monkeypatch.setattr(vectors, "QUERIES", 8)
    x = np.random.default_rng(1).normal(size=(300, 8))
    x[40:60] = x[40]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, [0.0] * 8), (901, None), (902, [1.0])], "vec_id long, embedding array<double>")
    got = {}
    for r in vectors.cosine_top_k(df.where("vec_id % 20 = 0"), df, 5, 0.2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 300, 20):
        s = np.round(u @ u[q], 12)
        s[q] = -9
        want = [i for i in np.lexsort((np.arange(300), -s)) if s[i] >= 0.2][:5]
        assert [s[v] for _, v, _ in sorted(got[q])] == pytest.approx([s[i] for i in want])
    assert [v for _, v, _ in sorted(got[40])] == [41, 42, 43, 44, 45]


def test_contexts_from_a_stored_graph(spark):
    chunks = chunking.char_chunks(spark.createDataFrame([(1, "The GSK980 and the Spindle turn. " * 4 + "Lathe-Nine only."), (2, "GSK980 again with Spindle and Main-Board")], "doc_id long, text string"), 60, 10)
    nodes, edges = graph.node_table(graph.mentions(chunks)), graph.edge_table(graph.extracted_relations(chunks))
    key = lambda df: {(r.doc_id, r.chunk_index): (r.prompt_context, r.related_entities, sorted(r.related_chunk_ids)) for r in df.collect()}
    assert key(context.graph_contexts(chunks, nodes, edges)) == key(context.chunk_contexts(chunks))
    one = chunks.orderBy("doc_id", "chunk_index").first()
    foreign = spark.createDataFrame([(None, "Named", None, "kind", "about", f"{one.chunk_id}<SEP>nowhere"), ("", None, None, "kind", "x", one.chunk_id), ("Other", None, "id", None, None, one.chunk_id)], "entity_id string, entity_name string, id string, entity_type string, description string, source_id string")
    links = spark.createDataFrame([("A", "B", None, "k", one.chunk_id), ("A", "", None, "k", one.chunk_id)], "source string, target string, description string, keywords string, source_id string")
    got = {(r.doc_id, r.chunk_index): r for r in context.graph_contexts(chunks, foreign, links).collect()}
    assert got[(1, 0)].related_entities == ["Named", "Other", "A", "B"] and "nowhere" in got[(1, 0)].related_chunk_ids
    assert "（类型：kind）：about" in got[(1, 0)].prompt_context and "A ↔ B：关键词 k" in got[(1, 0)].prompt_context
    assert got[(2, 0)].prompt_context == "" and got[(2, 0)].related_entities == []


def test_a_text_that_a_document_holds_twice_has_its_relations_once(spark):
    # two chunks of one id, the second of which comes after another chunk
    text = lambda body: f"{body}".ljust(60)
    docs = spark.createDataFrame([(1, text("GSK980 turns Spindle") + text("Lathe-Nine and GSK980 by Spindle") + text("GSK980 turns Spindle") + text("Spindle alone beside GSK980"))], "doc_id long, text string")
    chunks = chunking.char_chunks(docs, 60, 0)
    nodes, edges = graph.node_table(graph.mentions(chunks)), graph.edge_table(graph.extracted_relations(chunks))
    got = {r.chunk_index: r for r in context.graph_contexts(chunks, nodes, edges).collect()}
    assert got[0].chunk_id == got[2].chunk_id and got[0].prompt_context.count("GSK980 ↔ Spindle") == 1
    want = {r.chunk_index: r for r in context.chunk_contexts(chunks).collect()}
    assert all(got[i].related_chunk_ids == want[i].related_chunk_ids for i in want)


def test_one_text_that_fails_does_not_fail_its_batch(spark):
    class Picky:
        def embed(self, texts):
            if "bad" in texts:
                raise ValueError("bad")
            return [[1.0, 2.0] for _ in texts]

    rows = models.embed(spark.createDataFrame([("good",), ("bad",), ("fine",)], "text string").coalesce(1), Picky(), 3, tries=1).collect()
    assert [list(r.embedding) == [1.0, 2.0, 0.0] for r in rows] == [True, False, True]


def test_results_of_extractors():
    assert models.table_htmls([{"res": {"html": "a"}, "html": "b"}, {"html": "", "cell_html": "c"}, {}, "d", None]) == ["a", "c", "d"]
    assert models.table_htmls({"html": "x"}) == ["x"] and models.table_htmls(None) == []
    assert [models.markdown_of(x) for x in (None, "m", {"md": "", "text": "t"}, {"markdown": "k", "md": "l"}, {"z": 1})] == ["", "m", "t", "k", "{'z': 1}"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ends_are_stripped_without_a_pattern(spark):
    df = spark.createDataFrame([(chr(i) + "a b" + chr(i),) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000], "x string")
    assert "regexp" not in _plan(df.select(T.strip(F.col("x")).alias("y")))
    assert df.where(T.strip(F.col("x")) != F.regexp_replace("x", r"(?U)^\s+|\s+\z", "")).count() == 0


def test_nodes_of_records_are_made_without_a_join(spark):
    said = '("entity"<|>a<|>T<|>d)##("relationship"<|>a<|>b<|>e<|>k<|>1)##("relationship"<|>c<|>b<|>f<|>k<|>1)##("entity"<|>a<|>U<|>)'
    answers = spark.createDataFrame([(1, 0, "i", said), (1, 1, "j", '("entity"<|>a<|>u<|>d)')], "doc_id long, chunk_index int, chunk_id string, response string")
    nodes = extraction.record_nodes(extraction.parse_records(answers))
    assert "Join" not in _plan(nodes)
    got = {r.entity_id: (r.entity_type, r.description, r.source_id, r.first_chunk, r.first_pos) for r in nodes.collect()}
    assert got == {"a": ("u", "d", "i<SEP>j", 0, 0), "b": ("UNKNOWN", "e<SEP>f", "i", 0, 1), "c": ("UNKNOWN", "f", "i", 0, 2)}


def test_bigrams_as_sets(spark):
    texts = ["ab", "abab", "中文中文x", "\U0001f600\U0001f600a", "aaaa"]
    numbers, starts, sigs = dedup._grams(texts)
    for text, own, sig in zip(texts, np.split(numbers, starts[1:]), sigs, strict=True):
        want = {(ord(a) << 21) + ord(b) for a, b in zip(text, text[1:], strict=False)}
        assert len(own) == len(want) and set(own.tolist()) == want and bin(int(sig) & (2**64 - 1)).count("1") % 2 == len(want) % 2


def test_tasks_are_as_many_as_the_input_asks_for(spark, tmp_path, monkeypatch):
    spark.range(20_000).selectExpr("id doc_id", "0 chunk_index", "uuid() chunk_id", "uuid() name", "0 pos").write.parquet(str(tmp_path / "x"))
    monkeypatch.setattr(tables, "DEALT", 1 << 16)
    found = spark.read.parquet(str(tmp_path / "x"))
    assert tables.shares(found) > 10 and "RepartitionByExpression [doc_id#" in _plan(context.context_entities(found)) and f", {tables.shares(found)}" in _plan(context.context_entities(found))


def test_few_texts_with_tables_are_in_python_at_once(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    html_tables.render_tables(F.lit("x"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
