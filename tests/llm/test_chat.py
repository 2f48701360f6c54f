import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.llm import chat

TEXT = st.lists(st.sampled_from([*"ab\\<|>/s[]INST\nné", "<|turn|>", "<|end|>\n", "</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>"]), max_size=30).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "odd\nrole", "<|turn|>\\n"]), TEXT), max_size=6))
def test_round_trip(turns):
    formatted, mask = chat.format_turns(turns)
    assert chat.read_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    assert formatted.count(chat.TURN) == len(turns) and not any(c in formatted for c in ("</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0), (1, 4, 3, "user", "c", None), (1, 5, 4, "assistant", "d", 1.0), (1, 5, 4, "assistant", "e", 1.0),
        (2, 7, 99, "user", "orphan", 0.0), (2, 8, 9, "user", "x", 0.0), (2, 9, 8, "user", "y", 0.0), (2, 10, 9, "user", "z", 0.0),
        (None, 1, None, None, None, 0.0), (None, 2, 1, "assistant", "n", 0.0),
    ]
    df = spark.createDataFrame([(*r, "k") for r in rows], "tree long, node long, parent long, role string, text string, score double, path string")
    got = {(r.tree, r["rank"]): r.path for r in chat.reply_paths(df).collect()}
    assert got == {(1, 1): [1, 3, 4, 5], (1, 2): [1, 2], (2, 1): [7], (None, 1): [1, 2]}
    best = {r.tree: r for r in chat.format_trees(df, branches=1).collect()}
    assert chat.read_turns(best[1].formatted) == [("user", "q"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    assert chat.read_turns(best[None].formatted) == [("", ""), ("assistant", "n")]


def test_long_chains_take_linear_tables(spark, tmp_path, monkeypatch):
    """Tables on disk grow with the turns of a chain, not with their square."""
    written = {}
    for n in (4_000, 16_000):
        rows = spark.range(n).select(F.lit(1).cast("long").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(1.0).alias("score"))
        at = tmp_path / str(n)
        monkeypatch.setattr(chat, "settle", lambda df, at=at: (df.write.parquet(f"{at}/{len(list(at.glob('*')))}"), df.sparkSession.read.schema(df.schema).parquet(f"{at}/{len(list(at.glob('*'))) - 1}"))[1])
        at.mkdir()
        got = chat.format_trees(rows).collect()
        assert [r["rank"] for r in got] == [1] and [t for _, t in chat.read_turns(got[0].formatted)] == [str(i) for i in range(n)]
        written[n] = sum(f.stat().st_size for f in at.rglob("*.parquet"))
    assert written[16_000] < 6 * written[4_000]


def test_cycles_and_ties(spark):
    rows = [(1, 1, 2, 0.0), (1, 2, 3, 0.0), (1, 3, 1, 0.0), (1, 4, 3, 0.0), (1, 5, 5, 0.0), (2, 1, None, 2.0), (2, 2, 1, 0.0), (2, 3, 1, 0.0), (2, 4, 3, None)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    assert sorted((r.tree, r["rank"], r.path) for r in chat.reply_paths(df).collect()) == [(2, 1, [1, 2]), (2, 2, [1, 3, 4])]
    assert chat.reply_paths(df.where("tree = 1")).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.as_tree(empty).count() == 0
    assert chat.chat_digests(chat.format_trees(chat.as_tree(empty))).count() == 0


def test_trees_of_conversations_over_partitions(spark):
    rows = [(i % 3 if i % 3 else None, i, "user", f"t{i}") for i in range(300)]
    tree = chat.as_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))
    got = {r.tree: [t for _, t in chat.read_turns(r.formatted)] for r in chat.format_trees(tree).collect()}
    assert got == {k: [f"t{i}" for i in range(300) if (i % 3 or None) == k] for k in (None, 1, 2)}


def test_digests(spark, tmp_path):
    rows = [(1, 1, "assistant", "a\\b"), (1, 0, "user", None), (1, 1, None, "</s>"), (2, 0, "user", "x" * 50_000), (None, 3, "assistant", "n")] + [(3, i, "assistant", f"t{i}") for i in range(40)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in chat.op9_chat_formatting(spark, str(tmp_path)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\n\n</s>\nassistant\na\\b\n") and got[1].loss_sha256 == sha("a\\b") and got[1].n_turns == 3
    assert got[3].loss_sha256 == sha("".join(f"t{i}" for i in range(40))) and got[3].loss_chars == 110
    assert got[-1].turns_sha256 == sha(f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n") and got[-1].loss_chars == len(chat.PROBE)
    assert got[2].loss_chars == 0 and got[None].n_turns == 1
