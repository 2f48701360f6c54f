r"""Chat formatting of reply trees.

Messages point to the message that they answer. Iterative self-joins double the hops by which each message knows an ancestor,
until all know their depth and the sum of scores above them; no message carries a path. The branches of a tree are ranked by
the mean score of their messages. Only for the chosen leaves are root-to-leaf paths enumerated, by the same hops in reverse: a
stretch of a path is cut in two at the ancestor half-way, until each holds one message. All tables are linear in the messages,
but for a factor of the logarithm of the depth, and in the turns that are put out. Each chosen path becomes one conversation.

A turn is ``<|turn|>`` role, new line, text, ``<|end|>`` new line. Control strings inside roles and texts get a
backslash after their first character and backslashes are doubled, so that the output holds no control string but its
own and can be read back. The loss mask is the list of code-point spans of assistant texts.

Defined cases: null roles and texts are empty ones; a message whose parent is null or missing is a root; messages on a
cycle of parents have no root and are on no path; of rows that share tree and node the smallest by role and text counts;
null scores are 0; equal scores are ranked by leaf; rows with a null tree form one tree; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.sources.tables import read_table

from .common import settle, small_batches

TURN, END = "<|turn|>", "<|end|>\n"
#: What a text must not hold as it is: this template's marks and those of common other ones.
CONTROL = r"\\|<\||</?s>|\[/?INST\]|<</?SYS>>"
_CONTROL, _BACK = re.compile(CONTROL), re.compile(r"\\(.)", re.S)


def escape(text: str, line: bool = False) -> str:
    out = _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)
    return out.replace("\n", "\\n") if line else out


def unescape(text: str, line: bool = False) -> str:
    return _BACK.sub(lambda m: "\n" if line and m[1] == "n" else m[1], text)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[list[int]]]:
    """The conversation and the spans of the texts of ``learn``."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role, True)}\n", escape(text)
        if role == learn:
            mask.append([at + len(head), at + len(head) + len(body)])
        parts += head, body, END
        at += len(head) + len(body) + len(END)
    return "".join(parts), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    out = []
    for part in formatted.split(TURN)[1:]:
        role, _, text = part.removesuffix(END).partition("\n")
        out.append((unescape(role, True), unescape(text)))
    return out


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def reply_steps(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """For messages (tree, node, parent, score): tree, leaf, rank, score and a row for each place (from 1, the root) and node of
    the path."""
    nodes = messages.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"))
    there = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    known = nodes.join(there, _same(F.col("tree"), F.col("t")) & (F.col("parent") == F.col("p")), "left")
    # each way leads from a node to the one before ``up``, over ``hops`` nodes
    ways = settle(known.select("tree", "node", F.col("p").alias("up"), F.lit(1).cast("long").alias("hops"), F.col("score").alias("total")))
    inner = ways.where("up IS NOT NULL").select(F.col("tree").alias("t"), F.col("up").alias("p")).distinct()
    jumps, rooted = [], ways.where("up IS NULL")
    open_ways = ways.where("up IS NOT NULL")
    left = open_ways.count()
    while left:
        jumps.append(open_ways.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up"))
        above = rooted.unionByName(open_ways).select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("hops").alias("more"), F.col("total").alias("plus"))
        longer = open_ways.join(above, _same(F.col("tree"), F.col("t")) & (F.col("up") == F.col("n")))
        new = settle(longer.select("tree", "node", F.col("next").alias("up"), (F.col("hops") + F.col("more")).alias("hops"), (F.col("total") + F.col("plus")).alias("total")))
        rooted, open_ways = rooted.unionByName(new.where("up IS NULL")), new.where("up IS NOT NULL")
        before, left = left, open_ways.count()
        if left == before:
            break  # every round reaches some root as long as one can be reached: what is left leads to a cycle
    leaves = rooted.join(inner, _same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    ranked = leaves.withColumn("score", F.col("total") / F.col("hops")).withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), "node")))
    ranked = ranked if branches is None else ranked.where(F.col("rank") <= branches)
    steps = ranked.select("tree", F.col("node").alias("leaf"), "rank", "score", "node", F.col("hops").alias("place"), F.col("hops").alias("long"))
    for k in reversed(range(len(jumps))):
        half = F.lit(1 << k).cast("long")
        lower = F.struct("node", "place", F.least("long", half).alias("long"))
        upper = F.struct(F.col("up").alias("node"), (F.col("place") - half).alias("place"), (F.col("long") - half).alias("long"))
        met = steps.join(jumps[k], _same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("n")) & (F.col("long") > half), "left")
        steps = met.withColumn("x", F.explode(F.when(F.col("long") > half, F.array(upper, lower)).otherwise(F.array(lower)))).select("tree", "leaf", "rank", "score", "x.node", "x.place", "x.long")
        if k % 6 == 5:
            steps = settle(steps)
    return steps.drop("long")


def reply_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """For messages (tree, node, parent, score): tree, leaf, rank, path array<node> from root to leaf, score."""
    paths = reply_steps(messages, branches).groupBy("tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("path"))
    return paths.select("tree", "leaf", "rank", F.transform("path", lambda x: x["node"]).alias("path"), "score")


def format_trees(messages: DataFrame, branches: int | None = None, learn: str = "assistant") -> DataFrame:
    """For messages (tree, node, parent, score, role, text): tree, leaf, rank, score, formatted, mask array<array<int>>."""
    small_batches(messages.sparkSession, 128)
    steps = settle(reply_steps(messages, branches)).select(F.col("tree").alias("t"), "leaf", "rank", "score", "place", F.col("node").alias("n"))
    one = messages.groupBy("tree", "node").agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("turn"))
    turns = steps.join(one, _same(F.col("t"), F.col("tree")) & (F.col("n") == F.col("node"))).groupBy("tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list(F.struct("place", "turn.role", "turn.text"))).alias("turns"))
    schema = turns.select("tree", "leaf", "rank", "score").schema.add("formatted", "string").add("mask", T.ArrayType(T.ArrayType(T.IntegerType())))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [format_turns([(t["role"], t["text"]) for t in x], learn) for x in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([x for x, _ in done], pa.string()), pa.array([m for _, m in done], pa.list_(pa.list_(pa.int32())))], names=schema.names)

    return turns.mapInArrow(rows, schema)


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from ``formatted`` and ``mask``: tree and the digests of turns and of the text under the mask."""
    kind = formatted.schema["tree"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                turns = read_turns(text)
                learnt = "".join(unescape(text[a:b]) for a, b in mask)
                sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
                out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), len(text)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("tree"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("tree", "formatted", "mask").mapInArrow(rows, f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def as_tree(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Plain conversations as trees of one branch: rows by turn, then role and text, each answering the one before.

    Rows are sorted over all partitions, so that a conversation of very many turns is dealt over several. A row answers the
    one before it there; where that is another conversation's, it isn't in the tree and the row is a root."""
    rows = conversations.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("turn"), "role", "text")
    ordered = rows.repartitionByRange("tree", "turn").sortWithinPartitions("tree", "turn", "role", "text")
    numbered = settle(ordered.withColumn("node", F.monotonically_increasing_id()).select("tree", "node", "role", "text"))
    part = F.shiftright("node", 33)
    # one row per partition
    ends = numbered.groupBy(part.alias("part")).agg(F.min("node").alias("start"), F.max("node").alias("end"))
    ends = ends.select("start", F.lag("end").over(W.orderBy("part")).alias("before"))
    linked = numbered.join(F.broadcast(ends), F.col("node") == F.col("start"), "left")
    parent = F.when(F.col("start").isNull(), F.col("node") - 1).otherwise(F.col("before"))
    return linked.select("tree", "node", "role", "text", parent.alias("parent"), F.lit(0.0).alias("score"))


PROBE = "</s>[INST] ok [/INST]"


def op9_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    messages = as_tree(rows.unionByName(probe))
    return chat_digests(format_trees(messages)).withColumnRenamed("tree", "conv_id")


_COUNT = "len(regexp_extract_all({0}, '" + CONTROL + "'))"
OP9_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(TURN) + 1 + len(END)} + length(role) + {_COUNT.format('role')} + length(role) - length(replace(role, chr(10), '')) + length(text) + {_COUNT.format('text')})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
