r"""Conversation structure repair: the cheapest edits after which the roles of a conversation read ``(s?(ua)+)?``.

A dynamic programme over retained subsequences chooses which turns are kept or get another role. A state is the role of the last
retained turn. The price of a gap, of deleted turns between two retained ones, is the difference of two prefix sums, so that each
state has one running minimum of cost less prefix sum; the pair of roles at a gap says which empty turns are inserted there. Of
equal costs the ASCII-least audit counts. Audits are compared by rank: two of the same turns each end in a turn's letter, so that
neither begins the other, and how they were ranked before the last turn, or else their last letters, decides. Time is linear in turns.

Rows are sorted over all partitions by conversation, turn, role and text. What a task has of a conversation is cut into segments of
bounded rows and characters. One that begins and ends within a task in one segment is repaired there and then. Of the others (at
the edges of partitions, and very long ones) the cheapest way through each segment is found from each state to each state; these
ways are put together in order, one row a segment, and the segments are then repaired from their states, each by itself. Only the
digest of such a conversation runs through it in order, row by row, as SHA-256 has no other way.

Faults, the first one of a row counts: blank (no character but white space), duplicate (role and text of an earlier row: of the rows
that share them, all but the first, by a table of the first turns of those that occur in several, and by what stands before a row
within a turn), truncated (the last character that is not white space is none of ``.!?``).

Defined cases: null roles and texts are one space; rows with a null turn come first; rows of a turn are in the order of role and text;
repeated rows are duplicates; rows with a null id are one conversation; a role of no characters fits no state; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import settle, small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
WHITE = " \t\n\v\f\r"
USER, ASSISTANT = "user", "assistant"
#: States: nothing retained yet, or the initial of the last retained turn.
STATES = ("", "s", "u", "a")
#: The roles that are inserted between a state and a turn retained next; pairs that aren't here can't be.
BETWEEN = {
    ("", "s"): (), ("", "u"): (), ("", "a"): (USER,), ("s", "u"): (), ("s", "a"): (USER,),
    ("u", "a"): (), ("u", "u"): (ASSISTANT,), ("a", "u"): (), ("a", "a"): (USER,),
}
#: The roles that are inserted after the last turn.
CLOSING = {"": (), "s": (USER, ASSISTANT), "u": (ASSISTANT,), "a": ()}
LEGAL = {"su", "ua", "au"}
#: Rows and characters after which a segment ends.
SEGMENT_ROWS, SEGMENT_CHARS = 20_000, 8_000_000


@dataclass
class Turn:
    turn: int | None
    role: str
    text: str
    seen: bool  # an earlier row has its role and text
    fault: str = ""

    def __post_init__(self):
        end = self.text.rstrip(WHITE)
        self.fault = "blank" if not end else "duplicate" if self.seen else "" if end[-1] in ".!?" else "truncated"

    def ways(self) -> list[tuple[str, str, int]]:
        """The states that the turn can be retained in, with letter and price."""
        if self.fault in ("blank", "duplicate"):
            return []
        more = TRUNCATED if self.fault else 0
        own = self.role[:1]
        out = [(s, "R", REROLE + more) for s in ("u", "a") if s != own]
        return [*out, (own, "K", KEEP + more)] if own and own in STATES else out


def cheapest(turns: list[Turn], entry: str = "") -> dict[str, tuple[int, list[tuple[str, str, str]]]]:
    """From state ``entry`` to each state that can be reached: the price, and for each turn its state before, its letters (those of
    inserted turns first) and its state after."""
    net, rank = {entry: 0}, {entry: 0}
    back: list[dict[str, tuple[str, str]]] = []
    for turn in turns:
        # a state as it is: the turn is deleted, which the prefix sum pays for
        best = {s: (n, rank[s], "D", s) for s, n in net.items()}
        for state, letter, price in turn.ways():
            for before, n in net.items():
                between = BETWEEN.get((before, state))
                if between is not None:
                    way = (n + INSERT * len(between) + price - DELETE, rank[before], "I" * len(between) + letter, before)
                    if state not in best or way < best[state]:
                        best[state] = way
        net = {s: w[0] for s, w in best.items()}
        rank = {s: k for k, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        back.append({s: (w[3], w[2]) for s, w in best.items()})
    out = {}
    for last, n in net.items():
        steps, state = [], last
        for row in reversed(back):
            before, letters = row[state]
            steps.append((before, letters, state))
            state = before
        out[last] = n + DELETE * len(turns), steps[::-1]
    return out


def best_end(ways: dict[str, tuple[int, str]]) -> str:
    """The last state of the cheapest audit once what has to follow is inserted; ``ways`` has price and audit by state."""
    return min(ways, key=lambda s: (ways[s][0] + INSERT * len(CLOSING[s]), ways[s][1] + "I" * len(CLOSING[s])))


def audit_of(steps: list[tuple[str, str, str]]) -> str:
    return "".join(letters for _, letters, _ in steps)


def repaired(turns: list[Turn], steps: list[tuple[str, str, str]], last: bool) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that stand after the edits; ``last`` adds what closes the conversation."""
    for turn, (before, letters, after) in zip(turns, steps, strict=True):
        if letters != "D":
            yield from ((role, "") for role in BETWEEN[before, after])
            yield (turn.role if letters[-1] == "K" else USER if after == "u" else ASSISTANT), turn.text
    if last and steps:
        yield from ((role, "") for role in CLOSING[steps[-1][2]])


class Digest:
    """The hash of ``role:text`` lines."""

    def __init__(self):
        self.sha, self.first = hashlib.sha256(), True

    def add(self, turns: Iterable[tuple[str, str]]) -> Digest:
        for role, text in turns:
            self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False
        return self


COUNTS = ("lowest", "highest", "distinct", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn")


def counts_of(turns: list[Turn]) -> dict:
    """What is counted of a segment, and what its neighbours have to know."""
    numbers = [t.turn for t in turns if t.turn is not None]
    out = {"lowest": min(numbers, default=None), "highest": max(numbers, default=None), "distinct": len(set(numbers)), "first_turn": turns[0].turn, "last_turn": turns[-1].turn}
    out |= {f: sum(t.fault == f for t in turns) for f in ("blank", "duplicate", "truncated")}
    out["illegal"] = sum(a.role[:1] + b.role[:1] not in LEGAL for a, b in zip(turns, turns[1:], strict=False))
    return out | {"first_role": turns[0].role[:1], "last_role": turns[-1].role[:1]}


def joined_counts(a: dict, b: dict) -> dict:
    """The counts of two segments, ``a`` before ``b``."""
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated")}
    low, high = [x for x in (a["lowest"], b["lowest"]) if x is not None], [x for x in (a["highest"], b["highest"]) if x is not None]
    out |= {"lowest": min(low, default=None), "highest": max(high, default=None)}
    out["distinct"] = a["distinct"] + b["distinct"] - (a["last_turn"] is not None and a["last_turn"] == b["first_turn"])
    out["illegal"] = a["illegal"] + b["illegal"] + (a["last_role"] + b["first_role"] not in LEGAL)
    return out | {"first_turn": a["first_turn"], "first_role": a["first_role"], "last_turn": b["last_turn"], "last_role": b["last_role"]}


def gaps_of(c: dict) -> int:
    return 0 if c["lowest"] is None else c["highest"] - c["lowest"] + 1 - c["distinct"]


@dataclass
class Joined:
    """Segments of a conversation put together: for each state the price, the rank of its audit among those of the states and, as
    a chain, the segments' states and audits."""

    at: dict = field(default_factory=lambda: {"": (0, 0, None)})
    counts: dict | None = None

    def add(self, seg: int, counts: dict, ways: dict[tuple[str, str], tuple[int, str]]) -> None:
        best: dict = {}
        for (entry, leave), (price, audit) in ways.items():
            if entry in self.at:
                n, rank, chain = self.at[entry]
                way = (n + price, rank, audit)
                if leave not in best or way < best[leave][0]:
                    best[leave] = way, (chain, (seg, entry, leave, audit))
        rank = {s: k for k, s in enumerate(sorted(best, key=lambda s: best[s][0][1:]))}
        self.at = {s: (w[0], rank[s], chain) for s, (w, chain) in best.items()}
        self.counts = counts if self.counts is None else joined_counts(self.counts, counts)

    def done(self) -> tuple[int, str, list[tuple[int, str, str]]]:
        """Price, audit, and the states of each segment."""
        audits, chains = {}, {}
        for s, (n, _, chain) in self.at.items():
            steps = []
            while chain is not None:
                chain, step = chain
                steps.append(step)
            chains[s] = steps[::-1]
            audits[s] = n, "".join(x[3] for x in chains[s])
        end = best_end(audits)
        more = len(CLOSING[end])
        return audits[end][0] + INSERT * more, audits[end][1] + "I" * more, [x[:3] for x in chains[end]]


RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
RESULT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNT_FIELDS = [(k, pa.int64()) for k in COUNTS] + [("first_role", pa.string()), ("last_role", pa.string())]
COUNT_DDL = ", ".join(f"{k}: {'long' if t == pa.int64() else 'string'}" for k, t in COUNT_FIELDS)
WAY_FIELDS = [("entry", pa.string()), ("leave", pa.string()), ("price", pa.int64()), ("audit", pa.string())]


def _result(counts: dict, cost: int, audit: str, sha: str | None) -> dict:
    return {"gaps": gaps_of(counts), **{k: counts[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit, "repaired_sha256": sha}


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


class _Out:
    """Rows by kind as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, chars: int = 0, **row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= 4096 or self.chars >= SEGMENT_CHARS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.chars = [], 0


def _walked(conv: pa.DataType, with_turns: bool, most_rows: int, most_chars: int):
    """Sorted rows to: results of conversations that lie in one segment within the partition (kind 'done', with ``with_turns`` also
    their repaired turns, kind 'turn'); of all others the rows (kind 'row') and the ways through each segment (kind 'way')."""
    schema = pa.schema(
        [("conv", conv), ("kind", pa.string()), ("seg", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("seen", pa.bool_())]
        + [("done", pa.struct(RESULT)), ("counts", pa.struct(COUNT_FIELDS)), ("ways", pa.list_(pa.struct(WAY_FIELDS)))]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = _Out(schema)
        seg, nth = TaskContext.get().partitionId() << 33, 0  # nth conversation of the partition
        held: list[Turn] = []
        chars, now, began, split = 0, None, False, False

        def whole() -> Iterator[pa.RecordBatch]:
            ways = cheapest(held)
            end = best_end({s: (n, audit_of(steps)) for s, (n, steps) in ways.items()})
            n, steps = ways[end]
            more = len(CLOSING[end])
            turns = list(repaired(held, steps, True))
            result = _result(counts_of(held), n + INSERT * more, audit_of(steps) + "I" * more, Digest().add(turns).sha.hexdigest())
            yield from out.add(len(result["audit"]), conv=now, kind="done", done=result)
            if with_turns:
                for k, (role, text) in enumerate(turns):
                    yield from out.add(len(text), conv=now, kind="turn", seg=seg, place=k, role=role, text=text)

        def segment() -> Iterator[pa.RecordBatch]:
            ways = [{"entry": entry, "leave": leave, "price": n, "audit": audit_of(steps)} for entry in STATES for leave, (n, steps) in cheapest(held, entry).items()]
            yield from out.add(sum(len(w["audit"]) for w in ways), conv=now, kind="way", seg=seg, counts=counts_of(held), ways=ways)
            for k, t in enumerate(held):
                yield from out.add(len(t.text), conv=now, kind="row", seg=seg, place=k, turn=t.turn, role=t.role, text=t.text, seen=t.seen)

        before = None
        for conv_id, turn, role, text, later in _runs(batches, ["conv", "turn", "role", "text", "later"]):
            if not began or conv_id != now:
                if held:
                    yield from segment() if split or nth == 1 else whole()
                    held, chars, seg = [], 0, seg + 1
                now, began, split, nth = conv_id, True, False, nth + 1
                before = None
            elif len(held) >= most_rows or chars >= most_chars:
                yield from segment()
                held, chars, seg, split = [], 0, seg + 1, True
            key = (turn, role, text)
            held.append(Turn(turn, role, text, later or key == before))
            before = key
            chars += len(text)
        if held:
            yield from segment()
        yield from out.flush()

    return rows


def _in_order(conv: pa.DataType):
    """Segments of conversations, sorted by conversation and segment: their results without digest (seg null), and the states of
    each segment."""
    schema = pa.schema([("conv", conv), ("seg", pa.int64()), ("entry", pa.string()), ("leave", pa.string()), ("last", pa.bool_()), ("done", pa.struct(RESULT))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, joined = _Out(schema), None, None

        def done() -> Iterator[pa.RecordBatch]:
            cost, audit, states = joined.done()
            yield from out.add(len(audit), conv=now, done=_result(joined.counts, cost, audit, None))
            for k, (seg, entry, leave) in enumerate(states):
                yield from out.add(conv=now, seg=seg, entry=entry, leave=leave, last=k + 1 == len(states))

        for conv_id, seg, counts, ways in _runs(batches, ["conv", "seg", "counts", "ways"]):
            if joined is None or conv_id != now:
                if joined is not None:
                    yield from done()
                now, joined = conv_id, Joined()
            joined.add(seg, counts, {(w["entry"], w["leave"]): (w["price"], w["audit"]) for w in ways})
        if joined is not None:
            yield from done()
        yield from out.flush()

    return rows


def _replayed(conv: pa.DataType):
    """Rows of segments, sorted by segment and place, with the segment's states: their repaired turns."""
    schema = pa.schema([("conv", conv), ("seg", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, now = _Out(schema), [], None

        def done() -> Iterator[pa.RecordBatch]:
            conv_id, seg, entry, leave, last = now
            for k, (role, text) in enumerate(repaired(held, cheapest(held, entry)[leave][1], last)):
                yield from out.add(len(text), conv=conv_id, seg=seg, place=k, role=role, text=text)

        for *key, turn, role, text, seen in _runs(batches, ["conv", "seg", "entry", "leave", "last", "turn", "role", "text", "seen"]):
            if key != now:
                if held:
                    yield from done()
                held, now = [], key
            held.append(Turn(turn, role, text, seen))
        if held:
            yield from done()
        yield from out.flush()

    return rows


def _hashed(conv: pa.DataType):
    """Repaired turns, sorted by conversation, segment and place, to one digest a conversation; a row at a time."""
    schema = pa.schema([("conv", conv), ("sha", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, digest = _Out(schema), None, None
        for conv_id, role, text in _runs(batches, ["conv", "role", "text"]):
            if digest is None or conv_id != now:
                if digest is not None:
                    yield from out.add(conv=now, sha=digest.sha.hexdigest())
                now, digest = conv_id, Digest()
            digest.add([(role, text)])
        if digest is not None:
            yield from out.add(conv=now, sha=digest.sha.hexdigest())
        yield from out.flush()

    return rows


def _sorted(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text and later (an earlier turn has the role and text), sorted over all partitions."""
    space = F.lit(" ")
    own = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, space).alias("role"), F.coalesce(text_col, space).alias("text"))
    rows = rows.withColumn("own", own)
    first = rows.groupBy("conv", "own").agg(F.min(F.struct("turn")).alias("low"), F.max(F.struct("turn")).alias("high"))
    again = settle(first.where("NOT (low <=> high)").select(F.col("conv").alias("c"), F.col("own").alias("o"), F.col("low.turn").alias("low")))
    flagged = rows.join(again, rows["conv"].eqNullSafe(again["c"]) & (rows["own"] == again["o"]), "left")
    later = F.col("o").isNotNull() & ~F.col("turn").eqNullSafe(F.col("low"))
    by = ["conv", "turn", "role", "text"]
    return flagged.select(*by, later.alias("later")).repartitionByRange(*by).sortWithinPartitions(*by)


def repair(
    messages: DataFrame,
    with_turns: bool = False,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment_rows: int = SEGMENT_ROWS,
    segment_chars: int = SEGMENT_CHARS,
) -> tuple[DataFrame, DataFrame | None]:
    """(results, repaired turns or None). Results: conv and the columns of ``RESULT``, one row a conversation. Turns, if asked for:
    conv, seg, place, role, text, in the order of seg and place."""
    small_batches(messages.sparkSession)
    ordered = _sorted(messages, conv_col, turn_col, role_col, text_col)
    kind = ordered.schema["conv"].dataType.simpleString()
    arrow = ordered.limit(0).select("conv").toArrow().schema.field("conv").type
    way = "array<struct<entry: string, leave: string, price: long, audit: string>>"
    ddl = f"conv {kind}, kind string, seg long, place long, turn long, role string, text string, seen boolean, done struct<{RESULT_DDL}>, counts struct<{COUNT_DDL}>, ways {way}"
    walked = settle(ordered.mapInArrow(_walked(arrow, with_turns, segment_rows, segment_chars), ddl))
    # one row a segment, and only those of conversations that no task has whole
    ways = walked.where("kind = 'way'").select("conv", "seg", "counts", "ways").repartition("conv").sortWithinPartitions("conv", "seg")
    states = settle(ways.mapInArrow(_in_order(arrow), f"conv {kind}, seg long, entry string, leave string, last boolean, done struct<{RESULT_DDL}>"))
    chosen = states.where("seg IS NOT NULL").select(F.col("seg").alias("s"), "entry", "leave", "last")
    rows = walked.where("kind = 'row'").select("conv", "seg", "place", "turn", "role", "text", "seen").join(chosen, F.col("seg") == F.col("s"))
    replayed = rows.repartition("seg").sortWithinPartitions("seg", "place").select("conv", "seg", "entry", "leave", "last", "turn", "role", "text", "seen")
    turns = replayed.mapInArrow(_replayed(arrow), f"conv {kind}, seg long, place long, role string, text string")
    turns = settle(turns) if with_turns else turns
    digests = turns.repartition("conv").sortWithinPartitions("conv", "seg", "place").mapInArrow(_hashed(arrow), f"conv {kind}, sha string")
    digests = digests.select(F.col("conv").alias("c"), "sha")
    long = states.where("seg IS NULL").select("conv", "done").join(digests, F.col("conv").eqNullSafe(F.col("c")), "left")
    columns = [f"done.{k}" for k, _ in RESULT[:-1]]
    empty = F.lit(hashlib.sha256().hexdigest())
    results = walked.where("kind = 'done'").select("conv", "done.*").unionByName(long.select("conv", *columns, F.coalesce("sha", empty).alias("repaired_sha256")))
    whole = walked.where("kind = 'turn'").select("conv", "seg", "place", "role", "text")
    return results, (whole.unionByName(turns) if with_turns else None)


def damaged(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text of the rows after damage that depends on a row's conversation and turn: of twenty rows one is dropped,
    one loses its text, one its full stops, exclamation and question marks, one is repeated and one is given to the user."""
    space = F.lit(" ")

    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), space)

    kind = F.pmod(F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col)).cast("binary")), F.lit(20))
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, USER).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    results, _ = repair(damaged(rows))
    every = rows.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(k, zero).alias(k) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    found = every.join(results, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def _sql_state(state: str, own: str, price: str, role: str, *ways: tuple[str, str]) -> str:
    """The least of a state as it is with the turn deleted, and of the states that the turn can follow."""
    there = [f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + 2, 'a': {state}.a || 'D', 'o': {state}.o}} END"]
    for before, inserted in ways:
        letters, add = ("I" if inserted else ""), (f"['{inserted}:']" if inserted else "[]::VARCHAR[]")
        there.append(
            f"CASE WHEN {before} IS NOT NULL AND NOT gone AND {own} IS NOT NULL THEN {{'c': {before}.c + {5 if inserted else 0} + {price} + more, "
            f"'a': {before}.a || '{letters}' || {own}, 'o': list_concat(list_concat({before}.o, {add}), [{role} || ':' || text])}} END"
        )
    return f"list_sort(list_filter([{', '.join(there)}], lambda x: x IS NOT NULL))[1]"


_AS = {r: f"CASE WHEN ini = '{r[0]}' THEN role ELSE '{r}' END" for r in (USER, ASSISTANT)}
_LETTER = {r: f"CASE WHEN ini = '{r[0]}' THEN 'K' ELSE 'R' END" for r in (USER, ASSISTANT)}
_PRICE = {r: f"(CASE WHEN ini = '{r[0]}' THEN 0 ELSE 1 END)" for r in (USER, ASSISTANT)}
OP11_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT),
           lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295::BIGINT) AS crc
  FROM conversations
), kinds AS (SELECT *, xor(crc, 4294967295) % 20 AS kind FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS time FROM kinds WHERE kind <> 0)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, left(role, 1) AS ini,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM damaged
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM placed
), turns AS (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM faults
), dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS n,
         NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS s, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS u, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS a FROM conversations
  UNION ALL
  SELECT dp.conv_id, dp.k + 1, {{'c': n.c + 2, 'a': n.a || 'D', 'o': n.o}},
         {_sql_state("s", "CASE WHEN ini = 's' THEN 'K' END", "0", "role", ("n", ""))},
         {_sql_state("u", _LETTER[USER], _PRICE[USER], _AS[USER], ("n", ""), ("s", ""), ("a", ""), ("u", ASSISTANT))},
         {_sql_state("a", _LETTER[ASSISTANT], _PRICE[ASSISTANT], _AS[ASSISTANT], ("u", ""), ("n", USER), ("s", USER), ("a", USER))}
  FROM dp JOIN turns t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id AND t.k = dp.k + 1
), ends AS (
  SELECT conv_id, list_sort(list_filter([n,
           CASE WHEN s IS NOT NULL THEN {{'c': s.c + 10, 'a': s.a || 'II', 'o': list_concat(s.o, ['user:', 'assistant:'])}} END,
           CASE WHEN u IS NOT NULL THEN {{'c': u.c + 5, 'a': u.a || 'I', 'o': list_concat(u.o, ['assistant:'])}} END, a], lambda x: x IS NOT NULL))[1] AS e
  FROM (SELECT * FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1)
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id
)
SELECT ends.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, e.c AS cost, e.a AS audit, sha256(array_to_string(e.o, chr(10))) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id
"""
