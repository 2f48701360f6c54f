import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, seg int, own string, kind int, audit string"
ROLES = ["user", "assistant", "system", "tool", "ugly", "", "User"]
TEXTS = ["ok.", "ok", "no!", " \n", "", "why? ", "a.b"]


def plain(rows):
    """Faults, counts and the cheapest edits by trying each at each place. Rows are (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    n = len(rows)

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        """(cost, edits' initials, repaired) from row i on."""
        ways = [(0, "", ())] if i == n and state in ("", "a") else []
        if inserted < 3:
            role = "assistant" if state == "u" else "user"
            after = best(i, role[0], inserted + 1)
            ways += [(after[0] + 5, "I" + after[1], ((role, ""), *after[2]))] if after else []
        if i < n:
            _, role, text = rows[i]
            after = best(i + 1, state, 0)
            ways += [(after[0] + 2, "D" + after[1], after[2])] if after else []
            if faults[i] not in ("blank", "duplicate"):
                for letter, price, new in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if (state, new[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                        after = best(i + 1, new[:1], 0)
                        ways += [(after[0] + price + 5 * (faults[i] == "truncated"), letter + after[1], ((new, text), *after[2]))] if after else []
        return min(ways) if ways else None

    cost, audit, out = best(0, "", 0)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha), list(out)


def turns_of(rows):
    seen, out = set(), []
    for t, role, text in rows:
        out.append(cr.Turn(t, role, text, (role, text) in seen))
        seen.add((role, text))
    return out


ROWS = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(ROLES), st.sampled_from(TEXTS)), max_size=9)


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_cheapest_edits(rows):
    turns = turns_of(rows)
    ways = cr.cheapest(turns)
    end = cr.best_end({s: (n, cr.audit_of(steps)) for s, (n, steps) in ways.items()})
    want, out = plain(rows)
    n, steps = ways[end]
    assert (n + 5 * len(cr.CLOSING[end]), cr.audit_of(steps) + "I" * len(cr.CLOSING[end])) == want[5:7]
    assert list(cr.repaired(turns, steps, True)) == out


@settings(max_examples=300, deadline=None)
@given(ROWS.filter(bool), st.randoms())
def test_segments_give_the_same(rows, rng):
    turns = turns_of(rows)
    cuts = sorted({0, len(turns), *(rng.randint(0, len(turns)) for _ in range(rng.randint(0, 3)))})
    joined, parts = cr.Joined(), []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        parts.append(turns[a:b])
        joined.add(k, cr.counts_of(parts[-1]), {(e, s): (n, cr.audit_of(steps)) for e in cr.STATES for s, (n, steps) in cr.cheapest(parts[-1], e).items()})
    want, out = plain(rows)
    cost, audit, states = joined.done()
    assert (cost, audit) == want[5:7]
    c = joined.counts
    assert c["illegal"] == want[4] and tuple(c[k] for k in ("blank", "duplicate", "truncated")) == want[1:4]
    got = []
    for part, (seg, entry, leave) in zip(parts, states, strict=True):
        got += cr.repaired(part, cr.cheapest(part, entry)[leave][1], seg + 1 == len(parts))
    assert got == out


def some_rows(seed, convs=40):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for t in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([t, t, t, t, None, t + 3, 0]), rng.choice(ROLES + ["user", "assistant"] * 3 + [None]), rng.choice([*TEXTS, f"t{t}.", f"t{t}.", None])))
    rows += [(7, t, "user" if t % 2 else "assistant", f"r{t % 11}.") for t in range(120)]
    return rows + rows[:20]


def by_conv(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for v in out.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("segment", [3, 20_000])
def test_rows(spark, segment):
    rows = some_rows(segment)
    results, turns = cr.repair(frame(spark, rows).repartition(5), with_turns=True, segment_rows=segment)
    want = {conv: plain(own) for conv, own in by_conv(rows).items()}
    got = results.collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv][0], r.conv
    back = {}
    for r in sorted(turns.collect(), key=lambda r: (r.seg, r.place)):
        back.setdefault(r.conv, []).append((r.role, r.text))
    assert back == {c: out for c, (_, out) in want.items() if out}


def test_segments_end_by_characters(spark):
    rows = some_rows(11, 10)
    whole = {tuple(r) for r in cr.repair(frame(spark, rows))[0].collect()}
    assert {tuple(r) for r in cr.repair(frame(spark, rows), segment_chars=5)[0].collect()} == whole


def test_long_conversations_take_linear_steps():
    turns = turns_of([(k, "user" if k % 3 else "tool", f"{k}.") for k in range(30_000)])
    n, steps = cr.cheapest(turns)["a"]
    assert len(steps) == 30_000 and n > 0


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            out += [(conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    return out


def test_query_and_sql(spark, tmp_path):
    rows = [*some_rows(3, 150), *((900 + k, 0, "user", "one.") for k in range(60))]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    want = {conv: plain(own)[0] for conv, own in by_conv(after_damage(rows)).items()}
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in cr.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: want.get(c, none) for c in {r[0] for r in rows}} and none in got.values()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert {r[0]: r[1:] for r in con.execute(cr.OP11_SQL).fetchall()} == got


def test_empty(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert cr.op11_conversation_repair(spark, str(tmp_path)).count() == 0
