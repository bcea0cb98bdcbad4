"""Repairs against an exhaustive search, and the conversations of the table under many partitions."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest
from conftest import ROOT

from ledgerloom.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, n string, key int, fault string"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    """Rows in order with their first fault."""
    out, seen = [], set()
    for turn, role, text in rows:
        body = text.strip(SPACE)
        kind = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((turn, role, text, kind))
    return out


def follows(last, letter):
    return {"": "su", "s": "u", "u": "a", "a": "u"}[last].find(letter) >= 0 and letter != ""


def cheapest(rows):
    """Cost, least audit and repaired rows over all edits: insertions anywhere, in any number that can pay."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, said = heapq.heappop(heap)
        if (i, last) in done:
            continue
        if i == len(rows) and last in ("", "a"):
            return cost, audit, said
        done.add((i, last))
        for letter, role in (("u", "user"), ("a", "assistant")):
            if follows(last, letter):
                heapq.heappush(heap, (cost + 5, audit + "I", i, letter, (*said, f"{role}:")))
        if i < len(rows):
            _, role, text, kind = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, said))
            if kind not in (1, 2):
                more = 5 * (kind == 3)
                if follows(last, role[:1]):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*said, f"{role}:{text}")))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if follows(last, letter):
                        heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, letter, (*said, f"{name}:{text}")))


def answer(rows):
    """What the contract says of one conversation, from its rows after damage in order."""
    judged = faults(rows)
    cost, audit, said = cheapest(judged)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    letters = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
    count = [sum(k == f for *_, k in judged) for f in (1, 2, 3)]
    return (gaps, *count, illegal, cost, audit, sha256("\n".join(said).encode()).hexdigest())


def harmed(table):
    """Conversations after damage, rows in order: by turn (null first), role, digest of the text."""
    out = {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        rows = out.setdefault(conv, [])
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            rows += [row] * (1 + (kind == 3))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).digest())
    return {c: sorted(rows, key=key) for c, rows in out.items()}


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in R.ANSWER) for r in rows}
    assert len(out) == len(rows)
    return out


def repaired(spark, table):
    return got(R.repair(R.damaged(spark.createDataFrame([(*r, "n", 1, "f") for r in table], SCHEMA))))


def plain_solution(rows):
    result = R._solved([dict(turn=t, role=r, text=x, n=1, fault=k) for t, r, x, k in faults(rows)])
    return result


def drawn(rng, most=9):
    rows = []
    for turn in range(rng.randrange(most)):
        rows.append((turn, rng.choice(["user", "assistant", "system", "tool", "", "user", "assistant"]), rng.choice(["a.", "b!", "c", "d", " ", "e. ", f"{turn}?", f"{turn}"])))
    return rows


def test_divide_and_conquer_against_all_edits():
    rng = random.Random(5)
    for _ in range(4000):
        rows = drawn(rng)
        assert plain_solution(rows) == answer(rows), rows


def test_stretches_join_to_the_same_edits():
    rng = random.Random(6)
    for _ in range(1500):
        kinds = bytes(rng.randrange(8) for _ in range(rng.randrange(14)))
        _, costs, ranks = R.forward(kinds, R._at(R.START))
        whole = R.edits(kinds, R.START, R.crossing(costs, ranks, R.END_COSTS))
        cuts = sorted([0, len(kinds), *(rng.randrange(len(kinds) + 1) for _ in range(3))])
        parts = [kinds[a:b] for a, b in zip(cuts, cuts[1:])]
        ways = R.joined([R.matrix(p) for p in parts])
        assert [s for p, way in zip(parts, ways) for s in R.edits(p, *way)] == whole


@pytest.mark.parametrize("parts", ["1", "4", "60"])
def test_the_table_against_all_edits(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = [tuple(r) for r in spark.read.parquet(f"{ROOT}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        rng = random.Random(7)
        table += [(90_000 + c, t, r, x) for c in range(60) for t, r, x in drawn(rng)]
        table += [(95_000, t, r, x) for t, r, x in [(i, rng.choice(["user", "assistant"]), rng.choice(["p.", f"{i}.", f"{i}"])) for i in range(400)]]
        assert repaired(spark, table) == {c: answer(rows) for c, rows in harmed(table).items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_texts_too_long_to_hold(spark, monkeypatch):
    monkeypatch.setattr(R, "HELD_TEXT", 50)  # workers get it with the function that is sent to them
    rng = random.Random(8)
    table = [(c, t, r, x * 10) for c in range(30) for t, r, x in drawn(rng, 14)]
    assert repaired(spark, table) == {c: answer(rows) for c, rows in harmed(table).items()}


def test_nulls_ties_repeats_and_nothing(spark):
    table = [
        (None, None, None, None), (None, 1, "user", "hi."), (1, None, "user", "x."), (1, None, "user", "y."), (1, 3, "user", "x."), (2, 5, None, "x."), (2, 5, None, "x."),
        (2, 5, None, "x."), (3, 1, "user", None), (4, 1, "", ""), (4, 9, "assistant", "long " * 20_000), (5, -3, "system", "s."), (5, 3, "user", "u."), (5, 3, "user", "u."),
    ]
    dropped = next(t for t in range(100) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    table.append((8, dropped, "user", "gone."))
    out = repaired(spark, table)
    assert out == {c: answer(rows) for c, rows in harmed(table).items()}
    assert out[8] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert repaired(spark, []) == {}
