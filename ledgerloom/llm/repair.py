"""Repair of damaged conversations: the cheapest edits to a legal order of roles, found by divide and conquer in linear space."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import cut_lineage

#: Costs of the edits. Keeping is free; a truncated row that is not deleted costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What stands last in the repaired conversation: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEVER = 1 << 60
#: Text of one conversation that a task holds; a longer one is solved from one byte per row and streamed.
HELD_TEXT = 32 << 20
#: Roles by their first letter, as the classes of rows count them; 3 stands for any other.
LETTERS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
#: What completes a conversation, by what stands last.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

_SPACE = " \t\n\x0b\x0c\r"


def inserted(state: int) -> int:
    """What an inserted row has to be after ``state``."""
    return ASSISTANT if state == USER else USER


def kept(state: int, letter: int) -> int | None:
    """What stands last once a row of this letter is kept, or None where it must not follow."""
    if letter == 0:
        return SYSTEM if state == START else None
    if letter == 1:
        return None if state == USER else USER
    return ASSISTANT if letter == 2 and state == USER else None


def _moves(letter: int, truncated: int) -> list[dict[int, tuple[int, str]]]:
    """Per state: the cheapest way over one row to each other state, and its audit, the least among equals.

    An insertion stands right before the row that is kept or given another role after it; before a deleted row it would cost
    as much as behind it and make a greater audit. Two insertions in a row lead back to where a cheaper edit leads.
    """
    out = []
    for state in STATES:
        ways: dict[int, tuple[int, str]] = {state: (DELETE, "D")}
        for before, sign, paid in ((state, "", 0), (inserted(state), "I", INSERT)):
            for to, cost, edit in ((kept(before, letter), 0, "K"), (inserted(before), REROLE, "R")):
                if to is not None:
                    ways[to] = min(ways.get(to, (NEVER, "")), (paid + cost + TRUNCATED * truncated, sign + edit))
        out.append(ways)
    return out


#: By class of a row: twice its letter, plus one if it is truncated.
MOVES = [_moves(k // 2, k % 2) for k in range(8)]


@lru_cache(None)
def _forward_step(kind: int, costs: tuple, ranks: tuple) -> tuple[int, tuple, tuple]:
    """One row further: what the least cost grew by, costs above it, and the order of the least audits of the states.

    Two audits of different states differ within the rows they share, so the order of the earlier ones decides; audits from
    one state differ in the last row.
    """
    found: dict[int, tuple[int, int, str]] = {}
    for state in STATES:
        if costs[state] < NEVER:
            for to, (cost, sign) in MOVES[kind][state].items():
                way = (costs[state] + cost, ranks[state], sign)
                found[to] = min(found.get(to, (NEVER, 0, "")), way)
    low = min(c for c, _, _ in found.values())
    order = sorted((r, s, to) for to, (_, r, s) in found.items())
    rank = {to: n for n, (_, _, to) in enumerate(order)}
    return low, tuple(found[t][0] - low if t in found else NEVER for t in STATES), tuple(rank.get(t, 0) for t in STATES)


@lru_cache(None)
def _backward_step(kind: int, costs: tuple) -> tuple[int, tuple]:
    raw = [min((c + costs[to] for to, (c, _) in MOVES[kind][state].items()), default=NEVER) for state in STATES]
    low = min(raw)
    return low, tuple(c - low if c < NEVER else NEVER for c in raw)


def _at(state: int) -> tuple:
    return tuple(0 if s == state else NEVER for s in STATES)


def forward(kinds: bytes, costs: tuple) -> tuple[int, tuple, tuple]:
    """From the costs of the states before the rows: a base, the costs above it behind them, and the order of their audits."""
    base, ranks = 0, (0, 1, 2, 3)
    for k in kinds:
        grown, costs, ranks = _forward_step(k, costs, ranks)
        base += grown
    return base, costs, ranks


def backward(kinds: bytes, costs: tuple) -> tuple:
    """Costs of the rows and all that follows, by the state before them, above the least of them."""
    for k in reversed(kinds):
        costs = _backward_step(k, costs)[1]
    return costs


def crossing(costs: tuple, ranks: tuple, rest: tuple) -> int:
    """The state of an optimal path at a border; of several, the one whose audit so far is the least."""
    return min((costs[s] + rest[s], ranks[s], s) for s in STATES if costs[s] < NEVER and rest[s] < NEVER)[2]


def edits(kinds: bytes, first: int, last: int) -> list[str]:
    """The audit of each row on the cheapest, then least, way from ``first`` to ``last`` (Hirschberg 1975).

    Cost vectors from both ends meet in the middle, the crossing is fixed there, and both halves are solved alone; no table
    of rows by states is kept.
    """
    out: list[str] = []
    todo = [(0, len(kinds), first, last)]
    while todo:
        a, b, p, q = todo.pop()
        if b - a == 1:
            out.append(MOVES[kinds[a]][p][q][1])
        elif b > a:
            mid = (a + b) // 2
            _, costs, ranks = forward(kinds[a:mid], _at(p))
            s = crossing(costs, ranks, backward(kinds[mid:b], _at(q)))
            todo += [(mid, b, s, q), (a, mid, p, s)]
    return out


END_COSTS = tuple(INSERT * len(ENDING[s]) for s in STATES)


def matrix(kinds: bytes) -> tuple[list[tuple], list[tuple]]:
    """Of a stretch of rows, per state before it: costs of the states behind it, and the order of their least audits."""
    found = [forward(kinds, _at(s)) for s in STATES]
    return [tuple(c if c >= NEVER else c + base for c in costs) for base, costs, _ in found], [ranks for _, _, ranks in found]


def joined(stretches: list[tuple[list[tuple], list[tuple]]]) -> list[tuple[int, int]]:
    """The states before and behind each of the stretches of one conversation, on its cheapest, then least, way."""
    costs, ranks, before = _at(START), (0, 1, 2, 3), []
    for cost, rank in stretches:
        before.append((costs, ranks))
        found = {}
        for q in STATES:
            ways = [(costs[p] + cost[p][q], ranks[p], rank[p][q]) for p in STATES if costs[p] < NEVER and cost[p][q] < NEVER]
            if ways:
                found[q] = min(ways)
        order = sorted((r, s, q) for q, (_, r, s) in found.items())
        costs = tuple(found[q][0] if q in found else NEVER for q in STATES)
        ranks = tuple(next((n for n, x in enumerate(order) if x[2] == q), 0) for q in STATES)
    q, out = crossing(costs, ranks, END_COSTS), []
    for (costs, ranks), (cost, _) in zip(reversed(before), reversed(stretches)):
        p = min((costs[p] + cost[p][q], ranks[p], p) for p in STATES if costs[p] < NEVER and cost[p][q] < NEVER)[2]
        out.append((p, q))
        q = p
    return out[::-1]


class Result:
    """What is said about one conversation, from its rows in order; texts pass through."""

    def __init__(self) -> None:
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.said = sha256()
        self.lines, self.state, self.letter = 0, START, None

    def _line(self, role: str, text: str) -> None:
        self.said.update(("\n" * (self.lines > 0) + role + ":" + text).encode())
        self.lines += 1

    def _insert(self) -> None:
        self.state = inserted(self.state)
        self._line("assistant" if self.state == ASSISTANT else "user", "")
        self.cost += INSERT

    def add(self, turn: int | None, role: str, text: str, n: int, fault: int, audit: str) -> None:
        """``n`` equal rows; ``audit`` is that of the first, none if it has to go."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.high = self.turn = turn
        letter = role[:1]
        self.illegal += (self.letter is not None and self.letter + letter not in LEGAL) + n - 1
        self.letter = letter
        for sign in audit:
            if sign == "I":
                self._insert()
            elif sign == "D":
                self.cost += DELETE
            else:
                self.cost += TRUNCATED * (fault == 3) + REROLE * (sign == "R")
                self.state = inserted(self.state) if sign == "R" else kept(self.state, LETTERS[letter])
                self._line(("user" if self.state == USER else "assistant") if sign == "R" else role, text)
        gone = n if fault in (1, 2) else n - 1
        self.cost += DELETE * gone
        self.audit.append(audit + "D" * gone)
        self.blank += n * (fault == 1)
        self.duplicate += n * (fault == 2) + (n - 1) * (fault in (0, 3))
        self.truncated += fault == 3

    def row(self) -> tuple:
        ending = ENDING[self.state]
        for _ in ending:
            self._insert()
        self.audit.append(ending)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.said.hexdigest())


ANSWER = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
ANSWER_TYPE = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
ROWS = "turn bigint, role string, text string, n bigint, fault int"


def kind_of(role: str, fault: int) -> int:
    return 2 * LETTERS.get(role[:1], 3) + (fault == 3)


def _solved(rows: list[dict]) -> tuple:
    """The answer for a whole conversation that is held."""
    kinds = bytes(kind_of(r["role"], r["fault"]) for r in rows if r["fault"] not in (1, 2))
    _, costs, ranks = forward(kinds, _at(START))
    signs = iter(edits(kinds, START, crossing(costs, ranks, END_COSTS)))
    out = Result()
    for r in rows:
        out.add(r["turn"], r["role"], r["text"], r["n"], r["fault"], "" if r["fault"] in (1, 2) else next(signs))
    return out.row()


def _first_pass(id_kind: pa.DataType):
    """Solve the conversations that lie inside a partition; hand on the rows and a summary of those that may go on outside.

    Those are the first and the last of the partition, and any whose text is too long to hold. A summary has one byte per
    row that is not sure to go, and a 4 by 4 matrix of costs with the order of the audits.
    """
    kinds = {"conv_id": id_kind, "sort": pa.int32(), "part": pa.int32(), "place": pa.int64(), "turn": pa.int64(), "role": pa.string(),
             "text": pa.string(), "n": pa.int64(), "fault": pa.int32(), "kinds": pa.binary(), "costs": pa.list_(pa.int64()), "ranks": pa.list_(pa.int32()),
             **{c: pa.int64() for c in ANSWER[:6]}, "audit": pa.string(), "repaired_sha256": pa.string()}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, first = TaskContext.get().partitionId(), 0, True
        conv, rows, codes, held, spilt = batches, [], bytearray(), 0, False  # the iterator is equal to no id
        out: list[dict] = []

        def hand_on() -> None:
            out.extend({"conv_id": conv, "sort": 2, "part": part, "place": p} | {c: r[c] for c in ("turn", "role", "text", "n", "fault")} for p, r in rows)
            rows.clear()

        def close(last: bool) -> None:
            nonlocal first
            if spilt or first or last:
                hand_on()
                costs, ranks = matrix(bytes(codes))
                out.append({"conv_id": conv, "sort": 1, "part": part, "place": -1, "kinds": bytes(codes), "costs": [c for row in costs for c in row],
                            "ranks": [r for row in ranks for r in row]})
            else:
                out.append({"conv_id": conv, "sort": 0} | dict(zip(ANSWER, _solved([r for _, r in rows]))))
                rows.clear()
            first = False

        for batch in batches:
            for r in batch.to_pylist():
                if r["conv_id"] != conv:
                    if conv is not batches:
                        close(False)
                    conv, codes, held, spilt = r["conv_id"], bytearray(), 0, False
                if r["n"]:  # a row without copies only names its conversation
                    if r["fault"] not in (1, 2):
                        codes.append(kind_of(r["role"], r["fault"]))
                    rows.append((place, r))
                    place, held = place + 1, held + len(r["text"])
                    if held > HELD_TEXT:
                        spilt, held = True, 0
                        hand_on()
                if len(out) >= 1000:
                    yield batch_of(out)
                    out.clear()
        if conv is not batches:
            close(True)
        if out:
            yield batch_of(out)

    return run


def _last_pass(ways: dict[tuple, tuple[int, int]], id_kind: pa.DataType):
    """Answers for the conversations handed on: per stretch its summary, which is solved, then its rows, which pass through."""
    kinds = (id_kind, *[pa.int64()] * 6, pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, result, signs = batches, None, iter(())
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["conv_id"] != conv:
                    if result is not None:
                        out.append((conv, *result.row()))
                    conv, result = r["conv_id"], Result()
                if r["sort"] == 1:
                    signs = iter(edits(r["kinds"], *ways[r["conv_id"], r["part"]]))
                else:
                    result.add(r["turn"], r["role"], r["text"], r["n"], r["fault"], "" if r["fault"] in (1, 2) else next(signs))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["conv_id", *ANSWER])
        if result is not None:
            yield pa.record_batch([pa.array([c], t) for c, t in zip((conv, *result.row()), kinds)], ["conv_id", *ANSWER])

    return run


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", modulus: int = 20) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``n`` (copies, 0 for a dropped row): damage by the checksum of id and turn.

    By the remainder: 0 drops a row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 makes it the user's. Nulls count as one space. A dropped row stays as a row of nulls that names its conversation.
    """
    blank = F.lit(" ")
    conv, turn = F.col(id_col), F.col(turn_col).cast("long")
    role, text = F.coalesce(F.col(role_col), blank), F.coalesce(F.col(text_col), blank)
    name = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    rest = turns.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % modulus).alias("rest"))
    there = F.col("rest") != 0
    return rest.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.when(F.col("rest") == 4, F.lit("user")).otherwise(F.col("role"))).alias("role"),
        F.when(there, F.when(F.col("rest") == 1, F.lit("")).when(F.col("rest") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))).alias("text"),
        F.when(~there, F.lit(0)).when(F.col("rest") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("n"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation in ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, ``n`` copies).

    ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.
    Rows of a conversation stand by turn (null first; rows of one turn by role, then by the digest of their text). The repaired
    roles are an optional system row and then pairs of user and assistant; of the cheapest edits the least audit is taken.

    Equal rows are counted before they meet, and which texts were said earlier comes from an aggregate. Rows are then
    range-partitioned by conversation and turn, so a long conversation spans partitions. Conversations inside a partition
    are solved there. Of the others, each partition sends a 4 by 4 matrix of costs per stretch to the driver (two a
    partition, and one for each conversation of more than ``HELD_TEXT``); the crossings between stretches are fixed from those,
    and the rows stream once more, by conversation, to be edited and digested. A task holds one byte per row of a stretch,
    never the texts; the digest of one conversation's text is sequential, so that stream is one task's work, as is its audit,
    which is one value.

    Rows with ``n`` of 0 or with a null role and text only name their conversation; one without other rows gets zeros, an
    empty audit and the digest of nothing. Null ids are one conversation. A role that starts with none of s, u and a, an
    empty one too, cannot be kept. Empty texts are blank. No rows give no rows.
    """
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("key", key)
    first = F.min(F.struct("turn"))["turn"]
    again = counted.filter("n > 0").groupBy("conv_id", "role", "key").agg(first.alias("first"), F.count("*").alias("times")).filter("times > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "first", "times")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    later = F.col("times").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    end = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    fault = F.when(F.rtrim("text", F.lit(_SPACE)) == "", 1).when(later, 2).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    judged = cut_lineage(counted.join(again, same, "left").select("conv_id", "turn", "role", "text", "n", "key", fault.cast("int").alias("fault")))

    kind = judged.schema["conv_id"].dataType
    order = ["conv_id", "turn", "role", "key"]
    laid = cut_lineage(judged.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "n", "fault").mapInArrow(
        _first_pass(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, sort int, part int, place bigint, {ROWS}, kinds binary, costs array<bigint>, "
        f"ranks array<int>, {ANSWER_TYPE}"))

    stretches: dict = {}
    for r in sorted(laid.filter("sort = 1").select("conv_id", "part", "costs", "ranks").collect(), key=lambda r: r.part):
        square = [[tuple(v[4 * s: 4 * s + 4]) for s in STATES] for v in (r.costs, r.ranks)]
        stretches.setdefault(r.conv_id, []).append((r.part, tuple(square)))
    ways = {(conv, part): way for conv, found in stretches.items() for (part, _), way in zip(found, joined([m for _, m in found]))}

    handed = laid.filter("sort > 0").select("conv_id", "sort", "part", "place", "turn", "role", "text", "n", "fault", "kinds")
    streamed = handed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").mapInArrow(
        _last_pass(ways, to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {ANSWER_TYPE}")
    return laid.filter("sort = 0").select("conv_id", *ANSWER).unionByName(streamed)
