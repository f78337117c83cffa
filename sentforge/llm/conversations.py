"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation is an optional system row, then user and assistant rows
by turns: role initials ``(s?(ua)+)?``.  Each row is kept (0), given another role
(1) or deleted (2); rows with an empty text may be inserted anywhere (5); a
truncated row that stays adds 5; blank and duplicate rows must go.  Of the
cheapest repairs the one whose edit initials (``D``, ``I``, ``K``, ``R``) come
first in ASCII order is taken.

Four states say what was emitted last: nothing, system, user, assistant.  A row
is a 4 x 4 table of the cheapest way from state to state (``Step``).  Forward
vectors hold each state's cost and the rank of its best audit; backward vectors
hold costs.  Both meet in the middle; of the crossings with the least sum the
one of least rank is taken, and both halves are solved the same way with their
end states fixed, so nothing but vectors and the audit itself is kept.  Ranks
suffice: two audits over the same rows end in an edit of the last row, so
neither is a prefix of the other, and equal audits end in the same state.

Tables of neighbouring stretches compose into a table of the same size, which is
how a conversation of any length is spread over tasks: rows are range-sorted by
(conversation, turn, ...), each range partition writes conversations that lie
inside it at once and cuts the others into blocks of bounded size; blocks, then
range partitions, are stretches whose crossings are found by the same procedure,
and then every block is solved by itself.  Only the audit and the digest of a
conversation's repaired text gather its blocks, as one stream in block order.

Edge cases: null roles and texts count as one blank, so such rows are given
a role or deleted; null turns come first; null conversation ids are one conversation;
rows of one turn are ordered by role, the first 64 characters of the text and
its hash; equal rows after the first are duplicates; a conversation without rows
has zeros, an empty audit and no repaired row; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import stage

COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5  # a truncated row that is not deleted
FAR = 1 << 60  # no way
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 20
ROLES = {2: "user", 3: "assistant"}
BLANK, DUPLICATE, CUT, WHOLE = "blank", "duplicate", "truncated", ""
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
STATES = range(4)
_EMITS = {"s": {_START: _SYSTEM}, "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, "a": {_USER: _ASSISTANT}}
_NEXT = _EMITS["u"] | _EMITS["a"]  # what may be inserted, or what a row may be given, in a state


class Step(NamedTuple):
    """The cheapest way through a stretch of rows, from state to state: cost, and its audit's rank among those from one state."""

    cost: tuple
    rank: tuple


def _ranked(ways: list[dict]) -> tuple[Step, list[dict]]:
    """A step from ``ways[p][q] = (cost, audit)``."""
    cost = tuple(tuple(w[q][0] if q in w else FAR for q in STATES) for w in ways)
    rank = []
    for w in ways:
        order = sorted(w, key=lambda q: w[q][1])
        rank.append(tuple(order.index(q) if q in w else 0 for q in STATES))
    return Step(cost, tuple(rank)), [{q: a for q, (_, a) in w.items()} for w in ways]


def _row_ways(initial: str, fault: str) -> list[dict]:
    """Per state: the cheapest (cost, audit) to every state by one row, with the rows inserted before it."""
    ways = []
    for p in STATES:
        best: dict = {}
        at, spent, before = p, 0, ""
        for _ in range(3):  # nothing, one or two inserted rows reach every state
            extra = TRUNCATED if fault == CUT else 0
            edits = [(at, COSTS["D"], "D")]
            if fault not in (BLANK, DUPLICATE):
                edits.append((_NEXT[at], COSTS["R"] + extra, "R"))
                if at in _EMITS.get(initial, {}):
                    edits.append((_EMITS[initial][at], COSTS["K"] + extra, "K"))
            for q, c, letter in edits:
                best[q] = min(best.get(q, (FAR, "")), (spent + c, before + letter))
            at, spent, before = _NEXT[at], spent + COSTS["I"], before + "I"
        ways.append(best)
    return ways


#: One table for every kind of row: (first letter of the role, or "" for any other; fault).
STEPS = {(i, f): _ranked(_row_ways(i, f)) for i in ("s", "u", "a", "") for f in (BLANK, DUPLICATE, CUT, WHOLE)}
#: Rows inserted after the last one: cost by state.
LAST = (0, 2 * COSTS["I"], COSTS["I"], 0)
_NEVER = FAR >> 1


def kind_of(role: str, fault: str) -> tuple[str, str]:
    return (role[:1] if role[:1] in ("s", "u", "a") else "", fault)


def _forward(steps: list[Step], p: int) -> tuple[list[int], list[int]]:
    cost, rank = [FAR] * 4, [0] * 4
    cost[p] = 0
    for s in steps:
        ways = []
        for q in STATES:
            c, r = min(((cost[x] + s.cost[x][q], (rank[x], s.rank[x][q])) for x in STATES), default=None)
            ways.append((c, r))
        order = sorted({r for c, r in ways if c < _NEVER})
        cost = [min(c, FAR) for c, _ in ways]
        rank = [order.index(r) if c < _NEVER else 0 for c, r in ways]
    return cost, rank


def _backward(steps: list[Step], last: list[int] | tuple) -> list[int]:
    cost = list(last)
    for s in reversed(steps):
        cost = [min(FAR, min(s.cost[p][q] + cost[q] for q in STATES)) for p in STATES]
    return cost


def compose(steps: list[Step]) -> Step:
    """One step for a stretch of steps."""
    rows = [_forward(steps, p) for p in STATES]
    return Step(tuple(tuple(c) for c, _ in rows), tuple(tuple(r) for _, r in rows))


def crossings(steps: list[Step], p: int, last: list[int] | tuple) -> list[int]:
    """The states after each step, from state ``p``, of the audit-least cheapest way under the closing costs ``last``."""
    if not steps:
        return []
    if len(steps) == 1:
        s = steps[0]
        return [min(STATES, key=lambda q: (s.cost[p][q] + last[q], s.rank[p][q]))]
    half = len(steps) // 2
    cost, rank = _forward(steps[:half], p)
    rest = _backward(steps[half:], last)
    best = min(c + r for c, r in zip(cost, rest, strict=True))
    met = min((q for q in STATES if cost[q] + rest[q] == best), key=lambda q: rank[q])
    return [*crossings(steps[:half], p, _only(met)), *crossings(steps[half:], met, last)]


def _only(q: int) -> list[int]:
    return [0 if x == q else FAR for x in STATES]


def _apply(kinds, rows, states: list[int], p: int) -> tuple[str, list[tuple[str, str]]]:
    """The audit and the repaired (role, text) rows of rows whose crossings are known."""
    audit, lines = [], []
    for kind, (role, text), q in zip(kinds, rows, states, strict=True):
        edits = STEPS[kind][1][p][q]
        at = p
        for e in edits:
            if e in "IR":
                at = _NEXT[at]
                lines.append((ROLES[at], text if e == "R" else ""))
            elif e == "K":
                at = _EMITS[kind[0]][at]
                lines.append((role, text))
        audit.append(edits)
        p = q
    return "".join(audit), lines


def _tail(q: int) -> tuple[str, list[tuple[str, str]]]:
    lines, audit = [], ""
    while LAST[q]:
        q = _NEXT[q]
        audit += "I"
        lines.append((ROLES[q], ""))
    return audit, lines


def repair(rows: list[tuple[str, str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, audit and repaired (role, text) rows of one conversation of ``(role, text, fault)`` rows."""
    kinds = [kind_of(r, f) for r, _, f in rows]
    steps = [STEPS[k][0] for k in kinds]
    states = crossings(steps, _START, LAST)
    audit, lines = _apply(kinds, [(r, t) for r, t, _ in rows], states, _START)
    more, added = _tail(states[-1] if states else _START)
    p, cost = _START, 0
    for s, q in zip(steps, states, strict=True):
        cost, p = cost + s.cost[p][q], q
    return cost + LAST[p], audit + more, lines + added


# ------------------------------------------------------------------- rows ----
def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``copies`` (0 to 2) after the damage that the query states."""
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), F.lit(" ")))
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                                F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
                                (F.crc32(key.cast("binary")) % 20).alias("what"))
    text = F.when(F.col("what") == 1, F.lit("")).when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(F.col("what") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("what") == 0, 0).when(F.col("what") == 3, 2).otherwise(1).alias("copies"))


def _last_char(text: Column) -> Column:
    """The last character that is not white space, or the empty string."""
    cut = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.substring(cut, -1, 1)


def _turn_key(turn: str = "turn") -> Column:
    return F.struct(F.col(turn).isNotNull().alias("has"), F.col(turn).alias("at"))


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows with ``late`` (role and text stand at an earlier turn) and ``ending`` (see ``_last_char``).

    Texts are told by 128 bits of their SHA-256.  Equal rows of one turn are folded into one with the number of its
    ``copies`` by a partial aggregate, so that no task receives them all; which texts stand at several turns is an
    aggregate of the same narrow rows.  Both tables hold repeated rows only."""
    rows = rows.filter("copies > 0").select("*", F.sha2("text", 256).substr(1, 32).alias("digest"), _last_char(F.col("text")).alias("ending"))
    key = ["conv", "turn", "role", "digest"]
    seen = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    twice = seen.filter("n > 1").select(*[F.col(k).alias("_" + k) for k in key])
    equal = lambda names: reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col("_" + k)) for k in names])
    marked = rows.join(twice, equal(key), "left")
    folded = marked.filter("_digest is not null").groupBy(*key).agg(
        F.max("text").alias("text"), F.sum("copies").alias("copies"), F.max("ending").alias("ending"))
    rows = marked.filter("_digest is null").select(*key, "text", F.col("copies").cast("bigint").alias("copies"), "ending").unionByName(folded)
    again = seen.groupBy("conv", "role", "digest").agg(F.min(_turn_key()).alias("first"), F.max(_turn_key()).alias("final"))
    again = again.filter("first != final").select(*[F.col(k).alias("_" + k) for k in ("conv", "role", "digest")], "first")
    late = F.col("first").isNotNull() & (_turn_key() != F.col("first"))
    return rows.join(again, equal(["conv", "role", "digest"]), "left").select(
        "conv", "turn", "role", "text", "copies", "ending", late.alias("late"))


class _Stretch:
    """Rows of one conversation in one task: the faults, and the counts that need the order."""

    def __init__(self):
        self.rows, self.kinds, self.size = [], [], 0
        self.counts = {BLANK: 0, DUPLICATE: 0, CUT: 0}
        self.illegal = self.turns = 0
        self.first = self.last = None  # role initials
        self.low = self.high = None  # turns

    def add(self, turn, role: str, text: str, fault: str) -> None:
        self.rows.append((role, text))
        self.kinds.append(kind_of(role, fault))
        self.size += len(role) + len(text)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            if self.high is None or turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.size >= BLOCK_BYTES


_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())
_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_KEY = [(k, pa.int64()) for k in ("conv", "part", "block")]
_SUMMARY = pa.schema([*_KEY, ("step", _LONGS), ("counts", _LONGS), ("low", pa.int64()), ("high", pa.int64()), ("first", pa.string()), ("last", pa.string())])
_STRETCH = pa.schema([*_SUMMARY, ("cost", pa.int64()), ("audit", pa.string()), ("digest", pa.string()), ("lines", _ROWS),
                      ("kinds", _STRINGS), ("roles", _STRINGS), ("texts", _STRINGS)])
_ENDS = pa.schema([*_KEY, ("p", pa.int64()), ("q", pa.int64()), ("tail", pa.bool_())])
_SOLVED = pa.schema([*_KEY, ("cost", pa.int64()), ("audit", pa.string()), ("lines", _ROWS)])
_TOTAL = pa.schema([("conv", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("digest", pa.string())])
_KEY_SQL = "conv bigint, part bigint, block bigint"
_LINES_SQL = "lines array<struct<role: string, text: string>>"
_SUMMARY_SQL = f"{_KEY_SQL}, step array<bigint>, counts array<bigint>, low bigint, high bigint, first string, last string"
_STRETCH_SQL = (f"{_SUMMARY_SQL}, cost bigint, audit string, digest string, {_LINES_SQL}, kinds array<string>, roles array<string>, "
                "texts array<string>")
_ENDS_SQL = f"{_KEY_SQL}, p bigint, q bigint, tail boolean"
_SOLVED_SQL = f"{_KEY_SQL}, cost bigint, audit string, {_LINES_SQL}"
_TOTAL_SQL = "conv bigint, cost bigint, audit string, digest string"
_FAULTS = (BLANK, DUPLICATE, CUT)


def _packed(s: Step) -> list[int]:
    return [x for part in s for row in part for x in row]


def _told(lines) -> list[dict]:
    return [{"role": r, "text": t} for r, t in lines]


def _unpacked(x) -> Step:
    grid = [tuple(x[k:k + 4]) for k in range(0, 32, 4)]
    return Step(tuple(grid[:4]), tuple(grid[4:]))


def _text(lines) -> str:
    return "\n".join(f"{r}:{t}" for r, t in lines)


def _cut(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range partition: finished conversations, and the blocks of those that may go on elsewhere."""
    out: list[dict] = []
    held, conv, block, opening, part = None, None, 0, True, None
    before = None  # (turn, role, text) of the row above

    def close(ends: bool) -> None:
        row = {"conv": conv, "part": part, "block": block, "counts": [len(held.rows), *(held.counts[f] for f in _FAULTS), held.illegal, held.turns],
               "low": held.low, "high": held.high, "first": held.first, "last": held.last}
        if ends and not opening and block == 0:
            cost, audit, lines = repair([(r, t, k[1]) for (r, t), k in zip(held.rows, held.kinds, strict=True)])
            row |= {"cost": cost, "audit": audit, "digest": hashlib.sha256(_text(lines).encode()).hexdigest(), "lines": _told(lines) if texts else None}
        else:
            row |= {"step": _packed(compose([STEPS[k][0] for k in held.kinds])), "kinds": ["|".join(k) for k in held.kinds],
                    "roles": [r for r, _ in held.rows], "texts": [t for _, t in held.rows]}
        out.append(row)

    for batch in batches:
        for r in batch.to_pylist():
            part = r["part"] if part is None else part
            this = (r["turn"], r["role"], r["text"])
            for _ in range(r["copies"]):
                if held is None or conv != r["conv"]:
                    if held is not None:
                        close(ends=True)
                        opening = False
                    held, conv, block, before = _Stretch(), r["conv"], 0, None
                elif held.full():
                    close(ends=False)
                    held, block = _Stretch(), block + 1
                fault = (BLANK if r["ending"] == "" else DUPLICATE if r["late"] or this == before else
                         WHOLE if r["ending"] in (".", "!", "?") else CUT)
                held.add(*this, fault)
                before = this
                if len(out) >= 256 or (out and "step" in out[-1]):
                    yield pa.RecordBatch.from_pylist(out, schema=_STRETCH)
                    out.clear()
    if held is not None:
        close(ends=False)  # the last conversation may go on in the next partition
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_STRETCH)


def _in_order(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]))


def _joined(table: pa.Table) -> pa.Table:
    """One summary for neighbouring stretches of a conversation: the composed step and the counts, borders included."""
    rows = _in_order(table)
    counts = [sum(x) for x in zip(*(r["counts"] for r in rows), strict=True)]
    high = None
    for x, y in zip(rows, rows[1:], strict=False):
        high = x["high"] if x["high"] is not None else high
        counts[4] += x["last"] + y["first"] not in ("su", "ua", "au")
        counts[5] -= high is not None and high == y["low"]  # a turn that goes on
    lows, highs = ([r[k] for r in rows if r[k] is not None] for k in ("low", "high"))
    one = rows[0] | {"step": _packed(compose([_unpacked(r["step"]) for r in rows])), "counts": counts, "low": min(lows, default=None),
                     "high": max(highs, default=None), "last": rows[-1]["last"]}
    return pa.Table.from_pylist([{k: one[k] for k in _SUMMARY.names}], schema=_SUMMARY)


def _settle(table: pa.Table) -> pa.Table:
    """Where each of the stretches of a conversation begins and ends, between given states."""
    rows = _in_order(table)
    p, q, tail = (rows[0][k] for k in ("p", "q", "tail"))
    states = crossings([_unpacked(r["step"]) for r in rows], p, LAST if q is None else _only(q))
    done = [{"conv": r["conv"], "part": r["part"], "block": r["block"], "p": a, "q": b, "tail": tail and r is rows[-1]}
            for r, a, b in zip(rows, [p, *states[:-1]], states, strict=True)]
    return pa.Table.from_pylist(done, schema=_ENDS)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair blocks between known states; the last block of a conversation gets the rows inserted at its end."""
    for batch in batches:
        for r in batch.to_pylist():
            kinds = [tuple(k.split("|")) for k in r["kinds"]]
            steps = [STEPS[k][0] for k in kinds]
            states = crossings(steps, r["p"], _only(r["q"]))
            audit, lines = _apply(kinds, list(zip(r["roles"], r["texts"], strict=True)), states, r["p"])
            cost = sum(s.cost[a][b] for s, a, b in zip(steps, [r["p"], *states[:-1]], states, strict=True))
            if r["tail"]:
                more, added = _tail(r["q"])
                cost, audit, lines = cost + LAST[r["q"]], audit + more, lines + added
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("conv", "part", "block")} | {"cost": cost, "audit": audit, "lines": _told(lines)}],
                                             schema=_SOLVED)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks: every conversation's cost, audit and digest, holding one batch at a time (and the audit)."""
    live, conv, cost, audit, sha, some = False, None, 0, [], None, False

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv": conv, "cost": cost, "audit": "".join(audit), "digest": sha.hexdigest()}], schema=_TOTAL)

    for batch in batches:
        for r in batch.to_pylist():
            if not live or r["conv"] != conv:
                if live:
                    yield done()
                live, conv, cost, audit, sha, some = True, r["conv"], 0, [], hashlib.sha256(), False
            cost += r["cost"]
            audit.append(r["audit"])
            if r["lines"]:
                sha.update((("\n" if some else "") + _text((x["role"], x["text"]) for x in r["lines"])).encode())
                some = True
    if live:
        yield done()


_ORDER = ["conv", "part", "block"]


def _stretches(rows: DataFrame, texts: bool) -> DataFrame:
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("bigint"))
    return stage(dealt.sortWithinPartitions(*order, "text").mapInArrow(lambda x: _cut(x, texts), _STRETCH_SQL), "stretches")


def _at(names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col("_" + k)) for k in names])


def _spread(stretches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the conversations that stand in several blocks: their summaries, and every block repaired between its crossings."""
    open_ = stretches.filter("step is not null")
    steps = open_.select(*_SUMMARY.names)
    parts = stage(steps.groupBy("conv", "part").applyInArrow(_joined, _SUMMARY_SQL), "parts")  # the blocks of a range partition
    totals = parts.groupBy("conv").applyInArrow(_joined, _SUMMARY_SQL)  # a row per range partition
    whole = parts.select(*_ORDER, "step", F.lit(_START).cast("bigint").alias("p"), F.lit(None).cast("bigint").alias("q"), F.lit(True).alias("tail"))
    ends = whole.groupBy("conv").applyInArrow(_settle, _ENDS_SQL).select(*[F.col(k).alias("_" + k) for k in _ORDER], "p", "q", "tail")
    inner = steps.select(*_ORDER, "step").join(ends, _at(["conv", "part"])).select(*_ORDER, "step", "p", "q", "tail")
    inner = inner.groupBy("conv", "part").applyInArrow(_settle, _ENDS_SQL).select(*[F.col(k).alias("_" + k) for k in _ORDER], "p", "q", "tail")
    rows = open_.select(*_ORDER, "kinds", "roles", "texts").join(inner, _at(_ORDER)).select(*_ORDER, "kinds", "roles", "texts", "p", "q", "tail")
    return totals, stage(rows.mapInArrow(_solve, _SOLVED_SQL), "solved")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (``conv`` and ``turn`` 64-bit numbers, ``role``, ``text``, ``copies``):
    ``conv``, the counts ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, and ``cost``, ``audit`` and
    ``digest`` (SHA-256 of the repaired ``role:text`` lines) of its repair."""
    stretches = _stretches(with_faults(rows), texts=False)
    totals, solved = _spread(stretches)
    streamed = solved.repartition("conv").sortWithinPartitions(*_ORDER).mapInArrow(_streamed, _TOTAL_SQL)
    streamed = streamed.select(F.col("conv").alias("_conv"), "cost", "audit", "digest")
    names = ["conv", "counts", "low", "high", "cost", "audit", "digest"]
    many = totals.select("conv", "counts", "low", "high").join(streamed, _at(["conv"])).select(*names)
    every = stretches.filter("step is null").select(*names).unionByName(many)
    c = lambda k: F.col("counts")[k]
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - c(5), F.lit(0).cast("bigint"))
    return every.select("conv", gaps.alias("gaps"), c(1).alias("blank"), c(2).alias("duplicate"), c(3).alias("truncated"),
                        c(4).alias("illegal"), "cost", "audit", "digest")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv``, ``part``, ``block``, ``pos`` (sort by these four), ``role`` and ``text``."""
    stretches = _stretches(with_faults(rows), texts=True)
    lines = stretches.filter("step is null").select(*_ORDER, "lines").unionByName(_spread(stretches)[1].select(*_ORDER, "lines"))
    return lines.select(*_ORDER, F.posexplode("lines").alias("pos", "line")).select(*_ORDER, "pos", "line.role", "line.text")
