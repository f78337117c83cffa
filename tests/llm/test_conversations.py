"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from sentforge.llm import conversations as C
from sentforge.llm.queries import op11_conversation_repair

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"
FULL = re.compile(r"(s?(ua)+)?$")


def every_repair(rows):
    """All edits of (initial, fault) rows with at most two insertions at a place: cost, audit, initials."""
    inserts = [(5 * k, "I" * k, x) for k in range(3) for x in map("".join, itertools.product("ua", repeat=k))]

    def go(i):
        for c, a, x in inserts:
            if i == len(rows):
                yield c, a, x
                continue
            initial, fault = rows[i]
            edits = [(2, "D", "")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                edits += [(more, "K", initial or "?"), (1 + more, "R", "u"), (1 + more, "R", "a")]
            for c2, a2, x2 in edits:
                for c3, a3, x3 in go(i + 1):
                    yield c + c2 + c3, a + a2 + a3, x + x2 + x3

    return min((c, a) for c, a, x in go(0) if FULL.match(x))


def plain(rows):
    """The whole-table form with audits carried as strings."""
    best = {0: (0, "", [])}
    for role, text, fault in rows:
        new = {}
        for p, (c, a, out) in best.items():
            for _ in range(3):
                edits = [(p, 2, "D", [])]
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    to = 3 if p == 2 else 2
                    edits.append((to, 1 + more, "R", [("user" if to == 2 else "assistant") + ":" + text]))
                    ok = {"s": p == 0, "u": p != 2, "a": p == 2}.get(role[:1], False)
                    if ok:
                        edits.append(({"s": 1, "u": 2, "a": 3}[role[0]], more, "K", [role + ":" + text]))
                for q, d, e, lines in edits:
                    way = (c + d, a + e, out + lines)
                    if q not in new or way[:2] < new[q][:2]:
                        new[q] = way
                p, c, a, out = (3 if p == 2 else 2), c + 5, a + "I", out + ["assistant:" if p == 2 else "user:"]
        best = new
    ends = []
    for q, (c, a, out) in best.items():
        for k in ({0: 0, 1: 2, 2: 1, 3: 0}[q],):
            ends.append((c + 5 * k, a + "I" * k, out + [[], ["assistant:"], ["user:", "assistant:"]][k]))
    return min(ends, key=lambda x: x[:2])


def test_least_audit_of_all_repairs():
    r = random.Random(11)
    kinds = [(i, f) for i in ("s", "u", "a", "x") for f in ("blank", "duplicate", "truncated", "")]
    cases = [list(x) for k in range(3) for x in itertools.product(kinds, repeat=k)] + [[r.choice(kinds) for _ in range(3)] for _ in range(25)]
    for rows in r.sample(cases, 120) + cases[-25:]:
        cost, audit, _ = C.repair([(i, "t", f) for i, f in rows])
        assert (cost, audit) == every_repair(rows), rows


def test_long_conversations_equal_the_plain_table():
    r = random.Random(12)
    for _ in range(400):
        rows = [(r.choice(["system", "user", "assistant", "tool", ""]), str(i), r.choice(["", "", "", "truncated", "blank", "duplicate"])) for i in range(r.randint(0, 60))]
        cost, audit, lines = C.repair(rows)
        assert (cost, audit, [f"{a}:{b}" for a, b in lines]) == plain(rows)


def test_composed_stretches_give_the_same_crossings():
    r = random.Random(14)
    for _ in range(150):
        steps = [C.STEPS[r.choice(list(C.STEPS))][0] for _ in range(r.randint(1, 40))]
        cuts = sorted({0, len(steps), *(r.randint(0, len(steps)) for _ in range(4))})
        parts = [C.compose(steps[a:b]) for a, b in itertools.pairwise(cuts)]
        states = C.crossings(steps, 0, C.LAST)
        assert C.crossings(parts, 0, C.LAST) == [states[b - 1] for b in cuts[1:]]
        assert C.compose(parts) == C.compose(steps)


def brute(rows, damage=True):
    """Result by conversation of (conv, turn, role, text) rows."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        role = "user" if what == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(what, 1)
    out = {}
    for conv, items in convs.items():
        items.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faults = set(), []
        for _, role, text in items:
            body = text.rstrip(WHITE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in items if t is not None}
        initials = [x[1][:1] for x in items]
        cost, audit, lines = plain([(r, t, f) for (_, r, t), f in zip(items, faults, strict=True)])
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(out):
    return {r.conv_id: tuple(r)[1:] for r in out.collect()}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op11_conversation_repair(spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result(got) == brute(rows)


ODD = "conv_id bigint, turn bigint, role string, text string, part bigint, block string, conv string"


def odd_conversations(n_hot):
    r = random.Random(15)
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "", "tool:x"]), r.choice(["Yes.", "no", None, "", " \n", "Why? \t", "x" * 50]))
            for c in range(60) for t in range(r.randint(1, 7))]
    rows += [(None, t, "user", "hi.") for t in (None, None, 3, 3, 4)] + [(7, None, "assistant", "Late!")] * 4
    rows += [(99, t if t % 3 else None, r.choice(["user", "assistant", "assistant"]), f"text {t % 50}.") for t in range(n_hot)]
    return rows + [(99, 5, "user", "again and again.")] * (n_hot // 3) + [(98, 1, "user", "z" * 200_000 + "."), (98, 9, "assistant", "ok.")]


@pytest.mark.parametrize("block", [4096, 16])
def test_odd_and_hot_conversations(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)  # the task's own copy, in local mode forked from this process, may keep the default
    rows = odd_conversations(900)
    path = str(tmp_path / "sf")
    spark.createDataFrame([(*x, 1, "b", "c") for x in rows], ODD).repartition(5).write.parquet(f"{path}/conversations.parquet")
    want = brute(rows)
    assert result(op11_conversation_repair(spark, path)) == want
    conf = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert result(op11_conversation_repair(spark, path)) == want
        lines = C.repaired_rows(C.damaged(spark.read.parquet(f"{path}/conversations.parquet"))).orderBy("conv", "part", "block", "pos").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    texts = {}
    for x in lines:
        texts.setdefault(x.conv, []).append(f"{x.role}:{x.text}")
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: v[-1] for c, v in want.items() if v[-1] != empty}


def test_blocks_of_one_range_partition():
    """A conversation that fills several blocks inside one task."""
    import pyarrow as pa

    rows = [{"conv": 1, "turn": t, "role": "user", "text": f"{t}.", "copies": 1, "ending": ".", "late": False, "part": 0} for t in range(10_000)]
    rows = [{**rows[0], "conv": 0}, *rows, {**rows[0], "conv": 2}]
    out = [r for b in C._cut(iter([pa.RecordBatch.from_pylist(rows)]), False) for r in b.to_pylist()]
    mine = [r for r in out if r["conv"] == 1]
    assert [r["block"] for r in mine] == [0, 1, 2] and all(r["step"] for r in mine) and len(out) == 5
    steps = [C._unpacked(r["step"]) for r in mine]
    whole = C.repair([("user", f"{t}.", "") for t in range(10_000)])
    states = C.crossings(steps, 0, C.LAST)
    assert C.compose(steps).cost[0][states[-1]] + C.LAST[states[-1]] == whole[0]


def test_empty_and_dropped(spark, tmp_path):
    none = spark.createDataFrame([], ODD)
    assert C.repair_conversations(C.damaged(none)).count() == 0
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(dropped, 0, "user", "a.", 1, "", "")], ODD).write.parquet(str(tmp_path / "conversations.parquet"))
    assert result(op11_conversation_repair(spark, str(tmp_path))) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
