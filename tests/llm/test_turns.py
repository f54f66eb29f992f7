"""Conversation repair against a search over all edits and a slow copy of the whole query."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fichario.llm import turns
from fichario.llm.catalog import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?\Z")


def slow_repair(rows):
    """Cost, audit and lines by a uniform-cost search over (row, roles so far modulo the shape)."""
    faults, seen = [], set()
    for _, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "b" if not visible else "d" if (role, text) in seen else "t" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        short = roles[:1] if roles == "s" else ("S" if roles[:1] == "s" else "") + roles[-1:]
        if (at, short) in done:
            continue
        done.add((at, short))
        if at == len(rows) and SHAPE.match(roles):
            return faults, cost, audit, lines

        def go(more, letter, at, role, line):
            if not SHAPE.match(roles + role) and not SHAPE.match(roles + role + "a") and roles + role != "s":
                return
            heapq.heappush(heap, (cost + more, audit + letter, at, roles + role, lines + line))

        for name in ("user", "assistant"):
            go(5, "I", at, name[0], ((name, ""),))
        if at < len(rows):
            _, role, text = rows[at]
            go(2, "D", at + 1, "", ())
            if faults[at] not in ("b", "d"):
                more = 5 if faults[at] else 0
                if role[:1] in ("s", "u", "a"):
                    go(more, "K", at + 1, role[0], ((role, text),))
                for name in ("user", "assistant"):
                    go(1 + more, "R", at + 1, name[0], ((name, text),))


def slow_report(rows):
    """rows: (turn, role, text) of one conversation after the damage."""
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[2])))
    faults, cost, audit, lines = slow_repair(rows)
    numbers = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        faults.count("b"), faults.count("d"), faults.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def slow_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if harm == 1:
            text = ""
        elif harm == 2:
            text = re.sub("[.!?]", "", text)
        elif harm == 4:
            role = "user"
        if harm:
            own += [(turn, role, text)] * (2 if harm == 3 else 1)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_query_against_search(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r[n] for n in NAMES) for r in op11_conversation_repair(spark, folder).collect()}
    assert found == {conv: slow_report(own) for conv, own in slow_damage(rows).items()}
    assert sum(r[5] for r in found.values()) > 0


@pytest.mark.parametrize("piece", [1, 2, 3, 256])
def test_pieces_change_nothing(monkeypatch, piece):
    random.seed(piece)
    for _ in range(300):
        rows = [(random.choice(["s", "u", "a", ""]), random.choice([0, 0, 0, 1, 2]))
                for _ in range(random.randrange(9))]
        parts = [rows[i:i + piece] for i in range(0, len(rows), piece)]
        text = {0: "x.", 1: "x", 2: ""}
        given = [(n, {"s": "system", "u": "user", "a": "assistant", "": "tool"}[i], text[f] and f"{n}{text[f]}")
                 for n, (i, f) in enumerate(rows)]
        _, cost, audit, _ = slow_repair(given)
        assert turns.solve([(len(p), turns.piece_weights(p)) for p in parts]) == (cost, audit)


def test_odd_rows(spark, monkeypatch):
    rows = [
        (1, None, "user", "a."), (1, None, None, None), (1, 3, "assistant", "b!"), (1, 3, "assistant", "b!"),
        (1, 3, "tool", "c?"), (1, 9, "assistant", "b!"), (2, 0, "assistant", ""), (3, 0, "system", "only."),
        (None, 0, "user", "q." * 50_000), (None, 1, "assistant", "r"), (4, 5, "", "x."), (5, 1, "user", "y\n. \n"),
        (5, 2, "admin", "z."), (6, -3, "u", "é!"), (6, 4, "a", "ü."),
    ]
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", copies int, piece string")
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    found = turns.report(frame).collect()
    assert {r.conv_id: tuple(r[n] for n in NAMES) for r in found} == {c: slow_report(o) for c, o in want.items()}
    assert len(found) == len(want)
    empty = turns.report(frame, frame.filter("false").withColumn("copies", F.lit(1))).collect()
    assert {tuple(r[n] for n in NAMES) for r in empty} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert turns.report(frame.limit(0)).count() == 0


def test_repaired_turns_and_a_long_conversation(spark):
    """A conversation over many pieces and tasks; the turns that come out are those of the search."""
    random.seed(5)
    rows = [(8, n, random.choice(["user", "assistant", "system"]), random.choice([f"t{n}.", f"t{n}", "same.", ""]))
            for n in range(2_000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    report = turns.report(frame).collect()[0]
    out = sorted(turns.repaired(frame).collect(), key=lambda r: r.turn)
    assert [r.turn for r in out] == list(range(len(out)))
    assert SHAPE.match("".join(r.role[0] for r in out))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in out).encode()).hexdigest() == report.repaired_sha256
    width = 2 * len(rows)
    faults = []
    seen = set()
    for _, _, role, text in rows:
        faults.append(2 if not text or (role, text) in seen else 0 if text[-1] == "." else 1)
        seen.add((role, text))
    whole = turns.solve([(len(rows), turns.piece_weights([(r[2][0], f) for r, f in zip(rows, faults)]))])
    assert (report.cost, report.audit) == whole and len(report.audit) <= width


def test_damage(spark):
    rows = [(n, n % 7, "assistant", "a. b!") for n in range(400)] + [(None, None, None, None)]
    found = {}
    for r in turns.damaged(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r.conv_id, []).extend([(r.turn, r.role, r.text)] * r.copies)
    assert found == {c: o for c, o in slow_damage(rows).items() if o}
