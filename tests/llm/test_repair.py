"""Conversation repair against a plain search over all cheapest edits."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from clickloom.llm import queries as registered
from clickloom.llm import repair

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    """The contract's damage, row by row."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain(rows):
    """Cost and least audit by trying all edits, cheapest and then least first, per state."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, faults, tally = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        bare = text.strip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else \
            "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            tally[fault] += 1
    # best[state]: least (cost, audit) that ends there; states "", s, u, a
    def insert(best):
        for _ in range(4):
            for state in list(best):
                to = "a" if state == "u" else "u"
                cost, audit, lines = best[state]
                new = (cost + 5, audit + "I", [*lines, {"a": "assistant:", "u": "user:"}[to]])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = insert({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        following = {}
        for state, (cost, audit, lines) in best.items():
            more = 5 * (fault == "truncated")
            to = "a" if state == "u" else "u"
            name = {"a": "assistant", "u": "user"}[to]
            moves = [(state, 2, "D", lines)]
            if fault not in ("blank", "duplicate"):
                moves.append((to, 1 + more, "R", [*lines, f"{name}:{text}"]))
                if role[:1] == to or role[:1] == "s" and state == "":
                    moves.append((role[:1], more, "K", [*lines, f"{role}:{text}"]))
            for end, extra, letter, new in moves:
                option = (cost + extra, audit + letter, new)
                if end not in following or option[:2] < following[end][:2]:
                    following[end] = option
        best = insert(following)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
    return (gaps, *tally.values(), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check(spark, rows, frame=None):
    frame = spark.createDataFrame(rows, SCHEMA) if frame is None else frame
    found = repair.summaries(repair.repaired(registered.damaged(frame), present=F.col("present")))
    got = {r.conv: tuple(r)[1:] for r in found.collect()}
    after = damaged(rows)
    want = {conv: plain(after[conv]) for conv in {r[0] for r in rows}}
    assert got == want


def some_rows(seed, n_convs=60, most=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", " \t", "", None, "Why?", "é.", "a.\n", "b. \x0b", "c"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    rows = [
        (conv, rng.choice([None, turn, turn, turn, turn + 3]), rng.choice(roles), rng.choice(texts))
        for conv in [*range(n_convs), None] for turn in range(rng.randrange(1, most))
    ]
    return rows


@pytest.mark.parametrize("piece", [1, 3, 1024])
def test_edge_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = some_rows(piece)
    # One slice: ties keep the order of the input.
    check(spark, rows, spark.createDataFrame(rows, SCHEMA).coalesce(1))


def test_a_long_conversation_is_cut(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 64)
    rng = random.Random(1)
    roles, texts = ["user", "assistant", "system"], ["Yes.", "cut", *[f"Text {i}." for i in range(900)]]
    rows = [(1, t, rng.choice(roles), rng.choice(texts)) for t in range(3000)]
    rows += [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(2, 9) for t in range(4)]
    check(spark, rows)


def test_conversations_of_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/sf0.01/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    after = damaged(rows)
    got = {r.conv_id: tuple(r)[1:] for r in registered.op12_repair(spark, f"{TESTDATA}/sf0.01").collect()}
    assert got == {conv: plain(after[conv]) for conv in {r[0] for r in rows}}


def test_repaired_rows_alternate(spark):
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/conversations.parquet")
    found = repair.repaired(rows.withColumn("at", F.lit("own")).withColumn("conv", F.lit("own")))
    by = defaultdict(list)
    for r in found.collect():
        by[r.conv].append(r)
    assert sum(r.edit != "I" for of in by.values() for r in of) == rows.count()
    for of in by.values():
        of.sort(key=lambda r: r.place)
        initials = "".join(r.role[0] for r in of if r.edit != "D").removeprefix("s")
        assert initials == "ua" * (len(initials) // 2)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.summaries(repair.repaired(empty)).count() == 0
