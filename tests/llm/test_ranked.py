"""Ranked search against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from conftest import TESTDATA
from llm.edges import clashing, documents, texts

from clickloom.llm import ranked

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    words = defaultdict(set)
    for item, text in items:
        words[item] |= set(terms(text))
    out = set()
    for item, wanted in words.items():
        scored = []
        for i, b in bags:
            m = 50 + 50 * sum(b.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in wanted if t in b
            )
            if score > 0 and i is not None:
                scored.append((-score, i))
        out |= {(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


ITEMS = [
    (1, "Short same text"), (2, None), (3, "word WORD a b 日本語"), (4, "nothing-of-this"), (None, "ab text"),
    (5, ""), (6, texts()[9][1]), (1, "é changed"),
]


@pytest.mark.parametrize("block,held,k", [(500_000, 200_000, 50), (20, 3, 2)])
def test_edge_rows(spark, monkeypatch, block, held, k):
    monkeypatch.setattr(ranked, "BLOCK", block)
    monkeypatch.setattr(ranked, "HELD", held)
    # Many copies, so that classes are larger than k.
    rows = [*texts(), *[(100 + i, "Same text é word") for i in range(20)], *[(200 - i, "a b c") for i in range(9)]]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = ranked.ranked_documents(clashing(documents(spark, rows)), items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == plain(rows, ITEMS, k)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents(spark)
    assert ranked.ranked_documents(docs.limit(0), items).count() == 0
    assert ranked.ranked_documents(docs, items.limit(0)).count() == 0


def test_large_classes_are_cut_before_the_shuffle(spark):
    bags = spark.createDataFrame(
        [(1, 2, [0, 1], [1, 1])], "id bigint, n bigint, terms array<int>, counts array<bigint>"
    )
    seen = []
    original, ranked.written = ranked.written, lambda df, name: seen.append(df) or df
    try:
        ranked._classes(bags, 1, 2, 50)
    finally:
        ranked.written = original
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_classes_hold_copies_only_once(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{TESTDATA}/sf0.001/benchmark.parquet").select("item_id", "text")
    got = {tuple(r) for r in ranked.ranked_documents(docs, items).collect()}
    assert got == plain([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], 50)
