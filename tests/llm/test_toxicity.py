"""The toxicity classifier: held-out accuracy, n-grams, edge rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
from conftest import TESTDATA
from llm.edges import clashing, documents, texts

from clickloom.llm import queries as registered
from clickloom.llm import toxicity


def grams(text):
    """All n-grams of the words of a text with a blank before and behind, and the words, by plain slicing."""
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    words = "".join(c if c.isalnum() or not c.isascii() else " " for c in lowered).split()
    out = []
    for k, word in enumerate(words):
        padded = f" {word} "
        out += [(k, padded[i : i + n]) for n in toxicity.GRAMS for i in range(len(padded) - n + 1)]
        out.append((k, f"whole {word}"))
    return out


def test_features_are_the_n_grams_of_words():
    text = " Ab cdéfg,hi-JKLMN 日本 x!"
    rows, words = toxicity.features(text)
    want = grams(text)
    assert sorted(words.tolist()) == sorted(k for k, _ in want)
    # Equal n-grams get equal rows wherever they stand.
    for a, b in ((" idiot ", "IDIOT"), ("x,,y", "x y"), ("", None)):
        assert sorted(toxicity.features(a)[0]) == sorted(toxicity.features(b)[0])
    shared = set(toxicity.features("idiots")[0].tolist()) & set(toxicity.features("idiot")[0].tolist())
    assert len(shared) >= 7


def test_windows_cover_the_text_and_are_bounded():
    text = " ".join(f"w{i}" for i in range(1000))
    assert " ".join(toxicity.windows(text, 1 << 20)) == text
    some = toxicity.windows(text, 5)
    assert len(some) == 5 and some == toxicity.windows(text, 5) and toxicity.windows(None, 5) == []


def test_misspellings_share_n_grams():
    rng = random.Random(3)
    plain = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(6)) for _ in range(300)]

    def window(word=None):
        words = rng.choices(plain, k=8)
        return " ".join([*words[:4], *([word] if word else []), *words[4:7]])

    rows = [(window(), 0) for _ in range(900)] + [
        (window(rng.choice(["worthless", "disgusting", "pathetic"])), 1) for _ in range(300)]
    model = toxicity.learn([t for t, _ in rows], np.array([y for _, y in rows]))
    clean = np.array([model.raw(window()) for _ in range(200)])
    bad = np.array([model.raw(window(w)) for w in ("worthles", "disgustin", "pathetik", "wworthless") * 50])
    assert (bad[:, None] > clean[None, :]).mean() > 0.95
    # One such word in a long text counts as in a short one.
    long = " ".join(window() for _ in range(100))
    assert model.raw(f"{long} worthles disgustin") > np.quantile(clean, 0.9)


def test_held_out_documents(spark):
    sf = f"{TESTDATA}/sf0.1"
    got = {r.doc_id: r for r in registered.op11_toxicity(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    found = [(r.toxic, got[r.doc_id].predicted) for r in labels if got[r.doc_id].held_out]
    toxic, clean = [p for y, p in found if y], [p for y, p in found if not y]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.04


def test_edge_rows(spark):
    docs = clashing(documents(spark))
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (7, 1), (7, None), (9, 0), (9, 7), (None, 1), (4, 0), (12, 1), (99, 1)],
        "doc_id bigint, toxic int",
    )
    found = toxicity.toxicity(docs, labels)
    rows = found.collect()
    assert found.columns == ["doc_id", "score"] and len(rows) == len(texts())
    scores = {}
    for r in rows:
        scores.setdefault(r.doc_id, set()).add(round(r.score, 12))
    assert scores[1] == scores[2] == scores[3]  # no words: the bias alone
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == len(texts()) and all(r.score < 0.5 for r in none)
    one = toxicity.toxicity(docs, labels.where("toxic = 1")).collect()
    assert all(r.score < 0.5 for r in one)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
