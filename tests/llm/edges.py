"""Rows that every operator has to take: nulls, empty and very long texts, ties, repeated rows, and
extra columns with the names that operators give to their results."""

from __future__ import annotations

import random

CLASHING = (
    "ids", "decoded", "keep_id", "group_size", "kept", "text_sha256", "score", "epoch", "shard", "slot",
    "secrets", "removed", "fingerprint", "component_id", "start", "end", "key", "possible", "name",
    # Names of columns that operators work with, now or in earlier versions.
    "_key", "_possible", "_number", "_part", "_place", "_at", "_word", "_bits", "_sha", "_same", "_keep", "_by",
    "_bucket", "_total", "_up_to", "_start", "_leaf", "_whole", "_rest", "_last", "_id", "_h", "_spans", "row", "id",
    "h", "spans", "lists", "tie", "by", "number", "part", "place", "at", "sha", "same", "keep", "conv",
)
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def texts(seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghéñ") for _ in range(rng.randrange(2, 8))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = prose(120)
    long = prose(30_000)
    base = prose(200)
    near = base.split()
    near[100] = "changed"
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "Short"), (5, long), (6, "Same TEXT é"), (7, "same text é"),
        (7, "same text é"), (None, "Same text é"), (8, "SAME TEXT É"), (None, None), (9, "word " * 500),
        (10, prose(50) + "\n" + passage + "\n" + prose(40)), (11, prose(30) + " " + passage),
        (12, "".join(c.upper() if c.isascii() else c for c in passage) + " " + prose(60)), (13, base), (14, " ".join(near)), (15, "日本語 😀 \x00 <s>"),
        (16, base), (17, "ab"), (18, "a b"), (19, long + " tail"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [
        (i, t, ("en", "fr", None)[k % 3], ("src0", "src0", "src1", None)[k % 4], len(t or ""))
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, COLUMNS)


def clashing(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("own").alias(c) for c in CLASHING])


def own_values(frame, *results):
    """Whether the extra columns, but for an operator's results, hold what they held before."""
    names = [c for c in CLASHING if c not in results]
    return set(map(tuple, frame.select(*names).distinct().collect())) == {("own",) * len(names)}
