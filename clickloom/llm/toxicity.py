"""A toxicity classifier of subword bags.

A word is the bag of its character n-grams (3 to 5 long, the blanks around the word included) and of itself, each
hashed to one of 2^BITS rows of an embedding table. The embeddings of a window of WINDOW words are averaged
and go through a linear softmax of two classes; table and softmax are trained jointly, by gradient steps in
numpy. Words never seen before share n-gram vectors with the words they were made from. A text's raw score is that of
its most toxic window, so that a few words in a long text count as much as in a short one; every window of the
whole text is scored.

Learning takes a bounded sample: at most `per_label` documents of each label, chosen by a hash of the id, and of
each at most `per_document` windows, drawn with a seed from the whole text. Of every five labelled documents about
one, by another hash, is never learned from; all of these, at any size of the table, give the threshold on the
raw score that makes the fewest errors. The score is the logistic function of the distance to it: 0.5 there.

A window takes its document's label, though most windows of a toxic document are clean; what clean windows have in
common is thus seen with both labels and stays near the base rate.

Null texts and texts without a word have the raw score of an empty bag, which is the softmax's bias. Repeated rows are scored
alike. Labels other than 0 and 1, null labels, null ids and labels without a document aren't used. With one label
only, or none, all documents score 0.5 or less and none is toxic. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.frames import with_column_of, written
from clickloom.llm.quality import BINS, threshold_of_all

BITS, SIZE = 16, 8
WINDOW = 8
GRAMS = (3, 4, 5)
PER_LABEL, PER_DOCUMENT = 2000, 32
# Small samples are gone through more often, until there were LEAST_STEPS steps.
EPOCHS, LEAST_STEPS, BATCH, RATE, DROPPED = 5, 500, 256, 0.3, 0.5
SEED = 42
FOLDS = 5

_PLAIN = [chr(c).isalnum() for c in range(128)]
_BLANK = {c: " " for c in range(128) if not _PLAIN[c]}
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[~np.array(_PLAIN)] = 32
_ODD = np.array(
    [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD35A2D97], np.uint32
)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Hashes to rows of the table."""
    h ^= h >> np.uint32(15)
    h *= _ODD[5]
    return (h >> np.uint32(32 - BITS)).astype(np.int32)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all n-grams and words of a text, and the number of the word each is from."""
    chars = np.frombuffer(f" {text or ''} ".encode("utf-32-le"), np.uint32).copy()
    ascii_ = chars < 128
    chars[ascii_] = _FOLD[chars[ascii_]]
    blank = chars == 32
    kept = np.ones(len(chars), bool)
    kept[1:] = ~(blank[1:] & blank[:-1])
    chars, blank = chars[kept], blank[kept]
    if len(chars) < 3:  # no word
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    blanks = np.cumsum(blank, dtype=np.int32)
    word = blanks - 1  # the blank before a word belongs to it
    rows, words = [], []
    h = chars * _ODD[0]
    for n in range(2, GRAMS[-1] + 1):
        h = ((h[:-1] ^ (h[:-1] >> np.uint32(13))) + chars[n - 1 :]) * _ODD[n - 1]
        if not len(h):
            break
        if n in GRAMS:
            m = len(h)
            # No blank inside: at most its first and last character is one.
            whole = np.flatnonzero(blanks[n - 2 : n - 2 + m] == blanks[:m])
            rows.append(_mixed(h[whole]))
            words.append(word[whole])
    begin = np.flatnonzero(blank)
    place = np.arange(len(chars), dtype=np.uint32) - begin[word].astype(np.uint32)
    sums = np.add.reduceat(
        (chars + _ODD[3]) * (chars ^ _ODD[1]) * (place * _ODD[2] | np.uint32(1)), begin,
        dtype=np.uint32,
    )[:-1]
    rows.append(_mixed(sums))
    words.append(np.arange(len(sums), dtype=np.int32))
    return np.concatenate(rows), np.concatenate(words)


def windows(text: str | None, most: int) -> list[str]:
    """At most `most` windows of a text, drawn with a seed from all of them."""
    words = (text or "").translate(_BLANK).split()
    n = -(-len(words) // WINDOW)
    picked = range(n)
    if n > most:
        seed = np.random.default_rng(zlib.crc32((text or "").encode()))
        picked = sorted(seed.choice(n, most, replace=False).tolist())
    return [" ".join(words[k * WINDOW : (k + 1) * WINDOW]) for k in picked]


@dataclass(frozen=True)
class Model:
    """What each row of the table adds to the toxic class against the other, and the bias."""

    added: np.ndarray
    bias: float

    def raw(self, text: str | None) -> float:
        """The score of the most toxic window of a whole text."""
        rows, words = features(text)
        if not len(rows):
            return self.bias
        window = words // WINDOW
        sums = np.bincount(window, self.added[rows])
        return float((sums / np.bincount(window)).max() + self.bias)


def learn(texts: list[str], labels: np.ndarray, seed: int = SEED) -> Model:
    """Embeddings and softmax from labelled windows."""
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS), 0.0)  # one label, or none
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << BITS, SIZE)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (SIZE, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steepness = np.full((1 << BITS, 1), 1e-6, np.float32)
    bags = [features(t)[0] for t in texts]
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(bags)))):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            sizes = np.array([len(bags[i]) for i in part])
            rows = np.concatenate([bags[i] for i in part])
            # Features are left out at random, so that no word relies on itself alone; each bag keeps one.
            begin = np.cumsum(sizes) - sizes
            keep = rng.random(len(rows), dtype=np.float32) >= DROPPED
            keep[begin] = True
            sizes = np.add.reduceat(keep.astype(np.int64), begin)
            rows = rows[keep]
            begin = np.cumsum(sizes) - sizes
            means = np.add.reduceat(table[rows], begin) / sizes[:, None]
            wrong = means @ softmax + bias
            wrong = np.exp(wrong - wrong.max(axis=1, keepdims=True))
            wrong /= wrong.sum(axis=1, keepdims=True)
            wrong[np.arange(len(part)), labels[part]] -= 1
            slopes = np.repeat((wrong @ softmax.T / sizes[:, None]).astype(np.float32), sizes, axis=0)
            used, place = np.unique(rows, return_inverse=True)
            slope = np.stack(
                [np.bincount(place, slopes[:, k], len(used)) for k in range(SIZE)], axis=1
            ).astype(np.float32)
            steepness[used] += (slope * slope).mean(axis=1, keepdims=True)
            table[used] -= RATE * slope / np.sqrt(steepness[used])
            softmax -= RATE * (means.T @ wrong).astype(np.float32) / len(part)
            bias -= RATE * wrong.sum(axis=0).astype(np.float32) / len(part)
    return Model(
        (table @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0])
    )


def _kept_back(id: str) -> Column:
    """Labelled documents that are never learned from, but give the threshold."""
    return F.pmod(F.xxhash64(id, F.lit("threshold")), F.lit(FOLDS)) == 0


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id",
    label: str = "toxic", per_label: int = PER_LABEL, per_document: int = PER_DOCUMENT,
) -> Model:
    """Learn from at most `per_label` labelled rows of each label, and `per_document` windows of each."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~_kept_back(id)).select(
        F.col(id).alias("id"), F.col(label).cast("int").alias("label")
    ).distinct()
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    known = known.join(texts.select("id"), "id", "left_semi")
    picked = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_label)
        for value in (0, 1)
    ]
    sample = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "id")
    cut = with_column_of(
        sample, "text", "windows", T.ArrayType(T.StringType()),
        lambda column: pa.array([windows(t, per_document) for t in column.to_pylist()], pa.list_(pa.string())),
    )
    rows = cut.select("id", "label", "windows").collect()
    rows.sort(key=lambda r: (r["id"], r["label"], r["windows"]))
    flat = [(w, r["label"]) for r in rows for w in r["windows"]]
    return learn([w for w, _ in flat], np.array([y for _, y in flat], np.int64))


def with_raw(docs: DataFrame, model: Model, text: str = "text", target: str = "raw") -> DataFrame:
    """Adds the raw score of every text; an existing column `target` is replaced."""
    return with_column_of(
        docs, text, target, T.DoubleType(),
        lambda column: pa.array([model.raw(t) for t in column.to_pylist()], pa.float64()),
    )


def threshold(raw: DataFrame, labels: DataFrame, id: str, label: str) -> float | None:
    """The raw score that parts the kept-back documents with the fewest errors; null without both labels."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & _kept_back(id)).select(
        F.col(id).alias("id"), F.col(label).alias("_label")
    ).distinct()
    scored = raw.select("id", F.col("raw").alias("_raw")).join(known, "id")
    marks = scored.groupBy("_label").agg(
        F.percentile_approx("_raw", [k / BINS for k in range(1, BINS)], 10_000).alias("marks")
    ).collect()
    if len(marks) < 2:
        return None
    return threshold_of_all(scored, np.unique(np.concatenate([m["marks"] for m in marks])))


def toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id",
    label: str = "toxic", per_label: int = PER_LABEL, per_document: int = PER_DOCUMENT,
) -> DataFrame:
    """`id` and score (0 to 1; above 0.5 means toxic) of every document, learned from `labels`.

    Every text is scored once; the threshold and the final score come from the raw scores, as written.
    """
    model = fit(docs, labels, text, id, label, per_label, per_document)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    raw = written(with_raw(rows, model).select("id", "raw"), "raw")
    cut = threshold(raw, labels, id, label)
    # Without a threshold the softmax's own even chance is the cut; an untrained model scores below it.
    distance = F.col("raw") - F.lit(0.0 if cut is None else cut)
    if not model.added.any():
        distance = F.lit(-1.0)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(distance, F.lit(500.0)), F.lit(-500.0))))
    return raw.select(F.col("id").alias(id), score.alias("score"))
