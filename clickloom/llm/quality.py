"""A quality classifier learned from preference pairs (Bradley-Terry).

Each preference pair is a document labelled 1 and one labelled 0. The chance that the first is
preferred is the logistic function of the difference of two scores, and a score is linear in
features of the text; so the weights come from a logistic loss on feature differences. A document
is good when its score is above a threshold, the quantile of all labelled documents' scores that
parts the two labels best, each label with all its rows.

The weights are fitted on the driver on at most `per_label` documents of each label, chosen by a hash
of the id; that sample is bounded whatever the size of the tables. The threshold is found by Spark
from all labelled rows. Every text is scored whole.

Null and empty texts have all features zero and get a score like any other. Labels other than 0 and 1,
null labels and labels without a document are not used. With one label only, or none, all documents
score 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.frames import with_column_of

PER_LABEL = 4000
PAIRS = 20_000
STEPS, RIDGE = 30, 1e-3
BINS = 1024
SEED = 42

# Groups of bytes; each gives the share of the text's bytes in it.
GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t", b"\n",
    b".", b",", b"!", b"?", b"|", b"%", b"*", b"$", b"&", b"#", b"@", b"/", b"\\", b"-_", b"+=",
    b"<>", b"()", b"[]", b"{}", b":;", b"'\"", b"`~^", bytes(range(128, 256)),
    bytes([*range(9), 11, 12, *range(14, 32), 127]),
]
_TABLE = np.full(256, len(GROUPS), np.int64)
for _i, _group in enumerate(GROUPS):
    _TABLE[list(_group)] = _i
N_FEATURES = len(GROUPS) + 8


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of bytes, and figures of words and lines, of a whole text."""
    out = np.zeros(N_FEATURES)
    if not text:
        return out
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_TABLE, weights=counts, minlength=len(GROUPS) + 1)[: len(GROUPS)]
    out[: len(GROUPS)] = np.sqrt(kinds / len(data))
    words = data.split()
    n = max(1, len(words))
    lines = [line for line in data.split(b"\n") if line]
    out[len(GROUPS) :] = (
        len(set(words)) / n,
        len(data) / n / 20,
        np.log1p(n) / 10,
        len(set(lines)) / max(1, len(lines)),
        len(words) / max(1, len(lines)) / 50,
        sum(map(bytes.isupper, words)) / n,
        sum(map(bytes.isalpha, words)) / n,
        np.sqrt(sum(map(eq, words, words[1:])) / n),
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """Weights of features that are centred and scaled, and the threshold on the score."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; 0.5 at the threshold."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.threshold, -500, 500)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        """The linear score; equal rows get equal ones, whatever rows they come with."""
        return ((x - self.centre) / self.scale * self.weights).sum(axis=1)


def learn(x: np.ndarray, label: np.ndarray, seed: int = SEED) -> Ranking:
    """Bradley-Terry weights from pairs of a good and a bad row, drawn with a seed."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        n = x.shape[1]
        return Ranking(np.zeros(n), np.ones(n), np.zeros(n), 0.0)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - centre) / scale
    rng = np.random.default_rng(seed)
    n = max(len(good), len(bad), PAIRS)
    first = np.resize(rng.permutation(good), n)
    second = rng.choice(bad, n)
    gaps = z[first] - z[second]
    weights = np.zeros(x.shape[1])
    for _ in range(STEPS):  # Newton's steps on the logistic loss with a ridge
        wrong = 1 / (1 + np.exp(np.clip(gaps @ weights, -500, 500)))
        slope = gaps.T @ wrong / n - RIDGE * weights
        curve = (gaps * (wrong * (1 - wrong))[:, None]).T @ gaps / n
        move = np.linalg.solve(curve + RIDGE * np.eye(len(weights)), slope)
        weights += move
        if np.abs(move).max() < 1e-9:
            break
    ranking = Ranking(centre, scale, weights, 0.0)
    scores = ranking.raw(x)
    return replace(ranking, threshold=_threshold(scores[good], scores[bad]))


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The quantile of the labelled scores that parts the labels with the fewest errors.

    It lies midway between the two scores around it. Of several such quantiles the lowest is taken,
    which keeps more documents.
    """
    scores = np.concatenate([good, bad])
    isgood = np.concatenate([np.ones(len(good)), np.zeros(len(bad))])
    order = np.argsort(scores, kind="stable")
    scores, isgood = scores[order], isgood[order]
    lost = np.concatenate([[0], np.cumsum(isgood)])  # good ones below the cut
    errors = lost + len(bad) - np.arange(len(scores) + 1) + lost
    errors[1:-1][scores[1:] == scores[:-1]] = len(scores) + 1  # no cut between equal scores
    at = int(np.argmin(errors))
    if at == 0:
        return float(scores[0] - 1)
    if at == len(scores):
        return float(scores[-1] + 1)
    return float((scores[at - 1] + scores[at]) / 2)


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id",
    label: str = "quality", per_label: int = PER_LABEL,
) -> Ranking:
    """Learn from the labelled rows of `docs`: weights from at most `per_label` of each label."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).select(
        id, F.col(label).alias("_label")
    )
    # Only ids and labels are ranked; then the texts of the bounded sample are fetched.
    known = marked.join(docs.select(id), id, "left_semi")
    picked = [
        known.where(F.col("_label") == value).orderBy(F.xxhash64(id), id).limit(per_label)
        for value in (0, 1)
    ]
    sample = docs.select(id, text).join(F.broadcast(picked[0].unionByName(picked[1])), id)
    rows = with_features(sample, text).select(id, "_label", "_features").toPandas()
    if not len(rows):
        return learn(np.zeros((0, N_FEATURES)), np.zeros(0))
    rows = rows.sort_values([id, "_label"])
    x, values = np.stack(rows["_features"].to_numpy()), rows["_label"].to_numpy()
    ranking = learn(x, values)
    if len(set(values)) < 2:
        return ranking
    edges = np.unique(np.quantile(ranking.raw(x), np.linspace(0, 1, BINS + 1)[1:-1]))
    # Only ids and scores meet the labels, no text.
    scored = _with_raw(docs.select(id, text), ranking, text).select(id, "_raw").join(marked, id)
    return replace(ranking, threshold=threshold_of_all(scored, edges))


def _with_raw(docs: DataFrame, ranking: Ranking, text: str) -> DataFrame:
    def values(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(ranking.raw(np.stack([features(t) for t in texts.to_pylist()])))

    return with_column_of(docs, text, "_raw", T.DoubleType(), values)


def threshold_of_all(scored: DataFrame, edges: np.ndarray) -> float:
    """As `_threshold`, of a table with columns _raw and _label.

    Scores are dealt into bins between `edges`. A cut below a score makes as many errors as there
    are bad rows, and those more that lie below it and are good than are bad; so each bin finds the best of
    its own cuts, and only one row for each bin comes to the driver.
    """
    kinds = scored.groupBy(F.col("_raw").alias("score")).agg(
        F.sum(F.when(F.col("_label") == 1, 1).otherwise(-1)).alias("more")
    )
    bins = with_column_of(
        kinds, "score", "bin", T.IntegerType(),
        lambda scores: pa.array(np.searchsorted(edges, scores.to_numpy(False), "right").astype(np.int32)),
    )
    order = Window.partitionBy("bin").orderBy("score")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    cuts = bins.select(
        "bin", "score", "more", F.coalesce(F.sum("more").over(before), F.lit(0)).alias("below"),
        F.lag("score").over(order).alias("previous"),
    )
    best = cuts.groupBy("bin").agg(
        F.min(F.struct("below", "score", "previous")).alias("cut"), F.sum("more").alias("more"),
        F.max("score").alias("last"),
    ).select("bin", "cut.*", "more", "last")
    below, last, least, threshold = 0, np.nan, np.inf, 0.0
    for row in best.toPandas().sort_values("bin").itertuples():
        if below + row.below < least:
            least = below + row.below
            previous = last if np.isnan(row.previous) else row.previous
            threshold = row.score - 1 if np.isnan(previous) else (previous + row.score) / 2
        below, last = below + row.more, row.last
    return float(last + 1 if below < least else threshold)


def with_features(df: DataFrame, text: str) -> DataFrame:
    def values(texts: pa.Array) -> pa.Array:
        flat = np.concatenate([features(t) for t in texts.to_pylist()] or [np.zeros(0)])
        ends = np.arange(len(texts) + 1, dtype=np.int32) * N_FEATURES
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return with_column_of(df, text, "_features", T.ArrayType(T.DoubleType()), values)


def with_score(
    docs: DataFrame, ranking: Ranking, text: str = "text", target: str = "score"
) -> DataFrame:
    """Adds the score of `text`; an existing column `target` is replaced."""

    def values(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(ranking.score(np.stack([features(t) for t in texts.to_pylist()])))

    return with_column_of(docs, text, target, T.DoubleType(), values)
