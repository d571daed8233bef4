"""Exact ranked lexical search: the k documents of highest score for each item of a stated set.

Terms are runs of letters, digits and characters outside ASCII, A-Z lowered. A term's weight falls with the
number of documents that hold it, and what its occurrences add levels off, the sooner the longer the
document is against the mean. All sums are whole numbers.

Documents that agree in all that a score depends on are scored once (bag deduplication). A document is
restricted to the vocabulary of the items: what is left is a bag of term counts, and a number m that stands
for its length. Documents of equal bag and m form a class: a hash brings them together, the bags
themselves tell them apart. One row of a class is scored, with sums that walk the items' posting lists; each
task keeps the best k classes of each item, and classes are expanded into members by ascending id.
No item can use more than the first k members of a class, so more are never gathered, however large it is;
and no class behind the best k, by score and then by least member, can place a document.

Items are put into blocks of about BLOCK postings by a hash of their id; the vocabulary and postings of a block are
all that is sent to the tasks, and each block is one pass over the documents. Whole texts are read; counts
cover all documents.

Null and empty texts have no terms: they count nowhere. Documents without an id count in the statistics, but are not
ranked. Rows of equal id are separate documents. Rows of items with equal id (null is one) are one item
with the terms of all. Items that match nothing have no rows; empty tables give none. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.frames import Batches, ascii_lower, slices, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 500_000
HELD = 200_000
LENGTH_SHARE = 50

# Bytes of UTF-8: A-Z lowered, all ASCII but letters and digits made a blank.
_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.encode().translate(_BYTES).split(b" ") if text else []


def bag(text: str | None, vocabulary: dict[bytes, int]) -> tuple[int, list[tuple[int, int]]]:
    """The number of terms, and the counts of those in the vocabulary by their number."""
    found = [t for t in terms(text) if t]
    counts = Counter(map(vocabulary.get, found))
    counts.pop(None, None)
    return len(found), sorted(counts.items())


def _bags(docs: DataFrame, vocabulary: dict[bytes, int], id: str, text: str) -> DataFrame:
    """id, n, and the numbers and counts of the terms that are in the vocabulary."""

    def apply(batches: Batches) -> Batches:
        for batch in slices(batches):
            sizes, bags = zip(*(bag(t, vocabulary) for t in batch.column(1).to_pylist()))
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array([[t for t, _ in b] for b in bags], pa.list_(pa.int32())),
                 pa.array([[c for _, c in b] for b in bags], pa.list_(pa.int64()))],
                ["id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"id {kind}, n bigint, terms array<int>, counts array<bigint>")


class Postings:
    """Items of a block by term: the items that hold it; and the weights of terms."""

    def __init__(self, of_term: list[list[int]], weights: list[int], n_items: int) -> None:
        self.begin = np.cumsum([0, *map(len, of_term)])
        self.items = np.array([i for listed in of_term for i in listed], np.int32)
        self.weights = np.array(weights, np.int64)
        self.n_items = n_items

    def scores(self, ends: np.ndarray, term: np.ndarray, count: np.ndarray, m: np.ndarray) -> np.ndarray:
        """A row for each bag, a column for each item. Bags follow each other in term and count."""
        row = np.repeat(np.arange(len(m)), np.diff(ends, prepend=0))
        added = self.weights[term] * ((1_000_000_000 * count) // (1000 * count + 20 * m[row]))
        # Every term of a bag meets the posting list of the term.
        begin, size = self.begin[term], self.begin[term + 1] - self.begin[term]
        at = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        out = np.zeros((len(m), self.n_items), np.int64)
        np.add.at(out.reshape(-1), np.repeat(row, size) * self.n_items + self.items[at], np.repeat(added, size))
        return out


class Best:
    """The k best classes of each item among those seen so far: score, then least member."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.level = np.ones(n_items, np.int64)  # no score below it can be among the best
        self.rows = np.zeros((4, 0), np.int64)  # item, score, least member, hash
        self.waiting: list[np.ndarray] = []

    def add(self, scores: np.ndarray, members: np.ndarray, hashes: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.level)
        self.waiting.append(np.stack([item, scores[row, item], members[row], hashes[row]]))
        if sum(w.shape[1] for w in self.waiting) > HELD:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.rows, *self.waiting], axis=1)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        self.rows, self.waiting = rows[:, place < self.k], []
        last = rows[:, place == self.k - 1]
        self.level[last[0]] = last[1]
        return self.rows


def _classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The first k members of each class; the first one, `least`, with the bag."""
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {max(1, n_terms)}L")
    rows = bags.where(F.col("id").isNotNull() & (F.size("terms") > 0)).select(
        "id", "terms", "counts", m.alias("m")
    ).withColumn("hash", F.xxhash64("terms", "counts", "m"))
    order = Window.partitionBy("hash", "m", "terms", "counts").orderBy("id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(
        "*", F.row_number().over(order).alias("place"), F.first("id").over(upto).alias("least")
    ).where(F.col("place") <= k)
    bare = {c: F.when(F.col("place") == 1, F.col(c)) for c in ("terms", "counts", "m")}
    return written(placed.withColumns(bare), "classes")


def _search(docs: DataFrame, items: DataFrame, k: int, id: str, text: str) -> DataFrame:
    """item, id, score of the best k documents of each item of one block; `items` has item and term."""
    listed = items.select("item", "term").collect()
    names = list(dict.fromkeys(r["item"] for r in listed))
    number = {name: i for i, name in enumerate(names)}
    words = sorted({r["term"] for r in listed})
    vocabulary = {word.encode(): i for i, word in enumerate(words)}
    of_term: list[list[int]] = [[] for _ in words]
    for r in listed:
        of_term[vocabulary[r["term"].encode()]].append(number[r["item"]])

    bags = written(_bags(docs, vocabulary, id, text), "bags")
    n_docs, n_terms = bags.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = bags.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    held = {r["term"]: r["count"] for r in holding}
    weights = [
        math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(words))
    ]
    postings = Postings(of_term, weights, len(names))
    classes = _classes(bags, n_docs, n_terms, k)

    def score(batches: Batches) -> Batches:
        best = Best(postings.n_items, k)
        for batch in slices(batches):
            found, counts = batch.column("terms"), batch.column("counts")
            best.add(
                postings.scores(
                    np.cumsum(found.value_lengths().to_numpy()), found.flatten().to_numpy(),
                    counts.flatten().to_numpy(), batch.column("m").to_numpy(),
                ),
                batch.column("least").to_numpy(), batch.column("hash").to_numpy(),
            )
        rows = best.settle()
        yield pa.record_batch([pa.array(c) for c in rows], ["number", "score", "least", "hash"])

    first = classes.where("place = 1").select("terms", "counts", "m", "least", "hash")
    scored = first.mapInArrow(score, "number bigint, score bigint, least bigint, hash bigint")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "least")
    best = scored.withColumn("class_place", F.row_number().over(order)).where(F.col("class_place") <= k)
    members = best.join(classes.select("id", "least", "hash"), ["least", "hash"])
    order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
    ranked = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    spark = docs.sparkSession
    named = spark.createDataFrame(
        [(i, name) for i, name in enumerate(names)], f"number bigint, item {items.schema['item'].dataType.simpleString()}"
    )
    return ranked.join(F.broadcast(named), "number").select("item", "rank", "id", "score")


def ranked_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), id, score: the k highest-scoring documents of each item, above 0.

    Equal scores come by ascending id, which has to be a 64-bit number.
    """
    found = F.explode(F.regexp_extract_all(ascii_lower(F.col(item_text)), F.lit(TERM), F.lit(0)))
    postings = written(items.select(F.col(item_id).alias("item"), found.alias("term")).distinct(), "items")
    blocks = max(1, -(-postings.count() // BLOCK))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = [_search(docs, postings.where(block == b), k, id, text) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts).select(
        F.col("item").alias(item_id), "rank", F.col("id").alias(id), "score"
    )
