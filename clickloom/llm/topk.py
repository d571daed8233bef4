"""Exact top-k search by inner product, a term at a time.

A vector is a sparse row of terms: its components that aren't zero. Candidates are cut into blocks; a
block holds, for each term, a posting list of the candidates that have it, with their weights. Each
query scatters its terms' weights times those postings into a dense array of scores, one entry for
each candidate of the block. From that array the best are selected by partition, and the
bests of all blocks are merged by one ranking for each query.

Queries are a stated set. They are cut into blocks as well, and every block of queries meets every
block of candidates in a task of its own, so no task holds more than one block of either. Scores are
exact 64-bit integers; where a sum could leave that range, the sums are taken in
unbounded integers and a score outside it ends at the nearest 64-bit value.

Vectors that are null, or that hold a null or non-finite component, take no part. Components that a
shorter vector lacks count as zero. A query without any candidate has no rows. An empty vector has no
terms: it scores 0 with everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.frames import Batches

SCALE = 1024
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
LIMIT = 1 << 62
RESULT = "query_id bigint, vec_id bigint, score bigint"


def quantised(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as bigint."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str) -> Column:
    """Whether a vector and all its components are numbers."""
    fine = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def scores(queries: list[np.ndarray], candidates: list[np.ndarray]) -> list[np.ndarray]:
    """A dense array of scores of all candidates for each query."""
    most = [max((int(np.abs(v.astype(object)).max()) if len(v) else 0 for v in side), default=0)
            for side in (queries, candidates)]
    width = max((len(v) for v in [*queries, *candidates]), default=0)
    kind = np.int64 if most[0] * most[1] * max(1, width) < LIMIT else object
    postings = []
    for term in range(width):
        found = [(i, v[term]) for i, v in enumerate(candidates) if len(v) > term and v[term]]
        postings.append((
            np.array([i for i, _ in found], np.int64), np.array([int(w) for _, w in found], kind)
        ))
    out = []
    for query in queries:
        total = np.zeros(len(candidates), kind)
        for term in np.flatnonzero(query):
            at, weight = postings[term]
            total[at] += int(query[term]) * weight
        if kind is object:
            total = np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in total], np.int64)
        out.append(total)
    return out


def best(total: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k highest scores, ties to smaller ids; all rows if there are fewer."""
    rows = np.arange(len(total))
    if len(rows) > k:
        # Everything above the k-th score, and all that are level with it: ties are cut by id.
        level = np.partition(total, len(total) - k)[len(total) - k]
        rows = np.flatnonzero(total >= level)
    return rows[np.lexsort((ids[rows], -total[rows]))][:k]


def _block(batches: Batches, k: int) -> Batches:
    """Rows of blocks, one block of queries and one of candidates after the other."""
    held: dict[tuple[int, int], list] = {}

    def settle(rows: list) -> pa.RecordBatch:
        queries = [r for r in rows if r[0]]
        candidates = [r for r in rows if not r[0]]
        ids = np.array([c[1] for c in candidates], np.int64)
        out: list[tuple] = []
        vectors = [np.array(c[2], np.int64) for c in candidates]
        for (_, query, _), total in zip(queries, scores([np.array(q[2], np.int64) for q in queries], vectors)):
            other = np.flatnonzero(ids != query)
            picked = other[best(total[other], ids[other], k)]
            out.extend((query, int(ids[i]), int(total[i])) for i in picked)
        columns = list(zip(*out)) or [(), (), ()]
        return pa.record_batch(
            [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
        )

    for batch in batches:
        parts = [batch.column(c).to_pylist() for c in ("q", "c", "is_query", "id", "vector")]
        for q, c, *row in zip(*parts):
            if (q, c) not in held:
                if held:
                    yield settle(held.popitem()[1])
                held[q, c] = []
            held[q, c].append(row)
    if held:
        yield settle(held.popitem()[1])


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id",
    vector: str = "embedding", scale: int = SCALE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each query row."""
    terms = vectors.where(usable(vector) & F.col(id).isNotNull()).select(
        F.col(id).alias("id"), quantised(vector, scale).alias("vector"), is_query.alias("is_query")
    )
    n = vectors.count()
    blocks = max(1, -(-n // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-vectors.where(is_query).count() // QUERY_BLOCK))
    c = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    q = F.pmod(F.xxhash64("id", F.lit("query")), F.lit(query_blocks)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    queries = terms.where("is_query").select(
        q.alias("q"), every(blocks).alias("c"), F.lit(True).alias("is_query"), "id", "vector"
    )
    candidates = terms.select(
        every(query_blocks).alias("q"), c.alias("c"), F.lit(False).alias("is_query"), "id", "vector"
    )
    met = queries.unionByName(candidates).repartition(blocks * query_blocks, "q", "c")
    found = met.sortWithinPartitions("q", "c").mapInArrow(lambda b: _block(b, k), RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
