"""Shards that all have the mixture of the whole table, by proportional stratified interleaving.

Within each source the rows are shuffled with a seed and numbered. A row's fractional rank is its
number, less one half, over the rows of its source, so every source is spread evenly over 0 to 1. All
rows are sorted by it and cut into shards of equal counts: every shard gets each source in its
proportion, and the counts of two shards differ by one row at most.

Numbering rows in order needs no task that sees all of a source (see `running`).

Null is a source of its own. Rows that agree in source and id are told apart by `tie` columns; rows that
are equal in all of these are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.frames import packed, quoted, written
from clickloom.llm.running import BUCKET_ROWS, digest_bucket, running

SEED = 42


def interleaved_shards(
    rows: DataFrame, shards: int, by: str = "source", id: str = "doc_id",
    tie: Sequence[str] = (), seed: int = SEED,
) -> DataFrame:
    """Adds shard (from 0) and slot (from 0, without gaps in a shard).

    Existing columns of these names are replaced; all other columns stay. All columns given are
    carried through two shuffles, so leave out what can be joined later by id.
    """
    total = rows.count()
    buckets = max(1, total // BUCKET_ROWS)
    source = F.coalesce(F.concat(F.lit("="), quoted(by).cast("string")), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), quoted(id).cast("string")))
    keyed = rows.select(
        packed(rows, "shard", "slot"), source.alias("by"), key.alias("key"),
        F.struct(*[quoted(c) for c in (id, *tie)]).alias("tie"),
    )
    order = ["key", "tie"]
    shuffled = written(
        running(keyed, order, digest_bucket("key", buckets), F.lit(1), "number", ["by"])
        .withColumn("part", (F.col("number") - F.lit(0.5)) / F.col("_total"))
        .drop("_total", "number"),
        "shards",
    )
    placed = running(
        shuffled, ["part", *order, "by"], F.floor(F.col("part") * buckets), F.lit(1), "place"
    )
    # Shard s holds the places from s * total / shards on, rounded up.
    n, size = F.lit(shards).cast("bigint"), F.lit(max(1, total)).cast("bigint")
    sharded = placed.withColumn("at", F.col("place") - 1).withColumn("shard_no", _div(F.col("at") * n, size))
    first = _div(F.col("shard_no") * size + n - 1, n)
    return sharded.select(
        "row.*", F.col("shard_no").cast("int").alias("shard"), (F.col("at") - first).alias("slot")
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)
