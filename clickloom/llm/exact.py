"""Exact duplicates of texts, found with two passes over a Bloom filter.

The first pass throws each row's hash onto three bits of one word of a filter and keeps the bits
that were hit at least twice. The second pass looks up every row in the filter, which is broadcast:
a row with a bit that was hit once has no equal and passes straight through; only the other rows,
those that are possibly repeated, are shuffled and compared by their whole digest.

The filter has about 16 bits a row and grows with the table. Up to `MAX_WORDS` words it is broadcast, so
what is sent to every task has a fixed bound; a larger one is cut by ranges of hashes, and rows meet their
word of it in a shuffled join, which adaptive execution splits where copies make a word hot. Either way the same
rows are possibly repeated.

Texts are equal when they are identical after lower-casing A-Z only; null counts as empty. Of equal
texts the row with the largest id stays. Rows that share that id are the same document: they are
marked alike by `exact_groups`, and `exact_dedup` leaves one of them. A null id is the smallest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.frames import ascii_lower, packed, quoted, sha256_hex, written

ROWS_PER_WORD = 4
SALTS = 16
MAX_WORDS = 1 << 22


@dataclass(frozen=True)
class RepeatFilter:
    """Words of the filter with the bits that at least two rows hit: (word, bits)."""

    words: int
    bits: DataFrame


def possible_repeats(keyed: DataFrame, key: str = "key") -> RepeatFilter:
    """The first pass: the filter of all rows of `keyed`."""
    words = 1 << max(4, (keyed.count() // ROWS_PER_WORD).bit_length())
    hits = (
        keyed.select(_word(key, words).alias("word"), F.explode(_bits(key)).alias("bit"))
        .groupBy("word", "bit")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where("hits > 1")
    )
    bits = hits.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    return RepeatFilter(words, bits)


def _word(key: str, words: int) -> F.Column:
    return F.pmod(F.col(key), F.lit(words))


def _bits(key: str) -> F.Column:
    hashed = F.col(key)
    return F.array_distinct(
        F.array(*[F.shiftrightunsigned(hashed, n).bitwiseAND(63).cast("int") for n in (30, 40, 50)])
    )


def with_possible(
    rows: DataFrame, found: RepeatFilter, key: str = "key", target: str = "possible"
) -> DataFrame:
    """The second pass adds `target`: whether another row may have the same key.

    A filter of up to MAX_WORDS words is broadcast, and no row is shuffled.
    """
    mask = F.aggregate(
        _bits(key), F.lit(0).cast("bigint"),
        lambda got, bit: got.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
        ),
    )
    filter = found.bits.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    if found.words <= MAX_WORDS:
        filter = F.broadcast(filter)
    looked = rows.withColumn("_word", _word(key, found.words)).join(filter, "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    return looked.withColumn(target, hit).drop("_word", "_bits")


def exact_groups(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    `keep_id` is the id of the row that stays. An empty table gives an empty result.
    """
    keyed = _keyed(docs, text, id)
    rows = with_possible(keyed, possible_repeats(keyed)).drop("key")
    alone = rows.where(~F.col("possible")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "text_sha256"
    )
    repeated = rows.where("possible")
    groups = repeated.groupBy("text_sha256").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # One group may hold a third of the rows: its rows are dealt out by a salt.
    salted = repeated.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    grouped = salted.join(copies, ["text_sha256", "_salt"]).select(alone.columns)
    return alone.unionByName(grouped).select(
        F.col("id").alias(id), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def exact_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Texts are shuffled only for rows that are possibly repeated.
    """
    keyed = _keyed(docs, text, id)
    found = possible_repeats(keyed)
    kept = (
        with_possible(keyed, found).where("possible")
        .groupBy(F.col("text_sha256").alias("same")).agg(F.max("id").alias("keep"))
    )
    digest = _digest(quoted("row", text))
    rows = docs.select(packed(docs)).withColumn("key", _key(digest))
    rows = with_possible(rows, found).select("row", "possible")
    alone = rows.where(~F.col("possible")).select("row")
    repeated = rows.where("possible").select("row", digest.alias("sha"))
    same = (F.col("sha") == F.col("same")) & quoted("row", id).eqNullSafe(F.col("keep"))
    stay = repeated.join(kept, same, "left_semi").dropDuplicates(["sha"])
    return alone.unionByName(stay.select("row")).select("row.*")


def _digest(text: F.Column) -> F.Column:
    return sha256_hex(ascii_lower(F.coalesce(text, F.lit(""))))


def _key(digest: F.Column) -> F.Column:
    return F.xxhash64(digest)


def _keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    """Id, digest and hash of every row: whole texts are read once, then this small table."""
    digests = docs.select(quoted(id).alias("id"), _digest(quoted(text)).alias("text_sha256"))
    return written(digests.withColumn("key", _key(F.col("text_sha256"))), "exact-keys")
