"""Filtering rows by a list of keys when some keys hold very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_with(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in `listed`."""
    return _filter(rows, listed, key, "left_semi")


def rows_without(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in `listed`. Rows without a key stay."""
    return _filter(rows, listed, key, "left_anti")


def _filter(rows: DataFrame, listed: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join that adaptive execution can split.

    A list small enough is broadcast, by its size. If it is not, adaptive execution cuts the
    partition of a hot key into pieces, but only where both inputs come straight from a shuffle.
    A list that was grouped by the key is partitioned already and would not be shuffled, so the
    join has a second key, the hash of the first: the list, which has one row per key, is
    shuffled once more, and the rows of a hot key spread over many tasks.
    """
    mark = F.xxhash64(key).alias("_hash")
    return (
        rows.select("*", mark)
        .join(listed.select(key, mark), [key, "_hash"], how)
        .select(*rows.columns)
    )
