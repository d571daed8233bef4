"""Top rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"
# Up to this rank Spark cuts the groups of each task before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
CUT_BY_SPARK = 1000
PARTS = 256
# A result of so many narrow rows fits into every executor's memory.
BROADCAST_ROWS = 100_000


def ranked(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    spread_by: str,
    quota: str | None = None,
) -> DataFrame:
    """The first `n` rows of each group, with their rank in the column RANK.

    `quota` names a column with a group's own, smaller limit. A group that holds most rows does not
    come to one task whole: for small `n` Spark cuts it in every task, for large `n` it is ranked
    in parts first, by the hash of `spread_by`, and only the first rows of each part, no more
    than the group's limit, are ranked together.
    """
    wanted = F.col(RANK) <= n
    if quota is not None:
        wanted &= F.col(RANK) <= F.col(quota)
    if n > CUT_BY_SPARK:
        part = F.pmod(F.xxhash64(spread_by), F.lit(PARTS))
        in_part = Window.partitionBy(*group, "_part").orderBy(*order)
        rows = (
            rows.withColumn("_part", part)
            .withColumn(RANK, F.row_number().over(in_part))
            .where(wanted)
            .drop("_part", RANK)
        )
    in_group = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(RANK, F.row_number().over(in_group)).where(wanted)


def broadcast_up_to(frame: DataFrame, rows: int) -> DataFrame:
    """Mark a frame of at most `rows` rows for broadcast, if that is little enough."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame
