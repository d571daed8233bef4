"""Result tables with keys that micro-batches update, kept in two plain partitioned Parquet tables.

`new` holds what each of the last batches changed, partitioned by a slot of the batch id; `folded` holds
the sum of all earlier batches, partitioned by day. Both are written by dynamic partition overwrite: a
batch that runs again replaces its own slot, and folding replaces just the days that batches touched.
Every row carries the id of the last batch it stands for, so that reading takes from `new` only
what its day has not folded yet. Reading merges both by grouping on the key.

A table belongs to one streaming query: batch ids are those of its checkpoint. `fold` has to run at least
once in SLOTS / 2 batches. Spark replaces partitions one by one when a job commits; where a driver may be lost
in that moment, the folder should lie on storage with versions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.folders import ensured

# What a later batch does to rows that are there already.
ADD = "add"                      # value = value + new value
OVERWRITE = "overwrite"          # value = new value
REPLACE_GROUP = "replace_group"  # all rows of the group go, the new ones come
INSERT = "insert"                # a key that is there stays as it is
SLOTS = 128
# Rows take few bytes in Parquet, but many in a task that groups them: files of few rows let Spark deal them out.
FILE_ROWS = 1 << 18


@dataclass(frozen=True)
class KeyedTable:
    """Rows of `columns` (a DDL text). `keys` name the key, for REPLACE_GROUP the group, and include
    `partition`, the column of the days if there is one: reads of a few days open only these."""

    path: str
    columns: str
    keys: tuple[str, ...]
    rule: str
    value: str | None = None
    partition: str | None = None

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        rows = changes.select(
            *self._names(), F.lit(batch_id).cast("bigint").alias("batch_id"), self._day().alias("day"),
            F.lit(batch_id % SLOTS).alias("slot"),
        )
        self._overwrite(rows, "new", "slot")

    def read(
        self, spark: SparkSession, before: int | None = None, days: Column | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame:
        """Current rows; with `before`, those from batches with smaller ids that aren't folded yet.

        `days` is a condition on the partition column, `only` limits the rows to those whose key
        columns are in that frame. Both take effect before rows are merged.
        """
        return self._merge(self._rows(spark, before, days, only)).select(*self._names())

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The changes one batch wrote."""
        mine = (F.col("slot") == batch_id % SLOTS) & (F.col("batch_id") == batch_id)
        return self._table(spark, "new", ", slot int").where(mine).select(*self._names())

    def fold(self, spark: SparkSession, before: int) -> None:
        """Merge what batches before `before` have changed into the days they touched."""
        touched = self._fresh(spark, before, None).select("day").distinct()
        rows = self._rows(spark, before).join(touched, "day", "left_semi")
        upto = F.lit(before - 1).cast("bigint")
        self._overwrite(
            self._merge(rows).withColumns({"batch_id": upto, "day": self._day()}), "folded", "day"
        )

    def _day(self) -> Column:
        return F.col(self.partition) if self.partition else F.lit("all")

    def _rows(
        self, spark: SparkSession, before: int | None = None, days: Column | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame:
        parts = [self._folded(spark, days), self._fresh(spark, before, days)]
        if only is not None:
            parts = [rows.join(only, only.columns, "left_semi") for rows in parts]
        return parts[0].unionByName(parts[1])

    def _folded(self, spark: SparkSession, days: Column | None) -> DataFrame:
        rows = self._table(spark, "folded")
        if self.partition:  # in place of the stored column, so that conditions open few folders
            rows = rows.withColumn(self.partition, F.col("day"))
        return rows if days is None else rows.where(days)

    def _fresh(self, spark: SparkSession, before: int | None, days: Column | None) -> DataFrame:
        rows = self._table(spark, "new", ", slot int")
        if before is not None:  # batch `before` may be about to replace its slot
            rows = rows.where((F.col("slot") != before % SLOTS) & (F.col("batch_id") < before))
        rows = rows if days is None else rows.where(days)
        upto = self._folded(spark, days).groupBy("day").agg(F.max("batch_id").alias("upto"))
        fresh = rows.join(upto, "day", "left").where("upto IS NULL OR batch_id > upto")
        return fresh.select(*self._names(), "batch_id", "day")

    def _merge(self, rows: DataFrame) -> DataFrame:
        if self.rule == ADD:
            return rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value))
        if self.rule == OVERWRITE:
            return rows.groupBy(*self.keys).agg(F.max_by(self.value, "batch_id").alias(self.value))
        if self.rule == REPLACE_GROUP:
            last = rows.groupBy(*self.keys).agg(F.max("batch_id").alias("batch_id"))
            return rows.join(last, [*self.keys, "batch_id"], "left_semi")
        return rows.select(*self.keys).distinct()

    def _names(self) -> list[str]:
        return [part.split()[0] for part in self.columns.split(",")]

    def _table(self, spark: SparkSession, name: str, more: str = "") -> DataFrame:
        path = ensured(spark, f"{self.path}/{name}")
        return spark.read.schema(f"{self.columns}, batch_id bigint, day string{more}").parquet(path)

    def _overwrite(self, rows: DataFrame, name: str, by: str) -> None:
        # Rebalancing makes files of an even size, also when one day holds most rows.
        writer = rows.hint("rebalance", by).write.mode("overwrite").partitionBy(by)
        writer = writer.option("maxRecordsPerFile", FILE_ROWS)
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{name}")
