"""Plain result tables: append and replace."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(df: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Add rows to files at `target`, or to the database table `target` with fmt="jdbc"."""
    writer = df.write.mode("append").format(fmt).options(**options)
    if fmt == "jdbc":
        writer.option("dbtable", target).save()
    else:
        writer.save(target)


def replace(
    df: DataFrame, target: str, fmt: str | None = "parquet", partition_by: tuple[str, ...] = ()
) -> None:
    """Put `df` in the place of files at `target`, or of the catalog table when fmt is None."""
    if fmt is None:
        df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(target)
    else:
        df.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(target)


def register(df: DataFrame, view: str) -> DataFrame:
    """Name an intermediate result for SQL."""
    df.createOrReplaceTempView(view)
    return df
