"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.folders import scratch_dir

Batches = Iterator[pa.RecordBatch]
SLICE_ROWS, BATCH_ROWS = 256, 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends, executors may be lost."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}/{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Spark sends rows to Python in batches of at most `BATCH_ROWS`, in this session from now on.

    A batch is held outside the heap several times over, by the executor and by the worker; with Spark's 10,000
    rows, whole texts take tens of megabytes each time.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def slices(batches: Batches) -> Batches:
    """The same rows in small batches, so that Python objects of a few texts exist at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with one more column; a column of that name is replaced in its place."""
    at = batch.schema.get_field_index(name)
    if at >= 0:
        return batch.set_column(at, name, values)
    return batch.append_column(name, values)


def with_columns_of(
    df: DataFrame, source: str, targets: dict[str, T.DataType],
    values: Callable[[pa.Array], list[pa.Array]],
) -> DataFrame:
    """Columns computed from `source`, a few rows at a time; old ones of these names are replaced."""
    small_batches(df.sparkSession)

    def apply(batches: Batches) -> Batches:
        for batch in slices(batches):
            found = values(batch.column(batch.schema.get_field_index(source)))
            for target, column in zip(targets, found):
                batch = put(batch, target, column)
            yield batch

    fields = [T.StructField(f.name, targets.get(f.name, f.dataType)) for f in df.schema.fields]
    fields += [T.StructField(n, kind) for n, kind in targets.items() if n not in df.columns]
    return df.mapInArrow(apply, T.StructType(fields))


def with_column_of(
    df: DataFrame, source: str, target: str, kind: T.DataType, values: Callable[[pa.Array], pa.Array]
) -> DataFrame:
    """One column computed from `source`, as `with_columns_of` does."""
    return with_columns_of(df, source, {target: kind}, lambda column: [values(column)])


def packed(df: DataFrame, *left_out: str) -> Column:
    """All columns but some as one struct, named `row`: working columns beside it clash with none of them."""
    return F.struct(*[quoted(c) for c in df.columns if c not in left_out]).alias("row")


def quoted(*path: str) -> Column:
    """The column of that name, or the field of a struct, whatever characters are in the name."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in path))


def unused(name: str, taken: Sequence[str]) -> str:
    """`name`, with more underscores in front where a column has it already."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name


def ascii_lower(column) -> Column:
    """A-Z lowered, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256_hex(column) -> Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)
