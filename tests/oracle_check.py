"""Runs registered queries against DuckDB: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def difference(spark, con, sf_dir: str, name: str) -> tuple[str | None, int]:
    """What differs between a query and its SQL (None when nothing does), and the row count."""
    import __spark_entry__ as registered

    frame = registered.queries()[name](spark, sf_dir)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(registered.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = _rows(list(types), cursor.fetchall())
    count = sum(got[1].values())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}", count
    pairs = {
        "bigint": {"BIGINT", "NUMBER"}, "int": {"INTEGER", "NUMBER"},
        "double": {"DOUBLE", "NUMBER"}, "string": {"VARCHAR", "STRING"},
        "boolean": {"BOOLEAN", "bool"},
    }
    for column, dtype in frame.dtypes:
        if types[column] not in pairs.get(dtype, {types[column]}):
            return f"type of {column}: {dtype} / {types[column]}", count
    if got[1] != want[1]:
        extra, missing = got[1] - want[1], want[1] - got[1]
        return f"only Spark: {list(extra)[:3]} only SQL: {list(missing)[:3]}", count
    return None, count


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as registered

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(registered.queries())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/sf{sf}"
    db = connect(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            problem, count = difference(session, db, sf_dir, name)
        except Exception as error:  # report it and go on with the next query
            problem, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={count} "
              f"{time.time() - began:.2f}s {problem or ''}", flush=True)
    sys.exit(1 if failed else 0)
