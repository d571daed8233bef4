from __future__ import annotations

import os
import random
import shutil

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.sinks import keyed, tables
from clickloom.sinks.keyed import KeyedTable

COLUMNS = "date string, id bigint, n bigint"


def frame(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


def store(tmp_path, rule):
    keys = ("date",) if rule == keyed.REPLACE_GROUP else ("date", "id")
    return KeyedTable(f"{tmp_path}/t", COLUMNS, keys, rule, "n", "date")


BATCHES = [
    [("d1", 1, 5), ("d1", 2, 1), ("d2", 1, 7)],
    [("d1", 1, 2), ("d1", 3, 4)],
    [("d3", 1, 1)],
]
EXPECTED = {
    keyed.ADD: [("d1", 1, 7), ("d1", 2, 1), ("d1", 3, 4), ("d2", 1, 7), ("d3", 1, 1)],
    keyed.OVERWRITE: [("d1", 1, 2), ("d1", 2, 1), ("d1", 3, 4), ("d2", 1, 7), ("d3", 1, 1)],
    keyed.REPLACE_GROUP: [("d1", 1, 2), ("d1", 3, 4), ("d2", 1, 7), ("d3", 1, 1)],
}


@pytest.mark.parametrize("rule", EXPECTED)
def test_rules_replays_and_folding(spark, tmp_path, rule):
    t = store(tmp_path, rule)
    assert t.read(spark).count() == 0
    t.write_batch(frame(spark, *BATCHES[0]), 0)
    first = rows_of(t.read(spark))
    t.write_batch(frame(spark, *BATCHES[1]), 1)
    t.write_batch(frame(spark, *BATCHES[1]), 1)
    assert rows_of(t.read(spark, before=1)) == first
    # Batch 1 folds what came before it, runs again, and folds again.
    for _ in range(2):
        t.fold(spark, 1)
        assert rows_of(t.read(spark, before=1)) == first
        t.write_batch(frame(spark, *BATCHES[1]), 1)
    t.write_batch(frame(spark, *BATCHES[2]), 2)
    assert rows_of(t.read(spark)) == EXPECTED[rule]
    assert rows_of(t.read(spark, days=F.col("date").isin("d2", "d3"))) == [
        r for r in EXPECTED[rule] if r[0] in ("d2", "d3")]
    days = spark.createDataFrame([("d1",), ("d9",)], "date string")
    assert rows_of(t.read(spark, only=days)) == [r for r in EXPECTED[rule] if r[0] == "d1"]
    for before in (2, 3, 4):
        t.fold(spark, before)
        assert rows_of(t.read(spark)) == EXPECTED[rule]
    assert rows_of(t.read_batch(spark, 2)) == BATCHES[2]


def files_of(path):
    return {f for _, _, names in os.walk(path) for f in names if f.startswith("part-")}


@pytest.mark.parametrize("rule", EXPECTED)
def test_folding_leaves_untouched_days_as_they_are(spark, tmp_path, rule):
    t = store(tmp_path, rule)
    t.write_batch(frame(spark, *BATCHES[0]), 0)
    t.fold(spark, 1)
    day2 = files_of(f"{tmp_path}/t/folded/day=d2")
    assert day2
    for batch_id, rows in ((1, BATCHES[1]), (2, BATCHES[2])):
        t.write_batch(frame(spark, *rows), batch_id)
        t.fold(spark, batch_id + 1)
        assert files_of(f"{tmp_path}/t/folded/day=d2") == day2
    assert rows_of(t.read(spark)) == EXPECTED[rule]
    t.write_batch(frame(spark, ("d2", 9, 9)), 3)
    before = rows_of(t.read(spark))
    t.fold(spark, 4)
    assert rows_of(t.read(spark)) == before
    assert files_of(f"{tmp_path}/t/folded/day=d2") != day2


@pytest.mark.parametrize("rule", [keyed.ADD, keyed.REPLACE_GROUP])
def test_slots_are_used_again(spark, tmp_path, monkeypatch, rule):
    monkeypatch.setattr(keyed, "SLOTS", 4)
    rng = random.Random(5)
    a, b = store(f"{tmp_path}/a", rule), store(f"{tmp_path}/b", rule)
    batches = [
        sorted({(f"d{rng.randrange(3)}", i): rng.randrange(9) for i in rng.sample(range(6), 3)}.items())
        for _ in range(7)
    ]
    for batch_id, rows in enumerate(batches):
        changes = frame(spark, *[(d, i, n) for (d, i), n in rows])
        a.write_batch(changes, batch_id)
        if batch_id % 2:
            a.fold(spark, batch_id)
    monkeypatch.setattr(keyed, "SLOTS", 128)
    for batch_id, rows in enumerate(batches):
        b.write_batch(frame(spark, *[(d, i, n) for (d, i), n in rows]), batch_id)
    assert rows_of(a.read(spark)) == rows_of(b.read(spark))
    assert len(os.listdir(f"{tmp_path}/a/t/new")) <= 4 + 2


def test_files_hold_few_rows(spark, tmp_path, monkeypatch):
    """However small the rows are, many of them are dealt out to many tasks."""
    monkeypatch.setattr(keyed, "FILE_ROWS", 100)
    t = store(tmp_path, keyed.ADD)
    many = spark.range(1000).select(F.lit("d1").alias("date"), "id", F.lit(1).cast("bigint").alias("n"))
    t.write_batch(many, 0)
    assert len(files_of(f"{tmp_path}/t/new")) >= 10
    t.fold(spark, 1)
    assert len(files_of(f"{tmp_path}/t/folded")) >= 10
    assert t.read(spark).count() == 1000


def test_insert_only(spark, tmp_path):
    t = KeyedTable(f"{tmp_path}/b", "userid bigint", ("userid",), keyed.INSERT)
    for batch_id, ids in enumerate([[1, 2], [2, 3], []]):
        t.write_batch(spark.createDataFrame([(i,) for i in ids], "userid bigint"), batch_id)
    assert rows_of(t.read(spark)) == [(1,), (2,), (3,)]


def test_unfinished_work_is_not_read(spark, tmp_path):
    t = store(tmp_path, keyed.ADD)
    t.write_batch(frame(spark, *BATCHES[0]), 0)
    # What a lost job leaves behind: files below the writer's staging folders.
    for staging in (".spark-staging-1/slot=1", "_temporary/0/task/slot=1"):
        os.makedirs(f"{tmp_path}/t/new/{staging}")
        for name in files_of(f"{tmp_path}/t/new/slot=0"):
            shutil.copy(f"{tmp_path}/t/new/slot=0/{name}", f"{tmp_path}/t/new/{staging}/{name}")
    assert rows_of(t.read(spark)) == sorted(BATCHES[0])


def test_day_range_opens_only_its_folders(spark, tmp_path):
    t = store(tmp_path, keyed.ADD)
    t.write_batch(frame(spark, *BATCHES[0]), 0)
    t.fold(spark, 1)
    plan = t.read(spark, days=F.col("date") == "d2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(day" in plan.split("PartitionFilters: [", 1)[1]


def test_append_and_replace(spark, tmp_path):
    a, b = frame(spark, ("d1", 1, 1)), frame(spark, ("d1", 2, 2))
    for f in (a, b):
        tables.append(f, f"{tmp_path}/append")
        tables.replace(f, f"{tmp_path}/replace", partition_by=("date",))
    assert rows_of(spark.read.parquet(f"{tmp_path}/append")) == [("d1", 1, 1), ("d1", 2, 2)]
    assert rows_of(spark.read.parquet(f"{tmp_path}/replace"), "date", "id", "n") == [("d1", 2, 2)]
    tables.register(a, "registered_rows")
    assert spark.sql("SELECT n FROM registered_rows").first()[0] == 1
