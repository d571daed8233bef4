"""Removal of every byte that lies in a long string which occurs more than once.

Suffixes are bucketed and the buckets refined, to the depth of `LENGTH` bytes and only where a repeat
is possible. Names of strings take the place of ranks: a bucket's identifier is a 64-bit name of
the bytes it stands for, so every executor gives equal strings equal names without a global sort.

1. Initial buckets. Every position gets the name of its `GRAM` bytes. A window of `LENGTH` bytes belongs to
   the bucket of the least name in it, which depends on its bytes alone, so equal windows share a
   bucket. Consecutive windows of one bucket are a run; only runs are shuffled, one row for about 185
   bytes. A bucket with a single run, in which its name occurs once, has no repeats.
2. Whole runs. Runs that agree on all their bytes repeat in all their windows.
3. Refinement. The other runs of a bucket bring their bytes. The windows' buckets are refined by sorting on
   the name at their start together with the names at later offsets, twice as far each time; windows
   that are alone in a bucket leave, and the new names are what the next step refines by.
   A bucket with very many different runs is dealt out by the windows' own names instead.

Two windows are taken as equal when both the bucket's name and the window's name, 128 bits in all,
are. Texts are UTF-8 bytes, null is empty. Matches don't cross documents. Rows that share id and text
are repeats of each other. A text shorter than `LENGTH` loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.frames import Batches, packed, put, slices, unused, written

LENGTH, GRAM = 400, 32
WIDE = LENGTH - GRAM + 1
PIECE = 1 << 16
MAX_RUNS = 1024
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

_rng = np.random.default_rng(20240607)
_BYTES = _rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_K1, _K2, _K3 = _rng.integers(1 << 62, 1 << 63, 3).astype(np.uint64) | np.uint64(1)
_S29, _S32 = np.uint64(29), np.uint64(32)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of strings from the names of their two parts."""
    z = right >> _S29
    z ^= right
    z *= _K2
    z += left * _K1
    z ^= z >> _S32
    z *= _K3
    return z


def gram_names(data: np.ndarray) -> np.ndarray:
    """The name of the `GRAM` bytes from each position."""
    names, size = _BYTES[data], 1
    while size < GRAM:
        names = joined(names[:-size], names[size:])
        size *= 2
    return names


def least_in(names: np.ndarray, wide: int) -> np.ndarray:
    """The least of `wide` names from each position."""
    low, size, n = names, 1, len(names) - wide + 1
    while 2 * size <= wide:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:n], low[wide - size : wide - size + n]) if size < wide else low


def window_names(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The names of the `LENGTH` bytes from the positions `at`, by doubling from gram names."""
    def far(begin: np.ndarray) -> np.ndarray:
        parts = [grams[begin + i] for i in range(0, 256, GRAM)]
        while len(parts) > 1:
            parts = [joined(a, b) for a, b in zip(parts[::2], parts[1::2])]
        return parts[0]

    return joined(far(at), far(at + LENGTH - 256))


def _pieces(texts: list[np.ndarray]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Texts put together, and long ones cut, into lists of about `PIECE` bytes: (row, offset, bytes)."""
    held, size = [], 0
    for row, data in enumerate(texts):
        for at in range(0, len(data) - LENGTH + 1, PIECE):
            part = data[at : at + PIECE + LENGTH - 1]
            held.append((row, at, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _runs_of(parts: list[tuple[int, int, np.ndarray]]):
    """(row, start, size, bucket name, name of all bytes, name occurs again) of each run."""
    data = np.concatenate([p[2] for p in parts])
    grams = gram_names(data)
    low = least_in(grams, WIDE)
    valid = np.ones(len(low), bool)
    begins = np.cumsum([0, *(len(p[2]) for p in parts)])
    for end in begins[1:-1]:
        valid[max(0, end - LENGTH + 1) : end] = False
    at = np.flatnonzero(valid)
    new = np.ones(len(at), bool)
    new[1:] = (low[at[1:]] != low[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(at)))
    if sizes.max(initial=0) > WIDE:  # texts that repeat within a window
        since = np.arange(len(at)) - np.repeat(first, sizes)
        first = np.flatnonzero(since % WIDE == 0)
        sizes = np.diff(np.append(first, len(at)))
    s = at[first]
    e = at[first + sizes - 1]
    whole = joined(joined(window_names(grams, s), window_names(grams, e)), sizes.astype(np.uint64))
    here = np.concatenate([[0], np.cumsum(grams[: len(low)] == low)])
    view = np.lib.stride_tricks.sliding_window_view(grams, WIDE)
    again = here[e] - here[s] + (view[e] == low[e][:, None]).sum(axis=1) > 1
    part = np.searchsorted(begins, s, side="right") - 1
    row = np.array([p[0] for p in parts])[part]
    start = s - begins[part] + np.array([p[1] for p in parts])[part]
    return row, start, sizes, low[s], whole, again


def _run_batches(batches: Batches) -> Batches:
    for batch in slices(batches):
        texts = [np.frombuffer(t or b"", np.uint8) for t in batch.column(2).to_pylist()]
        ids, hashes = batch.column(0).to_numpy(False), batch.column(1).to_numpy(False)
        for parts in _pieces(texts):
            row, start, size, name, whole, again = _runs_of(parts)
            yield pa.record_batch({
                "id": ids[row], "h": hashes[row], "start": start.astype(np.int64),
                "size": size.astype(np.int32), "name": name.view(np.int64),
                "whole": whole.view(np.int64), "again": again,
            })


def _refined(grams: np.ndarray, at: np.ndarray, bucket: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the windows at `at` are repeated in their bucket; `weight` counts their copies."""
    level, size = grams, GRAM
    alive = np.arange(len(at))
    while size < LENGTH:
        step = min(size, LENGTH - size)
        if 2 * size < LENGTH:
            level = joined(level[:-size], level[size:])  # updates that the next step starts from
            names = level[at[alive]]
            size *= 2
            if size < 128:
                continue
        else:
            names = joined(level[at[alive]], level[at[alive] + step])
            size = LENGTH
        names = joined(bucket[alive], names)
        order = np.argsort(names, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = names[order][1:] != names[order][:-1]
        group = np.cumsum(new) - 1
        copies = np.bincount(group, weights=weight[alive][order])
        alive = np.sort(alive[order[copies[group] > 1]])
    found = np.zeros(len(at), bool)
    found[alive] = True
    return found


def _windows(rows: dict[str, np.ndarray], data: list[bytes]):
    """Gram names of all runs' bytes, and each window's position, run and bucket."""
    flat = np.frombuffer(b"".join(data), np.uint8)
    begins = np.cumsum([0, *map(len, data)])[:-1]
    sizes = rows["size"].astype(np.int64)
    run = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return gram_names(flat), begins[run] + within, run, within


def _settle(table: pa.Table) -> pa.RecordBatch:
    """Spans of the runs that stand for one copy only, from whole buckets."""
    rows = {c: table.column(c).to_numpy() for c in ("name", "copies", "id", "h", "start", "size")}
    grams, at, run, within = _windows(rows, table.column("data").to_pylist())
    bucket = rows["name"].view(np.uint64)[run]
    found = _refined(grams, at, bucket, rows["copies"][run])
    hit = np.flatnonzero(found & (rows["copies"][run] == 1))
    new = np.ones(len(hit), bool)
    new[1:] = (run[hit[1:]] != run[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit))[: len(first)] - 1
    of = run[hit[first]]
    return pa.record_batch({
        "id": rows["id"][of], "h": rows["h"][of],
        "start": rows["start"][of] + within[hit[first]],
        "end": rows["start"][of] + within[hit[last]] + LENGTH,
    })


def _bucket_batches(batches: Batches) -> Batches:
    """Rows come sorted by name; whole buckets are settled, the last one waits for its rest."""
    rest: pa.Table | None = None
    for batch in batches:
        for at in range(0, batch.num_rows, MAX_RUNS):
            rows = pa.Table.from_batches([batch.slice(at, MAX_RUNS)])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            names = rows.column("name").to_numpy()
            cut = int(np.searchsorted(names, names[-1]))
            if cut:
                yield _settle(rows.slice(0, cut))
            rest = rows.slice(cut)
    if rest is not None and rest.num_rows:
        yield _settle(rest)


def _window_batches(batches: Batches) -> Batches:
    for batch in slices(batches):
        rows = {c: batch.column(c).to_numpy(False) for c in ("name", "copies", "id", "h", "start", "size")}
        grams, at, run, within = _windows(rows, batch.column("data").to_pylist())
        yield pa.record_batch({
            "name": rows["name"][run], "window": window_names(grams, at).view(np.int64),
            "copies": rows["copies"][run], "id": rows["id"][run], "h": rows["h"][run],
            "start": rows["start"][run] + within,
        })


def repeated_spans(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, h, start, end) of byte spans that are repeated; they may overlap. See `keyed` for id, h."""
    data = keyed(docs, text, id)
    runs = written(
        data.mapInArrow(
            _run_batches, "id bigint, h bigint, start bigint, size int, name bigint, whole bigint, "
            "again boolean",
        ), "runs",
    )
    buckets = written(
        runs.groupBy("name").agg(
            F.count(F.lit(1)).alias("n"), F.max("again").alias("again"),
            F.min("whole").alias("low"), F.max("whole").alias("high"),
        ).where("n > 1 OR again").select("name", F.expr("low <> high OR again").alias("mixed")),
        "buckets",
    )
    live = written(runs.join(buckets, "name").drop("again"), "live-runs")
    kinds = written(
        live.groupBy("name", "whole", "mixed").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "h", "start", "size")).alias("run")
        ), "kinds",
    )
    several = kinds.where("copies > 1").select("name", "whole")
    end = F.col("start") + F.col("size") + (LENGTH - 1)
    whole = live.join(several, ["name", "whole"], "left_semi").select(
        "id", "h", "start", end.alias("end")
    )
    many = kinds.where("mixed").groupBy("name").agg((F.count(F.lit(1)) > MAX_RUNS).alias("many"))
    part = kinds.where("mixed").join(many, "name").select(
        "name", "many", F.least("copies", F.lit(2)).cast("int").alias("copies"), "run.*"
    )
    bytes_of = F.substring(F.col("data"), (F.col("start") + 1).cast("int"), F.col("size") + (LENGTH - 1))
    open_runs = written(
        part.join(data, ["id", "h"]).select(
            "name", "many", "copies", "id", "h", "start", "size", bytes_of.alias("data")
        ).dropDuplicates(["name", "id", "h", "start"]), "open-runs",
    )
    few = open_runs.where("NOT many").drop("many").repartition("name").sortWithinPartitions("name")
    spans = "id bigint, h bigint, start bigint, end bigint"
    found = few.mapInArrow(_bucket_batches, spans)
    windows = open_runs.where("many").drop("many").mapInArrow(
        _window_batches,
        "name bigint, window bigint, copies int, id bigint, h bigint, start bigint",
    )
    again = windows.groupBy("name", "window").agg(F.sum("copies").alias("all")).where("all > 1")
    single = windows.where("copies = 1").join(again, ["name", "window"], "left_semi").select(
        "id", "h", "start", (F.col("start") + LENGTH).alias("end")
    )
    return whole.unionByName(found).unionByName(single)


def keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    """id (0 for null), h, a hash of the text that tells apart rows with one id, and the bytes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id).cast("bigint"), F.lit(0)).alias("id"), _hash(whole, id).alias("h"),
        F.encode(whole, "UTF-8").alias("data"),
    )


def _hash(whole: Column, id: str) -> Column:
    return F.xxhash64(whole, F.col(id).isNull())


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of `data` without the spans, and the maximal runs they make."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    edges = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), runs


def _cut_batches(batches: Batches, text: str, found: str, kept: str, spans: str) -> Batches:
    for batch in slices(batches):
        at = batch.schema.get_field_index
        left, runs = [], []
        for t, listed in zip(batch.column(at(text)).to_pylist(), batch.column(at(found)).to_pylist()):
            rest, merged = cut((t or "").encode(), [(s["start"], s["end"]) for s in listed or ()])
            left.append(rest)
            runs.append([{"start": a, "end": b} for a, b in merged])
        batch = batch.remove_column(at(found))
        batch = put(batch, kept, pa.array(left, pa.binary()))
        yield put(batch, spans, pa.array(runs, _SPANS))


def remove_repeats(
    docs: DataFrame, text: str = "text", id: str = "doc_id", kept: str = "kept",
    spans: str = "removed",
) -> DataFrame:
    """Adds the bytes that stay (binary) and the removed runs, an array of (start, end) in bytes.

    The runs are maximal, in order, and may be none. Existing columns of these names are replaced.
    An empty table gives no rows.
    """
    found = written(repeated_spans(docs, text, id), "spans")
    columns = [c for c in docs.columns if c not in (kept, spans)]
    name = unused("spans", columns)
    lists = found.groupBy("id", "h").agg(
        F.collect_list(F.struct("start", "end")).alias("lists")  # no more than a text has runs
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        packed(docs, kept, spans), F.coalesce(F.col(id).cast("bigint"), F.lit(0)).alias("id"),
        _hash(whole, id).alias("h"),
    ).join(lists, ["id", "h"], "left")
    rows = rows.select("row.*", F.col("lists").alias(name))
    schema = T.StructType([
        *rows.drop(name).schema.fields, T.StructField(kept, T.BinaryType()),
        T.StructField(spans, T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        ]))),
    ])
    return rows.mapInArrow(lambda batches: _cut_batches(batches, text, name, kept, spans), schema)
