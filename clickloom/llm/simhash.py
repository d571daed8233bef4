"""Near-duplicate groups by SimHash fingerprints that differ in a few bits.

Pairs are found through pivot distance tables. The Hamming distances of every distinct fingerprint
to many reference fingerprints are its coordinates. Two fingerprints within `max_bits` differ by
at most `max_bits` in every coordinate, so a pair with a larger coordinate difference is discarded;
what is left is verified bit by bit.

For clusters, fingerprints first meet in blocks. The 64 bits are cut into `max_bits` + 2 bands; two
fingerprints within `max_bits` agree on two whole bands at least, that is, their distances to
references inside these bands are all the same. A block holds the fingerprints that agree on one pair
of bands. A block with more than `BLOCK` members is cut along the distance to the first pivot;
its pieces meet each other in separate tasks, but for pieces whose coordinates are too far apart.
Of the links within two pieces only a spanning star for each group is kept.

Equal fingerprints are one node, whatever their number. Nothing is capped, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.components import components
from clickloom.llm.frames import Batches, with_column_of, written

SEED = 42
WIDTH = 3
MAX_BITS = 3
BLOCK = 1024
N_PIVOTS = 32
PIVOTS = np.random.default_rng(SEED).integers(0, 1 << 64, N_PIVOTS, np.uint64, endpoint=False)


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """64 bits, each set when it is set in over half of the hashes of the word shingles.

    Words are what lies between ASCII white space, A-Z lowered. Shingles count as often as they
    occur; a text of fewer words is one shingle. A null text and one without words give zero.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles)
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", target: str = "fingerprint", width: int = WIDTH
) -> DataFrame:
    """Adds the fingerprint of `text` as a bigint; an existing column `target` is replaced."""

    def values(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, width) for t in texts.to_pylist()], pa.int64())

    return with_column_of(docs, text, target, T.LongType(), values)


def band_keys(fingerprint: str, max_bits: int) -> F.Column:
    """One number for each pair of bands and the bits in them."""
    n = max_bits + 2
    ends = [64 * i // n for i in range(n + 1)]
    masks = [sum(1 << k for k in range(a, b)) for a, b in zip(ends, ends[1:])]
    keys = []
    for i, (x, y) in enumerate(combinations(masks, 2)):
        mask = x | y
        keys.append(F.xxhash64(
            F.lit(i), F.col(fingerprint).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        ))
    return F.array(*keys)


def distances(fps: np.ndarray) -> np.ndarray:
    """The pivot distance table of fingerprints, one row each."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int16)


def near(fps: np.ndarray, table: np.ndarray, x: np.ndarray, y: np.ndarray, max_bits: int):
    """Which of the pairs (x, y) of row numbers are links."""
    kept = np.arange(len(x))
    for k in range(0, N_PIVOTS, 8):
        apart = np.abs(table[x[kept], k : k + 8] - table[y[kept], k : k + 8]).max(axis=1, initial=0)
        kept = kept[apart <= max_bits]
    kept = kept[np.bitwise_count(fps[x[kept]] ^ fps[y[kept]]) <= max_bits]
    return x[kept], y[kept]


def stars(ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each linked row to the smallest id it reaches through the pairs (x, y)."""
    low = ids.copy()
    while True:
        before = low.copy()
        least = np.minimum(low[x], low[y])
        np.minimum.at(low, x, least)
        np.minimum.at(low, y, least)
        if np.array_equal(before, low):
            break
    moved = low != ids
    return ids[moved], low[moved]


def _group_links(fps: np.ndarray, ids: np.ndarray, side: np.ndarray, max_bits: int):
    """Links of one task's piece or pair of pieces; `side` says whose rows they are."""
    table, across = distances(fps), side.min() != side.max()
    found_x, found_y = [], []
    for i in range(len(fps)):
        y = np.arange(i + 1, len(fps))
        if across:
            y = y[side[y] != side[i]]
        a, b = near(fps, table, np.full(len(y), i), y, max_bits)
        found_x.append(a)
        found_y.append(b)
    return stars(ids, np.concatenate(found_x), np.concatenate(found_y))


def link_batches(batches: Batches, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Stars of the links in groups that come one after the other (key, part, other, side)."""
    rest: pa.Table | None = None

    def settle(rows: pa.Table) -> pa.RecordBatch | None:
        col = {c: rows.column(c).to_numpy() for c in rows.column_names}
        fps, ids, side = col["fp"].view(np.uint64), col["node"], col["side"]
        new = np.ones(len(fps), bool)
        for c in ("key", "part", "other"):
            new[1:] &= col[c][1:] == col[c][:-1]
        new[1:] = ~new[1:]
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        small = sizes[group] <= 16
        out_a, out_b = [], []
        # Small groups all at once: each row against its next, its next but one and so on.
        at = np.flatnonzero(small)
        if len(at):
            table = distances(fps[at])
            for step in range(1, int(sizes[sizes <= 16].max())):
                x = np.flatnonzero(group[at][step:] == group[at][:-step])
                y = x + step
                # Parts of one block that are the same part are compared within, others across.
                part, other = col["part"][at[x]], col["other"][at[x]]
                ok = (part == other) | (side[at[x]] != side[at[y]])
                a, b = near(fps[at], table, x[ok], y[ok], max_bits)
                low = np.minimum(ids[at[a]], ids[at[b]])
                out_a.append(np.maximum(ids[at[a]], ids[at[b]]))
                out_b.append(low)
        starts = np.flatnonzero(new)
        for s in starts[sizes > 16]:
            n = sizes[group[s]]
            a, b = _group_links(fps[s : s + n], ids[s : s + n], side[s : s + n], max_bits)
            out_a.append(a)
            out_b.append(b)
        if not out_a:
            return None
        pair = np.stack([np.concatenate(out_a), np.concatenate(out_b)])
        pair = np.unique(pair, axis=1) if pair.shape[1] else pair
        return pa.record_batch([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        if not rows.num_rows:
            continue
        # The last group may go on in the next batch.
        same = np.ones(rows.num_rows, bool)
        for c in ("key", "part", "other"):
            values = rows.column(c).to_numpy()
            same &= values == values[-1]
        cut = rows.num_rows - int(same.sum())
        if cut and (found := settle(rows.slice(0, cut))):
            yield found
        rest = rows.slice(cut)
    if rest is not None and rest.num_rows and (found := settle(rest)):
        yield found


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between rows of `nodes` (fp, node), enough to connect every group.

    Fingerprints must be distinct.
    """
    rows = nodes.select(F.explode(band_keys("fp", max_bits)).alias("key"), "fp", "node")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    pivot = int(PIVOTS[0].astype(np.int64))
    # A piece of a large block is one distance to the first pivot, and a salt where that is not
    # enough. Pieces whose distances are too far apart need not meet.
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    salts = F.ceil(F.col("parts") / 4).cast("int")
    coordinate = F.bit_count(F.col("fp").bitwiseXOR(F.lit(pivot)))
    blocks = rows.join(sizes, "key").select(
        "key", "fp", "node", parts.alias("parts"), coordinate.alias("coordinate")
    )
    one = blocks.where("parts = 1").select(
        "key", "fp", "node", F.lit(0).alias("part"), F.lit(0).alias("other"), F.lit(0).alias("side")
    )
    salt = F.pmod(F.xxhash64("fp"), salts).cast("int")
    salted = blocks.where("parts > 1").withColumn(
        "own", F.col("coordinate").cast("int") * F.lit(1 << 20) + salt
    )
    pieces = salted.select(
        "key", F.col("own").alias("partner"), F.col("coordinate").alias("at")
    ).distinct()
    met = salted.join(pieces, "key").where(
        F.abs(F.col("coordinate") - F.col("at")) <= max_bits
    )
    many = met.select(
        "key", "fp", "node", F.least("own", "partner").alias("part"),
        F.greatest("own", "partner").alias("other"),
        (F.col("own") > F.col("partner")).cast("int").alias("side"),
    )
    dealt = one.unionByName(many).repartition("key", "part", "other")
    return dealt.sortWithinPartitions("key", "part", "other").mapInArrow(
        lambda batches: link_batches(batches, max_bits), "a bigint, b bigint"
    )


def near_groups(
    docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = WIDTH,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of `docs`: id, fingerprint (bigint), component_id.

    `component_id` is the smallest id that links reach, a row's own included. Rows with a null id
    take part through their fingerprint and don't name a component. An empty table gives no rows.
    """
    marked = written(
        fingerprints(docs.select(id, text), text, "fingerprint", width).select(id, "fingerprint"),
        "fingerprints",
    )
    nodes = written(
        marked.groupBy(F.col("fingerprint").alias("fp"))
        .agg(F.min(id).alias("node")).where("node is not null"), "nodes",
    )
    found = components(links(nodes, max_bits))
    named = nodes.join(found, F.col("node") == F.col("id"), "left").select(
        F.col("fp").alias("fingerprint"), F.coalesce("component", "node").alias("component_id")
    )
    return marked.join(named, "fingerprint", "left").select(id, "fingerprint", "component_id")
