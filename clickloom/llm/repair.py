"""Repair of conversations: the cheapest edits after which their turns alternate as they should.

A conversation is whole when the initials of its roles read `(s?(ua)+)?`. Every row may be kept (0), given
the role user or assistant (1) or deleted (2), and an empty turn of either role may be put in anywhere
(5). Rows that are blank or repeat an earlier row have to go; a row whose text is cut off costs 5
more unless it goes. The edits are a path through a lattice: before every row stands one of four states
(nothing yet, after s, after u, after a), and each edit is an arc with a whole cost.

The path is found by the auction algorithm for shortest paths. Every node has a price, at first zero. A path
grows from its origin along the arc that prices make the cheapest, as long as the node's price equals what that
arc costs; else the price rises to that and the path gives up its last node. Origins are taken from the last
row back to the first, so a path is complete when it meets a node that an earlier path has settled. In the
end a price is the exact cost of the way to the end; arcs whose cost equals the fall of prices are tight, and the
path that takes the least letter (D, I, K, R) among tight arcs is the answer.

Any conversation may be large. Rows are sorted by range of conversation and turn, which cuts long ones; a
conversation's run in the sorted table is cut into pieces of at most PIECE rows. A piece tells
what it costs to get from each state into each. These tables of 16 numbers are the arcs of a shorter
lattice, whose prices are found likewise, one task for a conversation; with them every piece is traced by
itself, from each state. Only the last step, which writes a conversation's rows in order, streams through
it in one task, without holding it: its digest can't be had otherwise.

Rows of one turn stay in the order of the input, null turns come first. Null roles and texts are read as one space;
a role with another initial than s, u, a (none included) can't be kept. Repeated rows are duplicates
from the second on. Null conversation ids are one conversation. A conversation none of whose rows is present has no
edits. Empty tables give empty ones; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from clickloom.llm.frames import Batches, slices, written

PIECE = 1024
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"

# States of the lattice: what the repaired rows end in.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
SPOKEN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by reroled and inserted turns
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
FAULTS = (None, "truncated", "blank", "duplicate")
# What is left to do after the last row.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
LEGAL = {"su", "ua", "au"}


def code(role: Column, fault: Column) -> Column:
    """A row as one letter, a to p: four faults by four initials."""
    initial = F.instr(F.lit(INITIALS), F.substring(role, 1, 1)) - 1
    known = F.when((F.length(role) > 0) & (initial >= 0), initial).otherwise(3)
    return F.char(F.ascii(F.lit("a")) + 4 * fault + known)


@lru_cache(maxsize=16)
def row_arcs(letter: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the edits of a row, in the order of their letters: letter, cost, next state."""
    fault, initial = divmod(ord(letter) - ord("a"), 4)
    arcs = []
    for state in STATES:
        out = [("D", DELETE, state)]
        if FAULTS[fault] not in ("blank", "duplicate"):
            more = CUT_OFF if FAULTS[fault] == "truncated" else 0
            kept = initial + 1  # the state that this initial leads to
            if kept == SYSTEM and state == NOTHING or kept in ROLES and kept == SPOKEN[state]:
                out.append(("K", KEEP + more, kept))
            out.append(("R", REROLE + more, SPOKEN[state]))
        arcs.append(tuple(out))
    return tuple(arcs)


def auction(layers: Sequence, exits: Sequence[int], inserting: bool = True) -> list[list[int]]:
    """Prices of all states before every layer, and behind the last, where they are `exits`.

    A layer gives for each state its arcs to the states behind it; before it, turns may be inserted.
    """
    prices = [[0] * 4 for _ in layers] + [list(exits)]
    for at in range(len(layers) - 1, -1, -1):
        price, behind, arcs = prices[at], prices[at + 1], layers[at]
        settled = [False] * 4
        for origin in STATES:
            path = [origin]
            while path and not settled[path[-1]]:
                node = path[-1]
                following = SPOKEN[node]
                least = min([cost + behind[to] for _, cost, to in arcs[node]], default=FAR)
                inner = INSERT + price[following] if inserting else 2 * FAR
                if price[node] < min(least, inner):
                    price[node] = min(least, inner)
                    if len(path) > 1:
                        path.pop()  # contraction
                elif least <= inner:
                    break  # the path goes on to the layer behind, which is settled
                else:
                    path.append(following)  # extension
            for node in path:
                settled[node] = True
    return prices


def trace(layers: Sequence, prices: list[list[int]], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from a state before the first layer, and where they end."""
    out = []
    for at, arcs in enumerate(layers):
        while True:
            price = prices[at][state]
            tight = [a for a in arcs[state] if price == a[1] + prices[at + 1][a[2]]]
            spoken = SPOKEN[state]
            if price == INSERT + prices[at][spoken]:
                tight.append(("I", INSERT, spoken))
            letter, _, to = min(tight)
            out.append(letter)
            state = to
            if letter != "I":
                break
    return "".join(out), state


@lru_cache(maxsize=1 << 14)
def crossing(codes: str) -> list[int]:
    """The costs from each state before a piece to each state behind it, FAR where there's no way."""
    layers = [row_arcs(c) for c in codes]
    columns = []
    for to in STATES:
        exits = [0 if state == to else FAR for state in STATES]
        # No insertion leads to the first two states, so without them prices needn't climb to FAR.
        columns.append(auction(layers, exits, inserting=to in ROLES)[0])
    return [min(FAR, columns[to][state]) for state in STATES for to in STATES]


def prices_behind(pieces: list[list[int]]) -> list[list[int]]:
    """For every piece of a conversation, given its crossing, the prices behind it."""
    layers = [
        [[("", c[4 * state + to], to) for to in STATES if c[4 * state + to] < FAR] for state in STATES]
        for c in pieces
    ]
    return auction(layers, END)[1:]


@lru_cache(maxsize=1 << 14)
def edits(codes: str, exits: tuple[int, ...], entries: tuple[int, ...]) -> list[str]:
    """The edits of a piece for each state that it may be entered in."""
    layers = [row_arcs(c) for c in codes]
    prices = auction(layers, exits)
    return [trace(layers, prices, state)[0] for state in entries]


def _each(source: DataFrame, column: str, kind: T.DataType, value) -> DataFrame:
    """`source` with a column more, computed by a Python function of its rows."""

    def apply(batches: Batches) -> Batches:
        for batch in slices(batches):
            found = pa.array([value(row) for row in batch.to_pylist()], type_of)
            yield pa.record_batch([*batch.columns, found], [*batch.schema.names, column])

    type_of = to_arrow_type(kind)
    return source.mapInArrow(apply, T.StructType([*source.schema.fields, T.StructField(column, kind)]))


def _sorted(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column
) -> DataFrame:
    """The rows in order: `at` rises with the conversation, the turn, and the order of the input."""
    keys = [F.asc_nulls_first(c) for c in ("conv", "turn", "given")]
    rows = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.coalesce(present, F.lit(False)).alias("present"),
        F.monotonically_increasing_id().alias("given"),
    )
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(ordered.withColumn("at", F.monotonically_increasing_id()).drop("given"), "turns")


def _same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(right[c])
    return same


def _coded(turns: DataFrame) -> DataFrame:
    """conv, at, and the letter of each present row."""
    bare = F.trim("text", F.lit(SPACES))
    rows = turns.where("present").select(
        "conv", "at", "role", F.sha2("text", 256).alias("same_text"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    # The first row of every text that comes again; counted in part before rows are dealt out.
    firsts = rows.groupBy("conv", "role", "same_text").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("times")
    ).where("times > 1")
    firsts = firsts.select(F.col("conv").alias("c"), F.col("role").alias("r"), "same_text", "first")
    met = rows.join(
        firsts, rows["conv"].eqNullSafe(F.col("c")) & (rows["role"] == F.col("r"))
        & (rows["same_text"] == firsts["same_text"]), "left",
    )
    fault = F.when(F.col("blank"), 2).when(F.col("at") > F.col("first"), 3) \
        .when(F.col("truncated"), 1).otherwise(0)
    return met.select("conv", "at", code(F.col("role"), fault).alias("code"))


def _pieces(turns: DataFrame) -> DataFrame:
    """conv, at (of the first row), and the letters of at most PIECE rows."""
    listed = F.array_sort(F.collect_list(F.struct("at", "code")))
    pieces = _coded(turns).groupBy("conv", F.expr(f"at div {PIECE}").alias("piece")).agg(
        listed.alias("rows")
    )
    return written(pieces.select(
        "conv", F.col("rows")[0]["at"].alias("at"), F.array_join("rows.code", "").alias("codes")
    ), "pieces")


def _solved(pieces: DataFrame) -> DataFrame:
    """`pieces` with the edits of each, for one or for all four states it may be entered in."""
    several = pieces.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("conv").alias("c")
    )
    cut = pieces.join(several, pieces["conv"].eqNullSafe(several["c"]), "left_semi")
    whole = pieces.join(several, pieces["conv"].eqNullSafe(several["c"]), "left_anti")
    longs = T.ArrayType(T.LongType())
    crossed = _each(cut, "crossing", longs, lambda row: crossing(row["codes"])).drop("codes")
    lists = crossed.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("at", "crossing"))).alias("cut")
    )
    behind = _each(
        lists, "behind", T.ArrayType(longs),
        lambda row: prices_behind([p["crossing"] for p in row["cut"]]),
    )
    exits = behind.select(F.explode(F.arrays_zip("cut.at", "behind")).alias("p")).select(
        F.col("p.at").alias("at"), F.col("p.behind").alias("exits")
    )
    ready = whole.withColumn("exits", F.lit(None).cast(longs)).unionByName(cut.join(exits, "at"))

    def solve(row: dict) -> list[str]:
        if row["exits"] is None:
            return edits(row["codes"], END, (NOTHING,))
        return edits(row["codes"], tuple(row["exits"]), tuple(STATES))

    return _each(ready, "edits", T.ArrayType(T.StringType()), solve).drop("exits")


def _rewrite(batches: Batches, kind: pa.DataType, turn_kind: pa.DataType) -> Batches:
    """Rows and pieces of whole conversations in order to the rows of `repaired`."""
    names = ["conv", "place", "turn", "edit", "fault", "old_role", "role", "text"]
    kinds = [kind, pa.int64(), turn_kind, *[pa.string()] * 5]
    out: list[tuple] = []
    state = place = 0
    letters: Iterator[str] = iter("")
    codes: Iterator[str] = iter("")
    current: tuple | None = None

    def insert(conv) -> None:
        nonlocal state, place
        state = SPOKEN[state]
        out.append((conv, place, None, "I", None, None, ROLES[state], ""))
        place += 1

    def finish(conv) -> None:
        while state in (SYSTEM, USER):
            insert(conv)

    for batch in slices(batches):
        for conv, is_row, present, turn, role, text, piece, given in zip(*(
            batch.column(c).to_pylist()
            for c in ("conv", "is_row", "present", "turn", "role", "text", "codes", "edits")
        )):
            if current != (conv,):
                if current:
                    finish(*current)
                current, state, place = (conv,), NOTHING, 0
            if not is_row:
                codes, letters = iter(piece), iter(given[state if len(given) > 1 else 0])
            elif not present:
                out.append((conv, None, turn, None, None, role, None, None))
            else:
                fault, initial = divmod(ord(next(codes)) - ord("a"), 4)
                letter = next(letters)
                while letter == "I":
                    insert(conv)
                    letter = next(letters)
                new = None
                if letter == "K":
                    state, new = initial + 1, role
                elif letter == "R":
                    state = SPOKEN[state]
                    new = ROLES[state]
                out.append((conv, place, turn, letter, FAULTS[fault], role, new, text))
                place += 1
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out.clear()
    if current:
        finish(*current)
    if out:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def repaired(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """Every row, and every one put in, in the order of its conversation.

    conv, place (from 0), turn, edit (K, R, D, I), fault (blank, duplicate, truncated), old_role, role (null if
    deleted), text. Rows for which `present` isn't true take no part: they have no edit and no place.
    Each conversation lies in one partition, sorted.
    """
    turns = _sorted(rows, conv, turn, role, text, F.lit(True) if present is None else present)
    solved = _solved(_pieces(turns))
    both = turns.withColumn("is_row", F.lit(True)).unionByName(
        solved.withColumn("is_row", F.lit(False)), allowMissingColumns=True
    )
    ordered = both.repartition("conv").sortWithinPartitions("conv", "at", "is_row")
    conv_kind, turn_kind = (turns.schema[c].dataType for c in ("conv", "turn"))
    schema = T.StructType([
        T.StructField("conv", conv_kind), T.StructField("place", T.LongType()),
        T.StructField("turn", turn_kind),
        *[T.StructField(c, T.StringType()) for c in ("edit", "fault", "old_role", "role", "text")],
    ])
    kinds = [to_arrow_type(k) for k in (conv_kind, turn_kind)]
    return ordered.mapInArrow(lambda batches: _rewrite(batches, *kinds), schema)


class _Summary:
    """What is reported of one conversation, gathered row by row."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.turns = self.illegal = self.cost = 0
        self.first = self.last = None
        self.initial: str | None = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.begun = False

    def add(self, turn, edit, fault, old_role, role, text) -> None:
        if edit is None:
            return
        self.audit.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if fault == "truncated" and edit != "D":
                self.cost += CUT_OFF
            if self.initial is not None and self.initial + old_role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = old_role[:1]
            if turn is not None:
                self.first = turn if self.first is None else self.first
                self.turns += turn != self.last
                self.last = turn
        if edit != "D":
            self.digest.update(f"{chr(10) * self.begun}{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


def summaries(repaired_rows: DataFrame) -> DataFrame:
    """A row for each conversation of `repaired`, with its faults, cost, edits and digest."""
    kind = repaired_rows.schema["conv"].dataType
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([
        T.StructField("conv", kind), *[T.StructField(c, T.LongType()) for c in longs],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def rows_of(found: Iterable[_Summary]) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(c, k) for c, k in zip(zip(*(s.row() for s in found)), arrow.types)], arrow.names
        )

    def apply(batches: Batches) -> Batches:
        open_one: _Summary | None = None
        for batch in slices(batches):
            done = []
            for conv, *row in zip(*(
                batch.column(c).to_pylist()
                for c in ("conv", "turn", "edit", "fault", "old_role", "role", "text")
            )):
                if open_one is None or open_one.conv != conv:
                    if open_one is not None:
                        done.append(open_one)
                    open_one = _Summary(conv)
                open_one.add(*row)
            if done:
                yield rows_of(done)
        if open_one is not None:
            yield rows_of([open_one])

    return repaired_rows.mapInArrow(apply, schema)
