"""Mixing sources to target weights, by budgets that go down a tree of sources.

The leaves are the groups of the `levels`, such as domain, language and source. A total of tokens goes
down from the root: every node shares its budget among its children by their weights. A child
can't take more than its leaves hold, times `max_epochs`; what it can't take goes to its siblings, again
by weight, and only what all children of a node together can't take is left to the node's own siblings,
which is why each node's budget is limited by what is below it before it is shared.

A leaf then reads its documents in epochs. An epoch is all its documents, shuffled with a seed of its
own. Whole epochs are taken while the budget lasts, and of the next one a prefix: the documents that
begin before the remaining tokens are used up.

Leaves are summed in Spark. The sums of up to `MAX_LEAVES` leaves make the budgets on the driver and are
broadcast; more stay in a table, whose budgets are made level by level, by running sums over the children of each
node, and which documents meet by leaf and salt. Both ways give the same budgets. The prefix of a leaf is one cut in the order of its keys, so documents are only filtered and repeated:
no text is shuffled, and a leaf with a third of all rows is no different from others.

Weights count in whole millionths, one at least. A weight that isn't given is 1; children of weight 0 get nothing but what would otherwise be lost.
Null is a value of a level like any other. Null ids are allowed; equal ids of one leaf have the same key
and stand or fall together. A document without tokens counts one. A table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.frames import packed, quoted, written
from clickloom.llm.running import BUCKET_ROWS, bucket_starts, digest_bucket

SEED = 42
MAX_LEAVES = 100_000
SALTS = 32
MILLION = 1_000_000
Weights = Mapping[str, Mapping[str | None, float]]
Path = tuple[str | None, ...]


def words(text: str) -> Column:
    """Tokens of a text for budgets: its words, without looking into them."""
    return F.size(F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+"))


def share(budget: int, weights: Sequence[float], limits: Sequence[int]) -> list[int]:
    """A budget by weights, none above its limit; the rest of those that are full goes to the others.

    Whole tokens: fractions are rounded down and what is left over goes to the first with room.
    """
    budget = min(budget, sum(limits))
    weights = [millionths(w) for w in weights]
    given = [0] * len(limits)
    left = budget
    while left:
        room = [i for i in range(len(limits)) if given[i] < limits[i]]
        heavy = [i for i in room if weights[i]] or room
        whole = sum(weights[i] for i in heavy)
        parts = {i: left * weights[i] // whole if whole else left // len(heavy) for i in heavy}
        full = [i for i in heavy if given[i] + parts[i] >= limits[i]]
        if full:  # fill these first, then share the rest anew
            for i in full:
                left -= limits[i] - given[i]
                given[i] = limits[i]
            continue
        for i, part in parts.items():
            given[i] += part
            left -= part
        for i in heavy:
            more = min(left, limits[i] - given[i])
            given[i] += more
            left -= more
    return given


def millionths(weight: float) -> int:
    return max(1, round(weight * MILLION)) if weight > 0 else 0


def budgets(
    supply: Mapping[Path, int], total: int, levels: Sequence[str], weights: Weights, max_epochs: int
) -> dict[Path, int]:
    """Tokens for each leaf of `supply`."""
    found: dict[Path, int] = {}

    def down(paths: list[Path], budget: int, depth: int) -> None:
        if depth == len(levels):
            found[paths[0]] = budget
            return
        children: dict[str | None, list[Path]] = {}
        for path in paths:
            children.setdefault(path[depth], []).append(path)
        names = sorted(children, key=lambda n: (n is not None, n))
        of = weights.get(levels[depth], {})
        limits = [sum(supply[p] for p in children[n]) * max_epochs for n in names]
        for name, part in zip(names, share(budget, [of.get(n, 1.0) for n in names], limits)):
            down(children[name], part, depth + 1)

    if supply:
        down(sorted(supply, key=repr), total, 0)
    return found


def shared(children: DataFrame) -> DataFrame:
    """parent, child, limit, weight (in millionths), budget (of the parent): adds `given`, by the rule of `share`.

    In the order of their limit by weight, children are full up to the first one that the rest of the budget
    does not fill.
    """
    def whole(column: Column) -> Column:
        return column.cast("decimal(19,0)")

    node = Window.partitionBy("parent")
    heavy = F.col("weight") > 0
    rows = children.withColumn("_heavy", heavy).withColumn(
        "_to_heavy", F.least("budget", F.sum(F.when(heavy, F.col("limit")).otherwise(0)).over(node))
    ).withColumn("_to_all", F.least("budget", F.sum("limit").over(node))).withColumn(
        "_budget", F.when(heavy, F.col("_to_heavy")).otherwise(F.col("_to_all") - F.col("_to_heavy"))
    ).withColumn("_weight", F.when(heavy, F.col("weight")).otherwise(1))
    kind = Window.partitionBy("parent", "_heavy")
    by_ratio = kind.orderBy(F.col("limit") / F.col("_weight"), "child")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_rest", F.col("_budget") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
    rows = rows.withColumn("_of", F.sum("_weight").over(kind) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    unfilled = whole(F.col("limit")) * whole(F.col("_of")) > whole(F.col("_weight")) * whole(F.col("_rest"))
    rows = rows.withColumn("_unfilled", unfilled).withColumn(
        "_open", F.max("_unfilled").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    open_ = F.col("_open")
    rows = rows.withColumn(
        "_rest", F.col("_budget") - F.sum(F.when(open_, 0).otherwise(F.col("limit"))).over(kind)
    ).withColumn("_of", F.sum(F.when(open_, F.col("_weight"))).over(kind))
    part = F.call_function("div", whole(F.col("_rest")) * whole(F.col("_weight")), whole(F.col("_of")))
    rows = rows.withColumn("_part", F.when(open_, part).otherwise(F.col("limit")))
    # What rounding has left goes to the first ones by name that have room.
    rows = rows.withColumn("_left", F.col("_rest") - F.sum(F.when(open_, F.col("_part")).otherwise(0)).over(kind))
    room = F.col("limit") - F.col("_part")
    by_name = kind.orderBy("child").rowsBetween(Window.unboundedPreceding, -1)
    more = F.least(room, F.greatest(F.lit(0), F.col("_left") - F.coalesce(F.sum(room).over(by_name), F.lit(0))))
    return rows.select("parent", "child", (F.col("_part") + more).alias("given"))


def budget_table(
    leaves: DataFrame, total: int, levels: Sequence[str], weights: Weights, max_epochs: int
) -> DataFrame:
    """_leaf, _supply, _budget of any number of leaves, from `_leaf` (a JSON array of names) and `_supply`."""
    nodes = leaves.withColumn("path", F.from_json("_leaf", "array<string>"))
    spark = leaves.sparkSession
    given = spark.range(1).select(F.lit("[]").alias("node"), F.lit(total).cast("bigint").alias("budget"))
    for depth, level in enumerate(levels):
        weight = F.lit(MILLION)
        for name, value in weights.get(level, {}).items():
            weight = F.when(F.col("child").eqNullSafe(F.lit(name)), millionths(value)).otherwise(weight)
        children = nodes.groupBy(
            F.to_json(F.slice("path", 1, depth)).alias("parent"), F.get("path", F.lit(depth)).alias("child"),
            F.to_json(F.slice("path", 1, depth + 1)).alias("node"),
        ).agg((F.sum("_supply") * max_epochs).alias("limit"))
        parents = given.select(F.col("node").alias("parent"), "budget")
        met = children.join(parents, "parent").withColumn("weight", weight.cast("bigint"))
        nodes_given = shared(met).select(
            F.to_json(F.concat(F.from_json("parent", "array<string>"), F.array("child"))).alias("node"),
            F.col("given").alias("budget"),
        )
        given = written(nodes_given, "mixing-budgets")
    return leaves.join(given.select(F.col("node").alias("_leaf"), F.col("budget").alias("_budget")), "_leaf")


def mix(
    docs: DataFrame, levels: Mapping[str, Column], weights: Weights, share_of_supply: float,
    tokens: Column, max_epochs: int = 1, id: str = "doc_id", seed: int = SEED,
) -> DataFrame:
    """The rows of `docs`, each as often as its leaf's epochs take it, with a column `epoch` (from 0).

    `levels` gives the tree from the root to the leaves, `share_of_supply` the tokens to select as
    a share of all there are. An existing column `epoch` is replaced; all others stay.
    """
    # Levels are compared as text, with a mark that keeps null apart from an empty name.
    leaf = F.to_json(F.array(*[c.cast("string") for c in levels.values()]))
    narrow = written(
        docs.select(
            leaf.alias("_leaf"), quoted(id).cast("string").alias("_id"),
            F.greatest(tokens, F.lit(1)).cast("bigint").alias("_tokens"),
        ),
        "mixing",
    )
    sums = narrow.groupBy("_leaf").agg(F.sum("_tokens").alias("_supply"))
    leaves = written(sums, "mixing-leaves")
    found = leaves.agg(F.count(F.lit(1)).alias("n"), F.sum("_supply").alias("supply")).first()
    few = found.n <= MAX_LEAVES
    total = int((found.supply or 0) * share_of_supply)
    if few:
        takes = _small_takes(leaves, total, list(levels), weights, max_epochs)
    else:
        given = budget_table(leaves, total, list(levels), weights, max_epochs)
        takes = written(given.select(
            "_leaf", F.call_function("div", "_budget", "_supply").alias("_whole"),
            (F.col("_budget") % F.col("_supply")).alias("_rest"),
        ), "mixing-takes")
    cuts = written(_cuts(narrow, takes, seed, few), "mixing-cuts")
    rows = docs.select(
        packed(docs, "epoch"), leaf.alias("_leaf"), quoted(id).cast("string").alias("_id")
    )
    joined = _by_leaf(rows, takes.join(cuts, "_leaf", "left"), few)
    partial = (F.col("_rest") > 0) & (_key("_id", F.col("_whole"), seed) <= F.col("_last"))
    last = F.col("_whole") - 1 + F.coalesce(partial, F.lit(False)).cast("bigint")
    epochs = F.when(last >= 0, F.sequence(F.lit(0), last.cast("int")))
    return joined.select("row", F.explode(epochs).alias("epoch")).select("row.*", "epoch")


def _small_takes(
    leaves: DataFrame, total: int, levels: Sequence[str], weights: Weights, max_epochs: int
) -> DataFrame:
    """_leaf, _whole epochs, _rest of tokens; of at most MAX_LEAVES leaves."""
    rows = leaves.withColumn("path", F.from_json("_leaf", "array<string>")).collect()
    given = budgets({tuple(r["path"]): r["_supply"] for r in rows}, total, levels, weights, max_epochs)
    plan = [(r["_leaf"], *divmod(given[tuple(r["path"])], r["_supply"])) for r in rows]
    return leaves.sparkSession.createDataFrame(plan, "_leaf string, _whole bigint, _rest bigint")


def _by_leaf(rows: DataFrame, takes: DataFrame, few: bool) -> DataFrame:
    """Rows with what is taken of their leaf. A leaf may hold most rows: many leaves meet them by salt as well."""
    if few:  # a row for each leaf, at most MAX_LEAVES
        return rows.join(F.broadcast(takes), "_leaf")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
    repeated = takes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, ["_leaf", "_salt"]).drop("_salt")


def _key(id: str, epoch: Column, seed: int) -> Column:
    """The place of a document in the shuffled order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(id).cast("string")))


def _cuts(narrow: DataFrame, takes: DataFrame, seed: int, few: bool) -> DataFrame:
    """For leaves with a part of an epoch: `_last`, the last key that is in it."""
    buckets = max(1, narrow.count() // BUCKET_ROWS)
    rows = _by_leaf(narrow, takes.where("_rest > 0"), few).select(
        "_leaf", "_rest", "_tokens", _key("_id", F.col("_whole"), seed).alias("_key")
    )
    marked = rows.withColumn("_bucket", digest_bucket("_key", buckets))
    starts = bucket_starts(marked, F.col("_tokens"), ["_leaf"])
    # Only the bucket that holds the cut is looked at row by row.
    cut = marked.join(starts, ["_leaf", "_bucket"]).where(
        (F.col("_start") < F.col("_rest")) & (F.col("_rest") <= F.col("_start") + F.col("_sum"))
    )
    before = Window.partitionBy("_leaf", "_bucket").orderBy("_key").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    up_to = F.col("_start") + F.sum("_tokens").over(before) - F.col("_tokens")
    return cut.withColumn("_before", up_to).where("_before < _rest").groupBy("_leaf").agg(
        F.max("_key").alias("_last")
    )
