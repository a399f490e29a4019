"""Mixing sources to target weights: budgets down a tree, then token prefixes of seeded epochs.

The tree has one level for each path column (here domain, language, source). A budget of tokens is divided among a node's
children by weight; a child that holds less than its share gives the rest to its siblings, by weight again, so a
shortage is made up among siblings before it is felt a level higher: a node's capacity is that of all leaves below.
A leaf holds ``epochs`` passes over its texts, each in a seeded order of its own; its budget takes the longest run of whole texts from the start of
these passes.

The order within a pass is that of md5(seed:epoch:doc_id). Sums run over the leading digits of that key first, so a leaf with a third of all rows
isn't ordered in one task: only the rows of one key range per leaf are. Budgets are a table as large as the tree; it meets
the texts by broadcast or salted join, and texts aren't shuffled.

Defined results: tokens are words; a text without a word, or null, is never drawn; a null path value is a node of its own;
rows that share a doc_id are drawn together; a null doc_id has the key of an empty id; extra columns stay; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanforge.llm.common import WORD, Scratch, fresh_name
from scanforge.plans.joins import lookup_join

RANGE_DIGITS = 3
NOTHING = "\u0000"


def path_value(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NOTHING))


def order_key(seed: int, epoch, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def share_out(children: DataFrame, parent: list[str], key: str) -> DataFrame:
    """``children`` (parent..., key, weight, capacity, budget of the parent) with their own whole-number budget.

    Children are filled up in order of capacity by weight; where the first that keep all they have end, the others share
    the rest by weight, rounded so that it adds up.
    """
    big = lambda c: F.col(c).cast("decimal(20,0)")
    filled = Window.partitionBy(*parent).orderBy("ratio", key)
    before, after = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(0, Window.unboundedFollowing)
    usable = children.where("weight > 0").withColumn("ratio", F.col("capacity") / F.col("weight"))
    usable = usable.withColumn("held", F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast("decimal(20,0)"))
    usable = usable.withColumn("weights", F.sum("weight").over(after).cast("decimal(12,0)"))
    usable = usable.withColumn("full", big("capacity") * F.col("weights") <= (big("budget") - F.col("held")) * F.col("weight").cast("decimal(12,0)"))
    group = Window.partitionBy(*parent)
    usable = usable.withColumn("rest", F.greatest(big("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(group), F.lit(0)), F.lit(0)).cast("decimal(20,0)"))
    usable = usable.withColumn("open", F.when(F.col("full"), 0).otherwise(F.col("weight")))
    usable = usable.withColumn("upto", F.sum("open").over(filled.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(12,0)"))
    usable = usable.withColumn("all_open", F.greatest(F.sum("open").over(group), F.lit(1)).cast("decimal(12,0)"))
    part = F.expr("(rest * upto) div all_open - (rest * cast(upto - open as decimal(12,0))) div all_open")
    return usable.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(part).cast("long"))


def leaf_budgets(leaves: DataFrame, path: list[str], weights: list[Column], budget_percent: int, epochs: int) -> DataFrame:
    """``leaves`` (path..., supply) with a token budget. ``weights``: one whole-number expression over the path columns for each level."""
    total = leaves.agg(F.sum("supply")).first()[0] or 0
    budget = total * budget_percent // 100
    nodes = None
    for depth, weight in enumerate(weights, 1):
        parent, key = path[: depth - 1], path[depth - 1]
        level = leaves.groupBy(*path[:depth]).agg((F.sum("supply") * epochs).cast("long").alias("capacity"), F.sum("supply").alias("supply"))
        level = level.withColumn("weight", weight.cast("long"))
        level = level.withColumn("budget", F.lit(budget).cast("long")) if nodes is None else level.join(nodes, parent)
        if not parent:
            level, parent = level.withColumn("_root", F.lit(0)), ["_root"]
        shared = share_out(level, parent, key)
        nodes = shared.select(*path[:depth], F.col("share").alias("budget"), "supply")
        leaf = nodes
        nodes = nodes.drop("supply")
    return leaf


def plan(docs: DataFrame, path: list[str], weights: list[Column], budget_percent: int, epochs: int, seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts): doc_id, path and tokens of each text; and for each leaf the whole passes and the last key of the next one."""
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select("doc_id", *[path_value(F.col(c)).alias(c) for c in path], tokens.alias("n_tokens")).where("n_tokens > 0")
    rows = scratch.save(rows, "tokens")
    leaves = scratch.save(rows.groupBy(*path).agg(F.sum("n_tokens").alias("supply")), "leaves")
    budgets = leaf_budgets(leaves, path, weights, budget_percent, epochs)
    budgets = budgets.select(*path, F.expr("cast(budget div supply as int)").alias("passes"), F.expr("budget % supply").alias("rest"))
    budgets = scratch.save(budgets, "budgets")

    keyed = lookup_join(rows, budgets.where("rest > 0"), path, F.col("doc_id"))
    keyed = keyed.withColumn("key", order_key(seed, F.col("passes"), F.col("doc_id"))).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = keyed.groupBy(*path, "range").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    upto = Window.partitionBy(*path).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    split = scratch.save(ranges.where("before <= rest and before + n > rest").select(*path, "range", "before"), "ranges")
    inside = lookup_join(keyed, split, [*path, "range"], F.col("doc_id"))
    # RANGE: rows with one key, thus one doc_id, are drawn together.
    ordered = Window.partitionBy(*path).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    last = inside.withColumn("upto", F.col("before") + F.sum("n_tokens").over(ordered)).where("upto <= rest").groupBy(*path).agg(F.max("key").alias("last"))
    # Without a whole text of its own range, a leaf's run ends with the range before.
    cuts = budgets.join(split.select(*path, "range"), path, "left").join(last, path, "left")
    cuts = cuts.select(*path, "passes", F.coalesce("last", "range", F.lit("")).alias("last"))
    return rows, scratch.save(cuts, "cuts")


def drawn(rows: DataFrame, cuts: DataFrame, path: list[str], seed: int) -> DataFrame:
    joined = lookup_join(rows, cuts, path, F.col("doc_id"))
    more = order_key(seed, F.col("passes"), F.col("doc_id")) <= F.col("last")
    n = F.col("passes") + F.when(more, 1).otherwise(0)
    return joined.withColumn("epoch", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))


def mix(docs: DataFrame, path: list[str], weights: list[Column], budget_percent: int = 60, epochs: int = 2, seed: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, path, n_tokens and epoch of each text drawn."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows, cuts = plan(docs, path, weights, budget_percent, epochs, seed, scratch)
    return drawn(rows, cuts, path, seed).select("doc_id", *path, "n_tokens", "epoch")


def take_mixed(docs: DataFrame, path: dict[str, Column], weights: list[Column], budget_percent: int = 60, epochs: int = 2, seed: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """``docs``, each row as often as it is drawn. ``path`` gives an expression over ``docs`` for each level."""
    scratch = scratch or Scratch(docs.sparkSession)
    names = list(path)
    placed = docs.select("doc_id", "text", *[e.alias(n) for n, e in path.items()])
    _, cuts = plan(placed, names, weights, budget_percent, epochs, seed, scratch)
    hidden = {n: fresh_name(docs, f"_mix_{n}") for n in [*names, "passes", "last"]}
    renamed = cuts.select(*[F.col(n).alias(hidden[n]) for n in cuts.columns])
    marked = docs.where(F.col("text").rlike(WORD)).select("*", *[path_value(e).alias(hidden[n]) for n, e in path.items()])
    joined = lookup_join(marked, renamed, [hidden[n] for n in names], F.col("doc_id"))
    more = order_key(seed, F.col(hidden["passes"]), F.col("doc_id")) <= F.col(hidden["last"])
    times = F.col(hidden["passes"]) + F.when(more, 1).otherwise(0)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    turn = fresh_name(docs, "_mix_turn")
    return joined.where(times > 0).select(*columns, F.explode(F.sequence(F.lit(1), times)).alias(turn)).select(*columns)
