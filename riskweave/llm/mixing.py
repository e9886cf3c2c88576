"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

Documents hang in a tree (by default domain, language, source). A token budget
is handed down from the root: every node shares its budget among its children
by their weights; a child never gets more than its documents can give in
``max_epochs`` passes, and what it can't use goes to its siblings by their
weights. Only what all of them together can't use goes up, because a node's own
need is the sum of its children's. Shares are whole tokens, exact for any size.

A leaf reads its documents in seeded epochs: epoch e orders them by
md5(seed:e:id). Whole epochs are taken while the budget lasts, then the longest
prefix of the next one. The cut is found without sorting a leaf: tokens are
summed in sqrt(rows) hash ranges, running totals name the range that holds the
cut, and only this range's rows are ordered. A hot leaf is thus no more than
sqrt(rows) partial sums and sqrt(rows) rows in one window.

Defined cases: null levels are leaves of their own, weighted 1 like every name
without a weight; a weight of 0 gives nothing. A null or empty text has no
tokens: it goes along wherever the order reaches it. Rows that repeat an id
have the same place in an epoch and are taken or left together; a null id
counts as the empty string. An empty table gives an empty result. Columns of
the documents besides id, text and levels may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.staging import Staged

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Plan:
    """``levels``: name of each level and the SQL expression it is computed by, from the top.

    ``weights``: whole-number weights by level and name. ``budget_share`` is
    the share of all tokens to select, in thousandths; ``budget`` a number of tokens instead.
    """

    levels: tuple[tuple[str, str], ...] = (("domain", "'all'"), ("lang", "lang"), ("source", "source"))
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    budget_share: int = 1000
    budget: int | None = None
    max_epochs: int = 1
    seed: int = 7

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.levels]


def _big(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)")


def _weight(plan: Plan, level: str) -> Column:
    out = F.lit(1)
    for name, weight in plan.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def token_sizes(docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """(id, levels, n_tokens): words of each text."""
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(_id_text(id_col).alias("id"), *(F.expr(e).alias(n) for n, e in plan.levels), tokens.alias("n_tokens"))


def _id_text(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def leaf_budgets(sizes: DataFrame, plan: Plan) -> DataFrame:
    """One row per leaf: levels, rows, tokens, budget."""
    names = plan.names
    leaves = sizes.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens"))
    for name in names:
        leaves = leaves.withColumn(f"w_{name}", _weight(plan, name))
    dead = F.lit(False)
    for name in names:
        dead = dead | (F.col(f"w_{name}") <= 0)
    leaves = leaves.withColumn("room", F.when(dead, F.lit(0)).otherwise(_big("tokens") * plan.max_epochs).cast("decimal(38,0)"))
    total = F.sum(_big("tokens")).over(Window.partitionBy())
    wanted = F.lit(plan.budget) if plan.budget is not None else F.expr("total * %d div 1000" % plan.budget_share)
    # One row per leaf and level: the tree is as large as the list of its leaves, not as the documents.
    budgets = leaves.withColumn("total", total).withColumn("budget", F.least(_big(wanted), F.sum("room").over(Window.partitionBy())).cast("decimal(38,0)"))
    for depth, name in enumerate(names):
        budgets = _shared_out(budgets, names[:depth], name)
    return budgets.select(*names, "rows", "tokens", F.col("budget").cast("long").alias("budget"))


def _shared_out(leaves: DataFrame, above: list[str], level: str) -> DataFrame:
    """Replaces ``budget`` (of the node above) by the budget of each leaf's node at ``level``."""
    keys = [*above, level]
    nodes = leaves.groupBy(*keys).agg(F.first("budget").alias("given"), F.first(f"w_{level}").alias("w"), F.sum("room").cast("decimal(38,0)").alias("node_room"))
    nodes = nodes.withColumn("w", _big("w")).withColumn("ratio", F.when(F.col("w") > 0, F.col("node_room").cast("double") / F.col("w").cast("double")).otherwise(F.lit(0.0)))
    order = Window.partitionBy(*above).orderBy("ratio", F.col(level).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("left_over", (F.col("given") - F.coalesce(F.sum("node_room").over(before), F.lit(0))).cast("decimal(38,0)"))
    # Full: its room is no more than its share of what is left after all that fill up before it.
    nodes = nodes.withColumn("is_full", _big("node_room") * F.sum("w").over(here).cast("decimal(18,0)") <= F.col("w").cast("decimal(18,0)") * F.col("left_over"))
    family = Window.partitionBy(*above)
    open_weight = F.sum(F.when(~F.col("is_full"), F.col("w"))).over(family)
    rest = F.col("given") - F.coalesce(F.sum(F.when(F.col("is_full"), F.col("node_room"))).over(family), F.lit(0))
    nodes = nodes.withColumn("open_weight", open_weight.cast("decimal(18,0)")).withColumn("rest", rest.cast("decimal(38,0)"))
    share = F.when(F.col("is_full"), F.col("node_room")).otherwise(F.expr("cast(cast(w as decimal(18,0)) * cast(rest as decimal(20,0)) div open_weight as decimal(38,0))"))
    nodes = nodes.select(*[F.col(k).alias(f"{k}__of") for k in keys], share.alias("share"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__of"))
    return leaves.join(nodes, same).drop(*[f"{k}__of" for k in keys], "budget").withColumnRenamed("share", "budget")


def _epoch_key(plan: Plan, id_text: Column, epoch: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{plan.seed}:"), epoch.cast("string"), F.lit(":"), id_text))


def _range(key: Column, ranges: Column) -> Column:
    """Which of the leaf's hash ranges a key lies in; rises with the key."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftrightunsigned(head * ranges, 32).cast("long")


def _with_leaf(rows: DataFrame, leaves: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """``rows`` with their leaf's columns; the leaf table is a written one, so Spark knows its size when it picks the join."""
    renamed = leaves.select(*[F.col(n).alias(f"{n}__leaf") for n in names], *columns)
    same = F.lit(True)
    for n in names:
        same = same & rows[n].eqNullSafe(F.col(f"{n}__leaf"))
    return rows.join(renamed, same).drop(*[f"{n}__leaf" for n in names])


def leaf_cuts(sizes: DataFrame, plan: Plan, staged: Staged) -> DataFrame:
    """One row per leaf: levels, full epochs, hash ranges, and where the prefix of the last epoch ends."""
    names = plan.names
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("long")
    leaves = leaf_budgets(sizes, plan).withColumn("epochs", whole)
    leaves = leaves.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")).withColumn("ranges", F.greatest(F.lit(1), F.ceil(F.sqrt("rows"))).cast("long"))
    leaves = staged.write(leaves, "leaves")
    placed = _with_leaf(sizes, leaves, names, ["epochs", "rest", "ranges"]).withColumn("key", _epoch_key(plan, F.col("id"), F.col("epochs"))).withColumn("range", _range(F.col("key"), F.col("ranges")))
    sums = placed.groupBy(*names, "rest", "range").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy("range"))
    crossed = sums.withColumn("upto", upto).where("upto > rest").groupBy(*names).agg(F.min("range").alias("cut_range"), F.min_by(F.col("upto") - F.col("tokens"), "range").alias("below"))
    crossed = staged.write(crossed, "crossed")
    inside = _with_leaf(placed, crossed, names, ["cut_range", "below"]).where("range = cut_range")
    running = F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("key", "id"))
    last = inside.withColumn("upto", F.col("below") + running).where("upto <= rest").groupBy(*names).agg(F.max(F.struct("key", "id")).alias("last"))
    return staged.write(_optional(_optional(leaves, crossed, names, ["cut_range"]), last, names, ["last"]).drop("rows", "tokens", "budget", "rest"), "cuts")


def _optional(left: DataFrame, right: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    renamed = right.select(*[F.col(n).alias(f"{n}__right") for n in names], *columns)
    same = F.lit(True)
    for n in names:
        same = same & left[n].eqNullSafe(F.col(f"{n}__right"))
    return left.join(renamed, same, "left").drop(*[f"{n}__right" for n in names])


CUT = ("epochs", "ranges", "cut_range", "last")


def _copies(plan: Plan, id_text: Column) -> Column:
    """How many epochs take a row that carries its leaf's cut in ``__cut``."""
    cut = F.col("__cut")
    key = _epoch_key(plan, id_text, cut["epochs"])
    at = _range(key, cut["ranges"])
    last = F.coalesce(F.struct(key.alias("key"), id_text.alias("id")) <= cut["last"], F.lit(False))
    # No range crosses the budget only where the leaf has no tokens: all its rows go along.
    in_prefix = cut["cut_range"].isNull() | (at < cut["cut_range"]) | ((at == cut["cut_range"]) & last)
    # In a leaf that is taken whole, rows without tokens that come first would fit once more.
    return F.least(cut["epochs"] + in_prefix.cast("long"), F.lit(plan.max_epochs).cast("long"))


def mixed(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are taken, once for each epoch that takes them; texts are not shuffled."""
    staged = Staged(docs.sparkSession, "mixing")
    cuts = leaf_cuts(staged.write(token_sizes(docs, plan, id_col, text_col), "sizes"), plan, staged)
    staged.drop("sizes")
    with_epochs = _taken(docs, plan, cuts, {n: F.expr(e) for n, e in plan.levels}, _id_text(id_col))
    return with_epochs.select(*[F.col(f"`{c}`") for c in docs.columns])


def selected(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and epoch that takes it: ``id_col``, levels, n_tokens, epoch."""
    staged = Staged(docs.sparkSession, "mixing")
    sizes = staged.write(token_sizes(docs, plan, id_col, text_col), "sizes")
    cuts = leaf_cuts(sizes, plan, staged)
    own_id = F.when(F.col("id") != "", F.col("id")).cast(docs.schema[id_col].dataType)
    return _taken(sizes, plan, cuts, {n: F.col(n) for n in plan.names}, F.col("id")).select(own_id.alias(id_col), *plan.names, "n_tokens", F.col("__epoch").alias("epoch"))


def _taken(rows: DataFrame, plan: Plan, cuts: DataFrame, levels: Mapping[str, Column], id_text: Column) -> DataFrame:
    named = cuts.select(*[F.col(n).alias(f"__leaf_{n}") for n in plan.names], F.struct(*CUT).alias("__cut"))
    same = F.lit(True)
    for name, value in levels.items():
        same = same & value.eqNullSafe(F.col(f"__leaf_{name}"))
    taken = rows.join(named, same).withColumn("__copies", _copies(plan, id_text)).where("__copies > 0")
    return taken.withColumn("__epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
