"""Mixing sources to target weights by hierarchical budgets.

Documents lie in the leaves of a tree: domain, language, source.  A budget of
tokens goes down from the root: each node shares its budget among its children by
weight; a child can take at most what its leaves hold in ``max_epochs`` passes,
and what it cannot take goes to its siblings by weight, before anything goes up to
the ancestors' siblings.  Each leaf then takes whole epochs and, of the next one,
a prefix of its documents in the order of a seeded hash, as long as the tokens fit.

Budgets and tokens are integers and shares are rounded down, so results do not depend
on the order of sums.  (Only the order in which children fill up compares the doubles
cap / weight; ties go by cap, weight and name.)  Budgets are computed over the leaves
(a table of their sums) with windows.  Prefixes need no sort of a whole leaf: tokens
are first summed by hash slice, and only the slice in which the budget ends is ordered,
without texts.  A leaf has more slices the more documents it has, so slices stay small.

Rules: null domain, language or source is a leaf of its own, named ''.  Null text
has no tokens; such documents cost nothing.  A weight that is not given is 1; a node
of weight 0 gives nothing, not even documents without tokens.  Rows with the same id and size are
chosen all or none.  Other columns pass through, but ``domain`` is read where it
exists, and ``n_tokens`` and ``copies`` are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import TOKEN, Scratch, broadcast_if_small

LEVELS = ["domain", "lang", "source"]
#: Share of all available tokens that is the budget, and passes over a document.
BUDGET_NUM, BUDGET_DEN = 1, 2
MAX_EPOCHS = 2
SEED = "mix-1"
#: Documents of a hash slice of a leaf, at most sixteen times as many.
SLICE_DOCS = 256
#: Leaves up to which their budgets are broadcast (about 200 bytes each).
BROADCAST_LEAVES = 100_000


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint")


def domain_of(source: Column) -> Column:
    """Sources are grouped by the last digit of their names; others form 'other'."""
    digit = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9])$", 1)
    return F.when(digit == "", "other").otherwise(F.concat(F.lit("domain"), (digit.cast("int") % 3).cast("string")))


def share_down(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``take`` to children with ``cap``, ``weight``, and their parent's ``budget``.

    In the order of cap / weight, children are full as long as the rest of the
    budget, shared by the weights left, covers them; the others share what is left.
    """
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy(ratio, "cap", "weight", *children.columns[:1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    group = Window.partitionBy(*parent)
    out = children.withColumns({
        "__spent": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "__weights": F.sum("weight").over(onward),
    })
    rest = F.col("budget") - F.col("__spent")
    out = out.withColumn("__full", (F.col("weight") > 0) & (F.col("cap") * F.col("__weights") <= F.col("weight") * rest))
    # The first child that is not full fixes the share of all that follow.
    part = F.when(~F.col("__full") & (F.col("weight") > 0), F.struct(F.col("__spent").alias("spent"), F.col("__weights").alias("weights")))
    out = out.withColumn("__cut", F.min(part).over(group))
    share = F.expr("(weight * (budget - __cut.spent)) div __cut.weights")
    take = F.when(F.col("weight") == 0, 0).when(F.col("__full"), F.col("cap")).otherwise(F.least("cap", share))
    return out.withColumn("take", take.cast("bigint")).drop("__spent", "__weights", "__full", "__cut")


def _weighted(nodes: DataFrame, column: str, weights: dict[str, int] | None) -> DataFrame:
    value = F.lit(1).cast("bigint")
    for name, w in (weights or {}).items():
        value = F.when(F.col(column) == name, F.lit(w).cast("bigint")).otherwise(value)
    return nodes.withColumn("weight", value)


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]] | None = None,
            num: int = BUDGET_NUM, den: int = BUDGET_DEN, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, take): the tokens each leaf gives; leaves of weight 0 are left out."""
    weights = weights or {}
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {num} div {den}").alias("budget"))
    level = None
    for depth, name in enumerate(LEVELS):
        keys = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*keys).agg((F.sum("tokens") * max_epochs).cast("bigint").alias("cap"))
        nodes = _weighted(nodes, name, weights.get(name)).select(name, *keys[:-1], "cap", "weight")
        if level is None:
            nodes = nodes.withColumns({"__one": F.lit(1), "__on": F.lit(True)}).join(
                F.broadcast(total.withColumn("__one", F.lit(1))), "__one")
            level = share_down(nodes.select(name, "cap", "weight", "budget", "__one", "__on"), ["__one"])
        else:
            up = level.select(*keys[:-1], F.col("take").alias("budget"), "__on")
            level = share_down(nodes.join(up, keys[:-1]), keys[:-1])
        level = level.withColumn("__on", F.col("__on") & (F.col("weight") > 0)).select(*keys, "take", "__on")
    sums = leaves.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    return sums.join(level.where("__on").drop("__on"), LEVELS)


def mix(docs: DataFrame, weights: dict[str, dict[str, int]] | None = None, seed: str = SEED,
        num: int = BUDGET_NUM, den: int = BUDGET_DEN, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` that are chosen, with ``domain``, ``n_tokens`` and ``copies``.

    ``domain`` is taken from the table where it has such a column.
    """
    scratch = Scratch(docs.sparkSession)
    named = docs if "domain" in docs.columns else docs.withColumn("domain", domain_of(F.col("source")))
    rows = named.withColumns({
        "n_tokens": n_tokens(F.col("text")),
        **{f"__{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LEVELS},
    })
    keys = [f"__{c}" for c in LEVELS]
    sums = rows.groupBy(*keys).agg(F.sum("n_tokens").cast("bigint").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = scratch.table(sums.select(*[F.col(k).alias(k[2:]) for k in keys], "tokens", "docs"))
    digits = F.greatest(F.lit(0), F.least(F.lit(8), F.ceil(F.log(16.0, F.col("docs") / SLICE_DOCS)))).cast("int")
    plan = scratch.table(budgets(leaves, weights, num, den, max_epochs).join(leaves.select(*LEVELS, "docs"), LEVELS).select(
        *[F.col(c).alias(f"__{c}") for c in LEVELS], digits.alias("__digits"),
        F.expr("case when tokens > 0 then take div tokens else 1 end").alias("__full"),
        F.expr("case when tokens > 0 then take % tokens else 0 end").alias("__rest"),
    ))
    order = F.md5(F.concat_ws(":", F.lit(seed), (F.col("__full") + 1).cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))

    def placed(plan: DataFrame) -> DataFrame:
        joined = rows.join(broadcast_if_small(plan, BROADCAST_LEAVES), keys).withColumn("__order", order)
        return joined.withColumn("__slice", F.substring("__order", F.lit(1), F.col("__digits")))

    ahead = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed(plan).groupBy(*keys, "__slice", "__rest").agg(F.sum("n_tokens").alias("__sum"))
    slices = slices.withColumn("__before", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)))
    edges = slices.where("__before + __sum > __rest").groupBy(*keys).agg(
        F.min(F.struct("__slice", "__before")).alias("__edge"))
    plan = scratch.table(plan.join(edges, keys, "left"))
    # Of the slice in which the budget ends, the last place that is still within it.
    at = F.struct(F.col("__order").alias("order"), F.col("n_tokens").alias("n"))
    inside = Window.partitionBy(*keys).orderBy("__order", "n_tokens")
    ends = placed(plan).where(F.col("__slice") == F.col("__edge.__slice")).select(*keys, "__order", "n_tokens", "__edge", "__rest")
    last = (
        ends.withColumn("__upto", F.col("__edge.__before") + F.sum("n_tokens").over(inside))
        .where("__upto <= __rest").groupBy(*keys).agg(F.max(at).alias("__last"))
    )
    both = placed(scratch.table(plan.join(last, keys, "left")))
    edge = F.col("__edge.__slice")
    chosen = (F.col("__slice") < edge) | ((F.col("__slice") == edge) & (at <= F.col("__last")))
    out = both.withColumn("copies", (F.col("__full") + F.coalesce(chosen, F.lit(False)).cast("int")).cast("bigint"))
    return out.where("copies > 0").select(*[F.col(f"`{c}`") for c in named.columns if c not in ("n_tokens", "copies")], "n_tokens", "copies")
