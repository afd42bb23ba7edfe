"""Mixing sources to target weights: a token budget handed down a tree of domains, languages, sources.

A node's budget goes to its children by weight.  A child can't take more than it holds (its tokens
times ``max_epochs``); what it can't take goes to its siblings, again by weight, and only if all
siblings are full is a node itself short, so that its own siblings take over.  A node's limit is
the sum of its children's, so one pass from the root settles this exactly.

Within a level: sort siblings by limit / weight.  If the first i are full, the others get the rate
r_i = (budget - their limits) / (weight left) for each unit of weight.  r_i grows while the next
sibling is full and falls after, so the rate is the largest r_i: two window sums and a maximum.

A leaf reads its documents in seeded epochs, each in an order of its own: whole epochs as long as
the budget lasts, then the shortest run of the next one that reaches the rest.  That run's end is
found from sums over slices of the order, so no leaf is ever sorted as a whole: only the slice that
holds the end is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Documents of a slice of a leaf's order.
SLICE = 20_000
#: Leaves up to which their table (some 100 bytes a row) is broadcast; beyond, it is joined.
FEW_LEAVES = 50_000


def word_count(text: Column) -> Column:
    """Words of a text between blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(column: str, weights: Mapping[str, float], default: float) -> Column:
    """A level's weight of a name; names that are not listed get ``default``."""
    if any(w < 0 for w in [*weights.values(), default]):
        raise ValueError("weights must not be negative")
    out = F.lit(float(default))
    for name, weight in weights.items():
        out = F.when(F.col(column) == name, F.lit(float(weight))).otherwise(out)
    return out


def _shared(nodes: DataFrame, parent: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``nodes`` (budget, weight, room) with the budget replaced by each node's share of it."""
    before = Window.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), *names)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("room").over(earlier), F.lit(0.0))
    weight = F.sum("weight").over(before.rowsBetween(0, Window.unboundedFollowing))
    rated = nodes.withColumn("rate", left / weight)
    rate = F.max("rate").over(Window.partitionBy(*parent))
    share = F.greatest(F.lit(0.0), F.least(F.col("room"), F.col("weight") * rate))
    return rated.withColumn("budget", share).drop("rate")


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Sequence[Mapping[str, float]],
    budget: Column | float,
    max_epochs: float,
    default: float = 1.0,
) -> DataFrame:
    """``leaves`` (the level columns, tokens) with the tokens to take from each in ``budget``.

    Leaves without tokens or with a weight of 0 on their way get nothing and take no part.  If all
    leaves together hold less than the budget, each gives all it has.
    """
    room = leaves.withColumn("room", F.col("tokens") * F.lit(float(max_epochs)))
    for level, of in zip(levels, weights):
        room = room.withColumn(f"_w_{level}", _weight(level, of, default))
    live = room.where(" and ".join(f"_w_{level} > 0" for level in levels) + " and room > 0")
    total = F.lit(float(budget)) if not isinstance(budget, Column) else budget
    above = None
    for depth, level in enumerate(levels):
        names = list(levels[: depth + 1])
        nodes = live.groupBy(*names).agg(F.sum("room").alias("room"), F.first(f"_w_{level}").alias("weight"))
        if above is None:
            nodes = nodes.withColumn("budget", total)
        else:
            nodes = nodes.join(above, names[:-1])
        above = _shared(nodes, names[:-1], names).select(*names, "budget")
    return leaves.join(above, list(levels), "left").fillna(0.0, ["budget"])


def _order(seed: int, epoch: Column, key: Column) -> Column:
    """A hexadecimal digest that orders the documents of an epoch."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def _fraction(digest: Column) -> Column:
    """The digest's first 52 bits as a number in [0, 1), in the digest's order."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    df: DataFrame,
    levels: Mapping[str, tuple[Column, Mapping[str, float]]],
    *,
    budget_share: float = 1.0,
    max_epochs: int = 2,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    default_weight: float = 1.0,
    slice_rows: int = SLICE,
) -> DataFrame:
    """``df`` mixed: each row once per epoch it is taken in, with ``epoch`` from 1.

    ``levels`` names the tree's levels from the root: name -> (column, weights).  A null name is the
    empty name.  The budget is ``budget_share`` of all words in ``df``.  The document in which a
    leaf's budget ends is taken whole, so a leaf gives less than one document too much.  Repeated
    rows are documents of their own; empty texts come along in the epochs that are taken whole.
    """
    if taken := {c for c in df.columns if c == "epoch" or c.startswith("_")}:
        raise ValueError(f"columns {sorted(taken)} exist already; names with a leading '_' are used inside")
    names = [f"_level_{k}" for k in range(len(levels))]
    named = df.withColumns({n: F.coalesce(c.cast("string"), F.lit("")) for n, (c, _) in zip(names, levels.values())})
    slim = written(named.select(*names, F.col(key).alias("_key"), word_count(F.col(text)).alias("_tokens")), "mix-sizes")
    sizes = slim.groupBy(*names).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs"))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    weights = [w for _, w in levels.values()]
    budgets = leaf_budgets(sizes, names, weights, budget_share * total, max_epochs, default_weight)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    leaves = written(
        budgets.withColumn("_whole", whole)
        .withColumn("_rest", F.col("budget") - F.col("_whole") * F.col("tokens"))
        .withColumn("_slices", F.ceil(F.col("docs") / F.lit(slice_rows)).cast("long"))
        .select(*names, "_whole", "_rest", "_slices"),
        "mix-leaves",
    )
    few = leaves.count() <= FEW_LEAVES
    digest = _order(seed, F.col("_whole") + 1, F.col("_key"))
    place = F.floor(_fraction(F.col("_digest")) * F.col("_slices")).cast("long")

    def placed(rows: DataFrame, leaf: DataFrame) -> DataFrame:
        met = rows.join(F.broadcast(leaf) if few else leaf, names)
        return met.withColumn("_digest", digest).withColumn("_slice", place)

    slices = placed(slim, leaves).groupBy(*names, "_slice").agg(F.sum("_tokens").alias("_sum"), F.first("_rest").alias("_rest"))
    before = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before_slice = F.coalesce(F.sum("_sum").over(before), F.lit(0))
    ends = (
        slices.withColumn("_before", before_slice)
        .where("_rest > 0 and _before < _rest")
        .groupBy(*names)
        .agg(F.max(F.struct("_slice", "_before")).alias("_end"))
        .select(*names, F.col("_end._slice").alias("_end"), F.col("_end._before").alias("_before"))
    )
    cut = written(leaves.join(ends, names, "left"), "mix-cuts")
    rows = placed(named.withColumn("_key", F.col(key)), cut)
    epochs = F.col("_whole") + F.when(F.col("_slice") < F.col("_end"), 1).otherwise(0)
    full = rows.withColumn("epoch", F.explode(F.when(epochs > 0, F.sequence(F.lit(1), epochs))))
    within = Window.partitionBy(*names).orderBy("_digest", "_key", "_tokens", F.xxhash64(text))
    running = within.rowsBetween(Window.unboundedPreceding, -1)
    last = (
        rows.where("_slice = _end")  # one slice of each leaf
        .withColumn("_tokens", word_count(F.col(text)))
        .withColumn("_met", F.col("_before") + F.coalesce(F.sum("_tokens").over(running), F.lit(0)))
        .where("_met < _rest")
        .withColumn("epoch", F.col("_whole") + 1)
    )
    return full.select(*df.columns, "epoch").unionByName(last.select(*df.columns, "epoch"))
