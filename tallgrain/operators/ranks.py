"""Ranks and exact quantiles without sending a whole group to one task.

Values are cut into ranges by edges taken from one quantile sketch.  The range number
is a pure function of the value, so it is the same in every pass and on every retry.
Equal values are counted together before any shuffle, which turns the most frequent
value of a group into a single row.  Running totals are then taken inside a
(group, range), and the totals of the earlier ranges are added.

The sketch is made in stages: tasks' sketches meet in a fixed number of slots, and only the
slots' marks, a fixed number again, come together.  Where the counts of the ranges show that
one holds too many rows, it gets a sketch and edges of its own, until none is too full.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

# One sketch yields up to this many candidate edges; they are thinned to what the data needs.
MAX_EDGES = 4096
# Rows one range should hold at most; rows of one value are never parted, and count as one line.
ROWS_PER_RANGE = 1_000_000
# Sketches of tasks are merged in so many slots, each by a task of its own.
SKETCH_SLOTS = 64
# Edges of one column that reach the driver at most.
MOST_EDGES = 1 << 17
# Group tables up to this many rows may be broadcast.
SMALL_GROUPS = 50_000


# No key with a smaller share of all rows counts as hot, so there are at most 1,000 hot keys.
HOT_SHARE = 0.001
# Share of the rows the sketch looks at.  Edges only steer how work is spread: results do not
# depend on them, so a sample is enough.
SKETCH_SHARE = 0.125


@dataclass
class ValueGrid:
    """Edges and frequent values per column, plus what the same scan told about size."""

    edges: dict[str, list[float]]
    frequent: dict[str, list[float]]
    rows: int
    groups: int
    hot_share: float = HOT_SHARE

    def renamed(self, **names: str) -> ValueGrid:
        """The same grid with other column names: ``new=old``."""
        return replace(
            self,
            edges={new: self.edges[old] for new, old in names.items()},
            frequent={new: self.frequent[old] for new, old in names.items()},
        )

    def small(self, per_group: int = 1) -> bool:
        return self.groups * per_group <= SMALL_GROUPS


def _missing(df: DataFrame, col: str) -> Column:
    """Null, or NaN in a floating-point column."""
    null = F.col(col).isNull()
    return null | F.isnan(col) if dict(df.dtypes)[col] in ("double", "float") else null


def present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in all columns."""
    for c in dict.fromkeys(cols):
        df = df.filter(~_missing(df, c))
    return df


def absent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The other rows."""
    return df.filter(reduce(or_, [_missing(df, c) for c in dict.fromkeys(cols)]))


def number(df: DataFrame, col: str) -> Column:
    """An order-preserving double for numbers, dates and timestamps."""
    kind = dict(df.dtypes)[col]
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind == "timestamp":
        return F.unix_micros(col).cast("double")
    if kind == "timestamp_ntz":
        start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
        return F.timestamp_diff("MICROSECOND", start, F.col(col)).cast("double")
    return F.col(col).cast("double")


def _merged_marks(lists: Sequence[tuple[int, Sequence[float]]], marks: int) -> list[float]:
    """Marks at equal shares of all rows, from the marks of slots with their numbers of rows."""
    lists = [(n, found) for n, found in lists if found]
    if not lists:
        return []
    values = np.concatenate([np.array(found, float) for _, found in lists])
    weights = np.concatenate([np.full(len(found), n / len(found)) for n, found in lists])
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weights[order])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, marks) / marks)
    return values[order][np.minimum(at, len(values) - 1)].tolist()


def _numbered(df: DataFrame, cols: Sequence[str], edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(column number, range, value) of every value that is present."""
    ranged = df.select(*cols)
    for i, c in enumerate(cols):
        ranged = with_range(ranged, c, edges[c], f"_r{i}")
    cells = [F.struct(F.lit(i).alias("c"), F.col(f"_r{i}").alias("r"), number(df, c).alias("v")) for i, c in enumerate(cols)]
    return ranged.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull() & ~F.isnan("v"))


def refined_edges(
    df: DataFrame, cols: Sequence[str], edges: Mapping[str, Sequence[float]], limit: int
) -> dict[str, list[float]]:
    """Edges with more of them inside ranges of more than ``limit`` rows, until no such range is left.

    A range of a single value can't be cut.  Each round counts all ranges of all columns in one
    aggregation; the too full ones are sketched side by side, one group each.
    """
    now = {c: sorted(edges[c]) for c in cols}
    while True:
        cells = _numbered(df, cols, now)
        counts = cells.groupBy("c", "r").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        full = counts.where((F.col("n") > limit) & (F.col("low") < F.col("high"))).collect()
        full = [x for x in full if len(now[cols[x["c"]]]) < MOST_EDGES]
        if not full:
            return now
        marks = min(MAX_EDGES, 2 * math.ceil(max(x["n"] for x in full) / limit))
        wanted = F.expr("array(" + ",".join(f"{i / marks}D" for i in range(1, marks)) + ")")
        asked = df.sparkSession.createDataFrame([(x["c"], x["r"]) for x in full], "c int, r int")
        inside = cells.join(F.broadcast(asked), ["c", "r"])
        found = inside.groupBy("c", "r").agg(F.percentile_approx("v", wanted, 4 * marks).alias("e")).collect()
        low = {(x["c"], x["r"]): x["low"] for x in full}
        fresh: dict[str, set[float]] = defaultdict(set)
        for x in found:
            for value, times in Counter(x["e"]).items():
                # a value that fills several marks gets a range of its own
                new = [value] if times == 1 else [value, float(np.nextafter(value, math.inf))]
                fresh[cols[x["c"]]].update(v for v in new if v > low[(x["c"], x["r"])])
        grown = {c: sorted({*now[c], *fresh[c]}) for c in cols}
        if grown == now:
            return now
        now = grown


def value_grid(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), ranges: int | None = None, limit: int | None = None
) -> ValueGrid:
    """Edges for every column from one map-side aggregation; a few numbers reach the driver.

    No range holds more than ``limit`` rows (default ``ROWS_PER_RANGE``), but for one of a single value.
    """
    spark = df.sparkSession
    limit = limit or ROWS_PER_RANGE
    slots = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    marks = min(MAX_EDGES, max(512, 16 * slots))
    # as text: building thousands of literals one by one costs more than the scan
    wanted = F.expr("array(" + ",".join(f"{i / marks}D" for i in range(1, marks)) + ")")
    seen = df.select(
        (F.spark_partition_id() % SKETCH_SLOTS).alias("_slot"),
        (F.rand(1) < SKETCH_SHARE).alias("_seen"),
        (F.xxhash64(*by) if by else F.lit(0).cast("bigint")).alias("_group"),
        *[number(df, c).alias(f"_v{i}") for i, c in enumerate(cols)],
    )
    picked = [
        F.percentile_approx(F.when(F.col("_seen"), F.col(f"_v{i}")), wanted, 4 * marks).alias(f"e{i}")
        for i in range(len(cols))
    ]
    sketch = [F.hll_sketch_agg("_group").alias("g")] if by else []
    parts = seen.groupBy("_slot").agg(F.count(F.lit(1)).alias("n"), *sketch, *picked)
    groups = F.hll_sketch_estimate(F.hll_union_agg("g")) if by else F.lit(1)
    lists = [F.collect_list(F.struct("n", f"e{i}")).alias(f"e{i}") for i in range(len(cols))]
    row = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), groups.alias("g"), *lists).first()
    if ranges is None:
        ranges = max(slots, math.ceil(row["n"] / limit))
    ranges = max(1, min(ranges, marks))
    # a key is hot if it alone would fill more than an even share of the slots
    hot_share = max(HOT_SHARE, 1 / slots)
    edges, frequent = {}, {}
    for i, c in enumerate(cols):
        found = _merged_marks(row[f"e{i}"], marks)
        step = marks / ranges
        thinned = [found[int(k * step) - 1] for k in range(1, ranges)] if found else []
        edges[c] = sorted({e for e in thinned if math.isfinite(e)})
        # a value that fills several marks in a row holds that share of the rows
        frequent[c] = [v for v, k in Counter(found).items() if k >= max(2, marks * hot_share / 2)]
    if row["n"] > limit:
        edges = refined_edges(df, cols, edges, limit)
    return ValueGrid(edges, frequent, row["n"], max(1, row["g"] or 1), hot_share)


def with_range(df: DataFrame, col: str, edges: Sequence[float], out: str = "_range") -> DataFrame:
    """Add the number of the value range; one binary search per row, inside the JVM."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    cutter = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol="_num", outputCol=out, handleInvalid="keep"
    )
    return (
        cutter.transform(df.withColumn("_num", number(df, col)))
        .drop("_num")
        # never null: otherwise joins on it add a null test to one side, and the two sides
        # of a self-join no longer share their shuffle
        .withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(0)))
    )


def tie_table(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    split: Sequence[str] = (),
    weights: Mapping[str, Column] | None = None,
    grid: ValueGrid | None = None,
    ranges: int | None = None,
    rows: str | None = None,
) -> DataFrame:
    """One row per (by, value[, split]) with running totals inside ``by``.

    Columns: ``n`` rows of this line, ``tie`` rows of this value, ``before`` rows with a
    smaller value, ``total`` rows of the group, ``rank`` the average rank of the value.
    For every entry ``w`` of ``weights`` (an aggregate): ``w``, ``w_before``, ``w_total``.
    Where the input is counted already, ``rows`` names its count column.
    Rows without a value or group do not take part.
    """
    by, split, weights = list(by), list(split), dict(weights or {})
    df = present(df, [value, *by])
    grid = grid or value_grid(df, [value], by, ranges)
    sums = ["n", *weights]
    counted = df.groupBy(*by, value, *split).agg(
        (F.sum(rows) if rows else F.count(F.lit(1))).alias("n"),
        *[w.alias(k) for k, w in weights.items()],
    )
    counted = with_range(counted, value, grid.edges[value])
    inside = Window.partitionBy(*by, "_range")
    running = inside.orderBy(value)  # default frame: all peers of a value included
    peers = Window.partitionBy(*by, "_range", value)
    lines = counted.select(
        "*",
        *[F.sum(k).over(running).alias(f"_{k}_run") for k in sums],
        *[(F.sum(k).over(peers) if split else F.col(k)).alias(f"_{k}_tie") for k in sums],
    )
    totals = counted.groupBy(*by, "_range").agg(*[F.sum(k).alias(f"_{k}_sum") for k in sums])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_{k}_sum").over(earlier), F.lit(0)).alias(f"_{k}_off") for k in sums],
        *[F.sum(f"_{k}_sum").over(whole).alias(f"_{k}_all") for k in sums],
    )
    joined = lines.join(offsets, [*by, "_range"])
    before = {k: F.col(f"_{k}_off") + F.col(f"_{k}_run") - F.col(f"_{k}_tie") for k in sums}
    named = [
        F.col("_n_tie").alias("tie"),
        before["n"].alias("before"),
        F.col("_n_all").alias("total"),
        (before["n"] + (F.col("_n_tie") + 1) / 2).alias("rank"),
    ]
    for k in weights:
        named += [before[k].alias(f"{k}_before"), F.col(f"_{k}_all").alias(f"{k}_total")]
    return joined.select(*by, value, *split, *sums, *named)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str, weight: str, grid: ValueGrid
) -> DataFrame:
    """Join rows to a table with one line per key, where ``weight`` counts the key's rows.

    Without frequent values this is one shuffled join.  Otherwise keys that hold at least
    ``hot_share`` of all rows are answered by a broadcast, which cannot have more than
    ``1 / hot_share`` lines, and only the other rows are shuffled.
    """
    keys, often = list(keys), grid.frequent.get(value)
    if not often:
        return rows.join(lookup, keys)
    is_often = number(lookup, value).isin(often)
    hot = lookup.filter(is_often & (F.col(weight) >= grid.rows * grid.hot_share))
    frequent = rows.filter(number(rows, value).isin(often)).join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(lookup, keys)
    return frequent.unionByName(rest)


def group_rank(
    df: DataFrame,
    order_by: str,
    by: Sequence[str] = (),
    method: str = "avg",
    out: str = "rank",
    ranges: int | None = None,
) -> DataFrame:
    """Rank of every row's value inside its group.

    ``avg``: ties share the mean of their places; ``min``: the first of them; ``max``: the
    last; ``dense``: number of smaller distinct values plus one.  Rows without a value or
    group stay, with a null rank.
    """
    keys = [*by, order_by]
    grid = value_grid(present(df, keys), [order_by], by, ranges)
    distinct = {"_one": F.max(F.lit(1))} if method == "dense" else {}
    ties = tie_table(df, order_by, by, weights=distinct, grid=grid)
    picked = {
        "avg": F.col("rank"),
        "min": F.col("before") + 1,
        "max": F.col("before") + F.col("tie"),
        "dense": F.col("_one_before") + 1 if distinct else None,
    }[method]
    table = ties.select(*keys, F.col("n").alias("_n"), picked.alias(out))
    ranked = lookup_join(present(df, keys), table, keys, order_by, "_n", grid).drop("_n")
    kind = dict(ranked.dtypes)[out]
    unranked = absent(df, keys).withColumn(out, F.lit(None).cast(kind))
    return ranked.select(*df.columns, out).unionByName(unranked)


def global_rank(df: DataFrame, order_by: str, method: str = "avg", out: str = "rank") -> DataFrame:
    return group_rank(df, order_by, (), method, out)


def order_values(df: DataFrame, col: str, places: Sequence[int]) -> tuple[int, dict[int, object]]:
    """(number of values, value at each place counted from 0 in ascending order, ties repeated).

    Ranges are counted first; only values of the ranges that hold a wanted place are looked at.
    Values come in the column's own type.  Places that there are not are left out.
    """
    some = present(df, [col]).select(col)
    ranged = with_range(some, col, value_grid(some, [col]).edges[col])
    sizes = dict(sorted(tuple(r) for r in ranged.groupBy("_range").count().collect()))
    ends = np.cumsum(list(sizes.values()), dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    inside: dict[int, list[int]] = defaultdict(list)
    for place in {p for p in places if 0 <= p < total}:
        inside[int(np.searchsorted(ends, place, "right"))].append(place)
    if not inside:
        return total, {}
    numbers = list(sizes)
    asked = [(numbers[i], place, place - int(ends[i]) + sizes[numbers[i]]) for i, some_ in inside.items() for place in some_]
    wanted = F.broadcast(df.sparkSession.createDataFrame(asked, "_range int, _place bigint, _at bigint"))
    counted = ranged.where(F.col("_range").isin([numbers[i] for i in inside])).groupBy("_range", col).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy("_range").orderBy(col)
    met = counted.withColumn("_to", F.sum("_n").over(run)).join(wanted, "_range")
    hit = met.where((F.col("_at") < F.col("_to")) & (F.col("_at") >= F.col("_to") - F.col("_n")))
    return total, {r[0]: r[1] for r in hit.select("_place", col).collect()}


def row_slice(
    df: DataFrame,
    order_by: str,
    start: int = 0,
    stop: int | None = None,
    cols: Sequence[int] | None = None,
) -> DataFrame:
    """Rows by position in the order of a unique key, columns by position.

    The keys at both ends are found first and become a filter that reaches the scan; no row is
    ranked.  Rows with an equal key share its first position.
    """
    start = max(start, 0)
    wanted = [start - 1, start] + ([stop - 1] if stop is not None else [])
    total, values = order_values(df, order_by, wanted)
    names = [df.columns[i] for i in cols] if cols is not None else df.columns
    kept = present(df, [order_by])
    key, kind = F.col(order_by), df.schema[order_by].dataType
    if start >= total or (stop is not None and stop <= start):
        return kept.where(F.lit(False)).select(*names)
    first = F.lit(values[start]).cast(kind)
    # the key before may be the same: its rows stand at an earlier position
    kept = kept.where(key > first if values.get(start - 1) == values[start] else key >= first)
    if stop is not None and stop < total:
        kept = kept.where(key <= F.lit(values[stop - 1]).cast(kind))
    return kept.select(*names)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    ranges: int | None = None,
    grid: ValueGrid | None = None,
    decimal: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation: (by, column, prob, quantile).

    Quantiles are doubles.  With ``decimal`` integers and decimals (up to nine places) are put in
    order and interpolated as such, and quantiles are decimal(38, 6), so that numbers above 2^53
    keep all their digits.

    A first pass counts rows per value range (a map-side aggregation).  That tells which
    ranges hold the wanted places, and only their values are shuffled in the second pass.
    """
    by = list(by)
    df = present(df, by)
    grid = grid or value_grid(df, cols, by, ranges)
    ranged = df
    for c in cols:
        ranged = with_range(ranged, c, grid.edges[c], f"_range_{c}")
    long = ranged.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        (F.col(c).cast("decimal(38,9)") if decimal else number(df, c)).alias("_value"),
                        F.col(f"_range_{c}").alias("_range"),
                    )
                    for c in cols
                ]
            )
        ),
    ).filter(F.col("_value").isNotNull())
    if not decimal:
        long = long.filter(~F.isnan("_value"))
    keys = [*by, "column"]
    filled = long.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = filled.select(
        *keys,
        "_range",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_rows").over(whole).alias("_all"),
    )
    # the two neighbouring places of every probability, counted from 0
    ends = []
    for p in probs:
        spot = (F.col("_all") - 1) * F.lit(float(p))
        low = F.floor(spot)
        ends.append(
            F.struct(
                F.lit(float(p)).alias("prob"),
                low.alias("_low"),
                F.least(low + 1, F.col("_all") - 1).alias("_high"),
                (spot - low).alias("_part"),
            )
        )
    inside = F.filter(
        F.array(*ends),
        lambda e: ((e["_low"] >= F.col("_off")) & (e["_low"] < F.col("_off") + F.col("_rows")))
        | ((e["_high"] >= F.col("_off")) & (e["_high"] < F.col("_off") + F.col("_rows"))),
    )
    targets = placed.select(*keys, "_range", "_off", inside.alias("_ends")).where(F.size("_ends") > 0)
    if grid.small(2 * len(probs) * len(cols)):
        targets = F.broadcast(targets)
    else:
        # written once: the planner then knows its size, and broadcasts it or not by that
        targets = stored(targets, "quantile-places")
    counted = (
        long.join(targets, [*keys, "_range"])
        .groupBy(*keys, "_range", "_value")
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_off").alias("_off"), F.first("_ends").alias("_ends"))
    )
    run = Window.partitionBy(*keys, "_range").orderBy("_value")
    placed = counted.withColumn("_last", F.col("_off") + F.sum("_n").over(run))
    values = placed.select(*keys, "_value", (F.col("_last") - F.col("_n")).alias("_first"), "_last", F.inline("_ends"))

    def at(place: str) -> Column:
        hit = (F.col(place) >= F.col("_first")) & (F.col(place) < F.col("_last"))
        return F.max(F.when(hit, F.col("_value")))

    part = F.col("_part").cast("decimal(10,9)") if decimal else F.col("_part")
    quantile = F.col("_a") + (F.col("_b") - F.col("_a")) * part
    return (
        values.groupBy(*keys, "prob", "_part")
        .agg(at("_low").alias("_a"), at("_high").alias("_b"))
        .select(*keys, "prob", (quantile.cast("decimal(38,6)") if decimal else quantile).alias("quantile"))
    )


def quantiles_wide(
    df: DataFrame, col: str, probs: Mapping[str, float], by: Sequence[str] = (), **how
) -> DataFrame:
    """Exact quantiles of one column as named columns, one row per group."""
    long = exact_quantiles(df, [col], list(probs.values()), by, **how)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(k) for k, p in probs.items()]
    )
