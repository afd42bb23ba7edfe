"""One-hot and ordinal encoding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_accents
from ..session import stored

# a column's levels that are broadcast: all if it has no more, else those with at least this part of its rows
SENT_LEVELS = 2000
# rows of a task that looks up rare levels, so that it reads the same whatever the size of the table;
# no more rare levels than that are left to Spark, which broadcasts a small table
TASK_ROWS = 100_000


def level_name(c) -> Column:
    """Value as part of a column name: lower case, no accents, separators as underscores."""
    return F.translate(strip_accents(F.lower(c)), " -/", "___")


def column_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 1000):
    """Sorted (value, name) pairs per column from one aggregation.

    Wide data is refused: more levels than ``max_levels`` in a column is an error, and the
    fetched rows are limited accordingly, so the driver never receives more than that.
    """
    kinds = dict(df.dtypes)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols]
    )
    seen = df.select(F.inline(pairs)).filter(F.col("v").isNotNull()).distinct()
    cap = max_levels * len(cols)
    rows = seen.select("c", "v", level_name("v").alias("name")).limit(cap + 1).collect()
    found: dict[str, list[tuple[str, str]]] = {c: [] for c in cols}
    for r in rows:
        found[r["c"]].append((r["v"], r["name"]))
    for c, got in found.items():
        if len(got) > max_levels or len(rows) > cap:
            raise ValueError(f"column {c!r} has more than {max_levels} levels to encode")
        is_number = kinds[c].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))
        got.sort(key=lambda p: float(p[0]) if is_number else p[0])
    return found


class OneHot:
    """0/1 columns ``<col>_<level>`` in place of the encoded columns.

    Levels are learned once, so a later batch gets the same columns even if it lacks some
    of them.  Levels whose names coincide share a column.
    """

    def __init__(
        self,
        cols: Sequence[str],
        drop_first: bool = False,
        dummy_na: bool = False,
        keep_source: bool = False,
        max_levels: int = 1000,
    ):
        self.cols, self.drop_first, self.dummy_na = list(cols), drop_first, dummy_na
        self.keep_source, self.max_levels = keep_source, max_levels
        self.levels: dict[str, list[tuple[str, str]]] | None = None

    def fit(self, df: DataFrame) -> OneHot:
        self.levels = column_levels(df, self.cols, self.max_levels)
        return self

    def column_names(self) -> list[str]:
        return list(self._expressions())

    def _expressions(self) -> dict[str, Column]:
        if self.levels is None:
            raise ValueError("fit has not been called")
        tests: dict[str, list[Column]] = {}
        for c in self.cols:
            for value, name in self.levels[c][1 if self.drop_first else 0 :]:
                tests.setdefault(f"{c}_{name}", []).append(F.col(c).cast("string") == F.lit(value))
            if self.dummy_na:
                tests.setdefault(f"{c}_none", []).append(F.col(c).isNull())
        return {k: F.coalesce(reduce(or_, t).cast("int"), F.lit(0)) for k, t in tests.items()}

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns(self._expressions())
        return out if self.keep_source else out.drop(*self.cols)


def check_one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Smallest, largest and total row sum of the 0/1 columns."""
    total = sum((F.col(c) for c in cols), F.lit(0))
    return df.select(total.alias("_s")).agg(
        F.min("_s").alias("min_sum"), F.max("_s").alias("max_sum"), F.sum("_s").alias("total")
    )


def ordinal(c, levels: Sequence) -> Column:
    """Place of the value in the list of levels from 0; unknown values are null."""
    c = F.col(c) if isinstance(c, str) else c
    spot = F.array_position(F.array(*[F.lit(v) for v in levels]), c)
    return (F.nullif(spot, F.lit(0)) - 1).cast("int")


def at_least(c, level, levels: Sequence) -> Column:
    """Ordered comparison: true from ``level`` upwards."""
    return ordinal(c, levels) >= list(levels).index(level)


class CategoryCodes:
    """Codes by sorted level, learned once."""

    def __init__(self, cols: Sequence[str], max_levels: int = 1000):
        self.cols, self.max_levels = list(cols), max_levels
        self.levels: dict[str, list[str]] = {}

    def fit(self, df: DataFrame) -> CategoryCodes:
        found = column_levels(df, self.cols, self.max_levels)
        self.levels = {c: [v for v, _ in pairs] for c, pairs in found.items()}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        codes = {f"{c}_code": ordinal(F.col(c).cast("string"), self.levels[c]) for c in self.cols}
        return df.withColumns(codes)


class DictionaryCodes:
    """Codes and sparse one-hot places of columns with any number of levels.

    The levels of all columns are a table, numbered by a distributed sort; no list of them reaches
    the driver.  Rows find their codes by a join, so a later batch gets the same codes, and a level
    that was not learnt has none.  Columns of few levels, and the frequent levels of others, are
    joined by broadcast, so that no task gets all rows of a level; at most ``SENT_LEVELS`` of a
    column are.  Only rare levels meet their rows by a shuffle.
    """

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.levels: DataFrame | None = None
        self.rare: dict[str, tuple[int, int]] = {}

    def fit(self, df: DataFrame) -> DictionaryCodes:
        """Learn (column, value, code, place, sent): ``code`` counts a column's levels from 0 in their order,
        ``place`` those of all columns.  Numbers are in numeric order, other values in that of their text.
        ``sent`` levels are broadcast; ``rare`` holds the columns that have others, with their filled rows and the number of others.
        """
        kinds = dict(df.dtypes)

        def numeric(c: str) -> bool:
            return kinds[c].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))

        cells = [
            F.struct(
                F.lit(i).alias("i"),
                (F.col(c) if numeric(c) else F.lit(None)).cast("double").alias("n"),
                F.col(c).cast("string").alias("v"),
            )
            for i, c in enumerate(self.cols)
        ]
        seen = df.select(F.inline(F.array(*cells))).where("v is not null").groupBy("i", "n", "v").agg(F.count(F.lit(1)).alias("rows"))
        # sorted across partitions; a row's place is the rows of earlier partitions and its own number
        dealt = seen.repartitionByRange("i", "n", "v").sortWithinPartitions("i", "n", "v")
        inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        placed = stored(dealt.select("i", "v", "rows", F.spark_partition_id().alias("p"), inside.alias("k")), "levels")
        earlier = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        sizes = placed.groupBy("p").count().select("p", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("off"))
        numbered = placed.join(F.broadcast(sizes), "p").select("i", "v", "rows", (F.col("off") + F.col("k")).alias("place"))
        first = numbered.groupBy("i").agg(
            F.min("place").alias("first"), F.count(F.lit(1)).alias("levels"), F.sum("rows").alias("all_rows")
        )
        sent = (F.col("levels") <= SENT_LEVELS) | (F.col("rows") * SENT_LEVELS >= F.col("all_rows"))
        names = F.get(F.array(*[F.lit(c) for c in self.cols]), F.col("i"))
        coded = numbered.join(F.broadcast(first), "i").select(
            names.alias("column"), F.col("v").alias("value"), (F.col("place") - F.col("first")).alias("code"), "place", sent.alias("sent"), "all_rows"
        )
        coded = stored(coded, "level-codes")
        # one row per column at most
        others = coded.where("not sent").groupBy("column").agg(F.max("all_rows"), F.count(F.lit(1))).collect()
        self.rare = {c: (rows, levels) for c, rows, levels in others}
        self.levels = coded.drop("all_rows")
        return self

    def _met(self, df: DataFrame, number: str) -> DataFrame:
        if self.levels is None:
            raise ValueError("fit has not been called")
        for i, c in enumerate(self.cols):
            value, key = F.col(c).cast("string"), f"_k{i}"
            own = self.levels.where(F.col("column") == c)
            sent = own.where("sent").select(F.col("value").alias("_v"), F.col(number).alias(key))
            df = df.join(F.broadcast(sent), value == F.col("_v"), "left").drop("_v")
            if c not in self.rare:
                continue
            # rows that have their code, or no value, get keys of their own and are dealt evenly
            left = F.col(key).isNull() & value.isNotNull()
            met = F.when(left, F.concat(F.lit("="), value)).otherwise(F.monotonically_increasing_id().cast("string"))
            other = own.where("not sent").select(F.concat(F.lit("="), "value").alias("_v"), F.col(number).alias("_r"))
            df, (rows, levels) = df.withColumn("_met", met), self.rare[c]
            if levels > TASK_ROWS:
                parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // TASK_ROWS + 1)
                df = df.repartition(parts, "_met")
            df = df.join(other, F.col("_met") == F.col("_v"), "left")
            df = df.withColumn(key, F.coalesce(key, "_r")).drop("_met", "_v", "_r")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<col>_code`` for every column; null and unknown levels have no code."""
        names = {f"_k{i}": f"{c}_code" for i, c in enumerate(self.cols)}
        return self._met(df, "code").withColumnsRenamed(names)

    def sparse(self, df: DataFrame, out: str = "places") -> DataFrame:
        """``df`` with the sorted places of its ones, in one row of 0/1 columns for all levels, as an array."""
        keys = [f"_k{i}" for i in range(len(self.cols))]
        return self._met(df, "place").withColumn(out, F.array_sort(F.array_compact(F.array(*keys)))).drop(*keys)
