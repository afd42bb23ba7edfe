"""Quality rules: learned decision lists of threshold conjunctions, as Spark conditions.

Features are counts and shares of a text, all made by SQL functions.  The list is learnt by
sequential covering: a rule grows by the condition with the largest information gain on the rows
no earlier rule covers, is pruned back to the prefix that does best on rows kept for that, and is
taken if it is precise enough there.  The statistics behind a step are counts by feature, bin and
label; Spark makes them, and only they go to the driver.  The result is an ordered
chain of ``when(...)`` over the features, and prints as one sentence a rule.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled_texts, written

#: Characters that count as symbols, and white space; fixed by the query's contract.
SYMBOLS = "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FEATURES = ("words", "word_length", "symbols", "duplicate_lines", "repeated_words", "capitals", "shouts")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though used many times inside lambdas."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that stand twice or more in the array.

    Windows are sorted by hash with their places; equal neighbours give the places of repeated
    windows, and the places' gaps how many words they cover.  n log n in the number of words.
    """

    def windows(w: Column) -> Column:
        every = F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return F.sort_array(F.slice(every, 1, F.greatest(F.size(w) - 2, F.lit(0))))

    def places(s: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            return F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)) | F.coalesce(
                x["h"] == F.get(s, j - 1)["h"], F.lit(False)
            )

        return F.sort_array(F.filter(F.transform(s, lambda x, j: F.when(same(x, j), x["i"])), lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda i, j: F.least(F.coalesce(F.get(p, j + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    return bound(bound(bound(words, windows), places), covered)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_lines", "_upper", "_shouts")


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and four helpers.

    Null texts count as empty; every count is then 0.  Repeated rows are counted alike, an empty
    table gives no rows.  A column that has the name of a count already is an error.
    """
    if taken := {*COUNTS} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} exist already")
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(NOT_SPACE))

    def without(chars: str) -> Column:
        return F.length(whole) - F.length(F.translate(whole, chars, ""))

    return df.withColumns(
        {
            "n_words": bound(words, lambda w: F.size(w)).cast("long"),
            "word_chars": F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": without(SYMBOLS).cast("long"),
            "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(words),
            "_lines": bound(lines, lambda x: F.size(x)).cast("long"),
            "_upper": without(UPPER).cast("long"),
            "_shouts": without("!").cast("long"),
        }
    )


def features() -> dict[str, Column]:
    """The features over the columns of ``counts``."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "duplicate_lines": F.col("n_dup_lines") / F.greatest("_lines", F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / words,
        "capitals": F.col("_upper") / chars,
        "shouts": F.col("_shouts") / words,
    }


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` if ``above``, else ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def binned(self) -> Column:
        return F.col(self.feature) > self.bin if self.above else F.col(self.feature) <= self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a text that meets one is rejected, all others are kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule(self) -> Column:
        """Number of the first rule met, from 1; 0 if none."""
        met = [F.when(_all([c.column() for c in conditions]), n) for n, conditions in enumerate(self.rules, 1)]
        return F.coalesce(*met, F.lit(0))

    def __str__(self) -> str:
        return "\n".join(f"{n}. reject if " + " and ".join(map(str, r)) for n, r in enumerate(self.rules, 1))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    """Information that a condition adds, times the rejected rows it keeps."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p and p0 else 0.0


def fit(
    sample: DataFrame,
    text: str = "text",
    label: str = "label",
    key: str = "doc_id",
    *,
    max_rules: int = 8,
    max_conditions: int = 3,
    precision: float = 0.99,
    least_rows: int = 5,
    seed: int = 3,
) -> DecisionList:
    """Learn rules that reject label 0, from all rows of a bounded sample.

    A third of them is kept for pruning.  Without rows of both labels there are no rules.
    """
    some = sample.where(F.col(label).isin(0, 1))
    made = features()
    fold = (F.pmod(F.xxhash64(F.lit(seed), "_key"), F.lit(3)) == 0).cast("int")
    rows = counts(some.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.col(label).alias("label"))).select(
        "label", fold.alias("kept"), *[c.alias(n) for n, c in made.items()]
    )
    rows = written(rows, "rules-features")
    # Quantiles of either label, so that both tails have some.
    share = F.array(*[F.lit(q) for q in (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)])
    found = rows.groupBy("label").agg(*[F.percentile_approx(n, share, 10_000).alias(n) for n in made]).collect()
    if len(found) < 2:
        return DecisionList(())
    cuts = {}
    for n in made:  # midway between neighbouring quantiles, which leaves a margin on both sides
        values = sorted({v for row in found for v in row[n]})
        cuts[n] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    # Bin k holds the values above k thresholds.
    bins = [sum(((F.col(n) > t).cast("int") for t in cuts[n]), F.lit(0)).alias(n) for n in made]
    cells = written(rows.select("label", "kept", *bins).groupBy("label", "kept", *made).agg(F.count("*").alias("n")), "rules-cells")
    taken: list[tuple[Condition, ...]] = []
    left = cells
    while len(taken) < max_rules:
        rule = _grown(left, cuts, max_conditions, least_rows, precision)
        if not rule:
            break
        taken.append(rule)
        left = left.where(~_all([c.binned() for c in rule]))
    return DecisionList(tuple(taken))


def fit_on_labels(docs: DataFrame, marks: DataFrame, max_rows: int = 20_000, seed: int = 3, **options) -> DecisionList:
    """Learn from at most ``max_rows`` of the documents in ``marks`` (doc_id, label), by a seeded hash."""
    sample = sampled_texts(docs, marks.select("doc_id", "label"), "doc_id", max_rows, seed)
    return fit(sample, seed=seed, **options)


def _statistics(cells: DataFrame, names: list[str]) -> dict[tuple[str, int, int, int], int]:
    """Rows by (feature, bin, label, kept): some hundred numbers."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("bin")) for n in names])
    long = cells.select("label", "kept", "n", F.explode(pairs).alias("x"))
    found = long.groupBy("x.feature", "x.bin", "label", "kept").agg(F.sum("n").alias("n"))
    return {(r["feature"], r["bin"], r["label"], r["kept"]): r["n"] for r in found.collect()}


def _grown(
    cells: DataFrame, cuts: dict[str, list[float]], most: int, least_rows: int, precision: float
) -> tuple[Condition, ...] | None:
    """One rule: grown on two thirds, pruned and judged on the last; None if none is good enough."""
    rule: list[Condition] = []
    kept: list[tuple[int, int]] = []  # (label 0, label 1) rows of the last third under each prefix
    inside = cells
    while len(rule) < most:
        count = _statistics(inside, list(cuts))

        def total(name: str, bins: range, label: int, fold: int) -> int:
            return sum(count.get((name, b, label, fold), 0) for b in bins)  # noqa: B023

        name = next(iter(cuts))
        every = range(len(cuts[name]) + 1)
        p0, n0 = total(name, every, 0, 0), total(name, every, 1, 0)
        if not p0 or not n0:
            break
        options = []
        for name, thresholds in cuts.items():
            for k, threshold in enumerate(thresholds):
                for above in (True, False):
                    bins = range(k + 1, len(thresholds) + 1) if above else range(k + 1)
                    p, n = total(name, bins, 0, 0), total(name, bins, 1, 0)
                    if p >= least_rows:
                        condition = Condition(name, above, threshold, k)
                        # Of equal gains the threshold that leaves more texts alone.
                        options.append((_gain(p0, n0, p, n), k if above else -k, condition, bins))
        gain, _, condition, bins = max(options, key=lambda o: o[:2], default=(0.0, 0, None, None))
        if gain <= 0:
            break
        rule.append(condition)
        kept.append((total(condition.feature, bins, 0, 1), total(condition.feature, bins, 1, 1)))
        inside = inside.where(condition.binned())
    if not rule:
        return None
    worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in kept]
    size = max(range(len(rule)), key=lambda i: (worth[i], -i)) + 1
    p, n = kept[size - 1]
    if p < max(1, least_rows // 2) or p < precision * (p + n):
        return None
    return tuple(rule[:size])
