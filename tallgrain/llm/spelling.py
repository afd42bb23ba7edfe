"""Grouping of spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are near if one code point was put in, taken out or replaced.  With M the length of the
longer one that is so exactly if their common prefix and their common suffix together reach M - 1.
Words are rows of a matrix of code points, padded to one width; blocks of rows are compared with
each other, all pairs of a block pair at once, column by column from the left and from the right.

Blocks meet only where a near pair can be.  An edit leaves either the first or the last half of
the longer word untouched, so words meet under those halves, once for each M they can belong to.
Groups that are still large are dealt again in the same way: of the part that is still open, either
the first or the last half is untouched.  That ends with one open code point, where a group is no
larger than the alphabet.  A pair goes down the left branch if its common prefix covers the half,
else down the right one, so it meets once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .simhash import _LOWER as LOWER

#: Words that one task counts before it hands its counts on.
HELD_WORDS = 200_000
#: Largest group that is compared as it is.
GROUP = 256
#: Rows of a block, and entries of a block's matrix of code points.
BLOCK, BLOCK_CELLS = 128, 1 << 21


def run_counts(df: DataFrame, key: str, text: str, least: int, every: int) -> DataFrame:
    """(word, n) of the runs of letters of all texts, some of them with a code point deleted.

    With h the crc32 of ``<key>:<run>``, a run loses its code point ``h % length`` where ``every``
    divides h.  Only words of at least ``least`` code points count.
    """
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)  # greedy, so a match is a whole run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(total, pa.string()), "n": pa.array(total.values(), pa.int64())})
            total.clear()
            return out

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                lowered = (value.as_py() or "").encode().translate(LOWER).decode()
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in Counter(runs.findall(lowered)).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    total[word] += n
                if len(total) >= HELD_WORDS:
                    yield handed()
        yield handed()

    made = df.select(F.col(key).cast("string"), text).mapInArrow(run, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def _half(longest: Column, a: Column, open_: Column, below: Column) -> Column:
    """Both halves of the open part [a, a + open) of words of class ``longest``, as an array of structs."""
    c = F.ceil(open_ / 2).cast("int")
    return F.array(
        F.struct(longest.alias("longest"), (a + c).alias("a"), (open_ - c).alias("open"), below.alias("below")),
        F.struct(longest.alias("longest"), a.alias("a"), c.alias("open"), F.least(below, a + c).alias("below")),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, part) with the columns of ``part`` and a key of what all words of the group share."""
    rest = F.col("part.longest") - F.col("part.a") - F.col("part.open")
    fixed = F.xxhash64(F.expr("substring(word, 1, part.a)"), F.when(rest > 0, F.expr("right(word, part.longest - part.a - part.open)")).otherwise(F.lit("")))
    return rows.select("word", "n", "part.*", fixed.alias("fixed"))


GROUP_KEYS = ["longest", "a", "open", "below", "fixed"]


def groups(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """(word, n, longest, a, open, below, fixed): words dealt to groups of at most ``limit`` words.

    Beyond that limit only groups with one open code point are left as they are.
    """
    size = F.length("word")
    whole = F.lit(2**31 - 1)
    both = F.array(size, size + 1)
    parts = F.flatten(F.transform(both, lambda m: _half(m, F.lit(0), m, whole)))
    now, done = words.select("word", "n", F.explode(parts).alias("part")), None
    while True:
        keyed = written(_keyed(now), "spelling-groups")
        counted = keyed.groupBy(*GROUP_KEYS).agg(F.count("*").alias("_size"))
        full = written(counted.where((F.col("_size") > limit) & (F.col("open") > 1)).drop("_size"), "spelling-full")
        counted = counted.where("_size > 1").drop("_size")
        kept = keyed.join(counted.join(full, GROUP_KEYS, "left_anti"), GROUP_KEYS)
        done = kept if done is None else done.unionByName(kept)
        if full.isEmpty():
            return done
        halves = _half(F.col("longest"), F.col("a"), F.col("open"), F.col("below"))
        now = keyed.join(full, GROUP_KEYS).select("word", "n", F.explode(halves).alias("part"))


def code_points(words: list[str], width: int, right: bool) -> np.ndarray:
    """Matrix of code points, one word a row, filled up with 0 at the other end."""
    padded = [w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words]
    return np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).reshape(len(words), width)


def common(one: np.ndarray, two: np.ndarray, columns: range, asked: np.ndarray) -> np.ndarray:
    """Equal columns, counted from the first of ``columns`` up to the first difference, of the pairs asked for."""
    alive, out = asked.copy(), np.zeros(asked.shape, np.int32)
    for column in columns:
        alive &= one[:, column, None] == two[None, :, column]
        if not alive.any():
            break
        out += alive
    return out


class Rows:
    """Words of one class ``width``, sorted by group, as the blocks that are compared."""

    def __init__(self, words: list[str], keys: np.ndarray, width: int):
        self.words, self.width = words, width
        self.group = np.cumsum(np.concatenate([[0], (keys[1:] != keys[:-1]).any(axis=1)]))
        self.a, self.end, self.below = keys[:, 1], keys[:, 1] + keys[:, 2], keys[:, 3]
        self.long = np.fromiter(map(len, words), np.int64, len(words)) == width
        self.rows = max(1, min(BLOCK, BLOCK_CELLS // width))

    def tiles(self) -> Iterator[tuple[slice, slice]]:
        """Pairs of blocks that share a group."""
        n = len(self.words)
        behind = np.searchsorted(self.group, self.group, "right")  # the row behind each row's group
        for i in range(0, n, self.rows):
            first = slice(i, min(i + self.rows, n))
            for j in range(i, int(behind[first.stop - 1]), self.rows):
                yield first, slice(j, min(j + self.rows, n))

    def near(self, first: slice, second: slice) -> tuple[np.ndarray, np.ndarray]:
        """Places (i, j) of near words, i in one block and j in the other, each pair once."""
        asked = self.group[first, None] == self.group[None, second]
        asked &= self.long[first, None] | self.long[None, second]
        if first == second:
            asked &= ~np.tri(len(asked), dtype=bool)
        one, two = self.words[first], self.words[second]
        prefix = common(code_points(one, self.width, False), code_points(two, self.width, False), range(self.width), asked)
        backwards = range(self.width - 1, -1, -1)
        suffix = common(code_points(one, self.width, True), code_points(two, self.width, True), backwards, asked)
        asked &= prefix + suffix >= self.width - 1
        # What the group's key says is checked again: a hash may meet another.
        asked &= (prefix >= self.a[first, None]) & (prefix < self.below[first, None])
        asked &= suffix >= self.width - self.end[first, None]
        i, j = np.nonzero(asked)
        return i + first.start, j + second.start

    def best(self, n: np.ndarray) -> pa.RecordBatch | None:
        """(word, n_near, best_n, best) of every word with a near one."""
        found = [self.near(*tile) for tile in self.tiles()]
        i, j = (np.concatenate(x) for x in zip(*found))
        if not len(i):
            return None
        place = np.empty(len(self.words), np.int64)
        place[sorted(range(len(self.words)), key=self.words.__getitem__)] = np.arange(len(self.words))
        one, two = np.concatenate([i, j]), np.concatenate([j, i])
        order = np.lexsort((place[two], -n[two], one))
        one, two = one[order], two[order]
        head = np.flatnonzero(np.diff(one, prepend=-1))
        count = np.diff(np.append(head, len(one)))
        names = pa.array(self.words, pa.string())
        columns = [names.take(pa.array(one[head])), pa.array(count), pa.array(n[two[head]]), names.take(pa.array(two[head]))]
        return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def near_words(dealt: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): number of near words, the largest n among them, and whose it is.

    Ties go to the smallest word in code-point order.
    """

    def settle(some: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([some.column(k).to_numpy() for k in GROUP_KEYS], axis=1)
        words, n = some.column("word").to_pylist(), some.column("n").to_numpy()
        for width in np.unique(keys[:, 0]).tolist():
            at = np.flatnonzero(keys[:, 0] == width)  # sorted, so they stand together
            low, high = int(at[0]), int(at[-1]) + 1
            if (out := Rows(words[low:high], keys[low:high], width).best(n[low:high])) is not None:
                yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            some = pa.Table.from_batches([batch])
            some = some if held is None else pa.concat_tables([held, some])
            keys = np.stack([some.column(k).to_numpy() for k in GROUP_KEYS], axis=1)
            other = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last group may go on in the next batch
            if cut:
                yield from settle(some.slice(0, cut))
            held = some.slice(cut)
        if held is not None:
            yield from settle(held)

    names = ["word", "n", *GROUP_KEYS]
    typed = dealt.select("word", "n", *(F.col(k).cast("long") for k in GROUP_KEYS))
    parted = typed.repartition(*GROUP_KEYS).sortWithinPartitions(*GROUP_KEYS)
    found = parted.select(*names).mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root): the last word on the way from a word to its form, that one's form and so on.

    Each round doubles the length of the ways that have been followed.
    """
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        far = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        now = written(now.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "spelling-roots")
    return now


def variants(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, min_count: int = 2, every: int = 31, factor: int = 10
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``min_count`` occurrences.

    Words are counted by ``run_counts``.  A word's form is its near word of largest n (ties: the
    smallest) if that is at least ``factor`` times the word's own, else null; its root is where
    following forms ends, the word itself if it has none.

    Null and empty texts hold no words; a null key counts as empty text.  Repeated rows count again.
    An empty table has no words.  Other columns take no part, whatever their names.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, so that forms end")
    counted = run_counts(df, key, text, least, every).where(F.col("n") >= min_count)
    words = written(counted, "spelling-words")
    near = near_words(groups(words))
    has = F.col("best_n") >= factor * F.col("n")
    table = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(has, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Each step multiplies n by the factor at least, which bounds the steps.
    most, steps = words.agg(F.max("n")).first()[0] or 1, 0
    while min_count * factor ** (steps + 1) <= most:
        steps += 1
    found = roots(table.where(F.col("form").isNotNull()), max(0, steps - 1).bit_length())
    return table.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
