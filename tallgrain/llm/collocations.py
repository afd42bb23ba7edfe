"""Phrase collocations by stripes.

A stripe belongs to a prefix and counts the words that follow it.  Tasks build stripes of one-word
prefixes from their texts, then stripes of three-word prefixes; equal prefixes meet and their
stripes are added element by element.  The added stripes hold everything that is asked for:

* an element is the count of the prefix extended by that word (phrases of two and four words),
* a stripe's total, the ends of pieces included, is the count of the prefix itself (one and three),
* the largest element that extends a phrase says whether a longer phrase subsumes it.

A phrase is rare if two neighbours in it are, so the pairs of the first stripes leave most of the
longer ones out: their hashes set bits of a field whose size is bounded, and a pair without its
bit is rare for sure.  Where the field is full of bits, more moves and the results are the same.

Tasks add up before anything moves, so the commonest prefix is a row a task.  A stripe that is long
for its task is cut by a hash of the following word, and its parts are added apart; a mark tells
the place of the uncut ones that there are such parts, and only then are sums passed on to be
added once more.  Rare elements are dropped only where their sum is complete.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mixed, written
from .simhash import _LOWER as LOWER

#: What a byte is: 0 of a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
#: Bytes of text that become stripes together; a longer text is one step of its own.
STEP_BYTES = 1 << 22
#: Places of words that are sorted together, so that three word numbers fit a 64-bit key.
STEP_WORDS = (1 << 20) - 1
#: A stripe of more words than this, and than a 1,024th of its step, is cut into parts.
LONG, PARTS = 64, 16

#: Bits of the field of frequent pairs: so many for each, between these bounds.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27

STRIPES = "width int, lang string, prefix string, part int, cut boolean, total long, nexts array<string>, counts array<long>"
NAMES = [c.split()[0] for c in STRIPES.split(", ")]
#: Columns of which rows are parts of one stripe, in the order of sorting.
ORDER = ["prefix", "lang", "width", "part"]


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, piece of each, text of each) of lower-cased texts."""
    raw = b"\n".join(texts)
    data = np.frombuffer(raw, np.uint8)
    kind = KIND[data]
    edge = np.diff(np.concatenate([[0], (kind == 0).view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    kept = np.ascontiguousarray(data[kind == 0])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(kept))
    piece = np.cumsum(kind == 2, dtype=np.int64)[start] if len(start) else start
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return words, piece, np.searchsorted(bounds, start, "right")


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where any of some sorted arrays changes, the first place included."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _rows(width: int, names: pa.Array, lang: pa.Array, codes: list[np.ndarray], most: float) -> pa.RecordBatch:
    """Stripes of the places whose words are numbered by ``codes``: language, prefix, next word or 0.

    Stripes of more than ``most`` words are cut.
    """
    order = np.lexsort((codes[-1], _key(codes[:-1])))
    codes = [c[order] for c in codes]
    element = _heads(*codes)
    count = np.diff(np.append(element, len(order)))
    codes = [c[element] for c in codes]
    head = _heads(*codes[:-1])
    row = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(element))))
    total = np.add.reduceat(count, head)
    ends = codes[-1] == 0
    after, n = codes[-1], count
    part = np.zeros(len(after), np.int64)
    sizes = np.bincount(row[~ends], minlength=len(head))
    long = sizes > most
    cut = long[row] & ~ends
    if cut.any():
        far, back = np.unique(after[cut], return_inverse=True)
        place = [1 + zlib.crc32(w.as_py().encode()) % PARTS for w in names.take(pa.array(far - 1))]
        part[cut] = np.array(place)[back]
    # One row for each part of each prefix; the ends of pieces, and the mark of a cut, are in part 0.
    moved = np.bincount(row[cut], weights=n[cut], minlength=len(head)).astype(np.int64)
    order = np.argsort(row[~ends] * (PARTS + 1) + part[~ends], kind="stable")
    row_, part_, after_, n_ = (x[~ends][order] for x in (row, part, after, n))
    first = _heads(row_, part_) if len(row_) else np.zeros(0, np.int64)
    listed = np.diff(np.append(first, len(row_)))
    whole = np.setdiff1d(np.arange(len(head)), row_[first][part_[first] == 0])  # prefixes without a list in part 0
    prefix = np.concatenate([row_[first], whole])
    parts = np.concatenate([part_[first], np.zeros(len(whole), np.int64)])
    sums = np.add.reduceat(n_, first) if len(first) else np.zeros(0, np.int64)
    totals = np.where(parts == 0, (total - moved)[prefix], np.concatenate([sums, np.zeros(len(whole), np.int64)]))
    bounds = pa.array(np.concatenate([[0], np.cumsum(np.concatenate([listed, np.zeros(len(whole), np.int64)]))]), pa.int32())
    at = head[prefix]
    spelled = [names.take(pa.array(c[at] - 1)) for c in codes[1:-1]]
    texts = pc.binary_join_element_wise(*spelled, pa.scalar(" ", pa.large_string())) if width > 1 else spelled[0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(prefix), width, np.int32)),
            lang.take(pa.array(codes[0][at])).cast(pa.string()),
            texts.cast(pa.string()),
            pa.array(parts.astype(np.int32)),
            pa.array(long[prefix] & (parts == 0)),
            pa.array(totals),
            pa.ListArray.from_arrays(bounds, names.take(pa.array(after_ - 1)).cast(pa.string())),
            pa.ListArray.from_arrays(bounds, pa.array(n_)),
        ],
        NAMES,
    )


def _key(codes: list[np.ndarray]) -> np.ndarray:
    """One number for a language and up to three words, ordered like them: below 2^20 languages and words."""
    _, first = np.unique((codes[0].astype(np.int64) << 32) | codes[1], return_inverse=True)
    for other in codes[2:]:
        first = (first << 21) | other
    return first


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings."""
    return np.array([xxhash.xxh64_intdigest(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def pair_bits(lang: np.ndarray, one: np.ndarray, two: np.ndarray, size: int) -> np.ndarray:
    """Bits of pairs in a field of ``size`` bits, from the hashes of language and words."""
    return mixed(mixed(mixed(lang) + one) + two) & np.uint64(size - 1)


def pair_field(pairs: DataFrame) -> np.ndarray:
    """The field of bits of the pairs in (lang, phrase), eight to a byte."""
    size = LEAST_BITS
    wanted = min(MOST_BITS, BITS_EACH * pairs.count())
    while size < wanted:
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, one, two = (_hashes(c) for c in batch.columns)
            bits = np.unique(pair_bits(lang, one, two, size))
            place, first = np.unique(bits // np.uint64(64), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (bits % np.uint64(64)), first) if len(bits) else bits
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(value.view(np.int64))], ["place", "bits"])

    words = [F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)]
    found = pairs.select("lang", *words).mapInArrow(run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits"))
    field = np.zeros(size // 64, np.uint64)
    rows = found.toArrow()  # a number for every 64 bits of the field at most
    field[rows.column("place").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return field


def stripes(
    df: DataFrame,
    lang: str,
    text: str,
    field: Broadcast | None = None,
    step_bytes: int = STEP_BYTES,
    step_words: int = STEP_WORDS,
    long: int = LONG,
) -> DataFrame:
    """Each task's stripes of one-word prefixes, or, given a field of frequent pairs, of three-word ones.

    The last three sizes only steer the work.
    """
    named = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text))

    def step(langs: pa.Array, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        words, piece, doc = words_of(texts)
        if not len(words):
            return
        words, langs = words.dictionary_encode(), langs.dictionary_encode()
        names = words.dictionary
        own = np.asarray(langs.indices)[doc].astype(np.int64)
        code = np.asarray(words.indices).astype(np.int64) + 1
        later = []
        for k in (1, 2, 3) if field else (1,):
            w = np.zeros(len(code), np.int64)
            w[:-k] = np.where(piece[k:] == piece[:-k], code[k:], 0)
            later.append(w)
        if field:
            spelled, tongue = _hashes(names), _hashes(langs.dictionary)
            often = later[0] > 0
            size = 64 * len(field.value)
            bits = pair_bits(tongue[own[often]], spelled[code[often] - 1], spelled[later[0][often] - 1], size)
            often[often] = (field.value[bits // np.uint64(64)] >> (bits % np.uint64(64))) & np.uint64(1) > 0
            full = np.zeros(len(code), bool)
            full[:-1] = often[:-1] & often[1:] & (later[1][:-1] > 0)
            later[2][:-2] = np.where(often[2:], later[2][:-2], 0)  # what follows a rare pair counts as an end
            own, code, later = own[full], code[full], [w[full] for w in later]
        for i in range(0, len(code), step_words):
            some = [x[i : i + step_words] for x in (own, code, *later)]
            most = max(long, len(some[0]) / 1024)
            spelled = names
            if len(names) > step_words:  # number the words of this step anew
                every, back = np.unique(np.concatenate([[0], *some[1:]]), return_inverse=True)
                spelled = names.take(pa.array(every[every > 0] - 1))
                some = [some[0], *np.split(back[1:], len(some) - 1)]
            yield _rows(3 if field else 1, spelled, langs.dictionary, some, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, langs = [], 0, []
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                lowered = (value.as_py() or "").encode().translate(LOWER)
                if held and size + len(lowered) > step_bytes:
                    yield from step(pa.array(langs, pa.string()), held)
                    held, size, langs = [], 0, []
                held.append(lowered)
                langs.append(name.as_py())
                size += len(lowered)
        if held:
            yield from step(pa.array(langs, pa.string()), held)

    return named.mapInArrow(run, STRIPES)


PHRASES = "lang string, phrase string, words int, n long, open boolean"


def added(parts: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n, open): equal prefixes' stripes added element by element.

    Where ``open`` is false, ``n`` is a phrase's whole count and at least ``least``; other rows are
    parts of counts.  A phrase of no words stands for its language and counts all words.
    """

    def merge(some: pa.Table) -> tuple[np.ndarray, ...]:
        """(first row of each prefix, total, prefix of each element, next word, count)."""
        columns = [some.column(c).combine_chunks() for c in ORDER]
        new = np.ones(some.num_rows, bool)
        if some.num_rows > 1:
            changed = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)) for c in columns]
            new[1:] = np.logical_or.reduce([c.to_numpy(zero_copy_only=False) for c in changed])
        head = np.flatnonzero(new)
        total = np.add.reduceat(some.column("total").to_numpy(), head)
        nexts, counts = some.column("nexts").combine_chunks(), some.column("counts").combine_chunks()
        owner = np.repeat(np.cumsum(new) - 1, np.diff(nexts.offsets.to_numpy()))
        word = nexts.flatten().dictionary_encode()
        n = counts.flatten().to_numpy()
        key = owner * max(1, len(word.dictionary)) + np.asarray(word.indices).astype(np.int64)
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = _heads(key) if len(key) else np.zeros(0, np.int64)
        n = np.add.reduceat(n, first) if len(first) else n
        key = key[first]
        size = max(1, len(word.dictionary))
        return head, total, key // size, word.dictionary.take(pa.array(key % size)), n

    def one_row(some: pa.Table) -> pa.Table:
        """Rows of one prefix as one row."""
        _, total, _, word, n = merge(some)
        row = some.slice(0, 1)
        marked = pc.any(some.column("cut")).as_py()
        put = {
            "cut": pa.array([marked]),
            "total": pa.array(total),
            "nexts": pa.ListArray.from_arrays(pa.array([0, len(word)], pa.int32()), word),
            "counts": pa.ListArray.from_arrays(pa.array([0, len(word)], pa.int32()), pa.array(n)),
        }
        for name, column in put.items():
            row = row.set_column(NAMES.index(name), name, column)
        return row

    def settle(some: pa.Table, sums: dict[str, int]) -> Iterator[pa.RecordBatch]:
        head, total, owner, word, n = merge(some)
        width, part = (some.column(c).to_numpy()[head] for c in ("width", "part"))
        marked = np.maximum.reduceat(some.column("cut").to_numpy(zero_copy_only=False).astype(np.int8), head) > 0
        open_ = marked | (part > 0)
        lang, prefix = (some.column(c).combine_chunks().take(pa.array(head)) for c in ("lang", "prefix"))
        one = width == 1
        for name, size in zip(lang.filter(pa.array(one)).to_pylist(), total[one].tolist()):
            sums[name] = sums.get(name, 0) + size
        keep = np.flatnonzero((total >= least) | open_)
        yield pa.RecordBatch.from_arrays(
            [lang.take(pa.array(keep)), prefix.take(pa.array(keep)), pa.array(width[keep]), pa.array(total[keep]), pa.array(open_[keep])],
            ["lang", "phrase", "words", "n", "open"],
        )
        keep = np.flatnonzero((n >= least) | open_[owner])
        if len(keep):
            at = pa.array(owner[keep])
            phrase = pc.binary_join_element_wise(prefix.take(at), word.take(pa.array(keep)).cast(pa.string()), " ")
            yield pa.RecordBatch.from_arrays(
                [lang.take(at), phrase, pa.array(width[owner[keep]] + np.int32(1)), pa.array(n[keep]), pa.array(open_[owner[keep]])],
                ["lang", "phrase", "words", "n", "open"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            some = pa.Table.from_batches([batch])
            some = some if held is None else pa.concat_tables([held, some])
            last = [some.column(c)[-1] for c in ORDER]
            same = [np.asarray(pc.equal(some.column(c), value)) for c, value in zip(ORDER, last)]
            cut = int(np.argmax(np.logical_and.reduce(same)))  # the last prefix may go on in the next batch
            if cut:
                yield from settle(some.slice(0, cut).combine_chunks(), sums)
            held = one_row(some.slice(cut).combine_chunks())
        if held is not None:
            yield from settle(held, sums)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.string()),
                    pa.array([""] * len(sums), pa.string()),
                    pa.array(np.zeros(len(sums), np.int32)),
                    pa.array(list(sums.values()), pa.int64()),
                    pa.array([True] * len(sums)),
                ],
                ["lang", "phrase", "words", "n", "open"],
            )

    return parts.repartition(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, PHRASES)


def phrases(df: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, **sizes: int) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of one to four words with at least ``least`` occurrences.

    ``words`` is 0 in the row of each language that counts all its words.
    """

    def whole(parts: DataFrame, label: str) -> DataFrame:
        sums = written(added(parts, least), f"{label}-sums")
        again = sums.where("open").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
        again = again.where((F.col("n") >= least) | (F.col("words") == 0))
        return written(sums.where("not open").drop("open").unionByName(again), label)

    short = whole(stripes(df, lang, text, **sizes), "collocation-pairs")
    field = df.sparkSession.sparkContext.broadcast(pair_field(short.where("words = 2")))
    return short.unionByName(whole(stripes(df, lang, text, field, **sizes), "collocation-phrases"))


def _wide(column: str):
    return F.col(column).cast("decimal(19,0)")


def collocations(
    df: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, share: int = 80, top: int = 2000, **sizes: int
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of two to four words per language.

    Texts are lower-cased in A-Z and split at punctuation and line ends into pieces, those at blanks
    and tabs into words.  ``a`` counts a phrase inside pieces, overlaps included; cutting it into two
    phrases that occur l and r times gives ``floor(2000000 a / (l + r))``, and the lowest cut counts
    (ties: the shortest first part).  A phrase inside a longer one that occurs at least ``share`` percent as
    often is dropped; ``n`` counts all words of the language.  Ranks go by score, then ``a``, both
    descending, then phrase in UTF-8 order.

    Null and empty texts hold no words, a null language is ``und``.  Repeated rows count again.
    An empty table gives no rows.  Other columns take no part, whatever their names.
    """
    found = phrases(df, lang, text, least, **sizes)
    totals = found.where("words = 0").select("lang", F.col("n").alias("n_lang"))
    counts = found.where("words > 0")
    chosen = counts.where("words > 1").withColumn("list", F.split("phrase", " "))

    # Any longer phrase of at least that share has one in it that is longer by a single word.
    shorter = F.explode(F.array(F.lit(1), F.lit(2))).alias("from")
    inner = chosen.where("words > 2").select("lang", "list", "words", "n", shorter)
    inner = inner.select("lang", F.array_join(F.slice("list", F.col("from"), F.col("words") - 1), " ").alias("phrase"), "n")
    longest = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    subsumed = (_wide("longer") * 100 >= _wide("n") * share) & F.col("longer").isNotNull()
    kept = chosen.join(longest, ["lang", "phrase"], "left").where(~F.coalesce(subsumed, F.lit(False)))

    cuts = kept.select("lang", "phrase", "n", "list", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        "k",
        F.array_join(F.slice("list", 1, F.col("k")), " ").alias("one"),
        F.array_join(F.slice("list", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("two"),
    )
    firsts = counts.select("lang", F.col("phrase").alias("one"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("two"), F.col("n").alias("r"))
    scored = cuts.join(firsts, ["lang", "one"]).join(rests, ["lang", "two"])
    scored = scored.withColumn("score", F.expr("(cast(2000000 as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = best.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    near = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order)))
    last = near.where(F.col("rank") <= top).drop("deal", "rank")
    ranked = last.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_lang").alias("n"), "score"
    )
