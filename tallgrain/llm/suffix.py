"""Suffix-array dedup: maximal repeats from the common-prefix intervals of an enhanced suffix array.

Removes every byte covered by a string of ``width`` bytes that also starts earlier (in a document
of smaller key, or earlier in the same one).  Each such string lies in a maximal repeat: a string
of at least ``width`` bytes whose occurrences can't all be extended by one same byte.  Removing all
occurrences but the first of every maximal repeat removes exactly those bytes.

A suffix array over a whole corpus can't be held anywhere, so suffixes are first dealt by content.

1. *Anchors.*  The anchor of a string of ``width`` bytes is the ``GRAM`` bytes in it with the least
   hash, so equal strings have equal anchors.  Consecutive starts with one anchor form a range, a
   row for some 30 bytes of text.  Ranges of equal anchor and equal text collapse to the first one,
   in blocks before the shuffle and for good after it; ranges whose anchor is met once are done.
2. *Suffix arrays.*  What is left, ranges whose anchor stands in different texts, is dealt by
   anchor with the text of each range.  A task sorts all suffixes of many anchors at once, takes
   the longest common prefixes of neighbours, and scans them with a stack; each interval of at least
   ``width`` whose occurrences follow different bytes is a maximal repeat with all its occurrences.
3. *Hot anchors.*  Ranges of an anchor with more than ``GROUP`` different ones are cut in two and
   dealt by twice as much of their text.  Where that still gathers more than ``GROUP``, it is dealt
   in several parts: each part's suffix array settles what is inside it, and only the first
   occurrence of each string is compared between the parts, by the string's hash.

No step gathers a group: a hot passage is one row a block after step 1, and a hot anchor is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, mixed, steps, text_bytes, written

#: Bytes of a string that, repeated, is removed; and of an anchor inside it.
WIDTH, GRAM = 100, 32
#: Ranges that are collapsed together before the shuffle.
BLOCK = 1 << 19
#: Different ranges of one anchor in a block from which the anchor is dealt by text, too.
MANY = 64
#: Different ranges of one anchor that one suffix array takes; beyond, the anchor is cut.
GROUP = 4096

PLAIN, OPEN, MARK, SPAN = 0, 1, 2, 3

_HASH = Hasher(seed=31)
_SALTS = mixed(np.arange(1, 65, dtype=np.uint64))


def least_places(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(least value, its first place) in each ``width`` neighbours, by doubling."""
    value, place, have = h, np.arange(len(h), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        a, b = value[:-step], value[step:]
        right = b < a
        value = np.where(right, b, a)
        place = np.where(right, place[step:], place[:-step])
        have += step
    return value, place


def anchor_ranges(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(document, start, number of starts, anchor hash, text hash) of every range of starts."""
    empty = np.zeros(0, np.int64)
    if len(data) < width:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    prefix = _HASH.prefix(data)
    value, place = least_places(_HASH.windows(prefix, GRAM), width - GRAM + 1)
    last = np.repeat(offsets[1:], np.diff(offsets))[: len(value)]
    at = np.flatnonzero(np.arange(len(value)) + width <= last)  # inside one document
    anchor = place[at]
    first = np.ones(len(at), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(at) != 1)
    head = np.flatnonzero(first)
    count = np.diff(np.append(head, len(at)))
    start = at[head]
    text = _HASH.spans(prefix, start, start + count - 1 + width)
    doc = np.searchsorted(offsets, start, "right") - 1
    return doc, start - offsets[doc], count, value[start], text


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any key."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def merged_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans sorted, with those of one document that touch or overlap joined."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    fresh = _runs(doc)
    # Running maximum of the ends inside a document: shift documents apart first.
    shift = np.cumsum(fresh).astype(np.int64) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    cut = np.ones(len(doc), bool)
    cut[1:] = fresh[1:] | ((start + shift)[1:] > reach[:-1])
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(doc)) - 1
    return doc[head], start[head], reach[tail] - shift[head]


def _range_batch(bucket, text, doc, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket.view(np.int64)), pa.array(text.view(np.int64)), pa.array(doc), pa.array(at)],
        ["bucket", "text_hash", "doc", "at"],
    )


def _collapsed(doc, start, count, anchor, text, width: int, many: int) -> Iterator[pa.RecordBatch]:
    """A block's ranges, each text once, and the spans of the others."""
    order = np.lexsort((start, doc, text, anchor))
    doc, start, count, anchor, text = (x[order] for x in (doc, start, count, anchor, text))
    head = np.flatnonzero(_runs(anchor, text))
    which = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(doc))))
    first = (doc == doc[head][which]) & (start == start[head][which])  # repeated rows of a document tie
    gone = ~first
    d, s, e = merged_spans(doc[gone], start[gone], start[gone] + count[gone] - 1 + width)
    if len(d):
        yield _range_batch(mixed(d.view(np.uint64)), (e - s).view(np.uint64), d, s << 10 | SPAN)
    doc, start, count, anchor, text = (x[head] for x in (doc, start, count, anchor, text))
    new = _runs(anchor)
    top = np.flatnonzero(new)
    size = np.diff(np.append(top, len(doc)))
    hot = np.repeat(size > many, size)
    bucket = np.where(hot, anchor ^ _SALTS[(text & np.uint64(63)).astype(np.int64)], anchor)
    yield _range_batch(bucket, text, doc, start << 10 | count << 2 | np.where(hot, OPEN, PLAIN))
    mark = top[size > many]  # tells the anchor's other ranges that there are more
    yield _range_batch(anchor[mark], text[mark], doc[mark], start[mark] << 10 | count[mark] << 2 | MARK)


def _ranges(docs: DataFrame, width: int, block: int, many: int) -> DataFrame:
    """Ranges of all documents, collapsed by blocks; ``docs`` has (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            for i, j in steps(offsets):
                doc, *rest = anchor_ranges(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                held.append((ids[i:j][doc], *rest))
                rows += len(doc)
                if rows >= block:
                    yield from _collapsed(*map(np.concatenate, zip(*held)), width, many)
                    held, rows = [], 0
        if rows:
            yield from _collapsed(*map(np.concatenate, zip(*held)), width, many)

    return docs.select("doc", "text").mapInArrow(run, "bucket long, text_hash long, doc long, at long")


def _column(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return batch.column(k).to_numpy(zero_copy_only=False)


def _settled(ranges: DataFrame, width: int) -> DataFrame:
    """(doc, start, size, anchor, open): spans to remove, and first ranges still to compare.

    Rows arrive sorted by bucket, text, document and start, so one pass with the last bucket held
    over suffices.
    """
    names = ["doc", "start", "size", "anchor", "open"]

    def settle(bucket, text, doc, at) -> pa.RecordBatch:
        flag, start, count = at & 3, at >> 10, at >> 2 & 255
        ready = flag == SPAN
        d, s, e = [doc[ready]], [start[ready]], [start[ready] + text[ready]]
        bucket, text, doc, flag, start, count = (x[~ready] for x in (bucket, text, doc, flag, start, count))
        new_bucket, new_text = _runs(bucket), _runs(bucket, text)
        head = np.flatnonzero(new_text)
        which = np.cumsum(new_text) - 1
        first = (doc == doc[head][which]) & (start == start[head][which])
        gone = ~first & (flag != MARK)
        d.append(doc[gone])
        s.append(start[gone])
        e.append(start[gone] + count[gone] - 1 + width)
        doc_, start_, end_ = merged_spans(*map(np.concatenate, (d, s, e)))
        group = np.cumsum(new_bucket) - 1
        texts = np.bincount(group, new_text) if len(group) else np.zeros(0)
        marked = np.bincount(group, flag == MARK) if len(group) else np.zeros(0)
        more = first & (flag != MARK) & ((texts[group] > 1) | (marked[group] > 0) | (flag == OPEN))
        salt = _SALTS[(text[more].view(np.uint64) & np.uint64(63)).astype(np.int64)]
        anchor = np.where(flag[more] == OPEN, bucket[more].view(np.uint64) ^ salt, bucket[more].view(np.uint64))
        columns = [
            np.concatenate([doc_, doc[more]]),
            np.concatenate([start_, start[more]]),
            np.concatenate([end_ - start_, count[more]]),
            np.concatenate([np.zeros(len(doc_), np.int64), anchor.view(np.int64)]),
            np.concatenate([np.zeros(len(doc_), bool), np.ones(int(more.sum()), bool)]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, _column(batch, k)]) for k, h in enumerate(held)]
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield settle(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield settle(*held)

    dealt = ranges.repartition("bucket").sortWithinPartitions("bucket", "text_hash", "doc", "at")
    return dealt.mapInArrow(run, "doc long, start long, size long, anchor long, open boolean")


class SuffixArray:
    """Suffixes at the starts of some ranges, sorted, with longest common prefixes.

    ``texts`` holds each range's starts and the ``width - 1`` bytes after the last one; a suffix
    goes on to the end of its range.
    """

    def __init__(self, texts: list[bytes], doc: np.ndarray, start: np.ndarray, width: int):
        self.width = width
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        most = int(size.max())
        padded = np.zeros((len(texts), 2 * most), np.uint8)
        joined = np.frombuffer(b"".join(texts), np.uint8)
        row = np.repeat(np.arange(len(texts)), size)
        inner = np.arange(len(joined)) - np.repeat(np.cumsum(size) - size, size)
        padded[row, inner] = joined
        count = size - width + 1
        which = np.repeat(np.arange(len(texts)), count)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        suffix = np.lib.stride_tricks.sliding_window_view(padded, most, axis=1)[which, offset]
        order = np.argsort(suffix.view(f"S{most}").ravel(), kind="stable")
        suffix, which, offset = suffix[order], which[order], offset[order]
        self.doc, self.place = doc[which], start[which] + offset
        self.range, self.length = which, size[which] - offset
        #: The byte before; -1 at the start of a range, which counts as unlike any other.
        self.before = np.where(offset > 0, padded[which, offset - 1].astype(np.int64), -1)
        self.common = np.zeros(len(which), np.int64)
        for i in range(1, len(which), 1 << 14):  # in slices, to bound memory
            j = min(len(which), i + (1 << 14))
            unlike = suffix[i:j] != suffix[i - 1 : j - 1]
            same = np.where(unlike.any(axis=1), unlike.argmax(axis=1), most)
            self.common[i:j] = np.minimum(same, np.minimum(self.length[i:j], self.length[i - 1 : j - 1]))

    def repeats(self) -> Iterator[tuple[int, int, int]]:
        """(first place, last place, length) in sorted order of every maximal repeat.

        Stack scan of the common prefixes: an interval opens where they rise and closes where they
        fall.  Whether its occurrences follow different bytes is gathered on the way; an interval
        inherits that from the intervals inside it.
        """
        near = self.common >= self.width
        edge = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
        common, before = self.common.tolist(), self.before.tolist()
        for low, high in zip(edge[::2].tolist(), edge[1::2].tolist()):
            # Suffixes low - 1 .. high - 1 share width bytes with their neighbours.
            stack: list[list] = []  # [length, first place, byte before, unlike bytes met]
            for i in range(low, high + 1):
                here = common[i] if i < high else 0
                first, byte, unlike = i - 1, before[i - 1], before[i - 1] < 0
                while stack and stack[-1][0] > here:
                    length, left, seen, differ = stack.pop()
                    differ = differ or unlike or seen != byte
                    if differ:
                        yield left, i - 1, length
                    first, byte, unlike = left, seen, differ
                if i == high:
                    break
                if stack and stack[-1][0] == here:
                    stack[-1][3] = stack[-1][3] or unlike or stack[-1][2] != byte
                else:
                    stack.append([here, first, byte, unlike])

    def spans(self) -> tuple[np.ndarray, ...]:
        """Merged (document, start, end) of all occurrences but the first of each maximal repeat."""
        d, s, e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for left, right, length in self.repeats():
            doc, place = self.doc[left : right + 1], self.place[left : right + 1]
            least = doc.min()
            later = (doc != least) | (place != place[doc == least].min())
            d.append(doc[later])
            s.append(place[later])
            e.append(place[later] + length)
        return merged_spans(*map(np.concatenate, (d, s, e)))

    def firsts(self) -> np.ndarray:
        """Places in sorted order of the first occurrence of each string of ``width`` bytes."""
        kind = np.cumsum(self.common < self.width)
        order = np.lexsort((self.place, self.doc, kind))
        return order[_runs(kind[order])]


def _compared(texts: DataFrame, width: int, group: int) -> DataFrame:
    """(doc, start, size, one, two): spans to remove, and first strings of hot anchors (size 0)."""
    names = ["doc", "start", "size", "one", "two"]

    def settle(anchor, hot, doc, start, text) -> Iterator[pa.RecordBatch]:
        array = SuffixArray(text, doc, start, width)
        d, s, e = array.spans()
        zero = np.zeros(len(d), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (d, s, e - s, zero, zero)], names)
        if hot.any():
            at = array.firsts()
            at = at[hot[array.range[at]]]
            joined = np.frombuffer(b"".join(text), np.uint8)
            size = np.fromiter(map(len, text), np.int64, len(text))
            base = np.cumsum(size) - size
            which = array.range[at]
            place = base[which] + array.place[at] - start[which]
            one = _HASH.spans(_HASH.prefix(joined), place, place + width)
            columns = (array.doc[at], array.place[at], np.zeros(len(at), np.int64), one.view(np.int64), anchor[which])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5
        text: list[bytes] = []

        def cut_off(n: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, text
            anchor, part, hot, doc, start = (h[:n] for h in held)
            yield from settle(anchor, hot > 0, doc, start, text[:n])
            held, text = [h[n:] for h in held], text[n:]

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                held = [np.concatenate([h, _column(some, k).astype(np.int64)]) for k, h in enumerate(held)]
                text += some.column(5).to_pylist()
                new = np.flatnonzero(_runs(held[0], held[1]))
                if len(text) >= group and new[-1]:
                    yield from cut_off(int(new[-1]))  # whole groups only
        if text:
            yield from cut_off(len(text))

    return texts.mapInArrow(run, "doc long, start long, size long, one long, two long")


def _between_parts(strings: DataFrame, width: int) -> DataFrame:
    """(doc, start, size): strings of hot anchors that another part has earlier."""

    def settle(one, two, doc, start) -> pa.RecordBatch:
        new = _runs(one, two)
        head = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        gone = (doc != doc[head][which]) | (start != start[head][which])
        d, s, e = merged_spans(doc[gone], start[gone], start[gone] + width)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (d, s, e - s)], ["doc", "start", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, _column(batch, k)]) for k, h in enumerate(held)]
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield settle(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield settle(*held)

    dealt = strings.select("one", "two", "doc", "start").repartition("one")
    return dealt.sortWithinPartitions("one", "two", "doc", "start").mapInArrow(run, "doc long, start long, size long")


def _halves(pieces: list[bytes], anchors: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, first start, number of starts, key): ranges cut in two, keyed by more of their text.

    Starts with more than ``half`` bytes before the anchor share the ``half + 1`` bytes before it;
    the others share what follows it.  Equal strings hold their anchor at the same place, so they
    fall into the same half with the same key.
    """
    prefix = _HASH.prefix(np.frombuffer(b"".join(pieces), np.uint8))
    grams, half, base = _HASH.windows(prefix, GRAM), (width - GRAM) // 2, 0
    out: list[tuple[int, int, int]] = []
    shared: list[tuple[int, int]] = []
    for i, (piece, anchor) in enumerate(zip(pieces, anchors)):
        starts = len(piece) - width + 1
        at = int(np.argmax(grams[base : base + len(piece) - GRAM + 1] == anchor))
        cut = min(max(at - half, 0), starts)
        if cut > 0:
            out.append((i, 0, cut))
            shared.append((base + at - half - 1, base + at + GRAM))
        if cut < starts:
            out.append((i, cut, starts - cut))
            shared.append((base + at, base + at - half + width))
        base += len(piece)
    low, high = np.array(shared, np.int64).reshape(-1, 2).T
    keys = _HASH.spans(prefix, low, high).view(np.int64).tolist()
    yield from ((*line, key) for line, key in zip(out, keys))


def _crowded(ranges: DataFrame, group: int) -> DataFrame:
    """Anchors with more than ``group`` ranges: a small table, written so that its size is known."""
    counted = ranges.groupBy("anchor").agg(F.count("*").alias("ranges"))
    return written(counted.where(F.col("ranges") > group), "repeats-crowded")


def _texts_of(docs: DataFrame, ranges: DataFrame, width: int, group: int) -> DataFrame:
    """The open ranges with their text, dealt by anchor; hot anchors by more text, then in parts."""
    dealt = ranges.join(_crowded(ranges, group), "anchor", "left").select(
        "doc", F.struct("anchor", F.col("ranges").isNotNull().alias("hot"), "start", "size").alias("r")
    )
    found = dealt.groupBy("doc").agg(F.collect_list("r").alias("ranges"))  # at most a document's length
    kinds = {"anchor": pa.int64(), "halved": pa.bool_(), "doc": pa.int64(), "start": pa.int64(), "text": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                out: list[tuple] = []
                hot: list[tuple] = []
                for doc, text, ranges in zip(*(some.column(k).to_pylist() for k in range(3))):
                    raw = text.encode()
                    for r in ranges:
                        a = r["start"]
                        line = (r["anchor"], False, doc, a, raw[a : a + r["size"] - 1 + width])
                        (hot if r["hot"] else out).append(line)
                if hot:
                    anchors = np.array([line[0] for line in hot], np.int64).view(np.uint64)
                    for k, low, n, key in _halves([line[-1] for line in hot], anchors, width):
                        _, _, doc, a, piece = hot[k]
                        out.append((key, True, doc, a + low, piece[low : low + n - 1 + width]))
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds.values())]
                    yield pa.RecordBatch.from_arrays(columns, list(kinds))

    made = docs.join(found, "doc").mapInArrow(run, "anchor long, halved boolean, doc long, start long, text binary")
    texts = written(made, "repeats-texts")
    crowded = F.col("ranges").isNotNull()
    parted = texts.where("halved").join(_crowded(texts.where("halved"), group), "anchor", "left").select(
        "anchor",
        F.when(crowded, F.pmod(F.xxhash64("doc", "start"), F.ceil(F.col("ranges") / group))).otherwise(0).alias("part"),
        crowded.cast("int").alias("hot"),
        *("doc", "start", "text"),
    )
    whole = texts.where("not halved").select("anchor", F.lit(0).alias("part"), F.lit(0).alias("hot"), "doc", "start", "text")
    return whole.unionByName(parted).repartition("anchor", "part").sortWithinPartitions("anchor", "part")


def _numbered(df: DataFrame, text: str, key: str) -> DataFrame:
    """``df`` with ``doc``: one number for each pair of key and text, in the order of the keys.

    It is the key itself where every text has one and no key has two texts.  Otherwise pairs are
    numbered after a sort by key and hash of the text, without gathering a key in one task, and the
    rows written once; texts without a key come after all others.
    """
    present = F.col(text).isNotNull()
    plain = F.when(present, F.col(key).cast("long"))
    marked = df.withColumns({"doc": plain, "_text_hash": F.when(present, F.xxhash64(text))})
    pairs = marked.where(present).select("doc", "_text_hash").distinct()
    if pairs.groupBy("doc").count().where("count > 1 or doc is null").isEmpty():
        return df.withColumn("doc", plain)
    numbers = pairs.orderBy(F.col("doc").asc_nulls_last(), "_text_hash")
    numbers = numbers.select(
        F.col("doc").alias("_doc"), F.col("_text_hash").alias("_hash"), F.monotonically_increasing_id().alias("_number")
    )
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    joined = marked.join(written(numbers, "repeats-numbers"), same, "left")
    return written(joined.select(*df.columns, F.col("_number").alias("doc")), "repeats-numbered")


def repeat_spans(
    df: DataFrame,
    text: str = "text",
    width: int = WIDTH,
    *,
    block: int = BLOCK,
    many: int = MANY,
    group: int = GROUP,
) -> DataFrame:
    """(doc, spans): for each ``doc`` with anything to remove, its sorted list of (start, size) in bytes.

    ``df`` comes from ``_numbered``; rows without a number have no text.  Rows that
    repeat a number count as one document read twice: neither is earlier than the other.
    ``block``, ``many`` and ``group`` steer the spread of work; results do not depend on them.
    """
    if width <= GRAM or width - GRAM + 1 > 255:
        raise ValueError(f"width must be between {GRAM + 1} and {GRAM + 254}")
    docs = df.where(F.col("doc").isNotNull()).select("doc", F.col(text).alias("text"))
    first = written(_settled(_ranges(docs, width, block, many), width), "repeats-ranges")
    second = written(_compared(_texts_of(docs, first.where("open"), width, group), width, group), "repeats-compared")
    third = _between_parts(second.where("size = 0"), width)
    spans = first.where("not open").select("doc", "start", "size")
    spans = spans.unionByName(second.where("size > 0").select("doc", "start", "size")).unionByName(third)
    return spans.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans"))


def _cut(raw: bytes, spans: list[dict] | None) -> tuple[list[tuple[int, int]], int]:
    """(kept pieces, number of maximal removed runs)."""
    kept, at, runs, reach = [], 0, 0, -1
    for span in spans or ():
        a, b = span["start"], span["start"] + span["size"]
        if a > reach:
            runs += 1
            kept.append((at, a))
        reach = max(reach, b)
        at = reach
    kept.append((at, len(raw)))
    return kept, runs


def _with_spans(df: DataFrame, text: str, key: str, width: int, **spread: int) -> DataFrame:
    """``df`` with ``spans``; different texts under one key are documents of their own."""
    numbered = _numbered(df, text, key)
    return numbered.join(repeat_spans(numbered, text, width, **spread), "doc", "left").drop("doc")


def digests(df: DataFrame, width: int = WIDTH, **spread: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row; null text is empty.

    Rows without a key come after all others, in the order of a hash of their texts.  Rows equal
    in key and text are one document, so neither is earlier than the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text or "").encode()
                kept, runs = _cut(raw, spans)
                rest = b"".join(raw[a:b] for a, b in kept)
                out.append((len(raw), len(raw) - len(rest), runs, hashlib.sha256(rest).hexdigest()))
            made = list(zip(*out)) or [()] * 4
            columns = [pa.array(c, k) for c, k in zip(made, [pa.int64()] * 3 + [pa.string()])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(df.select("doc_id", "text"), "text", "doc_id", width, **spread).select("doc_id", "text", "spans")
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept_text(text: str, spans: list[dict]) -> str:
    """The text without the removed bytes; a character goes only with all its bytes."""
    raw = text.encode()
    gone = np.zeros(len(raw) + 1, bool)
    for span in spans:
        gone[span["start"] : span["start"] + span["size"]] = True
    data = np.frombuffer(raw, np.uint8)
    head = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(head):
        return text
    whole = np.logical_and.reduceat(gone[:-1], head)
    keep = ~np.repeat(whole, np.diff(np.append(head, len(raw))))
    return data[keep].tobytes().decode()


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``df`` with repeated passages cut from ``text``; all rows and columns stay.

    A character is cut only if all its bytes are; a text may become empty, null stays null.
    """
    if {"spans", "doc", "_doc", "_text_hash", "_hash", "_number"} & set(df.columns):
        raise ValueError("columns 'spans', 'doc', '_doc', '_text_hash', '_hash' and '_number' are used inside")
    names = df.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            pairs = zip(columns[at].to_pylist(), batch.column(len(names)).to_pylist())
            columns[at] = pa.array([_kept_text(t, s) if t and s else t for t, s in pairs], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return _with_spans(df, text, key, width).select(*names, "spans").mapInArrow(run, df.schema)
