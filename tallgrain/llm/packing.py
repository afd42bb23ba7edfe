"""Packing documents into sequences whose tokens keep a target mixture of sources.

Each source is a queue of tokens.  Deficit round-robin visits the queues in rounds: a visit adds
the queue's quantum (its target share of a sequence) to its deficit, and as many packets of
``grain`` tokens leave the queue as the deficit pays for; what is left of it is carried to the
next round.  An empty queue gives up its share to the others.  What leaves is one stream, cut into
windows of ``width`` tokens, so every window is full and holds its target shares to within a
packet a queue; deficits are carried from window to window.

Rounds are not played one after the other.  After ``r`` rounds a queue has sent
``min(total, grain * floor((start + r * quantum) / grain))`` tokens, so any task finds the state
of all queues at any round, deficits included, from the totals of the queues alone: partitions
carry the deficits on without waiting for each other.  A document needs only its place in its
queue, which is a sum over earlier partitions.  Token ids never move for it.

The stream's end, shorter than a window, is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Characters of text whose segments are told apart together.
STEP_CHARS = 1 << 23
#: Pieces that are encoded together.
JOINED = 1 << 12
#: Queues with a share of their own; sources beyond share one queue.
MAX_QUEUES = 1024
#: Entries of the (queue x packet) matrices that one numpy step fills.
STEP_CELLS = 1 << 22


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of blanks that follow a character other than white space, as far as a look at bytes tells.

    No match of a byte-level tokenizer's splitting pattern holds white space after something else,
    so a text may be cut there without a change of its ids.  After characters of three bytes that
    begin with E1, E2 or E3, some of which are white space, nothing is cut.
    """
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    one = data[at - 1]
    two, three, four = (np.where(at >= k, data[at - k], 0) for k in (2, 3, 4))
    plain = (one > 32) & (one < 127)
    plain |= (one >= 128) & (two >= 0xC3) & (two < 0xE0)
    plain |= (one >= 128) & (two >= 128) & (two < 0xC0) & (three >= 0xE4) & (three < 0xF0)
    plain |= (one >= 128) & (three >= 128) & (three < 0xC0) & (four >= 0xF0)
    return at[plain]


def simple_pattern() -> re.Pattern:
    """The splitting pattern of byte-level tokenizers for code points below U+0250.

    There the categories of Unicode are settled, so no library differs from another.
    """
    kinds = {"L": "", "N": ""}
    for c in map(chr, range(0x250)):
        kind = unicodedata.category(c)[0]
        if kind in kinds:
            kinds[kind] += c  # letters and digits mean themselves in a class
    space = "\\t-\\r \x85\xa0"
    runs = f" ?[{kinds['L']}]+| ?[{kinds['N']}]+| ?[^{space}{kinds['L']}{kinds['N']}]+"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{runs}|[{space}]+(?![^{space}])|[{space}]+")


def byte_characters() -> str:
    """The character that stands for each byte in the tokens of a byte-level vocabulary.

    Bytes that print in Latin-1 stand for themselves, the others follow from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in plain else next(others)) for b in range(0x100))


class Encoder:
    """Ids of whole texts by a tokenizer file, each different piece of a step's texts encoded once.

    Segments of code points below U+0250 are split into pieces here, and the tokenizer's model gets
    different pieces only; other segments go through the tokenizer as they are.  The numbers of
    bytes that ids stand for tell where each piece begins among the ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.model = Tokenizer(self.tokenizer.model)  # takes pieces, in the characters of its bytes
        tokens = self.tokenizer.get_vocab()
        self.width = np.zeros(max(tokens.values()) + 1, np.int64)  # a byte is one character of a token
        self.width[list(tokens.values())] = list(map(len, tokens))
        self.pattern, self.characters = simple_pattern(), byte_characters()

    def _pieces(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces, number of ids of each)."""
        at, raw = _bytes(pieces)
        spelled = raw.tobytes().decode("latin-1").translate(self.characters)
        ends = at.tolist()
        words = [spelled[a:b] for a, b in zip(ends, ends[1:])]
        many = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        found = self.model.encode_batch_fast(many, is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.int64), *(np.array(e.ids, np.int64) for e in found)])
        return ids, self._sizes(ids, at)

    def _sizes(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Numbers of ids between places that are given in bytes."""
        reached = np.concatenate([[0], np.cumsum(self.width[ids])])
        places = np.searchsorted(reached, at)
        if len(ids) < places[-1] or not (reached[places] == at).all():
            raise RuntimeError("an id goes over a border")
        return np.diff(places)

    def _segments(self, segments: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments, number of ids of each)."""
        at, raw = _bytes(segments)
        last, before = raw[at[1:] - 1], raw[np.maximum(at[1:] - 2, 0)]
        # Blanks may be cut off behind these, so such segments may stand behind each other.
        free = (raw[at[:-1]] == 32) & (((last > 32) & (last < 127)) | ((last >= 128) & (before >= 0xC3)))
        free &= np.add.reduceat(raw >= 0xC9, at[:-1], dtype=np.int64) == 0
        simple = segments.filter(pa.array(free))
        ends, data = _bytes(simple)
        pieces = pa.array(self.pattern.findall(data.tobytes().decode()), pa.large_string()).dictionary_encode()
        flat, size = self._pieces(pieces.dictionary)
        code = np.asarray(pieces.indices)
        ids = gathered(flat, (np.cumsum(size) - size)[code], size[code])
        own = np.zeros(len(segments), np.int64)
        own[free] = self._sizes(ids, ends)
        found = self.tokenizer.encode_batch_fast(segments.filter(pa.array(~free)).to_pylist(), add_special_tokens=False)
        own[~free] = list(map(len, found))
        first = np.zeros(len(segments), np.int64)
        first[free] = np.cumsum(own[free]) - own[free]
        first[~free] = len(ids) + np.cumsum(own[~free]) - own[~free]
        return gathered(np.concatenate([ids, *(np.array(e.ids, np.int64) for e in found)]), first, own), own

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        raw = [t.encode() for t in texts]
        bounds = np.concatenate([[0], np.cumsum(list(map(len, raw)))])
        data = b"".join(raw)
        if not data:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        begin = np.zeros(len(data) + 1, bool)
        begin[bounds] = True
        begin[cuts(np.frombuffer(data, np.uint8))] = True
        offsets = np.flatnonzero(begin)
        segments = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        flat, size = self._segments(segments.dictionary)
        code = np.asarray(segments.indices)
        reached = np.concatenate([[0], np.cumsum(size[code])])[np.searchsorted(offsets, bounds)]
        return gathered(flat, (np.cumsum(size) - size)[code], size[code]), np.diff(reached)


def _bytes(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of strings without nulls."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``flat[first : first + size]`` one after the other."""
    ends = np.cumsum(size)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def id_lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow list column of 32-bit ids."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first place, texts) of runs of about ``STEP_CHARS`` characters, or of one longer text."""
    held, size, first = [], 0, 0
    for i, text in enumerate(column):
        text = text.as_py() or ""
        if held and size + len(text) > STEP_CHARS:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def tokens(df: DataFrame, path: str, queue: Column, key: str, text: str, end_id: int = 0) -> DataFrame:
    """(key, name of the queue, part, before, n_tokens, ids): ids end with ``end_id``.

    ``before`` counts the tokens of the same queue that stand earlier in the same partition.
    """
    chosen = df.select(F.col(key).alias("key"), F.coalesce(queue.cast("string"), F.lit("")).alias("name"), F.col(text).alias("text"))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, met = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for first, texts in _texts(batch.column(2)):
                some = batch.slice(first, len(texts))
                ids, count = encoder(path).encode(texts)
                ends = np.cumsum(count)
                ids = np.insert(ids, ends, end_id)
                before = []
                for name, n in zip(some.column(1).to_pylist(), (count + 1).tolist()):
                    before.append(met[name])
                    met[name] += n
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        some.column(1),
                        pa.array(np.full(len(texts), part, np.int64)),
                        pa.array(before, pa.int64()),
                        pa.array(count + 1),
                        id_lists(ids, count + 1),
                    ],
                    ["key", "name", "part", "before", "n_tokens", "ids"],
                )

    kind = df.schema[key].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, name string, part long, before long, n_tokens long, ids array<int>")


class Schedule:
    """Where the tokens of each queue stand in the stream that deficit round-robin sends."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, width: int, grain: int):
        self.totals, self.width, self.grain = totals.astype(np.int64), width, grain
        weights = np.maximum(weights, weights.max(initial=0) * 1e-6)  # so that rounds stay countable
        self.quantum = width * weights / weights.sum()
        # Queues start with different deficits, so that equal ones do not all send in one round.
        self.start = grain * np.modf((np.arange(len(totals)) + 1) * 0.6180339887498949)[0]
        self.length = int(self.totals.sum())
        whole, rest = divmod(self.length, width)
        self.whole = whole * width
        sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.ends = self.whole + np.cumsum([0, *sizes])  # bounds of the sequences after the last whole one

    def sent(self, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens that a queue has sent before a round."""
        paid = np.floor((self.start[queue] + rounds * self.quantum[queue]) / self.grain)
        return np.minimum(self.totals[queue], self.grain * paid.astype(np.int64))

    def round_of(self, queue: np.ndarray, packet: np.ndarray) -> np.ndarray:
        """The round in which a packet is sent."""
        need = np.minimum((packet + 1) * self.grain, self.totals[queue])
        r = np.maximum(0, np.ceil(((packet + 1) * self.grain - self.start[queue]) / self.quantum[queue]).astype(np.int64) - 1)
        while (late := (r > 0) & (self.sent(queue, r) >= need)).any():  # rounding is off by one at most
            r = r - late
        while (early := self.sent(queue, r + 1) < need).any():
            r = r + early
        return r

    def place(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Stream places of tokens, given by their places in their queues."""
        rounds = self.round_of(queue, at // self.grain)
        out = at - self.sent(queue, rounds)
        met, back = np.unique(rounds, return_inverse=True)
        every = np.arange(len(self.totals))[:, None]
        step = max(1, STEP_CELLS // len(self.totals))
        for i in range(0, len(met), step):
            some = (back >= i) & (back < i + step)
            now, after = self.sent(every, met[None, i : i + step]), self.sent(every, met[None, i : i + step] + 1)
            ahead = now.sum(axis=0) + np.cumsum(after - now, axis=0) - (after - now)
            out[some] += ahead[queue[some], back[some] - i]
        return out

    def sequence(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset in it, tokens up to its end) of stream places."""
        tail = np.searchsorted(self.ends, place, "right") - 1
        first = np.where(place < self.whole, place // self.width * self.width, self.ends[np.maximum(tail, 0)])
        after = np.where(place < self.whole, first + self.width, self.ends[np.minimum(tail + 1, len(self.ends) - 1)])
        number = np.where(place < self.whole, place // self.width, self.whole // self.width + np.maximum(tail, 0))
        return number, place - first, after - place

    def pieces(self, queue: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start, length, sequence, offset) of all pieces of documents at places of queues."""
        first = at // self.grain
        count = (at + size - 1) // self.grain - first + 1
        row = np.repeat(np.arange(len(at)), count)
        packet = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
        begin = np.maximum(at[row], packet * self.grain)
        length = np.minimum(at[row] + size[row], (packet + 1) * self.grain) - begin
        place = self.place(queue[row], begin)
        while True:  # cut at the ends of sequences
            number, offset, room = self.sequence(place)
            over = length > room
            if not over.any():
                break
            row, begin, place, length = (
                np.concatenate([row, row[over]]),
                np.concatenate([begin, begin[over] + room[over]]),
                np.concatenate([place, place[over] + room[over]]),
                np.concatenate([np.minimum(length, room), length[over] - room[over]]),
            )
        order = np.lexsort((begin, row))
        row, begin, length, number, offset = (x[order] for x in (row, begin, length, number, offset))
        # What goes on in the same sequence without a gap is one piece.
        joins = (row[1:] == row[:-1]) & (number[1:] == number[:-1]) & (offset[1:] == offset[:-1] + length[:-1])
        head = np.flatnonzero(np.concatenate([[True], ~joins])) if len(row) else np.zeros(0, np.int64)
        length = np.add.reduceat(length, head) if len(head) else length
        return row[head], begin[head] - at[row[head]], length, number[head], offset[head]


def _bases(cells: DataFrame) -> DataFrame:
    """(name, part, queue, base): tokens of the same queue in earlier cells, in the order (part, name).

    Summed in two levels, so that no queue is one task.
    """
    blocked = cells.withColumn("block", F.floor(F.col("part") / 512))
    blocks = blocked.groupBy("queue", "block").agg(F.sum("size").alias("whole"))
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("queue", "block", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("over"))
    inside = Window.partitionBy("queue", "block").orderBy("part", "name").rowsBetween(Window.unboundedPreceding, -1)
    under = F.coalesce(F.sum("size").over(inside), F.lit(0))
    return blocked.withColumn("under", under).join(blocks, ["queue", "block"]).select(
        "name", "part", "queue", (F.col("over") + F.col("under")).alias("base")
    )


def pack(
    df: DataFrame,
    path: str,
    queue: Column,
    targets: dict[str, float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    width: int = 1024,
    grain: int = 128,
    with_ids: bool = False,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all pieces of all documents.

    A document's tokens are its ids by the tokenizer file at ``path`` and a last id 0; null and
    empty texts have that one alone.  Every id lies in exactly one piece.  ``targets`` gives the
    weights of named queues; all other rows share one queue, with the weight that the name ``""``
    has there, or else their share of the tokens times the sum of the others.  Without targets the
    weights are the queues' shares of all tokens, so every window mirrors the corpus; then the
    ``MAX_QUEUES - 1`` largest sources have queues of their own and the rest share one.  Whatever the
    weights, everything is packed.  ``with_ids`` adds the ids of each piece.

    Keys may be null or repeat: every row is a document.  An empty table gives no rows.  Other
    columns take no part, whatever their names.
    """
    if width & (width - 1) or grain < 1 or width < 1:
        raise ValueError("width must be a power of two, grain at least 1")
    if targets is not None and any(w <= 0 for w in targets.values()):
        raise ValueError("weights of targets must be above 0")
    if targets is not None and len(targets) > MAX_QUEUES - 2:
        raise ValueError(f"at most {MAX_QUEUES - 2} targets")
    spark = df.sparkSession
    if targets is not None:
        named = queue.cast("string")
        queue = F.when(named.isin(list(targets)), named).otherwise(F.lit(""))
    made = written(tokens(df, path, queue, key, text), "packing-tokens")
    cells = written(made.groupBy("name", "part").agg(F.sum("n_tokens").alias("size")), "packing-cells")
    sums = cells.groupBy("name").agg(F.sum("size").alias("size"))
    total = cells.agg(F.sum("size")).first()[0] or 0
    own = [tuple(r) for r in sums.orderBy(F.desc("size"), "name").limit(MAX_QUEUES - 1).collect()]
    rest = total - sum(size for _, size in own)
    sizes = np.array([size for _, size in own] + [rest] * (rest > 0), np.int64)
    weights = sizes.astype(float)
    if targets is not None:
        others = sum(targets.values()) * dict(own).get("", 0) / max(1, total)
        weights = np.array([targets.get(name, others) for name, _ in own])
    numbers = spark.createDataFrame([(name, i) for i, (name, _) in enumerate(own)], "name string, queue long")
    numbered = cells.join(F.broadcast(numbers), "name", "left").fillna(len(own), ["queue"])
    bases = written(_bases(numbered), "packing-bases")  # its size is known then, which decides how it is joined
    placed = made.join(bases, ["name", "part"]).select(
        "key", "queue", (F.col("base") + F.col("before")).alias("at"), "n_tokens", "ids"
    )
    return _cut(placed, Schedule(sizes, weights, width, grain), key, with_ids)


def _cut(placed: DataFrame, schedule: Schedule, key: str, with_ids: bool) -> DataFrame:
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                batch = whole.slice(i, 2048)
                queue, at, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
                ids = batch.column(4)
                flat = np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False)).astype("<i4")
                begins = np.cumsum(size) - size
                row, start, length, number, offset = schedule.pieces(queue, at, size)
                low = begins[row] + start
                raw = memoryview(flat).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(low.tolist(), (low + length).tolist())]
                columns = [
                    batch.column(0).take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(size[row]),
                    pa.array(number),
                    pa.array(offset),
                ]
                if with_ids:
                    columns.append(id_lists(gathered(flat, low, length), length))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = placed.schema["key"].dataType.simpleString()
    made = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(run, made + ", ids array<int>" * with_ids)


def sequences(pieces: DataFrame, pad_id: int, width: int = 1024) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences themselves, from pieces with their ids.

    A sequence as long as a power of two is not padded; any other is filled up to ``width``.
    One sequence has at most ``width`` pieces.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    odd = n.bitwiseAND(n - 1) != 0
    fill = F.array_repeat(F.lit(pad_id), F.when(odd, F.lit(width) - n).otherwise(0))
    return joined.select("sequence_id", n.cast("long").alias("n_tokens"), F.concat("ids", fill).alias("ids"))
