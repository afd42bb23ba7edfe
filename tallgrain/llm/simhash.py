"""SimHash near-dedup: Golay-code fuzzy hashing, verified pairs, connected components.

A fingerprint has 64 bits; two texts are linked if at most four bits differ.  To find such pairs
without comparing all, the bits are cut into segments of 22, 21 and 21, each padded to the 23 bits
of the perfect Golay code.  A segment's keys are the code words at most four bits away (six or
one): of two segments that differ in at most two bits some word lies within one bit of both, its
code word is at most three away from it, so both have that code word among their keys.

Four differing bits over three segments leave two cases.

* One segment is untouched.  Of the other two, one differs in at most two bits: they meet under
  (that untouched segment itself, a code word of the other).
* Every segment is touched, so each differs in at most two bits: they meet under three code words.

Equal fingerprints are one node from the start, so a hot text is one row.  Keys carry 33 to 36
bits, so strangers seldom meet.  Within a key, nodes are compared by a search that leaves out what
is already connected, and only the links that connect something new are kept: never all pairs.
A key with very many nodes is dealt again: four differing bits leave one of five parts of the bits
that its nodes don't share untouched, and so on until every key is small enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, written

#: Most differing bits of a link; the keys below are made for four.
MAX_BITS = 4
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (lowest bit, width)
#: Nodes of a key that are compared in one task; larger keys are dealt again.
CROWD = 1 << 14

#: Generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, width: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of each ``width`` words; of the whole sequence if it is shorter."""
    words = text.translate(_LOWER).split()  # bytes.split() cuts at \\x20 and \\x09-\\x0d
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    spans = zip(start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)


def fingerprint(text: bytes, width: int = 4) -> int:
    """Bit i is 1 if it is set in over half of the hashes; 0 for a text without words."""
    h = shingle_hashes(text, width)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > len(h)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4) -> DataFrame:
    """(key, fp) of every row; ``fp`` is the fingerprint as a signed long.  Null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t or "").encode(), width) for t in batch.column(1).to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], [key, "fp"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit polynomials by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def error_table() -> np.ndarray:
    """Row s: the patterns of at most four bits with syndrome s, filled up with -1."""
    bits = [1 << i for i in range(23)]
    patterns = [0]
    for size in range(1, 5):
        chosen = np.array(np.meshgrid(*[np.arange(23)] * size, indexing="ij")).reshape(size, -1)
        chosen = chosen[:, (np.diff(chosen, axis=0) > 0).all(axis=0)]
        patterns += np.array(bits)[chosen].sum(axis=0).tolist()
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for pattern, s in zip(patterns, _syndromes(np.array(patterns)).tolist()):
        found[s].append(pattern)
    most = max(map(len, found))
    return np.array([f + [-1] * (most - len(f)) for f in found])


def codeword_keys(segment: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Numbers (12 bits) of the code words at most four bits from each segment; -1 fills up."""
    pattern = errors[_syndromes(segment)]
    return np.where(pattern < 0, -1, (segment[:, None] ^ pattern) >> 11)


def fuzzy_keys(fp: np.ndarray, errors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``fp``, key) arrays that hold every key of every fingerprint."""
    u = fp.view(np.uint64)
    segments = [((u >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    words = [codeword_keys(s, errors) for s in segments]
    kind = 1
    for i, exact in enumerate(segments):
        for j, near in enumerate(words):
            if i != j:
                place, column = np.nonzero(near >= 0)
                yield place, (kind << 40) | (exact[place] << 12) | near[place, column]
                kind += 1
    a, b, c = words
    for i in range(a.shape[1]):
        for j in range(b.shape[1]):
            two = np.flatnonzero((a[:, i] >= 0) & (b[:, j] >= 0))
            place, column = np.nonzero(c[two] >= 0)
            place = two[place]
            yield place, (kind << 40) | (a[place, i] << 24) | (b[place, j] << 12) | c[place, column]


def _keys_of(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = error_table()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 2048):
                found = list(fuzzy_keys(fp[i : i + 2048], errors))
                place = np.concatenate([p for p, _ in found])
                key = np.concatenate([k for _, k in found])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[i + place])], ["key", "fp"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long")


def _near(one: np.uint64, others: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(others ^ one) <= bits


def _links_in_bucket(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within one key: at most one less than its nodes.

    Search from a node at a time; what has been reached is never compared again.
    """
    out, rest = [], fp
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = _near(one, rest, bits)
            if near.any():
                reached = rest[near]
                out += [(int(one), int(x)) for x in reached]
                front += list(reached)
                rest = rest[~near]
    return out


def _links(keyed: DataFrame, bits: int, limit: int) -> DataFrame:
    """(a, b, key, mask): verified links among the nodes of each key, and the nodes of crowded keys.

    ``keyed`` has key, fp and mask, the bits that all nodes of a key share.  A link has no key.  Nodes
    under a key with more than ``limit`` of them are not compared; they come back as ``a``, with their
    key and mask, as they are read.
    """
    names = ["a", "b", "key", "mask"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # rows of the last key
        crowded = None  # the last key, if it is known to be crowded

        def passed(key: np.ndarray, fp: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(len(key), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), none, pa.array(key), pa.array(mask)], names)

        def settle(key: np.ndarray, fp: np.ndarray, mask: np.ndarray) -> Iterator[pa.RecordBatch]:
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(first, len(key)))
            pair = first[size == 2]  # the usual case, all at once
            pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= bits]
            a, b = [fp[pair]], [fp[pair + 1]]
            for s, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                if n > limit:
                    yield passed(key[s : s + n], fp[s : s + n], mask[s : s + n])
                elif links := _links_in_bucket(fp[s : s + n], bits):
                    one, two = np.array(links, np.uint64).T
                    a.append(one)
                    b.append(two)
            one, two = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            both = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1), axis=0)
            none = pa.nulls(len(both), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, none], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp, mask = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            rows = (key, fp.view(np.uint64), mask)
            if crowded is not None:
                same = int(np.searchsorted(key, crowded, "right"))
                if same:
                    yield passed(*(x[:same] for x in rows))
                if same == len(key):
                    continue
                crowded, rows = None, tuple(x[same:] for x in rows)
            held.append(rows)
            if held[0][0][0] == rows[0][-1]:  # one key so far
                if sum(len(x[0]) for x in held) > limit:
                    crowded = rows[0][-1]
                    for some in held:
                        yield passed(*some)
                    held = []
                continue
            rows = tuple(np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on in the next batch
            yield from settle(*(x[:cut] for x in rows))
            held = [tuple(x[cut:] for x in rows)]
        if held:
            yield from settle(*(np.concatenate(x) for x in zip(*held)))

    sorted_ = keyed.select("key", "fp", "mask").repartition("key").sortWithinPartitions("key", "fp")
    return sorted_.mapInArrow(run, "a long, b long, key long, mask long")


def open_blocks(mask: int, blocks: int = MAX_BITS + 1) -> list[int]:
    """``mask`` with one of ``blocks`` equal parts of its open bits added, for each part."""
    free = [1 << b for b in range(64) if not mask >> b & 1]
    ends = [len(free) * i // blocks for i in range(blocks + 1)]
    return [mask | sum(free[a:b]) for a, b in zip(ends, ends[1:])]


def _dealt_again(crowded: DataFrame) -> DataFrame:
    """Nodes of crowded keys under further keys: of five parts of the open bits one is untouched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, key, mask = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            for known in np.unique(mask).tolist():
                at = np.flatnonzero(mask == known)
                for wider in open_blocks(known % 2**64):
                    shared = fp[at].view(np.uint64) & np.uint64(wider)
                    new = mixed(mixed(key[at].view(np.uint64) + np.uint64(wider)) + shared)
                    signed = np.full(len(at), np.uint64(wider)).view(np.int64)
                    columns = [pa.array(new.view(np.int64)), pa.array(fp[at]), pa.array(signed)]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "fp", "mask"])

    return crowded.select("a", "key", "mask").mapInArrow(run, "key long, fp long, mask long")


def links(nodes: DataFrame, bits: int, limit: int = CROWD) -> DataFrame:
    """(a, b): links that connect what is connected among the different fingerprints ``fp``.

    Keys with more than ``limit`` nodes are dealt again by more of the nodes' bits, until none is
    left; the limit doubles each time, as a node then lies under up to five times as many keys.
    """
    found = written(_links(_keys_of(nodes).withColumn("mask", F.lit(0).cast("long")), bits, limit), "simhash-found")
    out = found.where("key is null").select("a", "b")
    while not (crowded := found.where("key is not null")).isEmpty():
        limit *= 2
        found = written(_links(_dealt_again(crowded), bits, limit), "simhash-found")
        out = out.unionByName(found.where("key is null").select("a", "b"))
    return out


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the smallest node it is connected to.

    Alternates large-star and small-star joins; each round is written to the shared folder, and
    only two numbers go to the driver.  Rounds grow with the logarithm of the links.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written(edges, label), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_groups(
    df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4, max_bits: int = MAX_BITS, limit: int = CROWD
) -> DataFrame:
    """(key, fp, component_id) of every row: the smallest key connected by links, itself included.

    Rows with equal fingerprints are linked, texts without words (fingerprint 0) too.  Repeated
    rows give repeated results; a null key never is the smallest unless all are null.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be between 0 and {MAX_BITS}")
    prints = written(fingerprints(df, text, key, width), "simhash-prints")
    nodes = written(prints.groupBy("fp").agg(F.min(key).alias("first_key")), "simhash-nodes")
    roots = components(links(nodes, max_bits, limit), "simhash-links")
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_key", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("first_key").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(key, "fp", "component_id")


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of each group of near copies, the one with the smallest key; all columns stay.

    Rows are told apart by key and text: different texts under one key are compared like any
    others, and rows equal in both are kept once.  A row without a key stays if no row with one is
    near it; of several such rows near each other one stays.
    """
    if {"_one", "_two"} & set(df.columns):
        raise ValueError("columns '_one' and '_two' are used inside")
    both = [F.isnull(key), F.isnull(text), F.col(key), F.col(text)]
    marked = df.withColumns({"_one": F.xxhash64(F.lit(1), *both), "_two": F.xxhash64(F.lit(2), *both)})
    row = F.struct(F.isnull(key).alias("last"), F.col(key).alias("key"), "_one", "_two")
    groups = near_groups(marked.select(text, row.alias("_row")), text, "_row", **options)
    copies = groups.where("_row <> component_id").select("_row._one", "_row._two")
    return marked.join(copies, ["_one", "_two"], "left_anti").dropDuplicates(["_one", "_two"]).select(*df.columns)
