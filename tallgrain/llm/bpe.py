"""Byte-level BPE: exact merges in linear time by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary
finds the longest token at every place in one scan.  Tokens are laid left to right; a token may
follow another only if merging by rank would leave that very border, which depends on the two
tokens alone and is remembered.  Where nothing fits, the last token is taken back and replaced
by its longest prefix that is a token.  Each place fails at most once, so the work is linear.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

# Code points that the `regex` module counts as letters or digits, but the Unicode
# tables of the tiktoken library do not yet.  For splitting they count as symbols.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
#: Stands for them while a text is split; a private-use code point, neither letter, digit nor space.
STAND_IN = "\ue000"

#: Pieces and borders that a worker remembers; what is beyond is computed again.
REMEMBERED = 1 << 18


class Vocabulary:
    """Ranks of byte strings, with the tables that the encoder needs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.finder.add_word(token.decode("latin-1"), (rank, len(token)))
        self.finder.make_automaton()
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.shorter = {rank: self._prefix(token) for token, rank in ranks.items()}
        self.parts = {rank: self._parts(token, rank) for token, rank in ranks.items()}
        self.merged = {pair: rank for rank, pair in self.parts.items() if pair}
        self.borders: dict[tuple[int, int], bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def _prefix(self, token: bytes) -> int | None:
        for n in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:n])) is not None:
                return rank
        return None

    def _parts(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one: what merging by lower ranks leaves."""
        left = [token[i : i + 1] for i in range(len(token))]
        while len(left) > 2:
            options = [(self.ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(left, left[1:]))]
            best, at = min(options)
            if best >= rank:
                return None
            left[at : at + 2] = [left[at] + left[at + 1]]
        return (self.ranks[left[0]], self.ranks[left[1]]) if len(left) == 2 else None

    def border(self, pair: tuple[int, int]) -> bool:
        """Whether merging the bytes of both tokens leaves exactly these two."""
        if len(self.borders) >= REMEMBERED:
            self.borders.clear()
        known = self.borders[pair] = self._border(*pair)
        return known

    def _border(self, one: int, two: int) -> bool:
        # Undo the merges on either side, latest first.  A merge across the border that ranks
        # below the one undone last would have been made before it.
        latest = len(self.ranks) + 256
        while True:
            across = self.merged.get((one, two))
            if across is not None and across < latest:
                return False
            left, right = self.parts[one], self.parts[two]
            if not left and not right:
                return True
            # With equal ranks merges go left to right, so the right one is the later of two.
            if left and (not right or one > two):
                latest, one = one, left[1]
            else:
                latest, two = two + 1, right[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the splitting pattern; at least one byte."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [0] * n
        for end, (rank, size) in self.finder.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank  # ends ascend, so the last one is the longest
        sizes, shorter, known, dead = self.sizes, self.shorter, self.borders, bytearray(n + 1)
        ids: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            end = at + sizes[token]
            if not dead[end]:
                pair = (last, token)
                fits = known.get(pair)
                if fits is None:
                    fits = last < 0 or self.border(pair)
                if fits:
                    ids.append(token)
                    if end == n:
                        return ids
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token is None:
                dead[at] = 1  # nothing fits here: shorten the token before
                before = ids.pop()
                at -= sizes[before]
                last = ids[-1] if ids else -1
                token = shorter[before]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker and file."""
    return Vocabulary.read(path)


class Pieces(dict):
    """Ids of each piece met so far, as packed 32-bit integers."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.vocab.encode_piece(piece.encode())).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.split = vocab, regex.compile(pattern)
        self.newer = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER) + "]")
        self.known = Pieces(vocab)

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern, one after the other."""
        if text.isascii() or not self.newer.search(text):
            return self.split.findall(text)
        plain = self.newer.sub(STAND_IN, text)  # as long as the text
        return [text[match.start() : match.end()] for match in self.split.finditer(plain)]

    def encode(self, text: str) -> array:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out = array("I")
        out.frombytes(b"".join(map(self.known.__getitem__, self.pieces(text))))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids))


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def id_lists(found: list[array]) -> pa.Array:
    """An Arrow list column of 32-bit ids."""
    ends = np.cumsum([0, *map(len, found)])
    flat = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(f, np.uint32) for f in found if f)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int32)))


def _worker_path(path: str, ship: bool) -> str:
    return SparkFiles.get(path.rsplit("/", 1)[-1]) if ship else path


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", ship: bool = False
) -> DataFrame:
    """``df`` with the token ids of ``text`` as an array column (ids fit a 32-bit integer).

    Null and empty texts give no ids.  ``ids`` must not be a column of ``df``.  ``path`` names
    the rank file where every worker sees it; with ``ship`` it is sent along by Spark.
    """
    if ids in df.columns:
        raise ValueError(f"column {ids!r} exists already")
    if ship:
        df.sparkSession.sparkContext.addFile(path)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary(_worker_path(path, ship)), pattern)
        for batch in batches:
            column = id_lists([codec.encode(t or "") for t in batch.column(names.index(text)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, ids])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(run, ", ".join([*fields, f"`{ids}` array<int>"]))


def decode(df: DataFrame, path: str, ids: str = "ids", data: str = "decoded", ship: bool = False) -> DataFrame:
    """``df`` with the bytes that the ids stand for; null ids give no bytes."""
    if data in df.columns:
        raise ValueError(f"column {data!r} exists already")
    if ship:
        df.sparkSession.sparkContext.addFile(path)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(_worker_path(path, ship)).bytes_of
        for batch in batches:
            rows = batch.column(names.index(ids)).to_pylist()
            column = pa.array([b"".join(known[i] for i in row or ()) for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, data])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(run, ", ".join([*fields, f"`{data}` binary"]))


def digests(df: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row, and its ids if wanted; one pass.

    Null and empty texts have no tokens.  Repeated rows give repeated results; an empty table none.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary(path), pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                ids = [codec.encode(text or "") for text in some.column(1).to_pylist()]
                columns = [
                    some.column(0),
                    pa.array(map(len, ids), pa.int64()),
                    pa.array([hashlib.sha256(little_endian(x)).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [id_lists(ids)] * with_ids, names)

    kind = df.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return df.select("doc_id", "text").mapInArrow(run, made + ", ids array<int>" * with_ids)
