"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut by the tokenizer's pattern. Tier 1 looks each piece up whole in a minimal perfect
hash of the vocabulary: one slot per token, found with one displacement, then compared. Tier 2
merges the bytes of a missing piece: a linked list of parts and a heap of adjacent pairs by rank,
so a piece of n bytes costs O(n log n). Recent pieces are remembered up to a bound per worker.

The vocabulary is a file of ranks whose path is a parameter; it is read on the driver and
broadcast (some 50,000 tokens, about 1 MB). Texts are mapped in place without a shuffle.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import PRE_TOKEN, PRE_TOKEN_ASCII, pieces, whole_text

#: Whether an array of this machine lies as the ids are stored.
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4

#: Pieces that a worker remembers in each of two generations, and the longest in characters.
MEMO_PIECES = 150_000
MEMO_LENGTH = 48


class PerfectHash:
    """Minimal perfect hash by displacement: n keys, n slots, one small integer per bucket."""

    def __init__(self, keys: Iterable[bytes]) -> None:
        keys = list(dict.fromkeys(keys))
        self.size = len(keys)
        self.buckets = max(1, self.size // 3)
        self.shift = array("q", bytes(8 * self.buckets))
        self.keys: list[bytes] = [b""] * self.size
        by_bucket: dict[int, list[tuple[int, int, bytes]]] = {}
        for key in keys:
            low, high = self._halves(key)
            by_bucket.setdefault(low % self.buckets, []).append((low, high, key))
        free = bytearray(b"\x01") * self.size
        # Full buckets first, while most slots are free.
        for bucket, held in sorted(by_bucket.items(), key=lambda b: (-len(b[1]), b[0])):
            if len(held) == 1:
                break
            step = 1
            while True:
                slots = [self._at(low, high, step) for low, high, _ in held]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                step += 1
            self._place(bucket, step, slots, held, free)
        # A bucket with one key points straight at a slot that is left.
        left = (s for s in range(self.size) if free[s])
        for bucket, held in sorted(by_bucket.items()):
            if len(held) == 1:
                slot = next(left)
                self._place(bucket, -slot - 1, [slot], held, free)

    @staticmethod
    def _halves(key: bytes) -> tuple[int, int]:
        digest = xxhash.xxh3_128_intdigest(key)
        return digest >> 64, (digest & 0xFFFFFFFFFFFFFFFF) | 1

    def _at(self, low: int, high: int, step: int) -> int:
        return ((((low ^ (step * 0x9E3779B97F4A7C15)) * high) >> 24) & 0xFFFFFFFFFF) % self.size

    def _place(self, bucket, step, slots, held, free) -> None:
        self.shift[bucket] = step
        for slot, (_, _, key) in zip(slots, held, strict=True):
            free[slot] = 0
            self.keys[slot] = key

    def slot(self, key: bytes) -> int:
        """The key's slot, -1 if it is not one of the keys."""
        if not self.size:
            return -1
        low, high = self._halves(key)
        step = self.shift[low % self.buckets]
        slot = -step - 1 if step < 0 else self._at(low, high, step)
        return slot if self.keys[slot] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: always merge the adjacent pair of lowest rank, the leftmost of equals."""
    size = len(piece)
    after = list(range(1, size + 1))  # where the part that starts here ends
    before = list(range(-1, size - 1))  # where the part in front starts
    pair = [-1] * size  # rank of this part with the next one
    rank_of = ranks.get
    heap = []
    for i in range(size - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            pair[i] = rank
            heap.append(rank * size + i)
    heapify(heap)
    while heap:
        rank, i = divmod(heappop(heap), size)
        if pair[i] != rank:
            continue  # one of the two parts has changed since
        gone = after[i]
        end = after[i] = after[gone]
        pair[gone] = -1
        pair[i] = -1
        if end < size:
            before[end] = i
            rank = rank_of(piece[i : after[end]])
            if rank is not None:
                pair[i] = rank
                heappush(heap, rank * size + i)
        front = before[i]
        if front >= 0:
            rank = rank_of(piece[front:end])
            if rank is None:
                pair[front] = -1
            else:
                pair[front] = rank
                heappush(heap, rank * size + front)
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


@dataclass
class Vocabulary:
    """Tokens by rank, the pattern that cuts a text into pieces, and how many of these a worker
    remembers in each of two generations: fewer take less memory and more time."""

    ranks: dict[bytes, int]
    pattern: str
    memo_pieces: int = MEMO_PIECES

    @cached_property
    def coder(self) -> "Coder":
        """Made once per worker, and gone with the broadcast vocabulary."""
        return Coder(self)

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern, "memo_pieces": self.memo_pieces}

    @classmethod
    def read(cls, path: str, pattern: str, memo_pieces: int = MEMO_PIECES) -> "Vocabulary":
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        for byte in range(256):
            if bytes([byte]) not in ranks:
                raise ValueError(f"{path}: no token for the byte {byte}")
        return cls(ranks, pattern, memo_pieces)


class Memo(dict):
    """Piece to its ids as little-endian 32-bit integers, computed on first use.

    Pieces are kept in two generations: when the younger is full it becomes the older, whose pieces
    return on their next use, so frequent ones stay and the rest is forgotten.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.ranks = vocabulary.ranks
        self.most = vocabulary.memo_pieces
        self.whole = PerfectHash(vocabulary.ranks)
        self.rank_at = [vocabulary.ranks[key] for key in self.whole.keys]
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode()
            slot = self.whole.slot(raw)
            ids = [self.rank_at[slot]] if slot >= 0 else merge(raw, self.ranks)
            packed = array("I", ids).tobytes() if LITTLE else b"".join(i.to_bytes(4, "little") for i in ids)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Coder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.any = self.ascii = regex.compile(vocabulary.pattern).findall
        if vocabulary.pattern == PRE_TOKEN:
            self.ascii = re.compile(PRE_TOKEN_ASCII, re.ASCII).findall
        self.memo = Memo(vocabulary)
        self.token = {i: t for t, i in vocabulary.ranks.items()}

    def encode(self, text: str) -> bytes:
        cut = self.ascii if text.isascii() else self.any
        return b"".join(map(self.memo.__getitem__, cut(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(packed).cast("I").tolist()))


def _coded(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str,
    text_column: str,
    schema: str,
    columns: Callable[[Coder, list[bytes]], dict[str, pa.Array]],
) -> DataFrame:
    """Id and what ``columns`` makes of the packed ids of a piece of the table, by ``schema``."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(
        F.col(id_column).alias("id"), whole_text(text_column).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held.value.coder
        for batch in batches:
            for piece in pieces(batch, "text"):
                packed = [coder.encode(text) for text in piece["text"].to_pylist()]
                yield pa.RecordBatch.from_pydict({"id": piece["id"]} | columns(coder, packed))

    return rows.mapInArrow(code, f"id {id_type}, {schema}").withColumnRenamed("id", id_column)


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """One row per input row: id, ``ids`` and, decoded from them, ``decoded``.

    ``ids`` is binary: little-endian unsigned 32-bit token ids. ``decoded`` is the text's bytes
    again. Null and empty texts have no ids. Rows that repeat are encoded each; other columns
    are not read. A text of any length is encoded whole. No rows give no rows.
    """

    def columns(coder: Coder, packed: list[bytes]) -> dict[str, pa.Array]:
        out = {"ids": pa.array(packed, pa.binary())}
        if with_text:
            out["decoded"] = pa.array(map(coder.decode, packed), pa.binary())
        return out

    schema = "ids binary" + ", decoded binary" * with_text
    return _coded(docs, vocabulary, id_column, text_column, schema, columns)


def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(packed).cast("I").tolist()))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """One row per input row: id, ``ids`` and, decoded from them, ``decoded``.

    ``ids`` is binary: little-endian unsigned 32-bit token ids. ``decoded`` is the text's bytes
    again. Null and empty texts have no ids. Rows that repeat are encoded each; other columns
    are not read. A text of any length is encoded whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(
        F.col(id_column).alias("id"), whole_text(text_column).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, ids binary" + ", decoded binary" * with_text

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held.value.coder
        for batch in batches:
            for piece in pieces(batch, "text"):
                packed = [coder.encode(text) for text in piece["text"].to_pylist()]
                columns = {"id": piece["id"], "ids": pa.array(packed, pa.binary())}
                if with_text:
                    columns["decoded"] = pa.array(map(coder.decode, packed), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(code, schema).withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids") -> DataFrame:
    """Add ``text`` from a column of ids as ``encode`` makes it; null ids give a null text."""
    held = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("binary")
    def texts(ids):
        token = {i: t for t, i in held.value.ranks.items()}
        return ids.map(
            lambda x: None
            if x is None
            else b"".join(map(token.__getitem__, memoryview(bytes(x)).cast("I").tolist()))
        )

    return encoded.withColumn("text", F.decode(texts(F.col(ids_column)), "UTF-8"))


def encode_digests(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Number of tokens and SHA-256 of what ``encode`` gives for each row: ``n_tokens``,
    ``ids_sha256`` and ``decoded_sha256``.

    Ids and decoded texts are hashed where they are made, so only narrow rows leave the worker;
    nulls, empty texts and repeated rows are as in ``encode``.
    """

    def columns(coder: Coder, packed: list[bytes]) -> dict[str, pa.Array]:
        return {
            "n_tokens": pa.array([len(ids) // 4 for ids in packed], pa.int64()),
            "ids_sha256": pa.array([sha256(ids).hexdigest() for ids in packed]),
            "decoded_sha256": pa.array([sha256(coder.decode(ids)).hexdigest() for ids in packed]),
        }

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _coded(docs, vocabulary, id_column, text_column, schema, columns)


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The same from a table that ``encode`` has returned."""
    return encoded.select(
        id_column,
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
