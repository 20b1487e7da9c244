"""Token counts without tokens: whole pre-tokens proven to be one token, the rest merged.

The model is a byte-level BPE file in the JSON format of the ``tokenizers`` library. Before any
text is read, every vocabulary string is merged once by the model's own rules: what ends as one
part is *proven*, and a text's pre-token that equals it counts 1 without a merge. Other pre-tokens
are merged, by the rank of the adjacent pair and the leftmost of equals, as far as counting needs:
a piece of n bytes takes O(n log n), whatever its length. Added strings such as an end-of-text mark
are found first and count one token each, as the library does by default.

The proof covers the vocabulary alone (some 50,000 strings, a second on the driver); the model,
about 2 MB whatever the corpus, is broadcast. Texts are mapped in place without a shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import PRE_TOKEN, PRE_TOKEN_ASCII, pieces, whole_text

#: Tokens beyond which a document is marked.
LIMIT = 512
#: Merged pieces a worker remembers in each of two generations, and the longest in characters.
MEMO_PIECES = 200_000
MEMO_LENGTH = 48
#: Pieces of so many bytes are merged by scanning the pairs; longer ones keep them in a heap.
SCANNED = 24


def byte_signs() -> dict[str, int]:
    """The byte that a sign of the file stands for: printable Latin-1 signs are themselves, the
    others are numbered from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Model:
    """The ids of single bytes, the rank of a pair of ids, and by rank the id they merge to."""

    byte_ids: list[int]
    ranks: dict[tuple[int, int], int]
    made: list[int]
    added: list[str]
    proven: frozenset[str]

    @classmethod
    def read(cls, path: str) -> "Model":
        """A byte-level BPE model; settings that would change the count otherwise are refused."""
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        bpe, cut = told["model"], told.get("pre_tokenizer") or {}
        odd = [
            bpe.get("type", "BPE") != "BPE",
            cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True),
            told.get("normalizer") is not None,
            *(bool(bpe.get(k)) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"
            )),
            *(a[k] for a in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip")),
        ]
        if any(odd):
            raise ValueError(f"{path}: not a plain byte-level BPE model")
        ids, signs = bpe["vocab"], byte_signs()
        byte_ids = [0] * 256
        for sign, byte in signs.items():
            byte_ids[byte] = ids[sign]
        ranks, made = {}, []
        for pair in bpe["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[ids[left], ids[right]] = len(made)
            made.append(ids[left + right])
        added = [a["content"] for a in told["added_tokens"]]
        model = cls(byte_ids, ranks, made, added, frozenset())
        model.proven = frozenset(model.prove(bytes(map(signs.__getitem__, t)) for t in ids))
        return model

    def prove(self, tokens: Iterator[bytes]) -> Iterator[str]:
        """Those tokens that are whole texts and that the model itself merges into one part."""
        for token in tokens:
            try:
                text = token.decode()
            except UnicodeDecodeError:
                continue  # part of a sign, never a whole pre-token
            if self.parts(token) == 1:
                yield text

    def parts(self, piece: bytes) -> int:
        """How many tokens are left of a pre-token once no adjacent pair merges."""
        size = left = len(piece)
        ids = list(map(self.byte_ids.__getitem__, piece))
        if size <= SCANNED:
            return self._scanned(ids)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        rank_of, made = self.ranks.get, self.made
        # A heap entry is rank and place in one number; it is stale if the place's rank changed.
        pair = [-1] * size
        heap = []
        for i in range(size - 1):
            rank = rank_of((ids[i], ids[i + 1]))
            if rank is not None:
                pair[i] = rank
                heap.append(rank * size + i)
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), size)
            if pair[i] != rank:
                continue
            ids[i] = made[rank]
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = pair[i] = -1
            left -= 1
            if end < size:
                before[end] = i
                rank = rank_of((ids[i], ids[end]))
                if rank is not None:
                    pair[i] = rank
                    heappush(heap, rank * size + i)
            front = before[i]
            if front >= 0:
                rank = rank_of((ids[front], ids[i]))
                pair[front] = -1 if rank is None else rank
                if rank is not None:
                    heappush(heap, rank * size + front)
        return left

    def _scanned(self, ids: list[int]) -> int:
        """The same for a few ids: no heap, the lowest rank is looked for among all pairs."""
        rank_of, made = self.ranks.get, self.made
        none = len(made)
        pairs = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            ids[i] = made[best]
            del ids[i + 1], pairs[i]
            if i:
                pairs[i - 1] = rank_of((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = rank_of((ids[i], ids[i + 1]), none)
        return len(ids)

    @cached_property
    def counter(self) -> "Counter":
        """Made once per worker, and gone with the broadcast model."""
        return Counter(self)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "counter"}


class Pieces(dict):
    """Pre-token to its number of tokens: 1 for proven ones, the rest merged on first use.

    Merged ones are kept in two generations: when the younger is full it becomes the older, whose
    pieces return on their next use, so frequent pieces stay and the rest is forgotten.
    """

    def __init__(self, model: Model) -> None:
        super().__init__(dict.fromkeys(model.proven, 1))
        self.model = model
        self.full = len(self) + MEMO_PIECES
        self.older: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        count = self.older.get(piece)
        if count is None:
            count = self.model.parts(piece.encode())
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= self.full:
                self.older = dict(self)
                self.clear()
                self.update(dict.fromkeys(self.model.proven, 1))
            self[piece] = count
        return count


class Counter:
    """Counts the tokens of texts by one model."""

    def __init__(self, model: Model) -> None:
        self.any = regex.compile(PRE_TOKEN).findall
        self.ascii = re.compile(PRE_TOKEN_ASCII, re.ASCII).findall
        # Longer strings first, so that of two added strings at one place the longer is taken.
        added = sorted(filter(None, model.added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))).split if added else None
        self.count = Pieces(model).__getitem__

    def tokens(self, text: str) -> int:
        cut = self.ascii if text.isascii() else self.any
        if self.added is None:
            return sum(map(self.count, cut(text)))
        parts = self.added(text)
        return len(parts) - 1 + sum(sum(map(self.count, cut(part))) for part in parts)


def count_tokens(
    docs: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``n_bytes`` is the length in UTF-8; ``over_limit`` tells whether a text has more than ``limit``
    tokens. Null and empty texts have none of both. Rows that repeat, also with a null id, are
    counted each; other columns are not read, whatever their names. A text of any length is counted
    whole: a piece of a million letters is merged in one heap. No rows give no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held.value.counter.tokens
        for batch in batches:
            for piece in pieces(batch, "text"):
                n = np.fromiter((tokens(text) for text in piece["text"].to_pylist()), np.int64)
                size = pa.compute.binary_length(piece["text"]).cast(pa.int64())
                yield pa.RecordBatch.from_pydict(
                    {"id": piece["id"], "n_bytes": size, "n_tokens": pa.array(n)}
                )

    counted = rows.mapInArrow(count, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
