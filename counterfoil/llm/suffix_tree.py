"""Language-model scores by a probabilistic suffix tree over words.

Learning. Spark counts every word of the training texts, and for contexts of one, two, ... words
everything that follows them. Contexts seen ``LEAST_CONTEXT`` times are candidates; one is
retained if its next-word distribution diverges from that of its suffix by more than the
description of its counts costs (half a ln n each). Counts of next words are discounted and the
rest of the mass goes to the suffix, down to the root. All counts of words, contexts and next
words are tables; contexts and next words have 64-bit hashes as keys.

Of the words, those with at least one in ``HEAD`` of all tokens, at most that many, are broadcast.

Scoring. All tokens are dealt out by their last context word, in blocks of numbers, so that every
context is whole in one group, together with the counts of its rare next words: the group counts
the contexts, tests them and scores its tokens in their longest retained suffix state. A group has
about ``GROUP`` tokens. A context too frequent for that is counted in tables and its tokens are
dealt out by one word more. Tokens whose share the group cannot tell go through a join with the
tables. Words never seen have one share together, by Good and Turing's estimate.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import (
    joined_bytes,
    mix,
    pieces,
    salted_join,
    whole_text,
    word_spans,
)
from counterfoil.llm.dart_minhash import word_hashes
from counterfoil.sources.storage import settled, store

#: The end of a text as a token; no word holds a space.
END = b" "
#: Entries with one in so many of all tokens are broadcast.
HEAD = 1_000_000
#: Occurrences that make words a candidate context.
LEAST_CONTEXT = 2
#: Bits of the filter of the keys seen often enough: 16 MB.
FILTER_BITS = 1 << 27
DEPTH = 2
DISCOUNT = 0.5
#: Tokens of a group, about; contexts with as many are dealt out over several.
GROUP = 500_000
#: Bytes of text that a task deals out at once.
DEALT_BYTES = 2 << 20
#: Words, or codes, that a task adds up before it hands them on.
HELD_WORDS, HELD_CODES = 400_000, 1_000_000


def tokens(text: bytes) -> list[bytes]:
    """Words after lower-casing A-Z, then one end."""
    return [*text.lower().split(), END]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column text (binary)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = pa.array(list(found), pa.binary())
            batch = pa.RecordBatch.from_pydict(
                {"word": words, "n": pa.array(list(found.values()), pa.int64())}
            )
            found.clear()
            return batch

        found: Counter = Counter()
        for batch in batches:
            for piece in pieces(batch, "text"):
                for text in piece["text"].to_pylist():
                    found.update(tokens(text))
                if len(found) > HELD_WORDS:
                    yield out()
        yield out()

    return (
        texts.select("text")
        .mapInArrow(work, "word binary, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


@dataclass
class Order:
    """What is broadcast of the contexts of one length: keys ascending, and their shares."""

    codes: np.ndarray  # retained contexts
    rest: np.ndarray  # share left to the suffix
    next_codes: np.ndarray  # next words in retained contexts
    next_shares: np.ndarray


@dataclass
class SuffixTree:
    """What is broadcast of the tree."""

    symbol: dict[bytes, int]
    counts: np.ndarray  # per symbol, the last one that of all rare words
    tokens: int
    words: int
    singles: int
    orders: list[Order] = field(default_factory=list)

    @property
    def size(self) -> int:
        """Number of symbols; the last is the rare one."""
        return len(self.counts)

    def unseen_share(self) -> float:
        """The share of all words that never occurred."""
        return (self.singles + 1) / (self.tokens + self.singles + 1)

    def root(self) -> np.ndarray:
        """The share of each symbol; that of the last is for a word that never occurred."""
        unseen = self.unseen_share()
        share = (1 - unseen) * self.counts / max(1, self.tokens)
        share[-1] = 0
        return np.where(share > 0, share, unseen)

    def sequence(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """Symbols of all texts in a row, where each begins, and the words."""
        get, rare = self.symbol.get, self.size - 1
        words = [tokens(t) for t in texts]
        begins = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        ids = np.fromiter(
            (i for w in words for i in map(get, w, repeat(rare))), np.int64, int(begins[-1])
        )
        return ids, begins, words

    def log_shares(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log10 of each symbol's share after its context, by what is broadcast alone."""
        hashes = np.append(hashes_of(list(self.symbol)), np.uint64(0))[ids]
        share = self.root()[ids]
        for order, (context, code, there) in zip(
            self.orders, keys(hashes, begins, len(self.orders)), strict=True
        ):
            state = np.where(there, find(order.codes, context), -1)
            held = find(order.next_codes, code)
            at = np.flatnonzero(state >= 0)
            own = np.zeros(len(at))
            own[held[at] >= 0] = order.next_shares[held[at][held[at] >= 0]]
            share[at] = np.where(own > 0, own, order.rest[state[at]] * share[at])
        return np.log10(share)


def find(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Index of each code, -1 where it is missing."""
    if not len(sorted_codes):
        return np.full(len(codes), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == codes, at, -1)


def hashes_of(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every word, also of the end."""
    data, begins = joined_bytes(pa.array(words, pa.binary()))
    return word_hashes(data, begins[:-1], begins[1:])


END_HASH = hashes_of([END])[0]


def text_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, and where each text begins."""
    return text_words(texts)[:2]


def text_words(
    texts: list[bytes],
) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """``text_hashes``, the lower-cased texts in a row, and where each word begins and ends."""
    data, begins = joined_bytes(pa.array([t.lower() for t in texts], pa.binary()))
    starts, ends, row = word_spans(data, begins)
    lengths = np.bincount(row, minlength=len(texts)) + 1
    cut = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    hashes = np.full(int(cut[-1]), END_HASH, np.uint64)
    hashes[np.arange(len(row)) + row] = word_hashes(data, starts, ends)
    return hashes, cut, data.tobytes(), starts, ends


def keys(
    hashes: np.ndarray, begins: np.ndarray, depth: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every order: context in front of each token, context with token, if there is one."""
    for context, there in contexts_of(hashes, begins, depth):
        yield context.view(np.int64), after(context, hashes), there


def contexts_of(
    hashes: np.ndarray, begins: np.ndarray, depth: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every order: context in front of each token, and if there is one."""
    place = np.arange(len(hashes)) - np.repeat(begins[:-1], np.diff(begins))
    context = np.zeros(len(hashes), np.uint64)
    for back in range(1, depth + 1):
        older = np.full(len(hashes), END_HASH, np.uint64)
        older[back:] = hashes[:-back] if len(hashes) > back else hashes[:0]
        # A text begins as if an end stood in front of it, and nothing before that.
        older[place < back] = END_HASH
        context = longer(context, older, back)
        yield context, place >= back - 1


def longer(context: np.ndarray, older: np.ndarray, back: int) -> np.ndarray:
    """The key of contexts with a word more in front, which stands ``back`` words before the next."""
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + mix(older + np.uint64(back)))


def after(context: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The key of each word after its context."""
    return mix(mix(context ^ np.uint64(0xD1B54A32D192ED03)) + hashes).view(np.int64)


def key_filter(codes: DataFrame) -> np.ndarray:
    """A filter of ``FILTER_BITS`` bits that knows at least the column code."""
    place = F.pmod("code", F.lit(FILTER_BITS))
    words = (
        codes.select(place.alias("place"))
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        .toArrow()
    )
    found = np.zeros(FILTER_BITS // 64, np.int64)
    found[words["word"].to_numpy()] = words["bits"].to_numpy()
    return found


def maybe(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """False for codes the filter was not made of."""
    place = codes & (FILTER_BITS - 1)
    return (known[place >> 6] >> (place & 63)) & 1 == 1


def count_next(
    texts: DataFrame, back: int, often: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """(code, context, below, n): what follows contexts of ``back`` words, in all texts.

    ``below`` is the code of the same word after the context's suffix. A context occurs as often
    as its last word after the ones before it: ``often`` tells by the code of these if it counts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            code, context, below = (
                np.concatenate(x) if x else np.zeros(0, np.int64)
                for x in (zip(*waiting, strict=True) if waiting else ([], [], []))
            )
            waiting.clear()
            code, first, n = np.unique(code, return_index=True, return_counts=True)
            return pa.RecordBatch.from_pydict(
                {
                    "code": code,
                    "context": context[first],
                    "below": below[first],
                    "n": n.astype(np.int64),
                }
            )

        waiting, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes, begins = text_hashes(piece["text"].to_pylist())
                found = [(None, hashes.view(np.int64), None), *keys(hashes, begins, back)]
                context, code, there = found[-1]
                shorter = found[-2][1]
                last = np.roll(shorter, 1)
                last[begins[:-1]] = END_HASH.view(np.int64)
                at = np.flatnonzero(there & often(last))
                waiting.append((code[at], context[at], shorter[at]))
                size += len(at)
                if size > HELD_CODES:
                    size = 0
                    yield out()
        yield out()

    return (
        texts.select("text")
        .mapInArrow(work, "code bigint, context bigint, below bigint, n bigint")
        .groupBy("code", "context", "below")
        .agg(F.sum("n").alias("n"))
    )


def seen_often(below: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """Leaves out most codes of ``below`` (code, n) seen less than ``LEAST_CONTEXT`` times."""
    known = key_filter(below.filter(F.col("n") >= LEAST_CONTEXT))
    held = below.sparkSession.sparkContext.broadcast(known)
    return lambda codes: maybe(held.value, codes)


def grow(
    texts: DataFrame, back: int, below: DataFrame, often: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """(context, code, n, share, own, whole) of contexts of ``back`` words and what follows them.

    ``below`` has the code, count and share of next words in the state of the contexts' suffixes;
    ``often`` is that of ``count_next``. All next words of candidate contexts are returned; ``own``
    tells if the context is retained. Rows that are ``whole`` are the contexts themselves: their
    code, their occurrences, the share they leave.
    """
    spark = texts.sparkSession

    def with_shares() -> DataFrame:
        counted = store(count_next(texts, back, often), "next-words")
        under = below.select(F.col("code").alias("below"), F.col("share").alias("under"))
        return salted_join(counted, under, "below").drop("below")

    def build() -> DataFrame:
        counted, _ = settled(spark, with_shares, "next-shares")
        n = F.col("n").cast("double")
        contexts = (
            counted.groupBy("context")
            .agg(
                F.sum("n").alias("total"),
                F.count(F.lit(1)).alias("kinds"),
                F.sum(n * F.log(n / F.col("under"))).alias("logs"),
            )
            .filter(F.col("total") >= LEAST_CONTEXT)
        )
        gain = F.col("logs") - F.col("total") * F.log(F.col("total"))
        contexts = store(
            contexts.select(
                "context",
                "total",
                (F.col("kinds") * DISCOUNT / F.col("total")).alias("rest"),
                (gain > F.lit(0.5) * F.col("kinds") * F.log(F.col("total"))).alias("own"),
            ),
            "contexts",
        )
        told = salted_join(counted, contexts, "context")
        share = (n - DISCOUNT) / F.col("total") + F.col("rest") * F.col("under")
        share = F.when(F.col("own"), share).otherwise(F.col("under"))
        nexts = told.select(
            "context", "code", "n", share.alias("share"), "own", F.lit(False).alias("whole")
        )
        return nexts.unionAll(
            contexts.select(
                "context", F.col("context").alias("code"), "total", "rest", "own", F.lit(True)
            )
        )

    return settled(spark, build, "tree")[0]


def roots(counts: DataFrame, tree: SuffixTree) -> DataFrame:
    """(code, n, share) of every word at the root."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = hashes_of(batch["word"].to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_pydict({"code": code, "n": batch["n"]})

    share = F.lit(1 - tree.unseen_share()) * F.col("n") / F.lit(float(max(1, tree.tokens)))
    hashed = counts.select("word", "n").mapInArrow(work, "code bigint, n bigint")
    return store(hashed.withColumn("share", share), "roots")


def frequent_words(counts: DataFrame) -> SuffixTree:
    """What is broadcast of the root."""
    sums = counts.agg(
        F.sum("n"), F.count("n"), F.sum((F.col("n") == 1).cast("bigint"))
    ).first()
    total, words, singles = (x or 0 for x in sums)
    least = least_head(total)
    frequent = counts.filter(F.col("n") >= least).toArrow().sort_by(
        [("n", "descending"), ("word", "ascending")]
    )
    found = dict(zip(frequent["word"].to_pylist(), frequent["n"].to_pylist(), strict=True))
    if END not in found:
        ends = counts.filter(F.col("word") == F.lit(END)).first()
        found[END] = ends.n if ends else 0
    numbers = np.array([*found.values(), 0], float)
    numbers[-1] = total - numbers.sum()
    return SuffixTree({w: i for i, w in enumerate(found)}, numbers, total, words, singles)


def least_head(total: int) -> int:
    """Occurrences that make an entry one of those that are broadcast."""
    return max(2, math.ceil(total / HEAD))


def learn(texts: DataFrame, counts: DataFrame, depth: int = DEPTH) -> SuffixTree:
    """The frequent entries of the tree of the column text (binary), whose word counts are given."""
    tree = frequent_words(counts)
    least = least_head(tree.tokens)
    nexts = roots(counts, tree)
    for back in range(1, depth + 1):
        grown = grow(texts, back, nexts, seen_often(nexts))
        nexts = grown.filter(~F.col("whole"))
        head = grown.filter(F.col("own") & (F.col("n") >= least))
        head = [head.filter(F.col("whole") == x).toArrow().sort_by("code") for x in (True, False)]
        tree.orders.append(Order(*(h[c].to_numpy() for h in head for c in ("code", "share"))))
    return tree


@dataclass
class Hot:
    """Contexts of one length, keys ascending, that are dealt out over several groups."""

    codes: np.ndarray
    parts: np.ndarray


def hot_contexts(grown: DataFrame, least: int) -> Hot:
    found = grown.filter(F.col("whole") & (F.col("n") >= least)).select("code", "n").toArrow()
    found = found.sort_by("code")
    return Hot(found["code"].to_numpy(), -(-found["n"].to_numpy() // least))


def grow_hot(
    texts: DataFrame, table: DataFrame, depth: int, least: int
) -> tuple[list[DataFrame], list[Hot]]:
    """The tables of ``grow``, and their keys, for contexts seen ``least`` times or more."""
    grown, hot, nexts = [], [], table
    while len(grown) < depth:
        codes = nexts.filter(F.col("n") >= least).select("code").toArrow()["code"].to_numpy()
        if not len(codes):
            break
        held = texts.sparkSession.sparkContext.broadcast(np.sort(codes))
        grown.append(
            grow(texts, len(grown) + 1, nexts, lambda x, held=held: find(held.value, x) >= 0)
        )
        hot.append(hot_contexts(grown[-1], least))
        nexts = grown[-1].filter(~F.col("whole"))
    return grown, hot


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed: the lowest bytes of all first, as the high ones are mostly 0."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = pa.decompress(data, 4 * size, "zstd", asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


@dataclass
class Numbered:
    """Numbers of the frequent words: 0 is none, the last one that of all rare words."""

    codes: np.ndarray  # hashes, ascending
    order: np.ndarray  # and their numbers
    spelt: np.ndarray  # the hash of each number
    root: np.ndarray  # and its share; that of the last for a word that never occurred
    once: float  # the share of a word that occurred once

    @classmethod
    def of(cls, tree: SuffixTree) -> Numbered:
        hashes = hashes_of(list(tree.symbol))
        order = np.argsort(hashes)
        root = np.append(1.0, tree.root())
        once = (1 - tree.unseen_share()) / max(1, tree.tokens)
        numbers = (order + 1).astype(np.uint32)
        return cls(hashes[order], numbers, np.pad(hashes, 1), root, once)

    @property
    def rare(self) -> int:
        return len(self.root) - 1

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        return np.append(self.order, np.uint32(self.rare))[find(self.codes, hashes)]


def places(
    hashes: np.ndarray, begins: np.ndarray, depth: int, hot: list[Hot], groups: int
) -> tuple[np.ndarray, np.ndarray]:
    """Level and group of each token.

    The level is the length of its longest frequent context. The group is told by that context, at
    level 0 by that of one word; tokens of a frequent one are dealt out by the context with one
    word more, or, where there is none, by their place.
    """
    level = np.zeros(len(hashes), np.int64)
    deal = np.arange(len(hashes))
    chain = np.ones(len(hashes), bool)
    for back, (context, there) in enumerate(contexts_of(hashes, begins, depth), 1):
        context = context.view(np.int64)
        # Tokens of the frequent contexts one word shorter are dealt out by this one.
        dealt = chain & there & (back > 1)
        deal[dealt] = context[dealt]
        if back == 1:
            anchor, parts = context.copy(), np.ones(len(hashes), np.int64)
        if back > len(hot):
            break
        at = find(hot[back - 1].codes, context)
        chain &= there & (at >= 0)
        level[chain], anchor[chain] = back, context[chain]
        parts[chain] = hot[back - 1].parts[at[chain]]
        deal[chain] = np.flatnonzero(chain)
    return level, (anchor % groups + deal % parts) % groups


def occurrences(
    rows: DataFrame,
    tree: SuffixTree,
    depth: int,
    hot: list[Hot],
    groups: int,
    often: Callable[[np.ndarray], np.ndarray],
) -> DataFrame:
    """Blocks (level, bucket, first, size, docs, words, rare) of tokens, as ``places`` deals them.

    ``rows`` has text (binary) and learns. A block holds each token's text, counted from the one
    with the key ``first``, and if it is learned from; the number of its word and of those before
    it, 0 for none; and the hashes of words that have no number of their own. ``often`` knows all
    words seen ``LEAST_CONTEXT`` times: contexts end in front of others, as none is a candidate.
    """
    spark = rows.sparkSession
    numbered = Numbered.of(tree)
    held = spark.sparkContext.broadcast((numbered, hot))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered, hot = held.value
        end = numbered.numbers(hashes_of([END]))[0]
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in pieces(batch, "text", DEALT_BYTES):
                texts = piece["text"].to_pylist()
                hashes, begins = text_hashes(texts)
                level, bucket = places(hashes, begins, depth, hot, groups)
                # Narrow numbers are sorted by their digits.
                target = level * groups + bucket
                target = target.astype(np.min_scalar_type((depth + 1) * groups))
                order = np.argsort(target, kind="stable")
                text = np.repeat(np.arange(len(texts)), np.diff(begins))
                place = np.arange(len(hashes)) - begins[text]
                number = numbered.numbers(hashes)
                seen = np.where((number < numbered.rare) | often(hashes.view(np.int64)), number, 0)
                words = np.zeros((depth + 1, len(order)), np.uint32)
                spelt = np.zeros((depth + 1, len(order)), np.uint64)
                words[0], spelt[0] = number[order], hashes[order]
                for back in range(1, depth + 1):
                    older = np.zeros(len(order), np.uint32)
                    older[back:] = seen[:-back] if len(seen) > back else seen[:0]
                    older[place < back] = 0
                    older[place == back - 1] = end
                    words[back] = older[order]
                    if back > 1:
                        words[back][words[back - 1] == 0] = 0
                    spelt[back] = hashes[np.maximum(order - back, 0)]
                learns = piece["learns"].to_numpy(zero_copy_only=False)
                level, bucket, text = level[order], bucket[order], text[order]
                cuts = np.flatnonzero((np.diff(level) != 0) | (np.diff(bucket) != 0)) + 1
                starts = np.concatenate([[0], cuts]).astype(np.int64)
                blocks = []
                for start, stop in zip(starts, [*cuts, len(order)], strict=True):
                    within, own = words[:, start:stop], text[start:stop]
                    step = np.diff(own, prepend=0)
                    blocks.append(
                        (
                            packed(step * 2 + learns[own]),
                            packed(within.ravel()),
                            spelt[:, start:stop][within == numbered.rare].tobytes(),
                        )
                    )
                docs, numbers, rare = zip(*blocks, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "level": pa.array(level[starts], pa.int32()),
                        "bucket": bucket[starts],
                        "first": np.full(len(starts), key),
                        "size": pa.array(np.diff(np.append(starts, len(order))), pa.int32()),
                        "docs": pa.array(docs, pa.binary()),
                        "words": pa.array(numbers, pa.binary()),
                        "rare": pa.array(rare, pa.binary()),
                    }
                )
                key += len(texts)

    return rows.select("text", "learns").mapInArrow(
        work,
        "level int, bucket bigint, first bigint, size int, docs binary, words binary, rare binary",
    )


def rare_dealt(
    rows: DataFrame,
    tree: SuffixTree,
    table: DataFrame,
    hot: list[Hot],
    groups: int,
    often: Callable[[np.ndarray], np.ndarray],
) -> DataFrame:
    """(level, bucket, code, share, whole) of the rare words that groups of level 0 look up.

    Words that ``often`` does not know were seen once if a text that is learned from has them.
    """
    held = rows.sparkSession.sparkContext.broadcast((Numbered.of(tree), hot))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered, hot = held.value
        for batch in batches:
            for piece in pieces(batch, "text", DEALT_BYTES):
                hashes, begins = text_hashes(piece["text"].to_pylist())
                learns = piece["learns"].to_numpy(zero_copy_only=False)
                open_to = ~np.repeat(learns, np.diff(begins)) | often(hashes.view(np.int64))
                at = np.flatnonzero(open_to)
                at = at[find(numbered.codes, hashes[at]) < 0]
                # Words after frequent contexts are looked up in the tables of these.
                level, bucket = places(hashes, begins, 1, hot[:1], groups)
                at = at[level[at] == 0]
                # One row for each word and group: equal ones are next to each other.
                code, bucket = hashes[at].view(np.int64), bucket[at]
                order = np.lexsort([code, bucket])
                code, bucket = code[order], bucket[order]
                new = (np.diff(code, prepend=0) != 0) | (np.diff(bucket, prepend=-1) != 0)
                yield pa.RecordBatch.from_pydict({"bucket": bucket[new], "code": code[new]})

    known = table.filter(F.col("n") < least_head(tree.tokens)).select("code", "share")
    needed = rows.select("text", "learns").mapInArrow(work, "bucket bigint, code bigint")
    return needed.join(known, "code").select(
        F.lit(0).alias("level"), "bucket", "code", "share", F.lit(False).alias("whole")
    )


def shares_dealt(level: int, grown: DataFrame, hot: Hot, groups: int) -> DataFrame:
    """(level, bucket, code, share, whole) of what the groups of frequent contexts look up."""
    rows = pa.table({"context": hot.codes, "parts": hot.parts.astype(np.int64)})
    parts = F.broadcast(grown.sparkSession.createDataFrame(rows, "context bigint, parts bigint"))
    table = grown.filter(F.col("own") | ~F.col("whole")).join(parts, "context")
    # Where there are fewer groups than parts, one row is enough for a group.
    last = F.least(F.col("parts"), F.lit(groups)) - 1
    table = table.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    bucket = F.pmod(F.pmod("context", F.lit(groups)) + F.col("part"), F.lit(groups))
    return table.select(
        F.lit(level).alias("level"), bucket.cast("bigint").alias("bucket"), "code", "share", "whole"
    )


SUMS = "key bigint, at bigint, slot int, code bigint, n bigint, score double"
SUMS_SCHEMA = pa.schema(
    [
        ("key", pa.int64()),
        ("at", pa.int64()),
        ("slot", pa.int32()),
        ("code", pa.int64()),
        ("n", pa.int64()),
        ("score", pa.float64()),
    ]
)


def score_group(
    level: int, blocks: pa.Table, table: pa.Table, numbered: Numbered, depth: int
) -> pa.Table:
    """Sums (key, n, score) of log10 of the tokens' shares, and what the open ones need besides.

    The needs are (key, at, slot, code, n): ``at`` tells tokens with different needs apart, slot 0
    is the word at the root, 2 k - 1 and 2 k a context of k words and the token after it.
    """
    key, learns, number, words = [], [], [], []
    for block in blocks.select(["first", "size", "docs", "words", "rare"]).to_pylist():
        step = unpacked(block["docs"], block["size"])
        key.append(block["first"] + np.cumsum(step >> 1, dtype=np.int64))
        learns.append((step & 1).astype(bool))
        numbers = unpacked(block["words"], (depth + 1) * block["size"])
        numbers = numbers.reshape(depth + 1, -1)
        hashes = numbered.spelt[numbers]
        hashes[numbers == numbered.rare] = np.frombuffer(block["rare"], np.uint64)
        number.append(numbers)
        words.append(hashes)
    key, learns = np.concatenate(key), np.concatenate(learns)
    number, words = np.concatenate(number, axis=1), np.concatenate(words, axis=1)
    share = numbered.root[number[0]]
    share[learns & (number[0] == numbered.rare)] = numbered.once
    context = np.zeros(len(key), np.uint64)
    contexts, codes = [], [words[0].view(np.int64)]
    for back in range(1, level + 1):
        context = longer(context, words[back], back)
        contexts.append(context.view(np.int64))
        codes.append(after(context, words[0]))
    told = np.zeros(len(key), bool)
    for whole in (False, True):
        known = table.filter(pc.equal(table["whole"], whole)).sort_by("code")
        at = np.flatnonzero(~told & ((number[0] == numbered.rare) | (level > 0)))
        place = find(known["code"].to_numpy(), (contexts[-1] if whole else codes[level])[at])
        at, value = at[place >= 0], known["share"].to_numpy()[place[place >= 0]]
        if whole:
            share[at] *= value
        else:
            share[at], told[at] = value, True
            # A word rare at the root, or one with frequent contexts between, is open.
            is_open = ~told & ((level > 1) | (level == 1) & (number[0] == numbered.rare))
            share[is_open] = 1.0
        if not level:
            break
    for back in range(level + 1, depth + 1):
        context = longer(context, words[back], back)
        share = _in_longer(share, learns, context, after(context, words[0]), number[back] > 0)
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    tokens = np.diff(np.append(starts, len(key)))
    sums = pa.table(
        {
            "key": key[starts],
            "at": pa.nulls(len(starts), pa.int64()),
            "slot": pa.nulls(len(starts), pa.int32()),
            "code": pa.nulls(len(starts), pa.int64()),
            "n": tokens,
            "score": np.add.reduceat(np.log10(share), starts),
        }
    )
    open_at = np.flatnonzero(is_open)
    needs = [x for pair in zip(codes, contexts, strict=False) for x in pair][: 2 * level - 1]
    wanted = [
        pa.table(
            {
                "key": key[open_at],
                "at": codes[level][open_at],
                "slot": np.full(len(open_at), slot, np.int32),
                "code": code[open_at],
                "n": np.ones(len(open_at), np.int64),
                "score": np.zeros(len(open_at)),
            }
        )
        for slot, code in enumerate(needs)
    ]
    return pa.concat_tables([sums, *wanted])


def _in_longer(
    share: np.ndarray, learns: np.ndarray, context: np.ndarray, code: np.ndarray, there: np.ndarray
) -> np.ndarray:
    """The shares after one word more of context, of which all learned tokens are given."""
    share = share.copy()
    at = np.flatnonzero(there)
    if not len(at):
        return share
    code, first, kind = np.unique(code[at], return_index=True, return_inverse=True)
    n = np.bincount(kind, learns[at], len(code))
    context, state = np.unique(context[at][first], return_inverse=True)
    total = np.bincount(state, n, len(context))
    kinds = np.bincount(state, n > 0, len(context))
    under = np.ones(len(code))
    taught = np.flatnonzero(learns[at])
    under[kind[taught]] = share[at[taught]]
    logs = np.bincount(state, n * np.log(np.maximum(n, 1) / under), len(context))
    logs -= total * np.log(np.maximum(total, 1))
    own = (total >= LEAST_CONTEXT) & (logs > 0.5 * kinds * np.log(np.maximum(total, 1)))
    rest = kinds * DISCOUNT / np.maximum(total, 1)
    mine = np.flatnonzero(own[state[kind]])
    kind, at = kind[mine], at[mine]
    state = state[kind]
    share[at] *= rest[state]
    share[at] += np.maximum(n[kind] - DISCOUNT, 0) / total[state]
    return share


def token_sums(
    rows: DataFrame, tree: SuffixTree, table: DataFrame, depth: int, grown: list[DataFrame],
    hot: list[Hot], groups: int,
) -> DataFrame:
    """(key, at, slot, code, n, score) of all tokens, added up."""
    often = seen_often(table)
    shares = rare_dealt(rows, tree, table, hot, groups, often)
    for level, (longer_ones, frequent) in enumerate(zip(grown, hot, strict=True), 1):
        shares = shares.unionAll(shares_dealt(level, longer_ones, frequent, groups))
    held = rows.sparkSession.sparkContext.broadcast(Numbered.of(tree))

    def work(key: tuple[pa.Scalar, ...], blocks: pa.Table, known: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return SUMS_SCHEMA.empty_table()
        level = key[0].as_py()
        return score_group(level, blocks, known, held.value, depth).cast(SUMS_SCHEMA)

    blocks = occurrences(rows, tree, depth, hot, groups, often)
    return (
        blocks.groupBy("level", "bucket")
        .cogroup(shares.groupBy("level", "bucket"))
        .applyInArrow(work, SUMS)
        .groupBy("key", "at", "slot", "code")
        .agg(F.sum("n").alias("n"), F.sum("score").alias("score"))
    )


def score(
    docs: DataFrame,
    learns: Column,
    depth: int = DEPTH,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score.

    ``learns`` tells which rows are learned from. Words are runs of other bytes than space and
    0x09-0x0D after lower-casing A-Z, and every text has one end. ``base_score`` adds
    log10((c + 1) / (N + V + 1)) of the training counts, ``score`` is log10 of the tree's
    share for the whole text; both count every unknown word as one and the same. Null counts
    as empty: one token. With nothing to learn from, base_score is 0. Rows that repeat are
    scored each. Other columns are not read.
    """
    text = whole_text(text_column).cast("binary").alias("text")
    texts = docs.filter(learns).select(text)
    counts = store(word_counts(texts), "word-counts")
    tree = frequent_words(counts)
    table = roots(counts, tree)
    spark = docs.sparkSession
    below = float(tree.tokens + tree.words + 1)
    base = np.log10((np.append(0.0, tree.counts) + 1) / below)
    base[-1] = 0
    known = np.append(0.0, tree.counts) > 0
    known[-1] = False
    held = spark.sparkContext.broadcast((Numbered.of(tree), base, known))
    taught = F.coalesce(learns, F.lit(False)).alias("learns")
    rows = docs.select(F.col(id_column).alias("id"), text, taught)
    id_type = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered, base, known = held.value
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes, begins, data, first, last = text_words(piece["text"].to_pylist())
                number = numbered.numbers(hashes)
                starts = begins[:-1]
                rare = np.flatnonzero(number == numbered.rare)
                cut = np.searchsorted(rare, begins).astype(np.int32)
                # Every text before has one token more than words.
                word = rare - (np.searchsorted(begins, rare, "right") - 1)
                spelt = [data[i:j] for i, j in zip(first[word], last[word], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": np.arange(key, key + len(piece)),
                        "id": piece["id"],
                        "n_tokens": np.diff(begins),
                        "n_known": np.add.reduceat(known[number].astype(np.int64), starts),
                        "base": np.add.reduceat(base[number], starts),
                        "rare": pa.ListArray.from_arrays(cut, pa.array(spelt, pa.binary())),
                    }
                )
                key += len(piece)

    scored = store(
        rows.select("id", "text").mapInArrow(
            work,
            f"key bigint, id {id_type}, n_tokens bigint, n_known bigint, base double, "
            "rare array<binary>",
        ),
        "scored",
    )
    rare = scored.select("key", F.explode("rare").alias("word"))
    rare_counts = counts.filter(F.col("n") < least_head(tree.tokens)).withColumnRenamed("n", "c")
    c = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    more = (
        rare.join(rare_counts, "word", "left")
        .groupBy("key")
        .agg(
            F.sum((c > 0).cast("bigint")).alias("known_more"),
            F.sum(F.log10((c + 1) / F.lit(below))).alias("base_more"),
        )
    )
    tokens = scored.agg(F.sum("n_tokens")).first()[0] or 0
    shares, _ = settled(
        spark, lambda: _score_sums(rows, texts, tree, table, depth, tokens), "scores"
    )
    zero = F.lit(0.0)
    # The texts are read twice: another order of their rows must not go unnoticed.
    same = F.col("n_tokens").eqNullSafe(F.col("n_scored"))
    whole = F.when(same, F.col("score")).otherwise(
        F.raise_error(F.lit("the rows to score came in another order when read again"))
    )
    return (
        scored.drop("rare")
        .join(more, "key", "left")
        .join(shares, "key", "left")
        .select(
            F.col("id").alias(id_column),
            "n_tokens",
            (F.col("n_known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
            F.lit(tree.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("base_more", zero)).alias("base_score"),
            whole.cast("double").alias("score"),
        )
    )


def _score_sums(
    rows: DataFrame, texts: DataFrame, tree: SuffixTree, table: DataFrame, depth: int, tokens: int
) -> DataFrame:
    """(key, n_scored, score) of every row: log10 of the tree's share, and of how many tokens."""
    groups = max(1, -(-tokens // GROUP))
    grown, hot = grow_hot(texts, table, depth, max(LEAST_CONTEXT, GROUP))
    sums = store(token_sums(rows, tree, table, depth, grown, hot, groups), "sums")
    known = table.select("code", F.col("share").alias("value"))
    # What follows contexts of the greatest length is never needed by a token of a longer one.
    for longest in grown[:-1]:
        known = known.unionAll(longest.filter("own").select("code", "share"))
    opened = _open_scores(sums.filter("at IS NOT NULL"), known, tree, max(0, len(grown) - 1))
    closed = sums.filter("at IS NULL").select("key", F.col("n").alias("n_scored"), "score")
    return closed.join(opened, "key", "left").select(
        "key", "n_scored", (F.col("score") + F.coalesce("score_more", F.lit(0.0))).alias("score")
    )


def _open_scores(needs: DataFrame, known: DataFrame, tree: SuffixTree, depth: int) -> DataFrame:
    """(key, score_more): log10 of the shares of the tokens that need the tables.

    ``needs`` is that of ``score_group``, ``known`` (code, value) the root and the retained contexts
    of up to ``depth`` words, with what they leave, and what follows them.
    """
    told = needs.join(known, "code", "left")
    slots = [
        F.max(F.when(F.col("slot") == i, F.col("value"))).alias(f"s{i}") for i in range(2 * depth + 1)
    ]
    share = F.coalesce("s0", F.lit(tree.unseen_share()))
    for k in range(1, depth + 1):
        # A next word is in the table only if its context is retained.
        share = F.coalesce(f"s{2 * k}", F.coalesce(f"s{2 * k - 1}", F.lit(1.0)) * share)
    return (
        told.groupBy("key", "at")
        .agg(F.max("n").alias("n"), *slots)
        .groupBy("key")
        .agg(F.sum(F.col("n") * F.log10(share)).alias("score_more"))
    )
