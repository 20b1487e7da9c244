"""URL filter by a cascade of Bloom filters: exact membership without a join.

The listed keys are known, and so is every key that will be asked for: the distinct keys of the
corpus. Level 1 encodes the listed keys; some unlisted ones pass it as well. Level 2 encodes
those, level 3 the listed keys that level 2 passes by mistake, and so on until a level makes no
mistake. The first level that does not know a key decides, so every key of the corpus gets its
true answer from a few bits per listed key.

Bit positions are computed and or-ed together by Spark; the driver sees stretches of filter words
only. Different keys that share both hashes, one listed and one not, pass every level; what is left
after ``MOST_LEVELS`` is decided by comparing the keys themselves. Keys are spread over shards by hash so that no filter outgrows ``SHARD_BITS``. Shards are built
and broadcast in blocks of at most ``BLOCK_BYTES``, one after the other, and each block judges
the rows of its shards; so the driver never holds more than one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import ascii_lower
from counterfoil.sources.storage import store

ALLOW, BLOCK = "allow", "block"
#: Bits of one filter level of one shard: 4 MB.
SHARD_BITS = 1 << 25
#: Bytes of filters in one broadcast.
BLOCK_BYTES = 64 << 20
#: Levels of a cascade; each but the last few lets a sixteenth through.
MOST_LEVELS = 60
#: Filter words that Spark packs together.
STRETCH = 1 << 12
#: Seeds of the two hashes that Spark computes per key; a level adds its number.
SEEDS = (0x5EED, 0xB10C)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, below a path prefix."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column, path: Column) -> Column:
    return F.concat(host, path)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does.

    The rules are a short parameter. Rules of one length with different texts cannot fit one
    url unless their host and path parts differ; then the one with the longer host wins.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: dict[int, np.ndarray]  # by shard


@dataclass(frozen=True)
class Cascade:
    """Levels of filters by shard. ``knows`` takes the two key hashes; it is not right for the
    hashes (first, second) in ``twins``, which a listed and another key share."""

    shards: int
    levels: tuple[Level, ...]
    twins: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"twins": None}

    def size(self) -> int:
        """Bytes of all filters."""
        return sum(8 * len(words) for level in self.levels for words in level.words.values())

    def knows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether a key is listed; right for every key of the universe."""
        answer = np.zeros(len(first), bool)
        shard = first % self.shards
        undecided = np.arange(len(first))
        for number, level in enumerate(self.levels):
            passes = np.zeros(len(undecided), bool)
            for s in np.unique(shard[undecided]):
                words = level.words.get(int(s))
                if words is None:
                    continue
                mine = np.flatnonzero(shard[undecided] == s)
                at = undecided[mine]
                held = np.ones(len(at), bool)
                for i in range(level.hashes):
                    place = positions(first[at], second[at], number, i, level.bits)
                    held &= (words[place >> 6] >> (place & 63)) & 1 == 1
                passes[mine] = held
            # Failing level n: not among those it encodes, so the answer of level n - 1.
            answer[undecided[~passes]] = number % 2 == 1
            undecided = undecided[passes]
        answer[undecided] = len(self.levels) % 2 == 1
        return answer


def positions(first, second, level: int, i: int, bits: int):
    """The i-th bit of a key at a level: double hashing, with another step at each level.

    For numpy arrays and, through ``position_column``, for Spark columns alike. Both hashes
    are cut to 31 bits, so no product overflows.
    """
    return (first // 64 + (i + 1) * (second * (2 * level + 1) % 2147483629)) % bits


def position_column(first: Column, second: Column, level: int, i: int, bits: int) -> Column:
    step = second * F.lit(2 * level + 1) % F.lit(2147483629)
    return (F.floor(first / 64) + F.lit(i + 1) * step) % F.lit(bits)


def hashes_of(key: Column) -> tuple[Column, Column]:
    """Two hashes of 45 and 31 bits, not negative."""
    first = F.xxhash64(F.lit(SEEDS[0]), key).bitwiseAND(F.lit((1 << 45) - 1))
    second = F.xxhash64(F.lit(SEEDS[1]), key).bitwiseAND(F.lit((1 << 31) - 1))
    return first, second


def build_cascades(
    listed: DataFrame, universe: DataFrame, key: str = "key"
) -> Iterator[tuple[range, Cascade]]:
    """Cascades that tell the ``listed`` keys from all other keys of ``universe``.

    Each is for a block of shards. Both tables need the column ``key`` only; null keys and
    repeated keys are fine. A listed key that the corpus does not have is encoded too. Empty
    lists and empty universes work.
    """
    column = F.col(f"`{key}`")
    first, second = hashes_of(F.col("key"))
    keys = (
        listed.select(column.alias("key"), F.lit(True).alias("listed"))
        .unionByName(universe.select(column.alias("key"), F.lit(False).alias("listed")))
        .filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.max("listed").alias("listed"))
        .select(first.alias("first"), second.alias("second"), "listed")
    )
    keys = store(keys, "cascade-keys")
    shards = max(1, math.ceil(16 * keys.filter("listed").count() / SHARD_BITS))
    # Later levels encode a sixteenth and less: a shard has two times its first level at most.
    per_block = max(1, BLOCK_BYTES // (SHARD_BITS // 4))
    for start in range(0, shards, per_block):
        block = range(start, min(start + per_block, shards))
        mine = keys
        if len(block) < shards:
            mine = store(keys.filter(_in_block(F.col("first"), shards, block)), "cascade-block")
        yield block, _cascade(mine, shards, len(block))


def _in_block(first: Column, shards: int, block: range) -> Column:
    return (first % shards).between(block[0], block[-1])


def _cascade(keys: DataFrame, shards: int, here: int) -> Cascade:
    """The levels for (first, second, listed), whose keys lie in ``here`` of all shards."""
    sums = {r[0]: r[1] for r in keys.groupBy("listed").count().collect()}
    left = {True: sums.get(True, 0), False: sums.get(False, 0)}
    levels: list[Level] = []
    side = True
    while left[side]:
        number = len(levels)
        # A level lets one in 16 others through, or fewer if there are many more others than
        # keys. Half would do with fewer bits in sum, but each level is a round of Spark jobs.
        hashes = max(4, round(math.log2(max(1.0, left[not side] / left[side]))))
        bits = 64 * max(1, math.ceil(left[side] / here * hashes * 1.4427 / 64) + 1)
        place = F.explode(
            F.array(
                *[
                    position_column(F.col("first"), F.col("second"), number, i, bits)
                    for i in range(hashes)
                ]
            )
        )
        ored = (
            keys.filter(F.col("listed") == side)
            .select((F.col("first") % shards).alias("shard"), place.alias("place"))
            .groupBy("shard", F.floor(F.col("place") / 64).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        )
        stretch = F.floor(F.col("word") / STRETCH).alias("stretch")
        words = {}
        for r in ored.select("shard", stretch, "word", "bits").groupBy("shard", "stretch").applyInArrow(
            _packed, "shard bigint, stretch bigint, packed binary"
        ).toLocalIterator():
            if r.shard not in words:
                words[r.shard] = np.zeros(bits // 64, np.int64)
            start = r.stretch * STRETCH
            held = np.frombuffer(r.packed, np.int64)[: bits // 64 - start]
            words[r.shard][start : start + len(held)] = held
        levels.append(Level(bits, hashes, words))
        # Of the other side only what passes this level goes on.
        other = keys.filter(F.col("listed") != side)
        mine = keys.filter(F.col("listed") == side)
        passing = other.filter(_passes(keys, Cascade(shards, (levels[-1],)), number))
        keys = store(mine.unionByName(passing), "cascade-keys")
        left[not side] = keys.filter(F.col("listed") != side).count()
        side = not side
        if len(levels) == MOST_LEVELS and left[side]:
            return Cascade(shards, tuple(levels), keys.select("first", "second").distinct())
    return Cascade(shards, tuple(levels))


def _packed(key: tuple, words: pa.Table) -> pa.Table:
    """The words of one stretch as bytes, those without bits zero."""
    shard, stretch = (k.as_py() for k in key)
    held = np.zeros(STRETCH, np.int64)
    held[words["word"].to_numpy() - stretch * STRETCH] = words["bits"].to_numpy()
    return pa.table({"shard": [shard], "stretch": [stretch], "packed": [held.tobytes()]})


def _passes(df: DataFrame, one: Cascade, number: int) -> Column:
    held = df.sparkSession.sparkContext.broadcast((one.levels[0], one.shards))

    @F.pandas_udf("boolean")
    def passes(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        level, shards = held.value
        for a, b in parts:
            first, second = a.to_numpy(), b.to_numpy()
            result = np.zeros(len(first), bool)
            for s, words in level.words.items():
                at = np.flatnonzero(first % shards == s)
                ok = np.ones(len(at), bool)
                for i in range(level.hashes):
                    place = positions(first[at], second[at], number, i, level.bits)
                    ok &= (words[place >> 6] >> (place & 63)) & 1 == 1
                result[at] = ok
            yield pd.Series(result)

    return passes(F.col("first"), F.col("second"))


def _member(held: Broadcast) -> Callable[..., Column]:
    @F.pandas_udf("boolean")
    def knows(pieces: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for first, second in pieces:
            yield pd.Series(held.value.knows(first.to_numpy(), second.to_numpy()))

    return knows


def with_membership(
    df: DataFrame, cascades: Iterable[tuple[range, Cascade]], key: Column, name: str
) -> DataFrame:
    """Add whether a key is listed; a null key is not. Rows are neither joined nor moved."""
    first, second = hashes_of(key)
    parts = []
    for block, cascade in cascades:
        member = _member(df.sparkSession.sparkContext.broadcast(cascade))(first, second)
        rows = df
        if len(block) < cascade.shards:
            # A null key has the hash of nothing, and so a block as well.
            rows = df.filter(_in_block(first, cascade.shards, block))
        parts.append(rows.withColumn(name, member & key.isNotNull()))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _told_apart(judged: DataFrame, key: Column, twins: DataFrame, listed: DataFrame) -> DataFrame:
    """``judged`` with the keys whose hashes are in ``twins`` looked up themselves."""
    first, second = hashes_of(F.col("key"))
    exact = listed.select("key").distinct().select(
        F.col("key").alias("__key"), first.alias("first"), second.alias("second"), F.lit(True).alias("__in")
    )
    exact = exact.join(twins, ["first", "second"], "left_semi").select("__key", "__in")
    first, second = hashes_of(key)
    pairs = twins.select(
        F.col("first").alias("__first"), F.col("second").alias("__second"), F.lit(True).alias("__twin")
    )
    same = (first == F.col("__first")) & (second == F.col("__second"))
    told = judged.join(pairs, same, "left").join(exact, key == F.col("__key"), "left")
    answer = F.when(F.col("__twin"), F.coalesce("__in", F.lit(False))).otherwise(F.col("listed"))
    return told.withColumn("listed", answer).select(*judged.columns)


def listed_by(rules: Sequence[Rule], keys: DataFrame) -> DataFrame:
    """The keys (columns host, path, key) that the rules block."""
    _, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    return keys.filter(verdict == BLOCK).select("key")


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per input row: id, host, path, the longest fitting rule, the verdict.

    ``listed`` has a column ``key`` of host and path run together. The cascade encodes these
    keys and those that the rules block, less those that the rules allow; a page is blocked
    if its key is in the cascade. Without a rule and without a listing the verdict is allow.
    A null url, or one without ``://``, has the empty host, path and key, which no rule fits.
    Rows that repeat are judged each by itself; urls of any length are judged whole; no rows give
    no rows. Other columns are not read.
    """
    parts = pages.select(
        F.col(id_column).alias(id_column),
        host_of(F.col(url_column)).alias("host"),
        path_of(F.col(url_column)).alias("path"),
    )
    keys = store(
        parts.select("host", "path").distinct().withColumn("key", key_of(F.col("host"), F.col("path"))),
        "url-keys",
    )
    blocked = listed_by(rules, keys)
    if listed is not None:
        _, verdict = longest_rule(rules, F.col("host"), F.col("path"))
        allowed = keys.filter(verdict == ALLOW).select("key")
        blocked = blocked.unionByName(listed.select("key").join(allowed, "key", "left_anti"))
    key = key_of(F.col("host"), F.col("path"))
    cascades = list(build_cascades(blocked, keys))
    judged = with_membership(parts, cascades, key, "listed")
    for _, cascade in cascades:
        if cascade.twins is not None:
            judged = _told_apart(judged, key, cascade.twins, blocked)
    rule, _ = longest_rule(rules, F.col("host"), F.col("path"))
    verdict = F.when(F.col("listed"), BLOCK).otherwise(ALLOW)
    return judged.select(
        id_column, "host", "path", rule.alias("rule"), verdict.alias("verdict")
    )
