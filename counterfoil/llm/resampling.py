"""Importance resampling towards a target: scores from an array, ranks from a distributed radix sort.

**Scores.** Every word of a text falls into one of a fixed number of buckets. Both corpora are
counted per bucket; the log ratio of the smoothed shares is the bucket's gain, an array of fixed
size that is broadcast. A document's weight is the mean gain of its words, and a hashed Gumbel
number added to it turns "the highest scores" into a draw without replacement.

**Ranks.** The eligible documents are narrow rows (score, id, number of words) at dense positions,
cut into blocks of consecutive positions. The composite key is read as digits, the least
significant first. One stable counting-sort pass for each digit: Spark counts (block, digit), prefix
sums of the counts over digits and then blocks say where each block's run of a digit begins, and
within a block the rows keep their order. The destination is the next position; after the last
digit it is the rank. Positions are dense, so every block has the same number of rows whatever the
keys, ties and repeated rows are, and no task ever sorts or holds more than a block.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.llm.common import LOWER, joined_bytes, pieces, positions, whole_text
from counterfoil.sources.storage import local_table, store

BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
#: Bits of a digit at most; 2 ** DIGIT_BITS counts per block.
DIGIT_BITS = 13
#: Rows of a block: as many as give one block a shuffle partition, within these bounds.
LEAST_BLOCK, MOST_BLOCK = 2_048, 1 << 20
#: What is ranked, and carried from pass to pass.
COLUMNS = ["id", "n_features", "weight", "score"]
#: Words of so many bytes are hashed all at once, longer ones one by one.
LONG_WORD = 48

_B = np.arange(256)
#: 0-9, a-z after lower-casing, and whatever lies beyond ASCII.
IN_WORD = ((_B >= 0x30) & (_B <= 0x39)) | ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)


def crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32 polynomial."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0xEDB88320), values >> 1)
    return values


CRC = crc_table()


def words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start and end of every word; no word spans two texts."""
    data = LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins[:-1]] = True  # a text begins here
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return data, starts, ends


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every span, all spans of one length together."""
    length = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(length, LONG_WORD + 1), kind="stable")
    at, size = starts[order], length[order]
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))
    crc = out[order]
    for k in range(int(size[long]) if long < len(size) else 0):
        upto = int(np.searchsorted(-size, -k, "left"))  # spans with more than k bytes
        part = crc[long:upto]
        crc[long:upto] = CRC[(part ^ data[at[long:upto] + k]) & 0xFF] ^ (part >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        crc[i] = zlib.crc32(data[at[i] : at[i] + size[i]])
    out[order] = crc
    return out


def buckets(texts: pa.BinaryArray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and where each text's words begin, with the end."""
    data, begins = joined_bytes(texts)
    data, starts, ends = words(data, begins)
    return crc32(data, starts, ends) % np.uint32(count), np.searchsorted(starts, begins)


def binary_text(df: DataFrame, text_column: str) -> Column:
    return whole_text(text_column).cast("binary").alias("text")


def bucket_counts(df: DataFrame, text_column: str, count: int) -> np.ndarray:
    """Features per bucket over all texts: one array per task, added up by Spark."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, _ = buckets(piece["text"], count)
                total += np.bincount(found, minlength=count)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held.astype(np.int32), "n": total[held]})

    counts = df.select(binary_text(df, text_column)).mapInArrow(tally, "bucket int, n bigint")
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(count, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares of target and raw corpus, per bucket."""
    size = float(len(raw))
    up = (target + 1.0) * (float(raw.sum()) + size)
    down = (raw + 1.0) * (float(target.sum()) + size)
    return np.array([math.floor(1000.0 * math.log(r)) for r in up / down], np.int64)


def scored(
    docs: DataFrame, gain: np.ndarray, seed: str, id_column: str, text_column: str
) -> DataFrame:
    """id, n_features, weight and score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, first = buckets(piece["text"], len(gain))
                total = np.concatenate([[0], np.cumsum(gain[found])])
                n = np.diff(first)
                weight = (total[first[1:]] - total[first[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_pydict(
                    {"id": piece["id"], "n_features": n.astype(np.int64), "weight": weight}
                )

    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), binary_text(docs, text_column))
    rows = rows.mapInArrow(weigh, "id bigint, n_features bigint, weight bigint")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + gumbel)


@dataclass
class Field:
    """``width`` bits of the composite key, from the unsigned ``value``."""

    value: Column
    width: int


def key_fields(score: tuple[int, int], ids: tuple[int, int], size: tuple[int, int]) -> list[Field]:
    """The composite key, least significant field first: score descending, id ascending with null
    last, number of features ascending. Widths cover the ranges that occur."""
    low, high = ids
    return [
        Field(F.col("n_features") - size[0], (size[1] - size[0]).bit_length()),
        # Only the bits below the ids' common beginning order them; the sign bit counts reversed.
        Field(
            F.coalesce(F.col("id"), F.lit(0)).bitwiseXOR(F.lit(-(1 << 63))),
            (low ^ high).bit_length() if (low < 0) == (high < 0) else 64,
        ),
        Field(F.col("id").isNull().cast("bigint"), 1),
        Field(F.lit(score[1]) - F.col("score"), (score[1] - score[0]).bit_length()),
    ]


def digit(fields: list[Field], low: int, high: int) -> Column:
    """Bits ``low`` to ``high`` of the composite key."""
    out, at = F.lit(0).cast("bigint"), 0
    for field in fields:
        a, b = max(low, at), min(high, at + field.width)
        if a < b:
            bits = F.shiftrightunsigned(field.value, a - at).bitwiseAND(F.lit((1 << (b - a)) - 1))
            out = out.bitwiseOR(F.shiftleft(bits, a - low))
        at += field.width
    return out.cast("int")


def run_starts(counted: DataFrame, kinds: int) -> DataFrame:
    """(block, digit, first): the position of the first row of a block's run of a digit.

    ``counted`` has the rows per (block, digit). A digit's rows begin after those of all smaller
    digits (``kinds`` numbers at most, on the driver) and a block's after those of earlier blocks.
    """
    counted = store(counted, "digit-counts")
    totals = np.zeros(kinds + 1, np.int64)
    told = counted.groupBy("digit").agg(F.sum("n").alias("n")).toArrow()
    totals[told["digit"].to_numpy() + 1] = told["n"].to_numpy()
    held = [(d, int(n)) for d, n in enumerate(np.cumsum(totals)[:-1]) if totals[d + 1]]
    schema = T.StructType.fromDDL("digit int, base bigint")
    base = local_table(counted.sparkSession, held, schema)
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.join(F.broadcast(base), "digit").select(
        "block",
        "digit",
        (F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("first"),
    )


def destinations(rows: pa.Table, runs: pa.Table) -> pa.Table:
    """The rows of one block with their next position as ``place``."""
    rows = rows.sort_by("place")
    digits = rows["digit"].to_numpy()
    order = np.argsort(digits, kind="stable")
    ordered = digits[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    within = np.arange(len(ordered)) - begin[np.cumsum(new) - 1]
    first = np.zeros(int(ordered[-1]) + 1 if len(ordered) else 0, np.int64)
    first[runs["digit"].to_numpy()] = runs["first"].to_numpy()
    moved = rows.take(pa.array(order))
    place = pa.array(first[ordered] + within)
    return moved.select(COLUMNS).append_column("place", place)


def radix_ranks(rows: DataFrame) -> DataFrame:
    """``rows`` (id, n_features, weight, score; a stored table) with their ``place`` from 0 in the
    order of score descending, id ascending, null last, and number of features."""
    spark = rows.sparkSession
    told = rows.agg(
        F.count(F.lit(1)),
        *[f(c) for c in ("score", "id", "n_features") for f in (F.min, F.max)],
    ).first()
    count, (s0, s1, i0, i1, n0, n1) = told[0], [x or 0 for x in told[1:]]
    if not count:
        return rows.withColumn("place", F.lit(None).cast("bigint"))
    fields = key_fields((s0, s1), (i0, i1), (n0, n1))
    bits = max(1, sum(f.width for f in fields))
    passes = -(-bits // DIGIT_BITS)
    width = -(-bits // passes)
    even = -(-count // int(spark.conf.get("spark.sql.shuffle.partitions")))
    block_rows = min(max(even, LEAST_BLOCK), MOST_BLOCK)
    placed = positions(rows)
    for k in range(passes):
        placed = placed.select(
            *COLUMNS,
            "place",
            F.expr(f"place div {block_rows}").alias("block"),
            digit(fields, k * width, min(bits, (k + 1) * width)).alias("digit"),
        )
        counted = placed.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n"))
        starts = run_starts(counted, 1 << width)
        moved = (
            placed.groupBy("block")
            .cogroup(starts.groupBy("block"))
            .applyInArrow(destinations, ", ".join(f"{c} bigint" for c in [*COLUMNS, "place"]))
        )
        placed = store(moved, f"radix-pass-{k}")
    return placed


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    count: int = BUCKETS,
    seed: str = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """One row per input row: id, ``n_features``, ``weight``, ``score`` and, where drawn, ``rank``.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) with
    the highest scores are drawn, ties to the smaller id, null ids last; rows that agree in score
    and id rank by their number of features, and are interchangeable if that is equal too. Null and
    empty texts have no features, weight 0 and are never drawn; a null id draws its number as if
    its text were empty. Rows that repeat take part each. An empty target gives every bucket the
    same count; no rows give no rows. Texts are read whole; other columns are not read, whatever
    their names. Ids must be whole numbers of 64 bits.
    """
    raw = bucket_counts(docs, text_column, count)
    wanted = bucket_counts(target, target_column, count)
    rows = scored(docs, gains(raw, wanted), seed, id_column, text_column)
    all_rows = store(rows, "importance-scores")
    fits = F.col("n_features") >= least_words
    eligible = store(all_rows.filter(fits), "eligible")
    drawn = F.expr(f"{eligible.count()} * {percent} div 100")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    ranked = radix_ranks(eligible).withColumn("rank", rank)
    rest = all_rows.filter(~fits).withColumn("rank", F.lit(None).cast("bigint"))
    out = [*COLUMNS, "rank"]
    return ranked.select(out).unionByName(rest.select(out)).withColumnRenamed("id", id_column)
