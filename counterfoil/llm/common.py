"""What the operators of this package share: inputs, folds, word spans, joins on hot keys."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words, as bytes and as the pattern of a word.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
WORD = r"[^\x20\x09-\x0D]+"

#: What byte-level tokenizers cut a text by, and the same for a text of ASCII signs only: the
#: standard engine is faster, and ``re.ASCII`` goes with it. Fixed values.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRE_TOKEN_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

#: A key with one of so many parts of all rows is dealt out apart; there are no more such keys.
HOT_SHARE = 1000
#: Below so many rows no key is worth dealing out.
HOT_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls into fold 0."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(folds), F.lit(0))


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with more underscores in front if a column has that name already."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def positions(rows: DataFrame, name: str = "place") -> DataFrame:
    """Dense positions 0, 1, 2... for the rows of a stored table, by file and place in it.

    Files are fixed once written, so a task that runs again numbers its rows alike; those of a
    sorted table are in its order. The only global step has one row per file.
    """
    file, at, first = (unused(c, rows) for c in ("__file", "__at", "__first"))
    placed = rows.select(
        "*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(at)
    )
    files = placed.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select(file, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(first))
    return placed.join(F.broadcast(begins), file).select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col(first) + F.col(at)).alias(name)
    )


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join many rows of ``left`` per key with at most one of ``right`` per key.

    Keys that hold a thousandth of the left rows or more, at most ``HOT_SHARE`` of them, are
    dealt out over several salts; their right rows are repeated once per salt. All other keys
    are small by definition. ``left`` is read twice, so pass a stored table or a scan.
    """
    rows_, parts_, salt_ = (unused(c, left, right) for c in ("__rows", "__parts", "__salt"))
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias(rows_))
    total = left.count()
    least = max(-(-total // HOT_SHARE), HOT_ROWS)
    hot = (
        counts.filter(F.col(rows_) >= least)
        .select(F.col(key), F.ceil(F.col(rows_) / F.lit(least)).cast("int").alias(parts_))
        .filter(F.col(key).isNotNull())
    )
    rows = hot.collect()
    if not rows:
        return left.join(right, key, how)
    hot = F.broadcast(left.sparkSession.createDataFrame(rows, hot.schema))
    parts = F.coalesce(F.col(parts_), F.lit(1))
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), parts).cast("int")
    one = left.join(hot, key, "left").withColumn(salt_, dealt).drop(parts_)
    many = right.join(hot, key, "left").withColumn(
        salt_, F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return one.join(many.drop(parts_), [key, salt_], how).drop(salt_)


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the column holds at most ``most`` bytes a piece, or one row.

    What a worker needs beside the batch is some tens of bytes for each byte of a piece.
    """
    array = batch.column(column)
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    start = 0
    while start < len(array):
        stop = int(np.searchsorted(ends, ends[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), len(array))
        yield batch.slice(start, stop - start)
        start = stop


def joined_bytes(array: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column without nulls, and where each row begins, with the end."""
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    ends = ends.astype(np.int64)
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = ~np.isin(_BYTES, list(SPACES))


def word_spans(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in joined texts, and the row it belongs to."""
    inside = IN_WORD[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    firsts = begins[:-1][np.diff(begins) > 0]
    starts[firsts] = inside[firsts]
    lasts = begins[1:][np.diff(begins) > 0] - 1
    ends[lasts] = inside[lasts]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(begins, at, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit moves about half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
