"""Vector codes: a vector becomes one byte for each of its parts, the nearest entry of a codebook.

The nearest entry is looked up by slice and intersect. For every dimension the entries'
coordinates are sorted, and each place of that order carries a bit mask of the entries before it.
A query asks for a cube: per dimension the coordinates within the radius are a slice, the masks at
its two ends differ by just the slice's entries, and the masks of all dimensions are ANDed. Whatever
lies within the radius is in the cube, so once the best candidate does, it is the nearest of all
entries, ties included. Otherwise the radius becomes that candidate's distance, or doubles while the
cube is empty.

Codebooks are refined in rounds: every task assigns its vectors and adds them up per entry, Spark
adds the tasks' sums, and the driver divides. Sums and codebooks have a fixed size (entries times
components), whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.llm.common import salted_join
from counterfoil.sources.storage import store

PARTS = 4
#: A code has two hex digits.
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Differences (vectors x entries x dimensions) a worker holds at once.
HELD = 1 << 21
#: Beyond one candidate in so many entries, all distances of a chunk come from one product.
DENSE = 16
#: Integers up to here are exact as doubles.
EXACT = 1 << 53


class Codebook:
    """The entries of one part, and the masks to look them up by."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        count, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(entries, order, axis=0)
        bits = np.zeros((count, -(-count // 64)), np.uint64)
        at = np.arange(count)
        bits[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        self.all = np.bitwise_or.reduce(bits, axis=0)
        # before[d, i]: the entries in front of place i in the order of dimension d.
        self.before = np.zeros((dims, count + 1, bits.shape[1]), np.uint64)
        for d in range(dims):
            self.before[d, 1:] = np.bitwise_or.accumulate(bits[order[:, d]], axis=0)
        self.radius = self._spacing()

    def _spacing(self) -> int:
        """The radius to begin with: half of the entries have another one so near."""
        if len(self.entries) < 2:
            return 1
        nearest = []
        for i, entry in enumerate(self.entries):
            square = ((self.entries - entry) ** 2).sum(axis=1)
            nearest.append(np.delete(square, i).min())
        return max(1, int(np.ceil(np.sqrt(np.median(nearest)))))

    def within(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries whose every coordinate is at most the radius away."""
        masks = np.repeat(self.all[None, :], len(x), axis=0)
        for d in range(x.shape[1]):
            low = np.searchsorted(self.coordinates[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.coordinates[:, d], x[:, d] + radius, "right")
            masks &= self.before[d, high] & ~self.before[d, low]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry; of equal ones the first."""
        index = np.zeros(len(x), np.int64)
        square = np.zeros(len(x), np.int64)
        radius = np.full(len(x), self.radius, np.int64)
        chunk = max(1, HELD // max(1, self.entries.size))
        open_rows = np.arange(len(x))
        while len(open_rows):
            left = []
            for start in range(0, len(open_rows), chunk):
                rows = open_rows[start : start + chunk]
                found, best = self._best(x[rows], self.within(x[rows], radius[rows]))
                index[rows], square[rows] = found, best
                left.append(rows[(best < 0) | (best > radius[rows] ** 2)])
            open_rows = np.concatenate(left)
            seen = square[open_rows]
            radius[open_rows] = np.where(seen < 0, 2 * radius[open_rows], root_above(seen))
        return index, square

    def _best(self, x: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest candidate, distance -1 without one."""
        count = len(self.entries)
        bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :count]
        row, entry = np.nonzero(bits)
        best = np.full(len(x), -1, np.int64)
        index = np.zeros(len(x), np.int64)
        most = 2 * max(np.abs(x).max(initial=0), np.abs(self.entries).max(initial=0))
        if len(row) * DENSE > bits.size and 4 * int(most) ** 2 * x.shape[1] < EXACT:
            a, b = x.astype(np.float64), self.entries.astype(np.float64)
            squares = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
            squares[bits == 0] = np.inf
            index = squares.argmin(axis=1)
            found = squares[np.arange(len(x)), index]
            some = np.isfinite(found)
            best[some] = found[some].astype(np.int64)
            return index, best
        if len(row):
            squares = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            best[row[starts]] = np.minimum.reduceat(squares, starts)
            first = np.where(squares == best[row], entry, count)
            index[row[starts]] = np.minimum.reduceat(first, starts)
        return index, best


def root_above(square: np.ndarray) -> np.ndarray:
    """The least whole number whose square is not below."""
    root = np.sqrt(np.maximum(square, 0).astype(np.float64)).astype(np.int64)
    root -= root**2 > square
    return root + (root**2 < square)


def integers(
    vectors: DataFrame, id_column: str, label_column: str, vector_column: str, scale: float
) -> DataFrame:
    """id, label and floor(scale * x) of the rows whose components are all there and finite."""
    vector = F.col(vector_column)
    good = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    numbers = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return vectors.filter(vector.isNotNull() & good).select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), numbers.alias("vector")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as lines of a matrix, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    length = column.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(width) < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def assigned(
    lines: np.ndarray, books: list[Codebook]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every part its columns, and index and squared distance of the nearest entry."""
    dims = lines.shape[1] // len(books)
    for p, book in enumerate(books):
        part = lines[:, p * dims : (p + 1) * dims]
        yield part, *book.nearest(part)


def sums(rows: DataFrame, entries: np.ndarray) -> pa.Table:
    """Per part, entry and dimension the number of vectors assigned and their sum."""
    parts, count, dims = entries.shape
    held = rows.sparkSession.sparkContext.broadcast(entries)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = list(map(Codebook, held.value))
        n = np.zeros((parts, count), np.int64)
        total = np.zeros((parts, count, dims), np.int64)
        for batch in batches:
            lines = matrix(batch["vector"], parts * dims)
            for p, (part, index, _) in enumerate(assigned(lines, books)):
                n[p] += np.bincount(index, minlength=count)
                np.add.at(total[p], index, part)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {
                "part": np.repeat(p, dims).astype(np.int32),
                "entry": np.repeat(e, dims).astype(np.int32),
                "dim": np.tile(np.arange(dims, dtype=np.int32), len(p)),
                "n": np.repeat(n[p, e], dims),
                "total": total[p, e].ravel(),
            }
        )

    schema = "part int, entry int, dim int, n bigint, total bigint"
    added = rows.select("vector").mapInArrow(add, schema).groupBy("part", "entry", "dim")
    out = added.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    held.unpersist()
    return out


def learn(rows: DataFrame, parts: int, count: int, rounds: int) -> np.ndarray:
    """The codebooks as (part, entry, dimension), from stored ``integers``.

    They start as the parts of the ``count`` smallest ids, nulls last, ties to the smaller vector.
    """
    width, top, low = rows.agg(
        F.max(F.size("vector")), F.max(F.array_max("vector")), F.min(F.array_min("vector"))
    ).first()
    dims = -(-(width or 0) // parts)
    if (2 * max(abs(top or 0), abs(low or 0))) ** 2 * max(1, parts * dims) >= 1 << 63:
        raise ValueError("squared distances exceed 64 bits: use a smaller scale")
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(count)
    vectors = first.toArrow()["vector"].combine_chunks()
    lines = matrix(vectors, parts * dims)
    entries = lines.reshape(len(lines), parts, dims).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(lines) else 0):
        told = sums(rows, entries)
        at = tuple(told[c].to_numpy() for c in ("part", "entry", "dim"))
        entries[at] = told["total"].to_numpy() // told["n"].to_numpy()
    return entries


def digest(entries: np.ndarray) -> str:
    """SHA-256 of all components as decimals, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def coded(rows: DataFrame, entries: np.ndarray) -> DataFrame:
    """id, label, code and error of every row of ``integers``."""
    parts, _, dims = entries.shape
    held = rows.sparkSession.sparkContext.broadcast(entries)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = list(map(Codebook, held.value))
        for batch in batches:
            lines = matrix(batch["vector"], parts * dims)
            codes = np.zeros((len(lines), parts), np.uint8)
            error = np.zeros(len(lines), np.int64)
            for p, (_, index, square) in enumerate(assigned(lines, books)):
                codes[:, p] = index
                error += square
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["label"],
                    pa.array([bytes(c).hex() for c in codes], pa.string()),
                    pa.array(error),
                ],
                names=["id", "label", "code", "error"],
            )

    kept = [rows.schema["id"], rows.schema["label"]]
    schema = T.StructType(kept).add("code", T.StringType()).add("error", T.LongType())
    return rows.mapInArrow(code, schema)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    count: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector: id, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Components become floor(scale * x). Rows whose vector is null or holds a null or non-finite
    component are left out; a null id or label is one like any other, so the errors of null labels
    are added up together. Rows that repeat are coded each. Vectors of different lengths count as
    filled up with zeros to the longest, and that to a multiple of ``parts``. Fewer vectors than
    ``count`` (256 at most) give so many entries; entries that win no vector stay; no vectors give
    no rows. Other columns are not read, whatever their names. Components so large that squared
    distances exceed 64 bits are refused.
    """
    if not 1 <= count <= ENTRIES:
        raise ValueError(f"a code of two hex digits has 1 to {ENTRIES} entries")
    rows = store(integers(vectors, id_column, label_column, vector_column, scale), "integers")
    entries = learn(rows, parts, count, rounds)
    key = F.to_json(F.struct("label")).alias("label")  # never null, so nulls meet
    out = store(coded(rows, entries).select("id", key, "code", "error"), "codes")
    per_label = out.groupBy("label").agg(F.sum("error").alias("label_error"))
    return salted_join(out, per_label, "label").select(
        F.col("id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(digest(entries)).alias("codebooks_sha256"),
    )
