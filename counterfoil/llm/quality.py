"""Quality classifier: ridge regression on random Fourier features, isotonic calibration.

A text becomes a dozen and a half numbers about its form. Cosines of random projections of the
standardized numbers approximate a Gaussian kernel. Every partition of the labelled rows sums
its share of the normal equations; the sums have the size of the features squared, whatever the
number of rows, and are solved on the driver. Ridge scores are calibrated by a monotone step
function: positives are counted per narrow score bin by Spark, and adjacent violators of the
bins (at most ``BINS``) are pooled on the driver. The scores that calibrate are out of fold: the
equations are summed per fold, and a fold's rows are scored by the solution of the others' sums, as
scores of the ridge on its own rows would look too good.

All labelled rows of the training folds take part; nothing is sampled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import joined_bytes, pieces, whole_text, word_spans
from counterfoil.llm.dart_minhash import word_hashes
from counterfoil.sources.storage import store

STATISTICS = (
    "log_bytes",
    "log_words",
    "word_length",
    "word_length_spread",
    "upper_share",
    "lower_share",
    "digit_share",
    "beyond_ascii_share",
    "sentence_mark_share",
    "other_mark_share",
    "line_share",
    "marked_word_share",
    "one_byte_word_share",
    "short_word_share",
    "long_word_share",
    "distinct_word_share",
    "repeated_line_share",
    "upper_word_share",
)
FOURIER = 256
BINS = 1_000
RIDGE = 1e-3
SEED = 20_240
FOLDS = 3
#: Labelled rows whose share of the normal equations one task sums.
ROWS_PER_TASK = 20_000

_B = np.arange(256)
_KINDS = {
    "upper_share": (_B >= 65) & (_B <= 90),
    "lower_share": (_B >= 97) & (_B <= 122),
    "digit_share": (_B >= 48) & (_B <= 57),
    "beyond_ascii_share": _B >= 128,
    "sentence_mark_share": np.isin(_B, list(b".,;:!?'\"-")),
    "other_mark_share": np.isin(_B, list(b"#$%&()*+/<=>@[\\]^_`{|}~")),
    "line_share": _B == 10,
}
_LETTER = _KINDS["upper_share"] | _KINDS["lower_share"] | _KINDS["beyond_ascii_share"]


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum per row, zero for empty rows."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return total[begins[1:]] - total[begins[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """Number of different keys per row."""
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return np.bincount(row[new], minlength=count).astype(float)


def text_statistics(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One line of ``STATISTICS`` per text; all zero for an empty one."""
    count = len(begins) - 1
    size = np.diff(begins).astype(float)
    out = dict.fromkeys(STATISTICS)
    for name, kind in _KINDS.items():
        out[name] = _sums(kind[data], begins) / np.maximum(size, 1)
    starts, ends, row = word_spans(data, begins)
    words = np.bincount(row, minlength=count).astype(float)
    per_word = np.maximum(words, 1)
    length = (ends - starts).astype(float)
    of_row = lambda x: np.bincount(row, weights=x, minlength=count) / per_word
    out["log_bytes"], out["log_words"] = np.log1p(size), np.log1p(words)
    out["word_length"] = of_row(length)
    spread = of_row(length**2) - out["word_length"] ** 2
    out["word_length_spread"] = np.sqrt(np.maximum(spread, 0))
    letter = _LETTER[data].astype(np.int32)
    total = np.concatenate([[0], np.cumsum(letter)])
    out["marked_word_share"] = of_row(ends - starts > total[ends] - total[starts])
    upper = np.concatenate([[0], np.cumsum(_KINDS["upper_share"][data])])
    raised = upper[ends] - upper[starts]
    out["upper_word_share"] = of_row((raised > 1) & (2 * raised >= ends - starts))
    out["one_byte_word_share"] = of_row(length == 1)
    out["short_word_share"] = of_row(length <= 3)
    out["long_word_share"] = of_row(length > 12)
    if len(data):
        out["distinct_word_share"] = (
            _distinct(word_hashes(data, starts, ends), row, count) / per_word
        )
        inside = data != 10
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = np.diff(begins) > 0
        first[begins[:-1][filled]] = inside[begins[:-1][filled]]
        last[begins[1:][filled] - 1] = inside[begins[1:][filled] - 1]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        line_row = np.searchsorted(begins, a, "right") - 1
        lines = np.maximum(np.bincount(line_row, minlength=count), 1)
        kinds = _distinct(word_hashes(data, a, b), line_row, count)
        out["repeated_line_share"] = np.where(size > 0, 1 - kinds / lines, 0)
        out["repeated_line_share"] = np.where(kinds > 0, out["repeated_line_share"], 0)
    else:
        out["distinct_word_share"] = out["repeated_line_share"] = np.zeros(count)
    return np.column_stack([out[name] for name in STATISTICS])


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, stats) of every row's whole text; null counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                table = text_statistics(*joined_bytes(piece["text"]))
                cut = np.arange(len(table) + 1, dtype=np.int32) * len(STATISTICS)
                stats = pa.ListArray.from_arrays(cut, pa.array(table.ravel()))
                yield pa.RecordBatch.from_pydict({"id": piece["id"], "stats": stats})

    rows = docs.select(
        F.col(id_column).alias("id"), whole_text(text_column).cast("binary").alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {id_type}, stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the Fourier features and the constant
    width: float
    edges: np.ndarray  # ridge scores, ascending
    levels: np.ndarray  # calibrated scores there

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(SEED)
        size = len(self.mean)
        return (
            draw.standard_normal((size, FOURIER)) / (self.width * math.sqrt(size)),
            draw.uniform(0, 2 * math.pi, FOURIER),
        )

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines and a constant; the kernel's width is relative to the number of statistics."""
        slopes, phases = self.projection()
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ slopes + phases) * math.sqrt(2 / FOURIER)
        return np.column_stack([z, np.ones(len(z))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(stats), self.edges, self.levels)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def fold_of() -> Column:
    """Copies of a text have the same statistics and share a fold."""
    return F.pmod(F.xxhash64("stats"), F.lit(FOLDS)).cast("int")


def normal_equations(train: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over (stats, y) per fold; each task adds up before Spark does."""
    held = train.sparkSession.sparkContext.broadcast(model)
    size = FOURIER + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            z = held.value.features(_matrix(batch["stats"]))
            y = batch["y"].to_numpy(zero_copy_only=False).astype(float)
            fold = batch["fold"].to_numpy(zero_copy_only=False)
            for f in range(FOLDS):
                mine = fold == f
                both[f] += z[mine].T @ np.column_stack([z[mine], y[mine]])
        cell = np.flatnonzero(both.ravel()).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"cell": cell, "value": both.ravel()[cell]})

    parts = train.select("stats", "y", fold_of().alias("fold"))
    sums = parts.mapInArrow(work, "cell int, value double").groupBy("cell")
    told = sums.agg(F.sum("value").alias("value")).toArrow()
    flat = np.zeros(FOLDS * size * (size + 1))
    flat[told["cell"].to_numpy()] = told["value"].to_numpy()
    whole = flat.reshape(FOLDS, size, size + 1)
    return whole[:, :, :size], whole[:, :, size]


def solve(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Ridge weights; the last feature is the constant, whose square counts the rows."""
    penalty = RIDGE * gram[-1, -1] / FOURIER * np.eye(len(target))
    penalty[-1, -1] = 0  # not of the constant
    return np.linalg.solve(gram + penalty + 1e-12 * np.eye(len(target)), target)


def pool_violators(count: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Isotonic means: the closest ascending levels to the bins' shares of positives."""
    blocks: list[list[float]] = []
    for n, p in zip(count, positive, strict=True):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, n2, k2 = blocks.pop()
            blocks[-1][0] += p2
            blocks[-1][1] += n2
            blocks[-1][2] += k2
    return np.concatenate([np.full(int(k), p / n) for p, n, k in blocks])


def fit(train: DataFrame, width: float = 1.0) -> QualityModel | float:
    """Fit on (stats, y); the share of ones if there is no more than one class."""
    rows, ones = train.agg(F.count("y"), F.sum("y")).first()
    if not rows or ones in (0, rows):
        return float(ones / rows) if rows else 0.5
    moments = train.select(F.posexplode("stats").alias("i", "x")).groupBy("i")
    moments = moments.agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"))
    moments = sorted(moments.collect())
    scale = np.array([r.spread if r.spread > 1e-9 else 1.0 for r in moments])
    model = QualityModel(
        np.array([r.mean for r in moments]), scale, np.zeros(FOURIER + 1), width, *[np.zeros(1)] * 2
    )
    # Dealt in turn, not by a key: copies of a text spread like all other rows.
    gram, target = normal_equations(train.repartition(max(1, -(-rows // ROWS_PER_TASK))), model)
    weights = solve(gram.sum(axis=0), target.sum(axis=0))
    model = QualityModel(model.mean, scale, weights, width, model.edges, model.levels)
    # A fold whose others have no rows, as with a single text, is scored by the whole.
    apart = [
        solve(gram.sum(axis=0) - gram[f], target.sum(axis=0) - target[f])
        if gram[:, -1, -1].sum() > gram[f, -1, -1] else weights
        for f in range(FOLDS)
    ]
    held = train.sparkSession.sparkContext.broadcast((model, np.array(apart)))

    @F.pandas_udf("int")
    def bin_of(stats: pd.Series, fold: pd.Series) -> pd.Series:
        model, apart = held.value
        z = model.features(np.stack(stats.to_numpy()))
        ridge = (z * apart[fold.to_numpy()]).sum(axis=1)
        return pd.Series((np.clip(ridge, -0.5, 1.5) * BINS / 2).round().astype(np.int32))

    bins = sorted(
        train.select(bin_of("stats", fold_of()).alias("bin"), "y")
        .groupBy("bin")
        .agg(F.count("y").alias("n"), F.sum("y").alias("p"))
        .collect()
    )
    count = np.array([r.n for r in bins], float)
    positive = np.array([r.p for r in bins], float)
    return QualityModel(
        model.mean, scale, model.weights, width,
        np.array([r.bin for r in bins]) * 2 / BINS, pool_violators(count, positive),
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learns: Column,
    threshold: float = 0.3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: id, score from 0 to 1, predicted 0 or 1.

    ``labels`` has the id and ``label``, 0 or 1; null labels and ids are left out, and an id
    labelled both ways counts as 1. ``learns`` tells, by the id column, which rows may be learned from. Null and
    empty texts have all statistics zero and are scored. Without both classes every score is
    the share of ones, or 0.5 without labels. Repeated rows are scored alike. Texts are read
    whole, however long; no rows give no rows. Other columns are not read.
    """
    known = (
        labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    stats = store(statistics(docs, id_column, text_column), "statistics")
    train = store(
        stats.withColumnRenamed("id", id_column)
        .filter(learns)
        .withColumnRenamed(id_column, "id")
        .join(known, "id")
        .select("stats", "y"),
        "quality-train",
    )
    model = fit(train)
    if isinstance(model, float):
        score = F.lit(model)
    else:
        held = docs.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def scored(column: pd.Series) -> pd.Series:
            if not len(column):
                return pd.Series([], dtype=float)
            return pd.Series(held.value.score(np.stack(column.to_numpy())))

        score = scored("stats")
    return (
        stats.select(F.col("id").alias(id_column), score.alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
