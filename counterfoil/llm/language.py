"""Language identification: sparse multinomial logistic regression on TF-IDF n-grams.

Texts become counts of their character n-grams (one to three characters, hashed into
``BUCKETS``), over the whole text. Document frequencies are counted over all training rows by
Spark. The regression is trained with the follow-the-regularised-leader rule per coordinate,
with L1 and L2 penalties, on at most ``max_labelled`` labelled rows chosen by a hash of their
id; a tenth of them is held back to fit one temperature that divides the logits.

Every language keeps a quota of the sample, so a rare one is learned however large the table is.

The model is a matrix of buckets times languages, mostly zero, and is broadcast. It holds about
``MODEL_CELLS`` numbers at most: with more languages there are fewer buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.llm.common import mix, pieces, whole_text
from counterfoil.sources.storage import local_table, store

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
LEAST_BUCKETS = 1 << 8
MODEL_CELLS = 1 << 23
#: Labelled rows that a language keeps at least, as a part of an even share, and in number.
QUOTA_SHARE, LEAST_QUOTA = 4, 20
#: Share of the labelled sample that fits the temperature only, one in so many.
CALIBRATION = 10
UNKNOWN = "und"
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.3, 0.05, 4


def bucket_count(languages: int) -> int:
    """Buckets for so many languages: a power of two."""
    count = BUCKETS
    while count > LEAST_BUCKETS and count * languages > MODEL_CELLS:
        count //= 2
    return count


def n_grams(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of all n-grams, sorted; each text is lower-cased and padded."""
    texts = [t.lower() for t in texts]
    joined = "\0" + "\0".join(texts) + "\0" if texts else ""
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    # Where the space before each text stands, and the one after the last.
    ends = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    points[ends[: len(points)]] = 0x20
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    last = ends[row + 1]
    out = np.zeros(len(texts) * buckets, np.int64)
    code = np.zeros(len(row), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        code = code[: len(points) - n + 1]
        code = code * np.uint64(0x110000) + points[n - 1 : n - 1 + len(code)]
        if n in ORDERS:
            at = np.flatnonzero(np.arange(len(code)) + (n - 1) <= last[: len(code)])
            bucket = mix(code[at] + np.uint64(n)) % np.uint64(buckets)
            out += np.bincount(
                row[at] * buckets + bucket.astype(np.int64), minlength=len(out)
            )
    place = np.flatnonzero(out)
    return place // buckets, place % buckets, out[place]


def weighted(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values, every row scaled to length one."""
    value = np.log1p(count) * idf[bucket]
    norm = np.sqrt(np.bincount(row, weights=value**2))
    return value / np.maximum(norm[row], 1e-12)


def text_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """At most 256 texts or 1 MB at a time, so that dense counts stay small."""
    for batch in batches:
        for piece in pieces(batch, column):
            for start in range(0, len(piece), 256):
                yield piece.slice(start, 256)


def document_frequencies(train: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """For every bucket the number of training texts that hold it, and their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = np.zeros(buckets, np.int64), 0
        for group in text_groups(batches, "text"):
            _, bucket, _ = n_grams(group["text"].to_pylist(), buckets)
            held += np.bincount(bucket, minlength=buckets)
            texts += len(group)
        yield pa.RecordBatch.from_pydict(
            {"bucket": np.arange(buckets + 1, dtype=np.int32), "held": np.append(held, texts)}
        )

    parts = train.select("text").mapInArrow(work, "bucket int, held bigint")
    told = parts.groupBy("bucket").agg(F.sum("held").alias("held")).toArrow()
    out = np.zeros(buckets + 1, np.int64)
    out[told["bucket"].to_numpy()] = told["held"].to_numpy()
    return out[:-1], int(out[-1])


class Ftrl:
    """Follow the regularised leader, per coordinate, for softmax regression."""

    def __init__(self, features: int, classes: int) -> None:
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        """Closed form of the minimizer: zero where the L1 penalty is not overcome."""
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, wanted: int) -> None:
        w = self.weights(at)
        error = softmax(value @ w)
        error[wanted] -= 1
        slope = value[:, None] * error[None, :]
        grown = self.n[at] + slope**2
        self.z[at] += slope - (np.sqrt(grown) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = grown


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # buckets and the constant, by language
    temperature: float

    def logits(self, texts: list[str]) -> np.ndarray:
        row, bucket, count = n_grams(texts, len(self.idf))
        value = weighted(row, bucket, count, self.idf)
        out = np.zeros((len(texts), len(self.languages)))
        for c in range(len(self.languages)):
            out[:, c] = np.bincount(
                row, weights=value * self.weights[bucket, c], minlength=len(texts)
            )
        return out + self.weights[-1]

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return softmax(self.logits(texts) / self.temperature)


def fit_temperature(logits: np.ndarray, wanted: np.ndarray) -> float:
    """The divisor with the least log loss, by golden-section search on its logarithm."""

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(wanted)), wanted]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, golden = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _train(sample: pa.Table, languages: tuple[str, ...], idf: np.ndarray) -> LanguageModel:
    index = {name: i for i, name in enumerate(languages)}
    sample = sample.sort_by([("draw", "ascending"), ("lang", "ascending")])
    wanted = np.array([index[x] for x in sample["lang"].to_pylist()], np.int64)
    examples = []
    for bucket, count in zip(sample["bucket"], sample["count"]):
        bucket, count = (np.asarray(x.values) for x in (bucket, count))
        value = weighted(np.zeros(len(bucket), np.int64), bucket, count.astype(float), idf)
        examples.append((np.append(bucket, len(idf)), np.append(value, 1.0)))
    calibrates = np.arange(len(examples)) % CALIBRATION == CALIBRATION - 1
    leader = Ftrl(len(idf) + 1, len(languages))
    order = np.random.default_rng(7)
    learning = np.flatnonzero(~calibrates)
    for _ in range(EPOCHS):
        for i in order.permutation(learning):
            leader.learn(*examples[i], wanted[i])
    weights = leader.weights(slice(None))
    temperature = 1.0
    if calibrates.any():
        logits = np.array([v @ weights[at] for at, v in (examples[i] for i in np.flatnonzero(calibrates))])
        temperature = fit_temperature(logits, wanted[calibrates])
    return LanguageModel(languages, idf, weights, temperature)


def sample_shares(rows: dict[str, int], most: int) -> dict[str, float]:
    """For each language the share of its labelled rows that are learned from.

    All take part alike, about ``most`` rows together, but a language keeps a quota or all it has:
    so there are at most a fourth more, or ``LEAST_QUOTA`` rows for each language.
    """
    alike = min(1.0, most / max(1, sum(rows.values())))
    quota = max(LEAST_QUOTA, most // (QUOTA_SHARE * max(1, len(rows))))
    return {lang: max(alike, min(1.0, quota / n)) for lang, n in rows.items()}


def fit(train: DataFrame, max_labelled: int = 4_000) -> LanguageModel | None:
    """Fit on (id, text, lang) without nulls; None without rows.

    Document frequencies and the list of languages come from all rows. The regression takes
    all rows, or about ``max_labelled`` of them by a hash of the id if there are more, see
    ``sample_shares``. Only their n-gram counts, not their texts, reach the one task that trains,
    and only the model the driver.
    """
    told = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = {r.lang: r.n for r in told}
    if not rows:
        return None
    languages = tuple(sorted(rows))
    buckets = bucket_count(len(languages))
    held, texts = document_frequencies(train, buckets)
    idf = np.log((1 + texts) / (1 + held)) + 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches, "text"):
            row, bucket, count = n_grams(group["text"].to_pylist(), buckets)
            cut = np.searchsorted(row, np.arange(len(group) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "draw": group["draw"],
                    "lang": group["lang"],
                    "bucket": pa.ListArray.from_arrays(cut, pa.array(bucket.astype(np.int32))),
                    "count": pa.ListArray.from_arrays(cut, pa.array(count.astype(np.int32))),
                }
            )

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            model = _train(pa.Table.from_batches(held), languages, idf)
            packed = pa.array([model.weights.tobytes()], pa.binary())
            yield pa.RecordBatch.from_pydict(
                {"weights": packed, "temperature": pa.array([model.temperature])}
            )

    chosen = train.select(F.xxhash64("id", F.md5("text")).alias("draw"), "lang", "text")
    shares = {k: v for k, v in sample_shares(rows, max_labelled).items() if v < 1}
    if shares:
        schema = T.StructType.fromDDL("lang string, least bigint")
        cut = [(lang, max(1, int(share * (1 << 20)))) for lang, share in shares.items()]
        limits = F.broadcast(local_table(train.sparkSession, cut, schema))
        part = F.pmod(F.xxhash64("draw"), F.lit(1 << 20))
        chosen = chosen.join(limits, "lang", "left").filter(
            F.col("least").isNull() | (part < F.col("least"))
        )
    counts = "draw bigint, lang string, bucket array<int>, count array<int>"
    sample = store(chosen.select("draw", "lang", "text").mapInArrow(features, counts), "language-sample")
    found = sample.repartition(1).mapInArrow(train_all, "weights binary, temperature double").first()
    if found is None:  # the hash chose no row
        return LanguageModel(languages, idf, np.zeros((buckets + 1, len(languages))), 1.0)
    weights = np.frombuffer(found.weights).reshape(buckets + 1, len(languages))
    return LanguageModel(languages, idf, weights, found.temperature)


def identify(
    docs: DataFrame,
    learns: Column,
    max_labelled: int = 4_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per input row: id, lang_pred, score (the calibrated probability).

    ``learns`` tells, by the id column, which rows may be learned from; rows with null text or
    language are left out of training. A text that is null or has no letter gets ``und`` with
    score 0, and so does every text if there is nothing to learn from. Whole texts are read,
    however long, and rows that repeat are judged alike. No rows give no rows. Other columns are
    not read.
    """
    train = (
        docs.filter(learns)
        .filter(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull())
        .select(
            F.col(id_column).alias("id"),
            F.col(text_column).alias("text"),
            F.col(lang_column).alias("lang"),
        )
    )
    model = fit(train, max_labelled)
    rows = docs.select(
        F.col(id_column).alias("id"),
        whole_text(text_column).alias("text"),
        whole_text(text_column).rlike(r"\p{L}").alias("letters"),
    )
    id_type = rows.schema["id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for group in text_groups(batches, "text"):
            letters = group["letters"].to_numpy(zero_copy_only=False)
            names, scores = np.full(len(group), UNKNOWN, object), np.zeros(len(group))
            if model is not None:
                p = model.probabilities(group["text"].to_pylist())
                names = np.where(letters, np.array(model.languages, object)[p.argmax(axis=1)], names)
                scores = np.where(letters, p.max(axis=1), scores)
            yield pa.RecordBatch.from_pydict(
                {"id": group["id"], "lang_pred": pa.array(names, pa.string()), "score": scores}
            )

    judged = rows.mapInArrow(judge, f"id {id_type}, lang_pred string, score double")
    return judged.withColumnRenamed("id", id_column)
