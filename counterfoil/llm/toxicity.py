"""Toxicity of whole texts, with obfuscated words restored by a noisy-channel decoder.

Restoring: a word with look-alike signs, doubled letters or separators between letters, one of
look-alike signs alone, and a run of single letters set apart by spaces, becomes a lattice of what
each sign may stand for. The Viterbi path through the lattice weighs the channel's costs against a
character trigram model, which Spark counts over all texts, in any script. Words of different
letters only have one path and are left alone; one with doubled letters counts as it is and as
restored.

Scoring: features are restored words and their beginnings. Those of which four in five
texts are labelled toxic carry their log-odds; a text's evidence adds the best feature of each different
word, and a logistic curve turns evidence into a probability. Labels are taken from at most
about ``max_labelled`` labelled rows chosen by a hash of the id, whose ids are broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.llm.common import pieces, unused, whole_text
from counterfoil.sources.storage import store

#: What a sign may stand for besides itself (fixed values).
LOOK_ALIKE = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "<": "c",
    "€": "e",
    "£": "l",
    "¥": "y",
}
SEPARATORS = set(".-_*~'`,:;/\\^#%&=\"")
#: Log-costs of the channel: a look-alike, a dropped separator, a dropped repetition, any
#: letter under a star, a look-alike dropped at an end, a sign that is kept although it is none.
SUBSTITUTED, DROPPED, REPEATED, STARRED, EDGE, KEPT = -1.0, -0.7, -0.2, -2.5, -4.0, -6.0

ALPHABET = 64
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
WHOLE, START = "w", "p"
PREFIXES = (3, 4, 5, 6)
MEMO_WORDS = 150_000

#: Stars that may stand for letters: so many in a row, so many in a word. With more, all of the
#: run, or of the word, are mere decoration; a star costs 26 letters times the states before it.
STAR_RUN, MOST_STARS = 6, 12

_SPACED = re.compile(r"(?:^|\s)\S\s+\S\s+\S(?:\s|$)")
_DOUBLED = re.compile(r"([^\W_]|[@$!|+(<])\1")
_STRETCHED = re.compile(r"([^\W\d_])\1")
#: Signs alone that may hide a word: not digits and separators only, as in a telephone number.
_SIGNS = re.compile(r"^(?=.*[@$!|+(<€£¥])(?=.*[^!+|.\-])[0-9@$!|+(<€£¥*.\-_]{3,}$")
_STARS = re.compile(r"\*+")
_LETTER = re.compile(r"[^\W\d_]")


def _symbol_table() -> np.ndarray:
    """Code point to model symbol: 0 for what is no letter; letters beyond a-z share 37."""
    table = np.zeros(0x250 + 1, np.int64)
    for point in range(0x250):
        if chr(point).isalpha():
            low = chr(point).lower()
            table[point] = symbol(low)
    return table


def symbol(char: str) -> int:
    char = char[0]
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) % 37 if char.isalpha() else 0


_SYMBOLS = _symbol_table()


def count_trigrams(texts: Sequence[str]) -> np.ndarray:
    """Counts of symbol triples, words set apart by a zero on both sides."""
    points = np.frombuffer("  ".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
    codes = _SYMBOLS[np.minimum(points, 0x250)]
    beyond = np.flatnonzero(points >= 0x250)
    if len(beyond):
        kinds, which = np.unique(points[beyond], return_inverse=True)
        codes[beyond] = np.array([symbol(chr(p).lower()) for p in kinds], np.int64)[which]
    triple = (codes[:-2] * ALPHABET + codes[1:-1]) * ALPHABET + codes[2:]
    triple = triple[(codes[1:-1] > 0) | ((codes[:-2] == 0) & (codes[2:] > 0))]
    return np.bincount(triple, minlength=ALPHABET**3)


def corpus_trigrams(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Trigram counts over the whole texts of all rows, summed by task and then by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET**3, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                total += count_trigrams(piece["text"].to_pylist())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"triple": at.astype(np.int32), "n": total[at]})

    rows = docs.select(whole_text(text_column).alias("text"))
    sums = rows.mapInArrow(work, "triple int, n bigint").groupBy("triple").agg(F.sum("n").alias("n"))
    out = np.zeros(ALPHABET**3, np.int64)
    for r in sums.toLocalIterator():  # at most ALPHABET ** 3 rows
        out[r.triple] = r.n
    return out


def trigram_model(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of a symbol after two others, backed off by interpolation."""
    tri = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(float)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    p1 = (uni + 1) / (uni.sum() + ALPHABET)
    p2 = (bi + 5 * p1) / (bi.sum(axis=1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


class Restorer:
    """Viterbi decoder of obfuscated words."""

    def __init__(self, log_p: np.ndarray) -> None:
        self.log_p = log_p.tolist()

    @staticmethod
    def core(word: str) -> str:
        """The word without the signs around it."""
        return word.strip(".,;:?\"'()[]{}!|&%#*$-_~ ")

    @staticmethod
    def noisy(word: str) -> bool:
        """Whether the word, without signs around it, may hide another one."""
        core = Restorer.core(word)
        if _SIGNS.match(word):
            return True
        if len(core) < 2 or not _LETTER.search(core):
            return len(word) > 2 and bool(_LETTER.search(word)) and not word.isalpha()
        return not core.isalpha() or bool(_STRETCHED.search(core)) or word[0] in "@$!|+("

    def options(self, word: str, i: int, most: int = 1) -> list[tuple[str, float]]:
        """What the sign at ``i`` may put out: a letter, nothing, or itself. It may be dropped as a
        repetition if the ``most`` signs before it are the same."""
        char = word[i]
        out = []
        again = i >= most and word[i - most : i] == char * most
        if char.isalpha():
            out.append((char, 0.0))
            if again:
                out.append(("", REPEATED))
            return out
        if char in LOOK_ALIKE:
            out += [(letter, SUBSTITUTED) for letter in LOOK_ALIKE[char]]
            if again:
                out.append(("", REPEATED))
        if char == "\0":  # a star that stands for nothing
            return [("", DROPPED)]
        if char in SEPARATORS or char.isspace():
            out.append(("", DROPPED))
        if char == "*":
            out += [(letter, STARRED) for letter in _LETTERS]
        if char not in LOOK_ALIKE:
            out.append(("", DROPPED * 2))
        elif i in (0, len(word) - 1):
            out.append(("", EDGE))
        out.append((" ", KEPT))
        return out

    def restore(self, word: str, most: int = 1) -> str:
        """The likeliest letters behind a word; a space where a sign parts two words. Up to
        ``most`` equal signs in a row are no repetition."""
        log_p = self.log_p
        if "*" in word and (len(_STARS.sub("", word)) == 0 or word.count("*") > MOST_STARS):
            word = word.replace("*", "\0")
        elif "*" in word:
            word = _STARS.sub(lambda run: run[0] if len(run[0]) <= STAR_RUN else "\0" * len(run[0]), word)
        # (last two symbols) -> (score, text so far as a linked list)
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i in range(len(word)):
            reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for letter, cost in self.options(word, i, most):
                code = symbol(letter) if letter else 0
                for (a, b), (score, text) in paths.items():
                    if not letter:
                        key, total, now = (a, b), score + cost, text
                    else:
                        key = (b, code)
                        total, now = score + cost + log_p[a][b][code], (letter, text)
                        if letter == " ":
                            key = (0, 0)
                    if key not in reached or reached[key][0] < total:
                        reached[key] = (total, now)
            paths = reached
        ends = ((score + log_p[a][b][0], text) for (a, b), (score, text) in paths.items())
        _, text = max(ends, key=lambda end: end[0])
        out = []
        while text is not None:
            out.append(text[0])
            text = text[1]
        return "".join(reversed(out))

    def words(self, text: str) -> set[str]:
        """Different words of a text in lower case, runs of single signs joined."""
        low = text.lower()
        words = low.split()
        out = set(words)
        if _SPACED.search(low):
            run: list[str] = []
            for word in [*words, ".."]:
                if len(word) == 1:
                    run.append(word)
                    continue
                if len(run) > 2:
                    out.add(" ".join(run))
                run = []
        return out

    def plain(self, word: str) -> list[str]:
        """The restored words behind one word."""
        if " " in word:
            return self.restore(word).split()
        if not self.noisy(word):
            return [word.strip(".,;:?\"'()[]{}!|&%#*$-_~")]
        core = self.core(word)
        if len(core) > 1 and core.isalpha() and word[0] not in "@$!|+(":
            word = core  # what stands around whole words is decoration
        if word.isalpha() and len(found := _STRETCHED.findall(word)) == 1:
            once = _STRETCHED.sub(r"\1", word)
            if found[0] * 3 not in word:
                return [once, word]  # the lattice has these two paths only, and both count
        bare = "".join(c if c.isalpha() else " " for c in word).split()
        word = word.rstrip("!.,;:?") or word
        # Of doubled signs both readings, once and twice.
        twice = self.restore(word, 2).split() if _DOUBLED.search(word) else []
        return [*self.restore(word).split(), *twice, *bare]


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [WHOLE + word, *[START + word[:k] for k in PREFIXES if len(word) >= k]]


@dataclass
class ToxicityModel:
    log_p: np.ndarray
    weights: dict[str, float]
    slope: float = 0.0
    base: float = 0.0
    memo: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def restorer(self) -> Restorer:
        return Restorer(self.log_p)

    def evidence(self, restorer: Restorer, text: str) -> float:
        memo, total = self.memo, 0.0
        for word in restorer.words(text):
            weight = memo.get(word)
            if weight is None:
                found = [self.weights.get(f, 0.0) for w in restorer.plain(word) for f in features(w)]
                weight = max(found, default=0.0)
                if len(word) < 40:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = weight
            total += weight
        return total


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learns: Column,
    max_labelled: int,
    id_column: str,
    text_column: str,
) -> DataFrame:
    """(text, y) of all labelled rows that may be learned from, or about ``max_labelled``.

    The chosen ids are a bounded list, so they are broadcast and no text is shuffled.
    """
    known = (
        labels.filter(learns)
        .select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    known = store(known, "labels")
    share = min(1.0, max_labelled / max(1, known.count()))
    if share < 1:
        part = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
        known = known.filter(part < F.lit(max(1, int(share * (1 << 20)))))
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return store(rows.join(F.broadcast(known), "id").select("text", "y"), "toxic-sample")


def feature_weights(
    sample: DataFrame, log_p: np.ndarray, least_share: float = 0.004
) -> tuple[dict[str, float], int, int]:
    """Log-odds of features that occur mostly in toxic texts; how many texts of each class.

    First the features of at least ``least_share`` of the toxic texts (and three) are found,
    which are few because every text has few, then how many clean texts have them.
    """
    held_p = sample.sparkSession.sparkContext.broadcast(log_p)
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return {}, 0, clean

    def of_texts(texts: Sequence[str], restorer: Restorer, only: dict[str, int] | None) -> Counter:
        found: Counter = Counter()
        memo: dict[str, list[str]] = {}
        for text in texts:
            mine: set[str] = set()
            for word in restorer.words(text):
                have = memo.get(word)
                if have is None:
                    have = [f for w in restorer.plain(word) for f in features(w)]
                    if only is not None:
                        have = [f for f in have if f in only]
                    memo[word] = have
                mine.update(have)
            found.update(mine)
        return found

    def work(batches: Iterator[pa.RecordBatch], only: dict[str, int] | None):
        restorer = Restorer(held_p.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = of_texts(piece["text"].to_pylist(), restorer, only)
                yield pa.RecordBatch.from_pydict(
                    {
                        "feature": pa.array(list(found), pa.string()),
                        "n": pa.array(list(found.values()), pa.int64()),
                    }
                )

    schema = "feature string, n bigint"
    least = max(3, math.ceil(least_share * toxic))
    rows = (
        sample.filter("y = 1")
        .select("text")
        .mapInArrow(lambda batches: work(batches, None), schema)
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .collect()
    )
    in_toxic = {r.feature: r.n for r in rows}
    held = sample.sparkSession.sparkContext.broadcast(in_toxic)
    in_clean = {
        r.feature: r.n
        for r in sample.filter("y = 0")
        .select("text")
        .mapInArrow(lambda batches: work(batches, held.value), schema)
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .collect()
    }
    weights = {}
    share = toxic / (toxic + clean)
    for feature, t in in_toxic.items():
        c = in_clean.get(feature, 0)
        # Twice the log-likelihood ratio; beyond 2 ln m none of m features is due to chance.
        gain = 2 * t * math.log(t / (t + c) / share)
        if c and clean:
            gain += 2 * c * math.log(c / (t + c) / (1 - share))
        if t >= 4 * c and gain > 2 * math.log(len(in_toxic)):
            weights[feature] = math.log((t + 0.5) / (toxic + 1) / ((c + 0.5) / (clean + 1)))
    return weights, toxic, clean


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve on log1p of evidence, by damped Newton steps."""
    z = np.column_stack([np.log1p(x), np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - n * p) - 1e-2 * w
        bend = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def with_evidence(
    docs: DataFrame, model: ToxicityModel, name: str = "evidence", text_column: str = "text"
) -> DataFrame:
    """Add the evidence in each text; all other columns stay as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        restorer = model.restorer()
        for batch in batches:
            for piece in pieces(batch, text_column):
                texts = piece[text_column].to_pylist()
                found = [model.evidence(restorer, t) if t else 0.0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(found, pa.float64())], [*piece.schema.names, name]
                )

    return docs.mapInArrow(work, T.StructType([*docs.schema, T.StructField(name, T.DoubleType())]))


def probability(model: ToxicityModel, evidence: str) -> Column:
    z = F.lit(model.base) + F.lit(model.slope) * F.log1p(F.col(evidence))
    return 1 / (1 + F.exp(-z))


def fit(docs: DataFrame, sample: DataFrame, text_column: str = "text") -> ToxicityModel:
    """Character model from all ``docs``, weights and curve from the labelled ``sample``."""
    log_p = trigram_model(corpus_trigrams(docs, text_column))
    weights, toxic, clean = feature_weights(sample, log_p)
    model = ToxicityModel(log_p, weights)
    if not toxic or not clean:
        model.base = 30.0 if toxic else (-30.0 if clean else 0.0)
        return model
    rows = (
        with_evidence(sample, model)
        .groupBy(F.round("evidence", 1).alias("x"))
        .agg(F.sum("y").alias("y"), F.count("y").alias("n"))
        .toPandas()
    )
    rows = rows.sort_values("x").astype(float)
    model.slope, model.base = fit_logistic(*[rows[c].to_numpy() for c in ("x", "y", "n")])
    return model


def classify(
    docs: DataFrame,
    labels: DataFrame,
    learns: Column,
    label: str = "toxic",
    threshold: float = 0.5,
    max_labelled: int = 20_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: id, score from 0 to 1, predicted 0 or 1.

    ``learns`` tells, by the id column, which labels may be learned from; null ids and labels
    are left out, and an id labelled both ways counts as toxic. Null and empty texts have no
    evidence and get the score of that. Texts are read whole, however long; the time grows with
    the length, as stars beyond ``STAR_RUN`` in a row or ``MOST_STARS`` in a word are not decoded.
    No rows give no rows. Without labels of both classes every text gets the
    same score: 0.5 without any, else near the one class. Repeated rows are scored alike;
    other columns are not read.
    """
    sample = labelled_sample(docs, labels, label, learns, max_labelled, id_column, text_column)
    model = fit(docs, sample, text_column)
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return (
        with_evidence(rows, model)
        .select(F.col("id").alias(id_column), probability(model, "evidence").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def reject(
    docs: DataFrame,
    labels: DataFrame,
    learns: Column,
    label: str = "toxic",
    threshold: float = 0.5,
    max_labelled: int = 20_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns.

    Learns and scores as ``classify`` does. Without both kinds of labels nothing is rejected.
    """
    sample = labelled_sample(docs, labels, label, learns, max_labelled, id_column, text_column)
    model = fit(docs, sample, text_column)
    if not model.weights:
        return docs
    name = unused("__evidence", docs)
    judged = with_evidence(docs, model, name, text_column)
    return judged.filter(probability(model, name) < threshold).drop(name)
