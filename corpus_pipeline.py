"""A training-data pipeline over ``documents``: five stages of the operators in counterfoil.llm.

Every stage takes what its predecessor kept, with the columns of ``documents``, and decides on
all of it: toxic texts go, of equal texts one stays, of near duplicates one stays, documents are
repeated or left out to meet their source's target, and the rest is encoded. The last stage
returns one row per row it gets: id, number of tokens, digests of the ids and of the decoded
bytes.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from counterfoil.llm import bpe, dart_minhash, exact_dedup, mixing, toxicity
from counterfoil.llm.common import fold, table
from counterfoil.sources.storage import delete, settled

#: SQL has no counterpart of the first, third and last stage.
ORACLE_SQL = None
VOCABULARY = "byte_bpe_50k.tiktoken"
#: What Arrow hands a worker at once. By default it is 64 MB of text, of which executor and worker
#: hold several copies beside a heap that the stages before have filled. No result depends on it.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL_BATCH = "4m"
#: Pieces that a worker of the last stage remembers in each generation, for the same reason.
MEMO_PIECES = 40_000


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands workers small batches, unless it has a limit of its own."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic texts; labels of one fold in five are never learned from."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels")
    return toxicity.reject(docs, labels, learns=fold("doc_id", 5) != 0)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return dart_minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = public_tokenizers.path(VOCABULARY)
    vocabulary = bpe.Vocabulary.read(path, public_tokenizers.PATTERN, MEMO_PIECES)
    return bpe.encode_digests(docs, vocabulary)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written once and read by the next.

    What a stage stores on its way goes when its rows are written, and these when the next stage's
    are; what the last stage reads is left for the reader of its result.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, written = settled(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
        if path is not None:
            delete(spark, path)
        path = written
    return STAGES[-1][1](spark, docs, sf_dir)
