"""The registered queries on the test tables, against SQL or brute force, stage by stage."""

import collections
import hashlib
import os
import pickle
import subprocess
import sys

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from counterfoil.llm import bpe, toxicity
from counterfoil.llm.common import fold
from counterfoil.llm.registry import QUERIES, SQL, bpe_vocabulary
from counterfoil.sources.storage import new_path

from test_operators import brute_classes, lowered, reference_coder

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.fixture(scope="module")
def tables(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, tables, name):
    df = QUERIES[name](spark, small)
    cursor = tables.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(r)) for r in cursor.fetchall())
    assert want and sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want


def digests(coder, text):
    ids = pa.array(coder.encode_ordinary(text or ""), pa.uint32()).to_numpy()
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(
        (text or "").encode()
    ).hexdigest()


def test_bpe_query(spark, small, tables):
    coder = reference_coder(bpe_vocabulary())
    rows = QUERIES["op5_bpe"](spark, small).collect()
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    assert {tuple(r) for r in rows} == {(i, *digests(coder, t)) for i, t in texts.items()}
    assert len(rows) == len(texts)


def test_near_duplicates_query(spark, small, tables):
    rows = QUERIES["op8_dart_minhash"](spark, small).collect()
    want = brute_classes(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in rows) == want


def test_language_query_on_held_out_rows(spark, small, tables):
    told = {r.doc_id: r for r in QUERIES["op4_language"](spark, small).collect()}
    rows = tables.execute("SELECT doc_id, lang FROM documents").fetchall()
    held = [(told[i].lang_pred, lang) for i, lang in rows if told[i].held_out]
    assert len(told) == len(rows) and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_quality_query_on_held_out_rows(spark, medium):
    told = {r.doc_id: r for r in QUERIES["op9_quality"](spark, medium).collect()}
    rows = duckdb.execute(f"SELECT doc_id, quality FROM '{medium}/labels.parquet'").fetchall()
    held = [(told[i].predicted, y) for i, y in rows if told[i].held_out and y is not None]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_pipeline_stage_by_stage(spark, medium):
    """Each stage on what its predecessor kept, against plain Python."""
    documents = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    seen = {"": documents.collect()}
    docs = documents
    for name in stages:
        docs = stages[name](spark, docs, medium)
        seen[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == documents.columns
            docs = spark.createDataFrame(seen[name], documents.schema)
    judged = toxicity.classify(documents, labels, learns=fold("doc_id", 5) != 0).collect()
    clean = {r.doc_id for r in judged if not r.predicted}
    assert 0 < len(clean) < len(judged)
    assert sorted(seen["toxicity"]) == sorted(r for r in seen[""] if r.doc_id in clean)
    kept = {}
    for r in seen["toxicity"]:
        key = lowered(r.text)
        kept[key] = max(kept.get(key, r), r, key=lambda x: x.doc_id)
    assert sorted(seen["exact_dedup"]) == sorted(kept.values())
    classes = brute_classes([(r.doc_id, r.text) for r in seen["exact_dedup"]])
    firsts = {c for _, c, _ in classes}
    assert sorted(seen["near_dedup"]) == sorted(
        r for r in seen["exact_dedup"] if r.doc_id in firsts
    )
    copies = collections.Counter(seen["mixing"])
    assert set(copies) <= set(seen["near_dedup"]) and set(copies.values()) <= {1, 2}
    size = lambda r: len((r.text or "").encode().split())
    total, mixed = sum(map(size, seen["near_dedup"])), sum(map(size, seen["mixing"]))
    assert abs(mixed - 1.5 * total) < 0.05 * total
    coder = reference_coder(bpe_vocabulary())
    assert sorted(map(tuple, seen["bpe"])) == sorted(
        (r.doc_id, *digests(coder, r.text)) for r in seen["mixing"]
    )


def test_workers_of_the_pipeline_get_small_batches(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    rows = spark.range(0, 4000, 1, 1).select(F.expr("repeat('x', 3000)").alias("text"))
    limit = corpus_pipeline.BATCH_BYTES

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    before = spark.conf.get(limit, None)
    try:
        for stage in ("toxicity", "near_dedup", "bpe"):
            spark.conf.unset(limit)
            dict(corpus_pipeline.STAGES)[stage](spark, documents.limit(20), small)
            held = [r.n for r in rows.mapInArrow(work, "n bigint").collect()]
            assert sum(held) > 12_000_000 and max(held) < 5_000_000
        spark.conf.set(limit, "1m")
        corpus_pipeline.encode(spark, documents, small)
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def test_a_worker_of_the_last_stage_remembers_few_pieces(spark, small):
    whole = bpe_vocabulary()
    held = pickle.loads(pickle.dumps(bpe.Vocabulary(whole.ranks, whole.pattern, 3)))
    text = "one two three four five one antidisestablishmentarianism two " * 3
    assert held.coder.encode(text) == whole.coder.encode(text)
    assert max(len(held.coder.memo), len(held.coder.memo.older)) <= 3
    assert corpus_pipeline.MEMO_PIECES < bpe.MEMO_PIECES == whole.memo_pieces


def test_a_run_of_the_pipeline_leaves_only_what_it_reads(spark, small):
    folder = os.path.dirname(new_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    assert corpus_pipeline.run(spark, small).count() > 0
    (left,) = {n for n in os.listdir(folder) if n not in before}
    assert left.startswith("pipeline-mixing-")


def test_the_rest_imports_without_this_package():
    code = (
        "import sys; sys.modules['counterfoil.llm'] = None; import __spark_entry__ as e; "
        "assert 'targeting_list' in e.queries() and 'pipeline' not in e.queries()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
