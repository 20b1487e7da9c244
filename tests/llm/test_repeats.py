"""Mixing where rows repeat, many sources, and tables whose columns clash with inner names."""

import collections
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from counterfoil.llm import common, dart_minhash, mixing, toxicity, url_filter
from counterfoil.llm.common import fold
from counterfoil.llm.registry import SQL
from counterfoil.sources.storage import store

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def copies(spark, seed, extra):
    """A source of which two thirds are one row, others with repeats, nulls and empty texts."""
    draw = random.Random(seed)
    rows = [(7, "w " * 9, "en", "hot", 18)] * 1600
    rows += [(i, "w " * draw.randint(0, 20), "en", "hot", 0) for i in range(100, 900)]
    rows += [(None, "a b c", "en", "b", 5)] * 300 + [(None, None, None, "b", None)] * 50
    rows += [(2000 + i % 40, "x y z " * (i % 3), "de", f"s{i % 5}", 0) for i in range(400)]
    rows += [(5000 + i, "q r", "de", None, i if extra else 0) for i in range(90) for _ in range(3)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, DOCS).repartition(5), rows


@pytest.mark.parametrize("share, epochs, weights", [(1.5, 2.0, None), (0.7, 3.0, None), (1.1, 1.0, None)])
def test_targets_are_met_though_rows_repeat(spark, share, epochs, weights):
    docs, rows = copies(spark, 3, True)
    got = mixing.mix(docs, share=share, max_epochs=epochs).collect()
    assert len(got) == len(rows)
    source = {i: s for i, _, _, s, _ in rows}
    by_source = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in got:
        of = by_source[source[r.doc_id]]
        of[0] += r.taken
        of[1] = r.target
        of[2] = max(of[2], r["size"])
        assert 0 <= r.taken <= epochs * r["size"]
    for name, (taken, target, largest) in by_source.items():
        assert abs(taken - target) <= largest / 2 + 1e-6, (name, taken, target)
    again = mixing.mix(docs.repartition(3).orderBy(F.rand(1)), share=share, max_epochs=epochs)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got))
    mixed = mixing.mixture(docs, share=share, max_epochs=epochs)
    assert mixed.columns == docs.columns
    held = collections.Counter(map(tuple, rows))
    assert all(n <= held[r] * -(-epochs // 1) for r, n in collections.Counter(map(tuple, mixed.collect())).items())
    assert mixed.count() == sum(r.repeats for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_rows_equal_the_sql(spark, tmp_path, seed):
    docs, rows = copies(spark, seed, False)
    docs = docs.filter("doc_id IS NOT NULL")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = connection.execute(SQL["op6_mixing"]).fetchall()
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_rows_alike_in_id_and_text_alone(spark):
    """They differ in another column; a hash of the whole row decides between them."""
    rows = [(1, "a b", "en", "s", i) for i in range(600)]
    got = mixing.mixture(spark.createDataFrame(rows, DOCS).repartition(3), share=0.5).collect()
    assert len(got) == 300 and len(set(got)) == 300


def test_copies_are_dealt_out_in_portions(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PORTION", 7)
    rows = [(1, "a b", "en", "s", 0)] * 100
    docs = spark.createDataFrame(rows, DOCS)
    assert mixing.mixture(docs, share=0.33, max_epochs=1.0).count() == 33
    assert sorted(r.taken for r in mixing.mix(docs, share=1.25).collect()) == [2] * 75 + [4] * 25


def test_more_sources_than_a_task_should_number(spark):
    rows = [(i, "w " * (1 + i % 3), "en", f"s{i:05d}" if i else None, 0) for i in range(2500)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    order = sorted((s is None, s or "") for _, _, _, s, _ in rows)
    weight = {s if not null else None: (5, 2, 1)[k % 3] for k, (null, s) in enumerate(order)}
    total = sum(r["size"] for r in got)
    targets = {r.doc_id: r.target for r in got}
    level = max(
        targets[i] / weight[s] for i, t, _, s, _ in rows if targets[i] < 2 * len(t.split())
    )
    for i, t, _, s, _ in rows:
        assert targets[i] == pytest.approx(min(level * weight[s], 2 * len(t.split())))
    assert sum(targets.values()) == pytest.approx(1.5 * total)


def test_positions_follow_the_order_of_a_stored_table(spark):
    kept = store(spark.range(500).select((F.col("id") * 7 % 500).alias("x"), F.lit(1).alias("__first"))
                 .repartitionByRange(6, "x").sortWithinPartitions("x"), "positions")
    got = common.positions(kept)
    assert got.columns == ["x", "__first", "place"]
    assert all(r.x == r.place for r in got.collect()) and got.count() == 500


CLASHING = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, __node_of string, "
    "__node string, __id string, __several boolean, __evidence string, row string, kept string, "
    "__rows int, __parts int, __salt int"
)


def test_columns_with_inner_names_survive(spark):
    long = "one two three four five six seven eight nine ten eleven twelve "
    rows = [
        (i, (long * 3 + f"x{i // 2}") if i % 3 else long * 3, "en", "s", 1, f"v{i}", "n", "i", True, "e",
         "r", "k", 1, 2, 3)
        for i in range(30)
    ]
    rows += [rows[0]] * 2
    docs = spark.createDataFrame(rows, CLASHING)
    kept = dart_minhash.keep_one(docs).collect()
    assert set(map(tuple, kept)) <= set(rows) and 0 < len(kept) < len(rows)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id bigint, quality int, toxic int")
    left = toxicity.reject(docs, labels, learns=fold("doc_id", 5) != 0)
    assert left.columns == docs.columns and set(map(tuple, left.collect())) <= set(rows)
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= set(rows)
    small = spark.createDataFrame([("s", 1)], "source string, __x int")
    monkey = docs.select("source", "__rows", "__parts", "__salt")
    assert common.salted_join(monkey, small, "source").columns == [*monkey.columns, "__x"]


def test_salted_join_with_clashing_names_and_a_hot_key(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("__salt"), F.lit(5).alias("__parts"), F.lit(6).alias("__rows"))
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = common.salted_join(left, right, "k")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_keys_that_share_both_hashes_are_told_apart(spark, monkeypatch):
    """All keys of one length collide; the listed ones are still the only ones that are blocked."""
    monkeypatch.setattr(url_filter, "MOST_LEVELS", 4)
    monkeypatch.setattr(url_filter, "hashes_of", lambda key: (F.length(key).cast("bigint"), F.lit(3).cast("bigint")))
    urls = [f"http://h{i}.org/{'x' * (i % 7)}" for i in range(60)] + [None, "none"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    listed = [f"h{i}.org/{'x' * (i % 7)}" for i in range(0, 60, 4)]
    rows = url_filter.filter_urls(pages, [], spark.createDataFrame([(k,) for k in listed], "key string")).collect()
    assert {r.page_id for r in rows if r.verdict == "block"} == set(range(0, 60, 4))
    assert len(rows) == len(urls)
