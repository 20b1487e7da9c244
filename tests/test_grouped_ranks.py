"""Ranks per group where groups are many and some are hot, against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from counterfoil.operators import evaluation, ranking


@pytest.fixture(scope="module")
def rows(spark):
    """Thousands of groups; one holds a third of the rows, a null one a sixth, all their scores
    tied; some scores are null."""
    draw = random.Random(1)
    out = []
    for i in range(12_000):
        kind = draw.random()
        group = "hot" if kind < 0.33 else None if kind < 0.5 else f"g{draw.randint(0, 3000)}"
        score = 0.5 if group is None else draw.choice([None, draw.random(), draw.randint(0, 3) / 4])
        out.append((draw.randint(0, 1), group, i, score, draw.randint(-5, 9)))
    return spark.createDataFrame(out, "part int, grp string, id bigint, score double, x bigint").cache()


def plain(rows, descending=True):
    order = F.col("score").desc() if descending else F.col("score").asc()
    w = Window.partitionBy("part", "grp").orderBy(order, "id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.filter("score IS NOT NULL").select(
        "*", F.row_number().over(Window.partitionBy("part", "grp").orderBy(order, "id")).cast("bigint").alias("r"),
        F.sum("x").over(w).alias("sx"),
    )


@pytest.mark.parametrize("hot_rows, per_cell, descending", [
    (10**9, None, True), (500, None, True), (500, 37, False), (1, 5, True)])
def test_equal_to_a_plain_window(rows, hot_rows, per_cell, descending):
    got = ranking.grouped_totals(
        rows, "score", "id", ["part", "grp"], {"sx": F.col("x")}, descending, "r", hot_rows, per_cell
    )
    assert got.columns == [*rows.columns, "r", "sx"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain(rows, descending).collect()))


def test_hot_groups_are_few_and_cut_evenly(spark, rows):
    keyed = ranking._keyed(rows, "score", True)
    n = keyed.count()
    hot = ranking.hot_groups(keyed, ["grp"], n, 500)
    assert {r[0] for r in hot} == {"hot", None}
    cuts = ranking.group_cuts(keyed, "id", ["grp"], hot, 100).collect()
    assert len(cuts) == 2
    # A group all of whose scores are equal is cut by id.
    (tied,) = [r for r in cuts if r["__g0"] is None]
    assert len({c.k for block in tied["__blocks"] for c in block}) == 1
    assert sum(len(block) for block in tied["__blocks"]) > 10


def test_no_task_gets_a_hot_group(spark, rows):
    """The largest partition of the window holds a cell, not a third of the rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ranking.grouped_totals(rows, "score", "id", ["grp"], {}, True, "r", 500, 100)
        placed = out.groupBy(F.spark_partition_id()).agg(F.count("r").alias("n"), F.max("r"))
        sizes = [r["n"] for r in placed.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert sum(sizes) == rows.filter("score IS NOT NULL").count()
    assert max(sizes) < 0.1 * sum(sizes)


def test_empty(spark, rows):
    assert not ranking.grouped_totals(rows.limit(0), "score", "id", ["grp"]).collect()


@pytest.mark.parametrize("hot_rows", [10**9, 50])
def test_a_curve_per_group_equals_one_curve_each(spark, hot_rows):
    draw = random.Random(2)
    data = [
        (g, i, draw.randint(0, 1) if g != "T" else 1, int(draw.random() < 0.4), draw.randint(0, 9) / 10)
        for g, n in (("A", 120), ("B", 9), ("T", 5), (None, 30)) for i in range(n)
    ]
    schema = "campaign string, customer_id bigint, is_treatment int, bought_after_promo int, uplift double"
    scored = spark.createDataFrame(data, schema).cache()
    got = evaluation.qini_curves(scored, ["campaign"], hot_rows=hot_rows).collect()
    assert len(got) == len(data)
    for group in ("A", "B", "T", None):
        one = evaluation.qini_curve(scored.filter(F.col("campaign").eqNullSafe(F.lit(group)))).collect()
        mine = [tuple(r)[1:] for r in got if r.campaign == group]
        assert sorted(mine) == sorted(map(tuple, one))
