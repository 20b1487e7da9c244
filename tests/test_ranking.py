import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from counterfoil.operators import ranking
from counterfoil.sources.storage import store


def expected(rows, descending=True):
    """rows: (group, id, score, v) -> {(group, id): (rank, running v)}"""
    found = {}
    for group in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == group and r[2] is not None]
        mine.sort(key=lambda r: (-r[2] if descending else r[2], r[1]))
        total = 0
        for place, r in enumerate(mine, 1):
            total += r[3]
            found[group, r[1]] = (place, total)
    return found


def make(kind, n=3000, seed=1):
    draw = random.Random(seed)
    score = {
        "distinct": lambda i: draw.uniform(-1, 1),
        "one_value": lambda i: 0.25,
        "third_tied": lambda i: 0.5 if i % 3 == 0 else draw.uniform(0, 1),
        "few": lambda i: float(draw.choice([-0.5, 0.0, 0.1, 7.0])),
        "nulls": lambda i: None if i % 5 == 0 else draw.uniform(-1, 1),
        "zeros": lambda i: draw.choice([0.0, -0.0, 1.0]),
    }[kind]
    rows = [(i % 2, i * 7919 % n, score(i), draw.randint(-3, 5)) for i in range(n)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind", ["distinct", "one_value", "third_tied", "few", "nulls", "zeros"])
@pytest.mark.parametrize("cells", [None, 1, 37])
def test_running_totals_equal_a_plain_sort(spark, kind, cells):
    rows = make(kind)
    df = store(spark.createDataFrame(rows, "g int, id bigint, s double, v bigint"), "t")
    got = ranking.running_totals(
        df, "s", "id", {"sv": F.col("v")}, groups=["g"], cells=cells
    ).collect()
    assert {(r.g, r.id): (r.n_pop, r.sv) for r in got} == expected(rows)


def test_running_totals_with_text_ids_ascending(spark):
    rows = [(0, f"C{i:05d}", s, v) for _, i, s, v in make("third_tied")]
    df = store(spark.createDataFrame(rows, "g int, id string, s double, v bigint"), "t")
    got = ranking.running_totals(
        df, "s", "id", {"sv": F.col("v")}, descending=False, cells=23
    ).collect()
    assert {(0, r.id): (r.n_pop, r.sv) for r in got} == expected(rows, descending=False)


def test_tied_scores_are_spread_over_cells(spark):
    """A score shared by all rows must not end up in one cell."""
    rows = make("one_value", 4000)
    df = store(spark.createDataFrame(rows, "g int, id bigint, s double, v bigint"), "t")
    keyed = ranking._keyed(df, "s", True)
    cuts = ranking.choose_cuts(keyed, "id", 20)
    sizes = [
        r["count"]
        for r in ranking.with_cells(keyed, "id", cuts).groupBy(*ranking.CELL).count().collect()
    ]
    assert sum(sizes) == 4000 and len(sizes) >= 15 and max(sizes) < 4000 / 20 * 3


def test_half_the_rows_on_one_score_are_spread(spark):
    df = store(
        spark.range(8000).select(
            "id", F.when(F.col("id") % 2 == 0, 0.5).otherwise(F.rand(3)).alias("s")
        ),
        "t",
    )
    keyed = ranking._keyed(df, "s", True)
    cells = ranking.with_cells(keyed, "id", ranking.choose_cuts(keyed, "id", 16))
    assert cells.groupBy(*ranking.CELL).count().agg(F.max("count")).first()[0] < 8000 / 16 * 3


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from([-1.0, 0.0, 0.5, 2.0]) | st.floats(-9, 9), st.integers(0, 99)),
        max_size=80,
        unique=True,
    ),
    st.integers(1, 30),
)
def test_cuts_are_ordered_and_ties_point_at_their_bucket(sample, cells):
    cuts = ranking.cuts_from_sample(sorted(sample), cells)
    assert cuts.splits == sorted(set(cuts.splits))
    assert cuts.splits[0] == -math.inf and cuts.splits[-1] == math.inf
    for bucket, ids in cuts.ties.items():
        key = cuts.splits[bucket]
        assert cuts.splits[bucket + 1] == math.nextafter(key, math.inf)
        assert all((key, i) in sample for i in ids) and ids == sorted(ids)


@pytest.mark.parametrize("kind", ["distinct", "one_value", "third_tied", "nulls"])
def test_rank_cuts_find_rows_and_cover_what_precedes(spark, kind):
    rows = make(kind)
    df = store(spark.createDataFrame(rows, "g int, id bigint, s double, v bigint"), "t")
    found = ranking.rank_cuts(df, "s", "id", lambda n: [0, 1, n // 3, n], groups=["g"], cells=19)
    places = expected(rows)
    for g in (0, 1):
        total = sum(1 for key in places if key[0] == g)
        for cut, position in zip(found[(g,)], [0, 1, total // 3, total], strict=True):
            covered = df.filter((F.col("g") == g) & cut.covers("s", "id")).collect()
            assert {r.id for r in covered} == {
                i for (group, i), (place, _) in places.items() if group == g and place <= position
            }


@pytest.mark.parametrize("n", [1, 2, 3, 5, 103, 1000])
def test_tiles_equal_ntile(spark, n):
    df = store(spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("s")), "t")
    cuts = ranking.rank_cuts(df, "s", "id", ranking.tile_ends(4), descending=False, cells=5)[()]
    df.createOrReplaceTempView("tiles")
    want = spark.sql("SELECT id, ntile(4) OVER (ORDER BY s, id) AS t FROM tiles").collect()
    got = df.select("id", ranking.tile(cuts, "s", "id").alias("t")).collect()
    assert sorted(want) == sorted(got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 50])
def test_slices_count_the_lower_cut_ids(spark, n):
    ids = [3 * i for i in range(n)]
    cuts = ranking.Cuts([-math.inf, 0.0, math.nextafter(0.0, 1.0), math.inf], {1: ids})
    rows = spark.range(-1, 3 * n + 2).select("id", F.lit(0.0).alias(ranking.KEY))
    for r in ranking.with_cells(rows, "id", cuts).collect():
        assert (r[ranking.BUCKET], r[ranking.SLICE]) == (1, sum(i < r.id for i in ids))


def test_share_position_is_decimal():
    assert ranking.share_position("0.29", 100) == 29
    assert ranking.share_position("0.3", 1501) == 450


def test_empty_input(spark):
    df = spark.createDataFrame([], "id bigint, s double")
    assert ranking.running_totals(df, "s", "id").count() == 0
    assert ranking.rank_cuts(df, "s", "id", lambda n: [n]) == {}
    assert df.filter(ranking.top_share(df, "s", "id", "0.3").covers("s", "id")).count() == 0


def test_a_position_outside_the_rows_is_refused(spark):
    df = spark.range(10).select("id", F.col("id").cast("double").alias("s"))
    with pytest.raises(ValueError):
        ranking.rank_cuts(df, "s", "id", lambda n: [n + 1])


def test_only_the_cell_table_meets_in_one_task(spark):
    df = store(spark.range(5000).select("id", F.rand(1).alias("s")), "t")
    ranked = ranking.running_totals(df, "s", "id", cells=25)
    lines = ranked._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate(keys=[__bucket" in lines[single[0] + 1]
