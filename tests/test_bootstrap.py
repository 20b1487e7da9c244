"""Bootstrap counts, sums and intervals against plain Python."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import bootstrap

SCHEMA = "customer_id bigint, is_treatment int, bought_after_promo int, uplift double, grp int"


def count(salt, r, i):
    text = f"{salt}:{r // 8}:{i}".encode()
    at = 8 * (r % 8)
    u = int(hashlib.sha256(text).hexdigest()[at : at + 8], 16) / 2**32
    k, p = 0, math.exp(-1)
    total = p
    while u >= math.floor(2**32 * total) / 2**32 and k < 12:
        k += 1
        p /= k
        total += p
    return k


@pytest.fixture(scope="module")
def data():
    draw = random.Random(5)
    return [
        (i, int(draw.random() < 0.7), int(draw.random() < 0.4), draw.choice([None, draw.randint(0, 20) / 20]), i % 3)
        for i in range(300)
    ]


def test_counts_are_poisson(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("customer_id"),
        *[w.alias(f"w{r}") for r, w in enumerate(bootstrap.weights("S", F.col("id"), 10))],
    ).collect()
    all_counts = [v for r in rows for v in r[1:]]
    assert abs(statistics.mean(all_counts) - 1) < 0.02
    assert abs(statistics.variance(all_counts) - 1) < 0.04
    for r in rows[:50]:
        assert list(r[1:]) == [count("S", k, r.customer_id) for k in range(10)]
    # Replicates of one digest and of two are not alike.
    a, b, c = ([r[k] for r in rows] for k in (1, 2, 9))
    assert abs(statistics.correlation(a, b)) < 0.06 and abs(statistics.correlation(a, c)) < 0.06


def test_sums_of_every_replicate(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = bootstrap.replicated_sums(df, ["grp"], bootstrap.arm_measures(), "S", 9).collect()
    for r in got:
        mine = [x for x in data if x[4] == r.grp]
        assert r.buyers_treated == sum(x[1] * x[2] for x in mine)
        assert list(r.buyers_treated_all) == [sum(count("S", k, x[0]) * x[1] * x[2] for x in mine) for k in range(9)]
        assert list(r.n_control_all) == [sum(count("S", k, x[0]) * (1 - x[1]) for x in mine) for k in range(9)]


def test_bounds_are_order_statistics(spark):
    cases = [list(range(40, 0, -1)), [3.0], [], [None, 2.0, None, 1.0], [5.0] * 10]
    df = spark.createDataFrame([(i, [None if x is None else float(x) for x in v]) for i, v in enumerate(cases)],
                               "i int, v array<double>")
    low, high = bootstrap.bounds(F.col("v"), 95)
    got = [tuple(r) for r in df.select("i", low, high).orderBy("i").collect()]
    assert got == [(0, 2.0, 39.0), (1, 3.0, 3.0), (2, None, None), (3, 1.0, 2.0), (4, 5.0, 5.0)]


def test_uplift_intervals(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(3).cache()
    got = {r.share: r for r in bootstrap.uplift_intervals(df, ["0.5", "0.1", "1"], "S", 16, 90, cells=5).collect()}
    ranked = sorted((x for x in data if x[3] is not None), key=lambda x: (-x[3], x[0]))

    def value(rows, w):
        n_t, n_c = sum(w(x) * x[1] for x in rows), sum(w(x) * (1 - x[1]) for x in rows)
        y_t, y_c = sum(w(x) * x[1] * x[2] for x in rows), sum(w(x) * (1 - x[1]) * x[2] for x in rows)
        uplift = y_t / n_t - y_c / n_c if n_t and n_c else None
        return uplift, (y_t - y_c * (n_t / n_c) if n_c else float(y_t))

    assert sorted(got) == [0.1, 0.5, 1.0]
    for share, r in got.items():
        top = ranked[: int(share * len(ranked))]
        assert (r.uplift, r.qini) == value(top, lambda x: 1)
        each = [value(top, lambda x: count("S", k, x[0])) for k in range(16)]
        for at, name in enumerate(("uplift", "qini")):
            found = sorted(v[at] for v in each if v[at] is not None)
            cut = int(len(found) * 0.05)
            assert (r[f"{name}_low"], r[f"{name}_high"]) == (found[cut], found[-1 - cut])
    empty = bootstrap.uplift_intervals(df.limit(0), ["0.5"], "S", 8)
    assert not empty.collect()


def test_intervals_cover_a_known_effect(spark):
    """Over 60 made-up campaigns the 90 % interval holds the true effect about that often."""
    draw = random.Random(9)
    rows = []
    for g in range(60):
        for i in range(250):
            arm = int(draw.random() < 0.5)
            rows.append((g * 1000 + i, arm, int(draw.random() < (0.5 if arm else 0.3)), 0.0, g))
    got = bootstrap.rate_intervals(spark.createDataFrame(rows, SCHEMA), "grp", "S", 40, 90).collect()
    held = sum(r.effect_low <= 0.2 <= r.effect_high for r in got)
    assert len(got) == 60 and 44 <= held <= 60
    assert all(r.rate_treated_low <= r.rate_treated <= r.rate_treated_high for r in got)
