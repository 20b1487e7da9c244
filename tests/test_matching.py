"""Nearest controls against all pairs; the work per point is bounded."""

import random

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import matching

SCHEMA = (
    "customer_id bigint, customer_segment_code int, recency_days bigint, frequency_30d bigint, "
    "monetary_90d double, is_treatment int, bought_after_promo int"
)


def people(seed, count=400, spread=60):
    draw = random.Random(seed)
    return [
        (i, draw.choice([0, 1, None]) if draw.random() < 0.2 else 1,
         draw.choice([None, 180, draw.randint(0, 10 * spread)]), draw.randint(0, 4),
         draw.choice([0.0, draw.random() * 20000 * spread]), int(draw.random() < 0.6), int(draw.random() < 0.4))
        for i in range(count)
    ]


def plain(rows, caliper, scales=matching.SCALES):
    def point(r):
        return [None if v is None else round(v * s) for v, s in zip(r[2:5], scales.values())]

    out = {}
    for t in (r for r in rows if r[5] == 1):
        best = (None, None, None)
        if t[1] is not None and None not in point(t):
            near = [
                (sum((a - b) ** 2 for a, b in zip(point(t), point(c))), c[0], c[6])
                for c in rows
                if c[5] == 0 and c[1] == t[1] and None not in point(c)
            ]
            near = [x for x in near if x[0] <= caliper**2]
            if near:
                square, control, label = min(near)
                best = (control, square, label)
        out[t[0]] = (best[0], best[1], t[6], best[2])
    return out


@pytest.mark.parametrize("seed, caliper, spread", [(1, 4, 60), (2, 1, 5), (3, 13, 40), (4, 6, 200)])
def test_equal_to_all_pairs(spark, seed, caliper, spread):
    rows = people(seed, spread=spread)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = matching.nearest_controls(df, caliper=caliper).collect()
    assert {r.customer_id: tuple(r)[1:] for r in got} == plain(rows, caliper)
    assert len(got) == sum(r[5] for r in rows)


def test_radii():
    assert [matching.radii(c) for c in (1, 2, 3, 4, 5, 8, 9)] == [
        [1], [1, 2], [1, 2, 3], [1, 2, 4], [1, 2, 4, 5], [1, 2, 4, 8], [1, 2, 4, 8, 9]]


def test_effect(spark):
    rows = [
        (1, 1, 10, 0, 0.0, 1, 1), (2, 1, 10, 0, 0.0, 1, 0), (3, 1, 500, 0, 0.0, 1, 1),
        (9, 1, 10, 0, 0.0, 0, 0), (8, 1, 20, 0, 0.0, 0, 1), (7, 0, 10, 0, 0.0, 0, 1),
    ]
    matches = matching.nearest_controls(spark.createDataFrame(rows, SCHEMA))
    (r,) = matching.nearest_effect(matches).collect()
    assert tuple(r) == (2, 1, 1, 1, 0, 0.5)
    nobody = matching.nearest_controls(spark.createDataFrame(rows[3:], SCHEMA))
    assert tuple(matching.nearest_effect(nobody).first()) == (0, 0, 0, 0, 0, None)


def test_customers_at_one_point_are_compared_once(spark, monkeypatch):
    """A third of the treated and half of the controls are alike: the join sees one row of each."""
    seen = []
    real = matching.nearest_points

    def watch(asked, controls, *rest):
        seen.append((asked.count(), controls.count()))
        return real(asked, controls, *rest)

    monkeypatch.setattr(matching, "nearest_points", watch)
    rows = [(i, 1, 180, 0, 0.0, i % 2, 1) for i in range(3000)]
    rows += [(3000 + i, 1, 10 * i, 1, 0.0, i % 2, 0) for i in range(30)]
    got = matching.nearest_controls(spark.createDataFrame(rows, SCHEMA)).collect()
    assert seen == [(16, 16)] and len(got) == 1515
    assert {r.control_id for r in got if r.customer_id < 3000} == {0}


def test_bad_settings(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert not matching.nearest_controls(df).collect()
    with pytest.raises(ValueError, match="caliper"):
        matching.nearest_controls(df, caliper=0)
    with pytest.raises(ValueError, match="features"):
        matching.nearest_controls(df, scales=dict.fromkeys("abcde", 1.0))
