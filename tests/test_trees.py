"""Node tables against the models they come from, and refusals of broken tables."""

import math
import random

import pytest
from pyspark.sql import types as T

from counterfoil.functions import constants as C
from counterfoil.operators import trees
from counterfoil.operators.learners import TreeTLearner
from counterfoil.plans.queries import SMALL_ENSEMBLE
from counterfoil.sources.storage import local_table

FEATURES = ", ".join(f"{c} double" for c in C.FEATURE_COLUMNS)


def people(spark, count=400, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        x = [float(draw.randint(0, 9)) for _ in C.FEATURE_COLUMNS]
        arm = int(draw.random() < 0.7)
        rows.append((i, *x, arm, int(draw.random() < (0.2 + 0.05 * x[0] + 0.2 * arm * (x[3] > 4)) / 1.2)))
    return spark.createDataFrame(
        rows, f"customer_id bigint, {FEATURES}, is_treatment int, bought_after_promo int"
    )


@pytest.fixture(scope="module")
def pilot(spark):
    return people(spark).cache()


@pytest.mark.parametrize("kind, setting", [("boosted", "BOOSTED_TREES"), ("forest", "FOREST")])
def test_table_scores_like_the_model(spark, pilot, tmp_path, monkeypatch, kind, setting):
    few = {"maxIter": 12} if kind == "boosted" else {"numTrees": 15}
    monkeypatch.setattr(C, setting, getattr(C, setting) | few)
    model = TreeTLearner(kind).fit(pilot)
    path = trees.write_table(trees.node_table(spark, model), str(tmp_path / "nodes"))
    table = trees.read_table(spark, path)
    want = {r.customer_id: r for r in model.transform(pilot).collect()}
    got = table.transform(pilot).collect()
    assert len(got) == len(want) == 400
    for r in got:
        for c in ("p_treatment", "p_control", "uplift"):
            assert abs(r[c] - want[r.customer_id][c]) <= 1e-12
    assert len({r.uplift for r in got}) > 20
    plan = table.transform(pilot)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def table(spark, rows):
    return local_table(spark, rows, T.StructType.fromDDL(trees.SCHEMA))


def plain(rows, x, arm):
    """The probability of one arm by walking the rows."""
    mine = {(r[1], r[2]): r for r in rows if r[0] == arm}
    votes = []
    for tree in sorted({t for t, _ in mine}):
        r = mine[tree, 0]
        while r[3] >= 0:
            v = x[r[3]]
            r = mine[tree, r[5] if v is not None and not math.isnan(v) and v <= r[4] else r[6]]
        votes.append(r[7] * (r[8] if r[9] == "logistic" else 1))
    if next(iter(mine.values()))[9] == "logistic":
        return 1 / (1 + math.exp(-2 * sum(votes)))
    return sum(votes) / len(votes)


def test_small_ensemble_by_hand(spark):
    draw = random.Random(2)
    rows = []
    for i in range(200):
        edge = [60.0, 0.5, 1.0, 500000.0, 1.0, 1.0, 100000.0, 0.15, 1.5]
        x = [draw.choice([e, e - 0.01, e + 0.01, None, float("nan")]) for e in edge]
        rows.append((i, *x))
    df = spark.createDataFrame(rows, f"customer_id int, {FEATURES}")
    got = {r.customer_id: r for r in trees.table_model(table(spark, SMALL_ENSEMBLE)).transform(df).collect()}
    for i, *x in rows:
        assert abs(got[i].p_treatment - plain(SMALL_ENSEMBLE, x, 1)) < 1e-12
        assert abs(got[i].p_control - plain(SMALL_ENSEMBLE, x, 0)) < 1e-12


def without(*keys):
    return [r for r in SMALL_ENSEMBLE if r[:3] not in keys]


def changed(key, at, to):
    return [tuple(to if i == at else v for i, v in enumerate(r)) if r[:3] == key else r for r in SMALL_ENSEMBLE]


@pytest.mark.parametrize(
    "rows, word",
    [
        ([r for r in SMALL_ENSEMBLE if r[0] == 1], "no trees"),
        (without((1, 0, 0)), "root"),
        (without((1, 0, 4)), "whole"),
        (changed((1, 0, 1), 5, 0), "whole"),
        (changed((1, 0, 0), 4, None), "threshold"),
        (changed((1, 0, 0), 3, 9), "input"),
        (changed((1, 0, 2), 7, None), "value"),
        (changed((1, 0, 2), 9, "mean"), "links"),
        (changed((0, 0, 1), 0, 2), "unknown"),
        ([*SMALL_ENSEMBLE, SMALL_ENSEMBLE[0]], "repeated"),
        ([*SMALL_ENSEMBLE, (1, 0, 9, -1, None, -1, -1, 0.1, 1.0, "logistic")], "no root leads"),
    ],
)
def test_broken_tables_are_refused(spark, rows, word):
    with pytest.raises(trees.TableError, match=word):
        trees.table_model(table(spark, rows))


def test_too_many_nodes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(trees, "MOST_NODES", 5)
    with pytest.raises(trees.TableError, match="more than 5"):
        trees.table_model(table(spark, SMALL_ENSEMBLE))
