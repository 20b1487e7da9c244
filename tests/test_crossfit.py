"""Out-of-fold scores against models fitted fold by fold, and against leaking labels."""

import random

import pytest
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.operators import crossfit, evaluation
from counterfoil.operators.learners import StratifiedTLearner, TreeTLearner

from test_trees import people


@pytest.fixture(scope="module")
def pilot(spark):
    draw = random.Random(3)
    rows = [
        (i, draw.randint(-1, 3), draw.choice([5, 40, 120, 400]), int(draw.random() < 0.6),
         int(draw.random() < 0.4))
        for i in range(500)
    ]
    rows += rows[:20]  # customers of two campaigns
    rows += [(None, 1, 5, 1, 1)]
    schema = "customer_id bigint, customer_segment_code int, recency_days bigint, is_treatment int, bought_after_promo int"
    return spark.createDataFrame(rows, schema).cache()


def scores(df):
    return sorted((r.customer_id, r.fold, r.p_treatment, r.p_control, r.uplift) for r in df.collect())


@pytest.mark.parametrize("folds", [2, 5])
def test_one_aggregation_equals_a_fit_per_fold(spark, pilot, folds):
    got = scores(crossfit.crossfit(pilot, "K", folds))
    rows = pilot.filter("customer_id IS NOT NULL").withColumn("fold", crossfit.fold("K", folds))
    want = []
    for f in range(folds):
        model = StratifiedTLearner().fit(rows.filter(F.col("fold") != f))
        want += scores(model.transform(rows.filter(F.col("fold") == f)))
    assert got == sorted(want) and len(got) == 520
    assert {f for _, f, *_ in got} == set(range(folds))


def test_rows_of_a_customer_share_a_fold(spark, pilot):
    out = crossfit.crossfit(pilot, "K", 5)
    assert out.groupBy("customer_id").agg(F.count_distinct("fold").alias("n")).agg(F.max("n")).first()[0] == 1


def test_own_label_does_not_move_the_own_score(spark, pilot):
    """Turning one customer's label leaves that customer's score alone and moves others'."""
    turned = pilot.withColumn(
        "bought_after_promo",
        F.when(F.col("customer_id") == 7, 1 - F.col("bought_after_promo")).otherwise(F.col("bought_after_promo")),
    )
    a, b = scores(crossfit.crossfit(pilot, "K")), scores(crossfit.crossfit(turned, "K"))
    mine = a[[x[0] for x in a].index(7)][1]
    assert [x for x in a if x[1] == mine] == [x for x in b if x[1] == mine]
    assert a != b


def test_a_stratum_in_one_fold_alone_gets_one_half(spark):
    rows = spark.createDataFrame(
        [(1, 3, 5, 1, 1)], "customer_id bigint, customer_segment_code int, recency_days bigint, is_treatment int, bought_after_promo int"
    )
    (r,) = crossfit.crossfit(rows, "K", 2).collect()
    assert (r.p_treatment, r.p_control) == (0.5, 0.5)
    assert not crossfit.crossfit(rows.limit(0), "K", 2).collect()
    with pytest.raises(ValueError, match="2 at least"):
        crossfit.crossfit(rows, "K", 1)


def test_trees_out_of_fold(spark, monkeypatch):
    """Each fold's rows have the scores of a forest fitted on the others, and the curve is flatter
    than that of the rows the forest was fitted on."""
    monkeypatch.setattr(C, "FOREST", C.FOREST | {"numTrees": 10})
    rows = people(spark, 300, seed=4)
    learner = TreeTLearner("forest")
    out = crossfit.crossfit(rows, "K", 2, learner)
    folded = rows.withColumn("fold", crossfit.fold("K", 2))
    model = learner.fit(folded.filter("fold = 1"))
    assert scores(out.filter("fold = 0")) == scores(model.transform(folded.filter("fold = 0")))
    area = lambda df: evaluation.qini_curve(df).agg(F.avg(F.col("qini") - F.col("random"))).first()[0]
    assert out.count() == 300 and area(out) < area(learner.fit(rows).transform(rows))
