import pytest
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.operators import learners
from counterfoil.operators.learners import (
    ArmError,
    StratifiedTLearner,
    TreeTLearner,
    _partitions,
)
from counterfoil.sources.storage import store

# segment code -> (response when treated, response otherwise), percent
TRUE_RATES = {3: (70, 15), 2: (85, 80), 1: (5, 5), 0: (8, 65)}


@pytest.fixture(scope="module")
def people(spark):
    """4,000 customers whose segment decides how they respond; every tenth not in the pilot."""
    df = spark.range(4000).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 4).cast("int").alias("customer_segment_code"),
        (F.col("id") % 200).alias("recency_days"),
        (F.col("id") % 3).alias("frequency_30d"),
        *[
            (F.col("id") * k % 97).cast("double").alias(name)
            for k, name in enumerate(
                ["monetary_90d", "total_spend", "avg_basket_value", "promo_ratio"], 3
            )
        ],
        (F.col("id") % 11).alias("total_visits"),
        (F.col("id") % 13).alias("total_items"),
    )
    arm = (E.hash_percent("arm", F.col("customer_id")) < 50).cast("int")
    rate = F.lit(0)
    for code, (treated, control) in TRUE_RATES.items():
        chance = F.when(arm == 1, treated).otherwise(control)
        rate = F.when(F.col("customer_segment_code") == code, chance).otherwise(rate)
    bought = (E.hash_percent("buy", F.col("customer_id")) < rate).cast("int")
    out = F.col("customer_id") % 10 == 0
    return store(
        df.withColumns(
            {
                "is_treatment": F.when(~out, arm),
                "bought_after_promo": F.when(~out, bought),
            }
        ),
        "people",
    )


def in_campaign(people):
    return people.filter(F.col("is_treatment").isNotNull())


def mean_uplift(scored):
    rows = scored.groupBy("customer_segment_code").agg(F.avg("uplift").alias("u")).collect()
    return {r.customer_segment_code: r.u for r in rows}


def fitted(people, learner):
    scored = store(learner.fit(in_campaign(people)).transform(people), "scored")
    assert scored.count() == 4000
    assert scored.filter("p_treatment < 0 or p_treatment > 1 or uplift is null").count() == 0
    return mean_uplift(scored)


@pytest.mark.parametrize("learner", [StratifiedTLearner(), TreeTLearner("boosted")])
def test_learners_recover_known_effects(people, learner):
    found = fitted(people, learner)
    for code, (treated, control) in TRUE_RATES.items():
        assert abs(found[code] - (treated - control) / 100) < 0.1


def test_forest_separates_the_effects(people):
    """Its splits see three of the nine features, of which one matters here: effects shrink
    towards each other, but keep their sign and order."""
    found = fitted(people, TreeTLearner("forest"))
    assert found[3] > 0.25 and found[0] < -0.25
    assert found[0] < min(found[1], found[2]) and max(found[1], found[2]) < found[3]


def test_stratified_rates_are_smoothed(spark):
    rows = [(3, 10, 1, 1), (3, 10, 1, 0), (3, 10, 0, 0), (2, 10, 1, 1)]
    df = spark.createDataFrame(
        rows,
        "customer_segment_code int, recency_days bigint, is_treatment int, "
        "bought_after_promo int",
    )
    scored = StratifiedTLearner().fit(df).transform(
        spark.createDataFrame(
            [(3, 30), (2, 0), (3, 31)], "customer_segment_code int, recency_days bigint"
        )
    )
    got = {(r[0], r[1]): (r.p_treatment, r.p_control) for r in scored.collect()}
    assert got == {(3, 30): (2 / 4, 1 / 3), (2, 0): (2 / 3, 0.5), (3, 31): (0.5, 0.5)}


def test_learner_settings():
    boosted, forest = TreeTLearner("boosted")._estimator(), TreeTLearner("forest")._estimator()
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()) == (100, 0.03, 3)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 4, 42)
    assert C.FEATURE_COLUMNS[0] == "recency_days" and len(C.FEATURE_COLUMNS) == 9
    with pytest.raises(ValueError):
        TreeTLearner("linear")._estimator()


@pytest.mark.parametrize("case", ["is_treatment = 1", "is_treatment = 0 or bought_after_promo = 0"])
def test_an_arm_that_cannot_be_fitted_is_named(people, case):
    with pytest.raises(ArmError, match="arm"):
        TreeTLearner("forest").fit(in_campaign(people).filter(case))


@pytest.mark.parametrize(
    ("rows", "partitions"), [(0, 1), (12_000, 1), (300_000, 15), (10**9, 50_000)]
)
def test_training_rows_are_spread_by_their_number(rows, partitions):
    assert _partitions(rows) == partitions


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_predictions_do_not_depend_on_where_rows_come_from(people, monkeypatch, kind):
    """Several partitions per arm; the input as one part, as four, as eight in other orders."""
    monkeypatch.setattr(learners, "ROWS_PER_PARTITION", 400)
    monkeypatch.setitem(C.BOOSTED_TREES, "maxIter", 5)
    train = in_campaign(people)
    found = []
    for parts in (1, 4, 8):
        rows = train.repartition(parts, F.rand(parts)).sortWithinPartitions(F.rand(9))
        model = TreeTLearner(kind).fit(store(rows, "train"))
        scored = model.transform(people).select("customer_id", "p_treatment", "p_control")
        found.append({r[0]: r[1:] for r in scored.collect()})
    for other in found[1:]:
        assert all(other[i] == pytest.approx(p, abs=1e-12) for i, p in found[0].items())
