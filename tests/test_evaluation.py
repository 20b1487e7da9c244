import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from counterfoil.operators import evaluation, reports
from counterfoil.sources.storage import store

SCHEMA = (
    "customer_id bigint, is_treatment int, bought_after_promo int, p_treatment double, "
    "p_control double, uplift double"
)


def pilot(n, seed=3, treated=0.7, levels=9):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        w, y = int(draw.random() < treated), int(draw.random() < 0.4)
        pt, pc = draw.randint(0, levels) / levels, draw.randint(0, levels) / levels
        rows.append((i, w, y, pt, pc, pt - pc))
    return rows


@pytest.fixture(scope="module")
def rows():
    return pilot(1500)


@pytest.fixture(scope="module")
def scored(spark, rows):
    return store(spark.createDataFrame(rows, SCHEMA), "scored")


def plain_qini(rows):
    ordered = sorted(rows, key=lambda r: (-r[5], r[0]))
    n_t = y_t = y_c = 0
    found = []
    for place, (i, w, y, *_) in enumerate(ordered, 1):
        n_t, y_t, y_c = n_t + w, y_t + y * w, y_c + y * (1 - w)
        n_c = place - n_t
        found.append((i, place, n_t, n_c, y_t, y_c, y_t - y_c * (n_t / n_c) if n_c else y_t))
    return found


@pytest.mark.parametrize("cells", [None, 31])
def test_qini_curve(scored, rows, cells):
    got = sorted(evaluation.qini_curve(scored, cells=cells).collect(), key=lambda r: r.n_pop)
    want = plain_qini(rows)
    assert [
        (r.customer_id, r.n_pop, r.n_t, r.n_c, r.y_t, r.y_c, r.qini) for r in got
    ] == want
    assert got[-1].qini == pytest.approx(got[-1].random)


def test_qini_before_and_without_controls(spark):
    some = [(1, 1, 1, 0, 0, 0.9), (2, 1, 0, 0, 0, 0.8), (3, 0, 1, 0, 0, 0.1)]
    some = [(i, w, y, float(a), float(b), u) for i, w, y, a, b, u in some]
    df = spark.createDataFrame(some, SCHEMA)
    got = sorted(evaluation.qini_curve(df).collect(), key=lambda r: r.n_pop)
    assert [r.qini for r in got] == [1.0, 1.0, 1 - 1 * 2.0]
    only = evaluation.qini_curve(df.filter("is_treatment = 1")).collect()
    assert all(r.random is None and r.qini == r.y_t for r in only)


def test_uplift_at_k(scored, rows):
    ordered = sorted(rows, key=lambda r: (-r[5], r[0]))
    for r in evaluation.uplift_at_k(scored, ["0.1", "0.5", "1"], cells=17).collect():
        top = ordered[: int(r.share * len(rows))]
        arms = [[x[2] for x in top if x[1] == w] for w in (1, 0)]
        assert r.n_top == len(top)
        assert r.uplift_at_k == sum(arms[0]) / len(arms[0]) - sum(arms[1]) / len(arms[1])


def test_uplift_at_k_with_an_empty_arm(spark):
    df = spark.createDataFrame(pilot(10, treated=1.1), SCHEMA)
    assert evaluation.uplift_at_k(df, ["0.5"]).first().uplift_at_k is None
    assert evaluation.uplift_at_k(df, ["0.01"]).first().n_top == 0


@pytest.mark.parametrize("levels", [1, 9, 10_000])
@pytest.mark.parametrize("cells", [None, 13])
def test_auc_equals_all_pairs(spark, levels, cells):
    rows = pilot(400, levels=levels)
    df = spark.createDataFrame(rows, SCHEMA)
    for r in evaluation.auc(df, cells=cells).collect():
        mine = [(x[3] if x[1] else x[4], x[2]) for x in rows if x[1] == r.is_treatment]
        pos, neg = [s for s, y in mine if y], [s for s, y in mine if not y]
        wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
        assert r.auc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
        assert (r.n, r.positives) == (len(mine), len(pos))


def test_auc_agrees_with_the_library_evaluator(spark):
    df = spark.createDataFrame(pilot(600), SCHEMA)
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="p_treatment", labelCol="bought_after_promo", numBins=0
    )
    want = evaluator.evaluate(df.filter("is_treatment = 1"))
    got = evaluation.auc(df).filter("is_treatment = 1").first().auc
    assert got == pytest.approx(want, abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    rows = [(i, 1, 1, 0.1 * i, 0.0, 0.0) for i in range(5)]
    assert evaluation.auc(spark.createDataFrame(rows, SCHEMA)).first().auc is None


def test_precision(scored, rows):
    for r in evaluation.precision_at(scored, "0.2", cells=11).collect():
        mine = [x for x in rows if x[1] == r.is_treatment]
        mine.sort(key=lambda x: (-(x[3] if x[1] else x[4]), x[0]))
        top = mine[: len(mine) // 5]
        assert (r.n_top, r.precision) == (len(top), sum(x[2] for x in top) / len(top))


def test_response_signal(spark):
    rows = [(1, 1, int(i < 60)) for i in range(100)] + [(4, 1, int(i < 40)) for i in range(100)]
    df = spark.createDataFrame(rows, "rfm_quartile int, is_treatment int, bought_after_promo int")
    r = evaluation.response_signal(df).first()
    assert (r.rate_q1, r.rate_q4) == (0.6, 0.4)
    assert r.z == pytest.approx(0.2 / (0.25 * 0.02) ** 0.5)
    assert evaluation.response_signal(df.filter("rfm_quartile = 1")).first().z is None


@pytest.mark.parametrize("n", [1, 2, 6, 501])
def test_feature_profile_equals_pandas(spark, n):
    df = store(
        spark.range(n).select(
            F.col("id").alias("customer_id"),
            (F.col("id") * 37 % 11).alias("a"),
            (F.rand(5) * 1e6).alias("b"),
            F.lit(2.5).alias("c"),
        ),
        "f",
    )
    want = df.toPandas()[["a", "b", "c"]].describe()
    for r in reports.feature_profile(df, ["a", "b", "c"], cells=7).collect():
        w = want[r.feature]
        got = [r.n, r.mean, r.min, r.q25, r.q50, r.q75, r.max]
        assert got == pytest.approx(
            [w["count"], w["mean"], w["min"], w["25%"], w["50%"], w["75%"], w["max"]], abs=1e-4
        )
        assert r.std is None if n == 1 else r.std == pytest.approx(w["std"], abs=1e-4)


def test_value_counts_are_ordered(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    got = [tuple(r) for r in reports.value_counts(df, "k").collect()]
    assert got == [("b", 2), ("a", 1), ("c", 1)]
