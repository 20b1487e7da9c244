from datetime import date, timedelta
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import experiment, features
from counterfoil.sources.binding import Retail
from counterfoil.sources.catalog import SCHEMAS

START = date(2026, 6, 1)
PRODUCTS = [("P1", 9.99, 5.0, "A"), ("P2", 20.0, 9.0, "A"), ("P3", 30.0, 9.0, "B")]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, SCHEMAS["products"])


def offers(spark, rows):
    return spark.createDataFrame(
        [(p, 0.2, product, start, start + timedelta(days=6)) for p, product, start in rows],
        SCHEMAS["promotions"],
    )


def sent(spark, pairs):
    return spark.createDataFrame(
        [("C", c, p, 1) for c, p in pairs],
        "campaign_id string, customer_id string, promotion_id string, is_treatment int",
    )


def bought(spark, rows):
    return spark.createDataFrame(
        [(dt.fromisoformat(when), product, 1.0, 1, c, "", "S", "o") for c, product, when in rows],
        SCHEMAS["transactions"],
    )


def labels(df):
    return {(r.customer_id, r.promotion_id): r.bought_after_promo for r in df.collect()}


PURCHASES = [
    ("first", "P1", "2026-06-01T00:00:00"),
    ("last", "P1", "2026-06-07T23:59:59"),
    ("late", "P1", "2026-06-08T00:00:00"),
    ("early", "P1", "2026-05-31T23:59:59"),
    ("sister", "P2", "2026-06-02T00:00:00"),
    ("other", "P3", "2026-06-02T00:00:00"),
    ("first", "P1", "2026-06-02T00:00:00"),
    (None, "P1", "2026-06-02T00:00:00"),
]


@pytest.mark.parametrize(
    ("match", "buyers"),
    [
        ("product", {"first", "last"}),
        ("category", {"first", "last", "sister"}),
        ("any", {"first", "last", "sister", "other"}),
    ],
)
def test_label_window_and_match(spark, products, match, buyers):
    people = ["first", "last", "late", "early", "sister", "other", "nobody"]
    found = labels(
        experiment.response_label(
            sent(spark, [(c, "X") for c in people]),
            offers(spark, [("X", "P1", START)]),
            bought(spark, PURCHASES),
            products,
            match=match,
        )
    )
    assert len(found) == len(people)
    assert {c for (c, _), y in found.items() if y} == buyers


@pytest.mark.parametrize("match", ["product", "category", "any"])
def test_many_promotions_keep_their_own_windows(spark, products, match):
    """More start dates than one bit word holds, against a plain double loop."""
    starts = [START + timedelta(days=5 * i) for i in range(70)]
    promos = [(f"X{i}", "P1" if i % 2 else "P3", s) for i, s in enumerate(starts)]
    purchases = [
        (f"c{i % 7}", ["P1", "P2", "P3"][i % 3], f"{START + timedelta(days=11 * i)}T12:00:00")
        for i in range(40)
    ]
    category = {p[0]: p[3] for p in PRODUCTS}
    pairs = [(f"c{c}", p) for c in range(7) for p, _, _ in promos]

    def matches(product, wanted):
        if match == "any":
            return True
        if match == "product":
            return product == wanted
        return category[product] == category[wanted]

    want = {}
    for c, p in pairs:
        wanted, start = next((w, s) for name, w, s in promos if name == p)
        begin = dt.combine(start, dt.min.time())
        want[c, p] = int(
            any(
                who == c
                and matches(product, wanted)
                and begin <= dt.fromisoformat(when) < begin + timedelta(days=7)
                for who, product, when in purchases
            )
        )
    got = labels(
        experiment.response_label(
            sent(spark, pairs), offers(spark, promos), bought(spark, purchases), products,
            match=match,
        )
    )
    assert got == want and 0 < sum(want.values()) < len(want)


def test_label_without_promotions_and_bad_match(spark, products):
    dispatch = sent(spark, [("a", "X")])
    none = offers(spark, [("X", "P1", START)]).limit(0)
    found = experiment.response_label(dispatch, none, bought(spark, PURCHASES), products)
    assert labels(found) == {("a", "X"): 0}
    with pytest.raises(ValueError):
        experiment.response_label(dispatch, none, dispatch, products, match="brand")


def test_arms_from_fact(spark):
    rows = spark.createDataFrame(
        [
            (dt(2026, 6, 2), "P1", 1.0, 1, "a", "X", "S", "1"),
            (dt(2026, 6, 2), "P1", 1.0, 1, "b", "", "S", "2"),
            (dt(2026, 7, 2), "P1", 1.0, 1, "c", "X", "S", "3"),
        ],
        SCHEMAS["transactions"],
    )
    people = spark.createDataFrame([(c, "x") for c in "abcd"], SCHEMAS["customers"])
    arms = experiment.arms_from_fact(people, rows, "X", "2026-06-01", 7).collect()
    assert {r.customer_id: r.is_treatment for r in arms} == {"a": 1, "b": 0, "c": 0, "d": 0}


def test_arms_and_folds_are_repeatable_and_independent(spark):
    people = spark.range(10_000).select(F.col("id").alias("customer_id"))
    arms = experiment.assign_arms(people, "K").withColumn("fold", experiment.fold("K"))
    first, second = sorted(arms.collect()), sorted(arms.repartition(7).collect())
    assert first == second
    shares = arms.groupBy("fold").agg(F.avg("is_treatment").alias("t")).collect()
    assert all(abs(r.t - 0.8) < 0.02 for r in shares)


def test_arm_summary(spark):
    rows = [(1, 1), (1, 0), (1, 1), (0, 0), (0, 1)]
    df = spark.createDataFrame(rows, "is_treatment int, bought_after_promo int")
    r = experiment.arm_summary(df).first()
    assert (r.n_treated, r.buyers_treated, r.n_control, r.buyers_control) == (3, 2, 2, 1)
    assert r.average_effect == 2 / 3 - 1 / 2
    r = experiment.arm_summary(df.filter("is_treatment = 1")).first()
    assert r.rate_control is None and r.average_effect is None


def test_matched_controls(spark):
    rows = (
        [(3, 10, 0, 1, 1)] * 3 + [(3, 10, 0, 1, 0)] + [(3, 10, 0, 0, 0)] * 2
        + [(2, 100, 5, 1, 1)] * 2 + [(2, 100, 9, 0, 1)]
        + [(1, 999, 0, 1, 1)] * 5 + [(0, 1, 1, 0, 1)]
    )
    df = spark.createDataFrame(
        rows,
        "customer_segment_code int, recency_days bigint, frequency_30d bigint, "
        "is_treatment int, bought_after_promo int",
    )
    r = experiment.matched_controls(df).first()
    assert (r.n_bins, r.n_treated_matched, r.n_treated_unmatched) == (2, 6, 5)
    assert r.matched_effect == round((4 * 0.75 + 2 * 0.0) / 6, 8)


def test_append_campaign(spark, products):
    facts = bought(spark, [("a", "P1", "2026-05-01T00:00:00")])
    log = spark.createDataFrame(
        [("C", "a", "X", 1, 1), ("C", "b", "X", 0, 1), ("C", "d", "X", 1, 0)],
        SCHEMAS["campaign"],
    )
    both = experiment.append_campaign(
        facts, log, offers(spark, [("X", "P1", START)]), products, "S2"
    )
    new = {r.customer_id: r for r in both.filter("store_id = 'S2'").collect()}
    assert both.count() == 3 and set(new) == {"a", "b"}
    assert (new["a"].price, new["a"].promotion_id) == (7.99, "X")
    assert (new["b"].price, new["b"].promotion_id) == (9.99, "")
    assert new["a"].datetime == dt(2026, 6, 3, 14) and new["b"].po_id == "PO_C_b"


def test_purchases_of_two_campaigns_are_two_baskets(spark, products):
    facts = bought(spark, [("a", "P1", "2026-05-01T00:00:00")])
    log = spark.createDataFrame(
        [("C1", "a", "X", 1, 1), ("C2", "a", "X", 1, 1)], SCHEMAS["campaign"]
    )
    both = experiment.append_campaign(
        facts, log, offers(spark, [("X", "P1", START)]), products, "S2"
    )
    people = spark.createDataFrame([("a", "x")], SCHEMAS["customers"])
    row = features.rfm_features(both, people, "2026-07-01").first()
    assert (row.total_visits, row.frequency_30d) == (3, 2)


def test_labels_with_many_promotions_and_a_hot_one(spark):
    """One category, 12,000 promotions, half of the log on one of them."""
    many = spark.range(12_000)
    products = many.select(
        F.concat(F.lit("P"), "id").alias("product_id"), F.lit("A").alias("product_taxonomies")
    )
    deals = many.select(
        F.concat(F.lit("X"), "id").alias("promotion_id"),
        F.concat(F.lit("P"), "id").alias("product_id"),
        F.date_add(F.lit(START), (F.col("id") % 300).cast("int")).alias("start_date"),
    )
    log = spark.range(3_000).select(
        F.lit("C").alias("campaign_id"),
        F.col("id").cast("string").alias("customer_id"),
        F.concat(F.lit("X"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))).alias(
            "promotion_id"
        ),
    )
    lines = spark.range(6_000).select(
        (F.lit(START).cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id % 320 as int))")).alias(
            "datetime"
        ),
        F.concat(F.lit("P"), F.col("id") % 12_000).alias("product_id"),
        (F.col("id") % 3_000).cast("string").alias("customer_id"),
    )
    got = experiment.response_label(log, deals, lines, products, days=7)
    assert got.columns == [*log.columns, "bought_after_promo"]
    rows = {int(r.customer_id): r.bought_after_promo for r in got.collect()}
    for i in range(3_000):
        start = 0 if i % 2 == 0 else i % 300
        days = {i % 320, (i + 3_000) % 320}
        assert rows[i] == int(any(start <= d < start + 7 for d in days))
    assert len(rows) == 3_000 and 0 < sum(rows.values()) < 3_000


def test_label_arguments_are_checked(spark, products):
    log = sent(spark, [("a", "X")])
    facts = bought(spark, [("a", "P1", "2026-06-02T00:00:00")])
    with pytest.raises(ValueError, match="products"):
        experiment.response_label(log, offers(spark, [("X", "P1", START)]), facts)
    undated = offers(spark, [("X", "P1", START)]).withColumn(
        "start_date", F.lit(None).cast("date")
    )
    assert labels(experiment.response_label(log, undated, facts, products)) == {("a", "X"): 0}


def test_promoted_products_filter_the_lines_below_the_orders(spark, small):
    retail = Retail(spark, small)
    df = experiment.response_label(
        retail.dispatch, retail.promotions, retail.transactions, match="product"
    )
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join LeftSemi") > text.index("l_orderkey")
