from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import features
from counterfoil.sources.binding import Retail
from counterfoil.sources.catalog import SCHEMAS

REF = "2026-06-01"


def line(customer, when, price=10.0, qty=1, promotion="", po="a", store="S1", product="P1"):
    return (dt.fromisoformat(when), product, price, qty, customer, promotion, store, po)


@pytest.fixture(scope="module")
def table(spark):
    lines = [
        line("late", "2026-05-31T23:00:00"),
        line("edge30", "2026-05-02T00:00:00", po="e1"),
        line("edge30", "2026-05-01T23:59:59", po="e2"),
        line("edge90", "2026-03-03T00:00:00", 5.0, 2),
        line("edge90", "2026-03-02T23:59:59", 100.0),
        line("future", "2026-06-01T00:00:00"),
        line("basket", "2026-05-20T10:00:00", po="b1"),
        line("basket", "2026-05-20T10:00:00", 2.5, 4, po="b1"),
        line("promo", "2026-05-20T10:00:00", promotion="X", po="p1"),
        line("promo", "2026-05-20T10:00:00", promotion=None, po="p2"),
        line("promo", "2026-05-20T10:00:00", promotion="", po="p3"),
        line("promo", "2026-05-20T10:00:00", promotion="Y", po="p4"),
        line("nopo", "2026-05-20T10:00:00", po=None),
        line(None, "2026-05-20T10:00:00"),
    ]
    customers = ["late", "edge30", "edge90", "future", "basket", "promo", "nopo", "new"]
    people = spark.createDataFrame([(c, "Other") for c in customers], SCHEMAS["customers"])
    rows = spark.createDataFrame(lines, SCHEMAS["transactions"])
    found = features.rfm_features(rows, people, REF)
    return {r.customer_id: r for r in found.collect()}


def test_one_row_per_customer(table):
    assert len(table) == 8 and None not in table


def test_recency_counts_whole_elapsed_days(table):
    assert table["late"].recency_days == 0
    assert table["edge30"].recency_days == 30


def test_window_edges(table):
    assert table["edge30"].frequency_30d == 1 and table["edge30"].total_visits == 2
    assert table["edge90"].monetary_90d == 10.0 and table["edge90"].total_spend == 110.0


def test_reference_moment_is_excluded_and_defaults(table):
    for name in ("future", "new"):
        r = table[name]
        assert r.recency_days == 180
        assert (r.frequency_30d, r.total_visits, r.total_items) == (0, 0, 0)
        assert (r.monetary_90d, r.total_spend, r.avg_basket_value, r.promo_ratio) == (0, 0, 0, 0)


def test_lines_of_one_basket_are_one_visit(table):
    r = table["basket"]
    assert (r.frequency_30d, r.total_visits, r.total_items) == (1, 1, 5)
    assert r.avg_basket_value == 20.0


def test_promo_ratio(table):
    assert table["promo"].promo_ratio == 0.5


def test_lines_without_basket_id_count_as_spend_only(table):
    r = table["nopo"]
    assert (r.total_visits, r.total_spend, r.avg_basket_value) == (0, 10.0, 0.0)


def test_unknown_segment(table):
    assert {r.customer_segment_code for r in table.values()} == {-1}


def test_history_of_one_customer_is_not_gathered_in_one_task(spark):
    """Half of all lines belong to one customer; the totals stay exact."""
    rows = spark.range(20_000).select(
        F.lit(dt(2026, 5, 1)).cast("timestamp_ntz").alias("datetime"),
        F.lit("P").alias("product_id"),
        F.lit(0.1).alias("price"),
        F.lit(1).alias("qty"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("string").alias(
            "customer_id"
        ),
        F.lit("").alias("promotion_id"),
        F.lit("S").alias("store_id"),
        F.col("id").cast("string").alias("po_id"),
    )
    people = spark.createDataFrame([("0", "Occasional")], SCHEMAS["customers"])
    r = features.rfm_features(rows, people, REF).first()
    assert (r.total_visits, r.total_spend) == (10_000, 1000.0)
    plan = features.basket_totals(rows, REF)._jdf.queryExecution().toString()
    assert "hashpartitioning(customer_id" in plan and "po_id" in plan


def test_row_order_and_partitioning_do_not_matter(spark, small):
    retail = Retail(spark, small)
    lines, people = retail.transactions, retail.customers
    want = sorted(features.rfm_features(lines, people, "2001-01-01").collect())
    for parts, key in ((1, F.rand(1)), (13, F.rand(2))):
        mixed = lines.repartition(parts, key).sortWithinPartitions(F.rand(3))
        assert sorted(features.rfm_features(mixed, people, "2001-01-01").collect()) == want
    assert sorted(retail.features.collect()) == want


def test_spend_by_keeps_unmatched_lines_in_the_total(spark):
    rows = spark.createDataFrame(
        [
            line("c", "2026-05-01T00:00:00", 1.5, 2, product="P1"),
            line("c", "2026-05-01T00:00:00", 2.0, product="P2"),
            line("c", "2026-05-01T00:00:00", 4.0, product="P9"),
        ],
        SCHEMAS["transactions"],
    )
    products = spark.createDataFrame(
        [("P1", 1.0, 1.0, "A"), ("P2", 1.0, 1.0, "B b")], SCHEMAS["products"]
    )
    people = spark.createDataFrame([("c", "x"), ("d", "x")], SCHEMAS["customers"])
    parts = features.spend_parts(rows, products, "product_id", "product_taxonomies", REF)
    labels = products.select("product_taxonomies")
    found = features.spend_by(parts, people, labels).orderBy("customer_id")
    assert [tuple(r) for r in found.collect()] == [("c", 3.0, 2.0, 9.0), ("d", 0.0, 0.0, 0.0)]


def test_spend_by_more_labels_than_a_thousand(spark):
    rows = spark.createDataFrame(
        [line("c", "2026-05-01T00:00:00", 1.5, 2, product=f"P{i}") for i in range(0, 1200, 7)],
        SCHEMAS["transactions"],
    )
    products = spark.createDataFrame(
        [(f"P{i}", 1.0, 1.0, f"L{i:04}") for i in range(1200)], SCHEMAS["products"]
    )
    people = spark.createDataFrame([("c", "x")], SCHEMAS["customers"])
    parts = features.spend_parts(rows, products, "product_id", "product_taxonomies", REF)
    row = features.spend_by(parts, people, products.select("product_taxonomies")).first()
    assert len(row) == 1202 and row.spend_total == 3.0 * 172
    assert row.spend_L0007 == 3.0 and row.spend_L0008 == 0.0


def test_pivots_shuffle_lines_once_and_orders_once(spark, small):
    retail = Retail(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = retail.spend_parts(
            retail.products, "l_partkey", "product_id", "product_taxonomies"
        )
        text = parts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # raw lines by product, and products
    assert text.count("Exchange hashpartitioning(product_id") == 2
    # each further exchange carries partial sums
    assert text.count("functions=[partial_sum") == 2 and "partial_sum(shiftright" in text


def test_labels_beyond_the_limit_are_refused(spark):
    labels = spark.createDataFrame([(f"l{i}",) for i in range(5)] + [(None,), ("l1",)], "label string")
    assert features.label_names(labels) == [f"l{i}" for i in range(5)]
    with pytest.raises(features.TooManyLabels, match="more than 4"):
        features.label_names(labels, 4)
