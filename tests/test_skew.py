"""One key with a third of the rows or more: exact results, and no task that gets them all."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import features, joins
from counterfoil.sources.catalog import SCHEMAS
from counterfoil.sources.storage import store

N = 60_000
REF = "2026-06-01"


@pytest.fixture(scope="module")
def tables(spark):
    """Three lines in four are one customer's, on one product, without promotion; every third
    line is in one basket."""
    hot = F.col("id") % 4 != 0
    key = F.md5(F.col("id").cast("string").cast("binary"))
    lines = spark.range(N).select(
        F.lit(dt(2026, 5, 20)).cast("timestamp_ntz").alias("datetime"),
        F.when(hot, "P1").otherwise(F.concat(F.lit("P"), F.col("id") % 400)).alias("product_id"),
        (F.pmod(F.xxhash64("id"), F.lit(99_999)) / 100).alias("price"),
        F.lit(2).alias("qty"),
        F.when(hot, "0").otherwise((F.col("id") % 3000).cast("string")).alias("customer_id"),
        F.when(hot, "").otherwise("X").alias("promotion_id"),
        F.lit("S1").alias("store_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(key).alias("po_id"),
    )
    people = spark.range(3000).select(
        F.col("id").cast("string").alias("customer_id"),
        F.when(F.col("id") % 2 == 0, "Occasional").otherwise("High Value").alias(
            "customer_taxonomies"
        ),
    )
    products = spark.range(400).select(
        F.concat(F.lit("P"), F.col("id")).alias("product_id"),
        (F.col("id") + 1.0).alias("price"),
        F.lit(1.0).alias("cogs"),
        (F.col("id") % 5).cast("string").alias("product_taxonomies"),
    )
    stores = spark.createDataFrame([("S1", "Mini")], SCHEMAS["stores"])
    promotions = spark.createDataFrame(
        [("X", 0.1, "P1", dt(2026, 6, 1).date(), dt(2026, 6, 7).date())], SCHEMAS["promotions"]
    )
    return {
        "lines": store(lines.repartition(8), "lines"),
        "people": store(people, "people"),
        "products": store(products, "products"),
        "stores": stores,
        "promotions": promotions,
    }


@pytest.fixture
def splitting(spark):
    """Run-time skew splitting at a size a test can reach; no side of a join is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df._jdf.queryExecution().executedPlan().executeCollect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_splits_the_hot_customer(tables, splitting):
    joined = joins.star_join(
        tables["lines"], tables["people"], tables["promotions"], tables["products"],
        tables["stores"],
    )
    assert joined.count() == N
    assert joined.filter("customer_id = '0'").count() >= N * 3 // 4
    assert joined.filter("customer_taxonomies is null or store_taxonomies is null").count() == 0
    assert "skew=true" in final_plan(joined)


def test_features_of_the_hot_customer(tables):
    found = features.rfm_features(tables["lines"], tables["people"], REF)
    hot = found.filter("customer_id = '0'").first()
    mine = tables["lines"].filter("customer_id = '0'").agg(
        F.countDistinct("po_id").alias("visits"),
        F.count(F.lit(1)).alias("lines"),
        F.sum((F.col("price") * F.col("qty")).cast("decimal(18,4)")).alias("spend"),
        F.sum(F.when(F.col("promotion_id") != "", 1)).alias("promo"),
    ).first()
    assert hot.total_visits == mine.visits and hot.total_items == 2 * mine.lines
    assert hot.total_spend == float(mine.spend)
    assert hot.promo_ratio == mine.promo / mine.lines


def test_hot_basket_is_added_up_before_the_shuffle(spark, tables):
    """The hot basket leaves each input task as one row."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = features.basket_totals(tables["lines"], REF)._jdf.queryExecution().executedPlan()
        text = plan.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("partial_sum")


def test_spend_by_splits_the_hot_product(tables, splitting):
    label = "product_taxonomies"
    parts = features.spend_parts(tables["lines"], tables["products"], "product_id", label, REF)
    found = features.spend_by(
        parts, tables["people"], tables["products"].select(label).distinct()
    )
    total = found.agg(F.sum(F.col("spend_total").cast("decimal(20,4)"))).first()[0]
    want = tables["lines"].agg(F.sum((F.col("price") * 2).cast("decimal(20,4)"))).first()[0]
    assert total == want
    assert "skew=true" in final_plan(found)
