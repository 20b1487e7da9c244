"""Joins of the fact table with its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import expressions as E
from counterfoil.operators import features
from counterfoil.sources.storage import small_side


def star_join(
    transactions: DataFrame,
    customers: DataFrame,
    promotions: DataFrame,
    products: DataFrame,
    stores: DataFrame,
) -> DataFrame:
    """Every line with customer, promotion, product and store columns; no line is lost.

    Promotions and stores are broadcast if their estimated bytes are few, customers and products
    are left to Spark. Most lines carry
    no promotion; they get a key of their order instead of sharing one, so that they spread
    where the promotions are too many to be broadcast. Other skew is split at run time.
    """
    offers = promotions.select(
        F.col("promotion_id").alias("__offer"), "discount", "start_date", "end_date"
    )
    none = F.concat(F.lit("\0"), F.xxhash64("po_id").cast("string"))
    named = E.has_promotion(F.col("promotion_id")) == 1
    return (
        transactions.join(customers, "customer_id", "left")
        .withColumn("__key", F.when(named, F.col("promotion_id")).otherwise(none))
        .join(small_side(offers), F.col("__key") == F.col("__offer"), "left")
        .join(
            products.select(
                "product_id", "product_taxonomies", F.col("price").alias("product_price")
            ),
            "product_id",
            "left",
        )
        .join(small_side(stores), "store_id", "left")
        .select(
            *transactions.columns,
            "customer_taxonomies",
            "discount",
            "start_date",
            "end_date",
            "product_taxonomies",
            "product_price",
            "store_taxonomies",
        )
    )


def discount_depth(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """1 - paid / list price of each line; null without a list price."""
    listed = products.select("product_id", F.col("price").alias("list_price"))
    return transactions.join(listed, "product_id", "left").select(
        "po_id",
        "product_id",
        "promotion_id",
        F.col("price").alias("paid_price"),
        "list_price",
        (1 - E.ratio(F.col("price"), F.col("list_price"))).alias("discount_depth"),
    )


def category_buyers(
    customers: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
    category: str,
    reference: str,
) -> DataFrame:
    """Customers with a purchase of the category before the reference date."""
    wanted = products.filter(F.col("product_taxonomies") == category).select("product_id")
    buyers = (
        transactions.filter(F.col("datetime") < features.reference_timestamp(reference))
        .join(wanted, "product_id", "left_semi")
        .select("customer_id")
        .distinct()
    )
    return customers.join(buyers, "customer_id", "left_semi")
