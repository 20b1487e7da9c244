"""The retail tables seen through an order-entry star schema stored as Parquet.

Lines and orders play the transactions, parts the products, suppliers the stores. Schemas
are declared, so opening a table starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.operators import asof, experiment, features

FILES: dict[str, str] = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

# Fixed values of the binding.
REFERENCE_DATE = "2001-01-01"
CAMPAIGN_DAYS = 90
CAMPAIGN_ID = "CAMP_01"
PROMOTION_ID = "PROM_001"
PAST_PROMOTION = "PROM_HIST"
PROMO_DISCOUNT_ABOVE = 0.085
COGS_SHARE = 0.60
SEGMENTS = {
    "AUTOMOBILE": "High Value",
    "BUILDING": "Frequent Shopper",
    "FURNITURE": "Price Sensitive",
    "HOUSEHOLD": "Occasional",
}
# campaign -> (promotion, start); an earlier campaign in the same log
CAMPAIGNS = {
    "CAMP_00": ("PROM_002", "2000-07-01"),
    CAMPAIGN_ID: (PROMOTION_ID, REFERENCE_DATE),
}
# promotion -> (product key, discount)
PROMOTIONS = {
    "PROM_001": (1, 0.20),
    "PROM_002": (12, 0.15),
    "PROM_003": (25, 0.10),
    "PROM_004": (35, 0.25),
}


def _paid_price() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")


def _promotion() -> Column:
    return F.when(F.col("l_discount") > PROMO_DISCOUNT_ABOVE, PAST_PROMOTION).otherwise("")


@dataclass(frozen=True)
class Retail:
    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(FILES[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        renamed = segment
        for market, name in SEGMENTS.items():
            renamed = F.when(segment == market, name).otherwise(renamed)
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), renamed.alias("customer_taxonomies")
        )

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_retailprice").alias("price"),
            (F.lit(COGS_SHARE) * F.col("p_retailprice")).alias("cogs"),
            F.col("p_type").alias("product_taxonomies"),
        )

    @property
    def stores(self) -> DataFrame:
        return (
            self.raw("supplier")
            .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("store_id"), F.col("n_name").alias("store_taxonomies")
            )
        )

    @property
    def promotions(self) -> DataFrame:
        """One row per promoted part."""
        key = F.col("p_partkey")
        name = discount = F.lit(None)
        for promotion, (part, rate) in PROMOTIONS.items():
            name = F.when(key == part, promotion).otherwise(name)
            discount = F.when(key == part, rate).otherwise(discount)
        start = F.lit(REFERENCE_DATE).cast("date")
        return (
            self.raw("part")
            .filter(key.isin([part for part, _ in PROMOTIONS.values()]))
            .select(
                name.alias("promotion_id"),
                discount.alias("discount"),
                key.alias("product_id"),
                start.alias("start_date"),
                F.date_add(start, CAMPAIGN_DAYS - 1).alias("end_date"),
            )
            .limit(len(PROMOTIONS))  # part keys are unique; tells Spark how few these are
        )

    @property
    def transactions(self) -> DataFrame:
        """One row per line. Both sides are large and meet on the order key."""
        return (
            self.raw("lineitem")
            .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_orderdate").alias("datetime"),
                F.col("l_partkey").alias("product_id"),
                _paid_price().alias("price"),
                F.col("l_quantity").cast("int").alias("qty"),
                F.col("o_custkey").alias("customer_id"),
                _promotion().alias("promotion_id"),
                F.col("l_suppkey").alias("store_id"),
                F.col("l_orderkey").alias("po_id"),
            )
        )

    @property
    def shipments(self) -> DataFrame:
        """One row per line at the time it was shipped; the lines of an order part."""
        return (
            self.raw("lineitem")
            .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_shipdate").alias("datetime"),
                _paid_price().alias("price"),
                F.col("l_quantity").cast("int").alias("qty"),
                F.col("o_custkey").alias("customer_id"),
                _promotion().alias("promotion_id"),
                F.col("l_orderkey").alias("po_id"),
            )
        )

    @property
    def visits(self) -> DataFrame:
        """Who bought when; needs the order heads only."""
        return self.raw("orders").select(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("datetime")
        )

    def spend_parts(self, dimension: DataFrame, line_key: str, key: str, label: str) -> DataFrame:
        """Revenue per customer and label, with the lines added up per order and label before
        they meet the orders; for ``features.spend_by``."""
        revenue = E.to_units(_paid_price() * F.col("l_quantity"), E.REVENUE_PLACES)
        per_order = (
            self.raw("lineitem")
            .withColumnRenamed(line_key, key)
            .join(dimension.select(key, F.col(label).alias("label")), key, "left")
            .groupBy("l_orderkey", "label")
            .agg(*E.sum_units(revenue, "revenue"))
        )
        return (
            self.raw("orders")
            .filter(F.col("o_orderdate") < features.reference_timestamp(REFERENCE_DATE))
            .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("customer_id"), "label")
            .agg(*E.sum_parts("revenue"))
        )

    def spend_sums(
        self, dimension: DataFrame, line_key: str, key: str, label: str, names: Sequence[str]
    ) -> DataFrame:
        """Spend per customer as one pair of sums per label; for ``features.spend_wide``.

        The lines are added up per order first, all labels in one row, so they are shuffled by the
        order only, already added up by task, and meet the orders where they are.
        """
        revenue = E.to_units(_paid_price() * F.col("l_quantity"), E.REVENUE_PLACES)
        per_order = (
            self.raw("lineitem")
            .withColumnRenamed(line_key, key)
            .join(dimension.select(key, F.col(label).alias("label")), key, "left")
            .groupBy("l_orderkey")
            .agg(*features.label_sums(revenue, F.col("label"), names))
        )
        return (
            self.raw("orders")
            .filter(F.col("o_orderdate") < features.reference_timestamp(REFERENCE_DATE))
            .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(*features.label_parts(names))
        )

    def _per_order(self, lines: DataFrame) -> DataFrame:
        units = E.to_units(_paid_price() * F.col("l_quantity"), E.REVENUE_PLACES)
        return lines.groupBy("l_orderkey").agg(
            *E.sum_units(units, "revenue"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("items"),
            F.sum(E.has_promotion(_promotion()).cast("bigint")).alias("promo_lines"),
            F.count(F.lit(1)).alias("lines"),
        )

    def baskets(
        self, reference: str = REFERENCE_DATE, customers: DataFrame | None = None
    ) -> DataFrame:
        """Basket totals, with the lines added up per order *before* they meet the orders.

        The shuffle carries one row per order and map task instead of one per line, an order
        holding most lines shrinks to one row per task, and the join is one to one. Given
        customers restrict the orders, and these the lines, before anything is added up.
        """
        orders, lines = self.raw("orders"), self.raw("lineitem")
        if customers is not None:
            wanted = customers.select(F.col("customer_id").alias("o_custkey"))
            orders = orders.join(wanted, "o_custkey", "left_semi")
            keys = orders.select(F.col("o_orderkey").alias("l_orderkey"))
            lines = lines.join(keys, "l_orderkey", "left_semi")
        per_order = self._per_order(lines)
        ref = features.reference_timestamp(reference)
        date = F.col("o_orderdate")
        paid_lately = date >= features.days_before(reference, C.MONETARY_DAYS)
        return (
            orders.filter(date < ref)
            .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("customer_id"),
                F.col("o_orderkey").alias("po_id"),
                date.alias("last_purchase"),
                "revenue_high",
                "revenue_low",
                F.when(paid_lately, F.col("revenue_high")).alias("recent_high"),
                F.when(paid_lately, F.col("revenue_low")).alias("recent_low"),
                "items",
                "promo_lines",
                "lines",
                (date >= features.days_before(reference, C.FREQUENCY_DAYS)).alias("visited"),
            )
        )

    def day_buckets(self, before: date) -> DataFrame:
        """Customer days up to a date; an order lies on one day, so no basket is chained."""
        orders = self.raw("orders").filter(
            F.col("o_orderdate") < features.reference_timestamp(before.isoformat())
        )
        baskets = orders.join(
            self._per_order(self.raw("lineitem")), F.col("l_orderkey") == F.col("o_orderkey")
        ).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderkey").alias("po_id"),
            F.col("o_orderdate").alias("last_purchase"),
            *asof.SUMS,
        )
        return asof.day_buckets(
            asof.single_day_baskets(baskets.filter(F.col("customer_id").isNotNull()))
        )

    @property
    def features(self) -> DataFrame:
        return features.customer_features(self.baskets(), self.customers, REFERENCE_DATE)

    def features_of(self, customers: DataFrame) -> DataFrame:
        """Features of some customers only."""
        few = customers.select("customer_id")
        return features.customer_features(
            self.baskets(customers=few), customers, REFERENCE_DATE
        )

    @property
    def dispatch(self) -> DataFrame:
        """The pilot campaign without its label: every customer, one promotion, hashed arms."""
        return experiment.assign_arms(self.customers, CAMPAIGN_ID).select(
            F.lit(CAMPAIGN_ID).alias("campaign_id"),
            "customer_id",
            F.lit(PROMOTION_ID).alias("promotion_id"),
            "is_treatment",
        )

    @property
    def campaign(self) -> DataFrame:
        """The pilot campaign; the label is any order in the campaign window."""
        return experiment.response_label(
            self.dispatch, self.promotions, self.visits, days=CAMPAIGN_DAYS, match="any"
        )

    @property
    def several_campaigns(self) -> DataFrame:
        """The logs of all ``CAMPAIGNS`` without labels, each row with its campaign's start."""
        logs = [
            experiment.assign_arms(self.customers, campaign).select(
                F.lit(campaign).alias("campaign_id"),
                "customer_id",
                F.lit(promotion).alias("promotion_id"),
                "is_treatment",
            )
            for campaign, (promotion, _) in CAMPAIGNS.items()
        ]
        return asof.with_start(reduce(DataFrame.unionByName, logs), self.dated_promotions)

    @property
    def dated_promotions(self) -> DataFrame:
        """The promotions with the starts of ``CAMPAIGNS``."""
        start = F.col("start_date")
        for promotion, first in CAMPAIGNS.values():
            start = F.when(F.col("promotion_id") == promotion, F.lit(first).cast("date")).otherwise(
                start
            )
        return self.promotions.withColumn("start_date", start)

    @property
    def purchases_subday(self) -> DataFrame:
        """Purchase events: transactions that carry a time of day."""
        return (
            self.raw("events")
            .filter(F.col("event_type") == "purchase")
            .select(
                F.col("ts").alias("datetime"),
                F.col("value").alias("price"),
                F.lit(1).alias("qty"),
                F.col("user_id").alias("customer_id"),
                F.lit("").alias("promotion_id"),
                F.col("event_id").alias("po_id"),
            )
        )
