"""Customer features as of a reference date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E


def reference_timestamp(reference: str) -> Column:
    return F.lit(datetime.fromisoformat(reference).isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(reference: str, days: int) -> Column:
    """A plan-time constant, so comparisons with it reach the scan."""
    moment = datetime.fromisoformat(reference) - timedelta(days=days)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def basket_totals(transactions: DataFrame, reference: str) -> DataFrame:
    """Lines before the reference date, added up per (customer, basket).

    This first level turns the two distinct basket counts of the features into plain counts.
    It is keyed by customer *and* basket, so a customer with a large share of all lines is
    spread over tasks.
    """
    moment = F.col("datetime")
    units = E.to_units(F.col("price") * F.col("qty"), E.REVENUE_PLACES)
    return (
        transactions.filter(
            F.col("customer_id").isNotNull() & (moment < reference_timestamp(reference))
        )
        .groupBy("customer_id", "po_id")
        .agg(
            F.max(moment).alias("last_purchase"),
            *E.sum_units(units, "revenue"),
            *E.sum_units(
                F.when(moment >= days_before(reference, C.MONETARY_DAYS), units), "recent"
            ),
            F.sum(F.col("qty").cast("bigint")).alias("items"),
            F.sum(E.has_promotion(F.col("promotion_id")).cast("bigint")).alias("promo_lines"),
            F.count(F.lit(1)).alias("lines"),
            F.max(moment >= days_before(reference, C.FREQUENCY_DAYS)).alias("visited"),
        )
    )


def customer_features(baskets: DataFrame, customers: DataFrame, reference: str) -> DataFrame:
    """One row per customer, also for those without history.

    The second level is a sum per customer with partial sums before its shuffle; the join
    with the customers then uses the same partitioning.
    """
    named = F.col("po_id").isNotNull()
    totals = (
        baskets.groupBy("customer_id")
        .agg(
            F.max("last_purchase").alias("last_purchase"),
            *E.sum_parts("revenue"),
            *E.sum_parts("recent"),
            F.count("po_id").alias("visits"),
            F.sum((named & F.col("visited")).cast("bigint")).alias("recent_visits"),
            F.sum("items").alias("items"),
            F.sum("promo_lines").alias("promo_lines"),
            F.sum("lines").alias("lines"),
        )
    )
    return customers.join(totals, "customer_id", "left").select(
        "customer_id", *finished(reference_timestamp(reference))
    )


def finished(reference: Column) -> list[Column]:
    """The feature columns after the id, from the sums of a customer's history before
    ``reference``; all sums are null without history."""
    zero = F.lit(0).cast("bigint")
    spend = E.from_parts("revenue", E.REVENUE_PLACES)
    return [
        F.col("customer_taxonomies"),
        F.coalesce(
            E.elapsed_days(F.col("last_purchase"), reference),
            F.lit(C.RECENCY_WITHOUT_HISTORY),
        )
        .cast("bigint")
        .alias("recency_days"),
        F.coalesce("recent_visits", zero).alias("frequency_30d"),
        F.coalesce(E.from_parts("recent", E.REVENUE_PLACES), F.lit(0.0)).alias("monetary_90d"),
        F.coalesce(spend, F.lit(0.0)).alias("total_spend"),
        F.coalesce("visits", zero).alias("total_visits"),
        F.coalesce("items", zero).alias("total_items"),
        F.coalesce(E.ratio(spend, F.col("visits")), F.lit(0.0)).alias("avg_basket_value"),
        F.coalesce(E.ratio(F.col("promo_lines"), F.col("lines")), F.lit(0.0)).alias(
            "promo_ratio"
        ),
        E.segment_code(F.col("customer_taxonomies")).alias("customer_segment_code"),
    ]


def rfm_features(transactions: DataFrame, customers: DataFrame, reference: str) -> DataFrame:
    return customer_features(basket_totals(transactions, reference), customers, reference)


def spend_parts(
    transactions: DataFrame, dimension: DataFrame, key: str, label: str, reference: str
) -> DataFrame:
    """Revenue per customer and label of a dimension, as exact parts; for ``spend_by``."""
    revenue = E.to_units(F.col("price") * F.col("qty"), E.REVENUE_PLACES)
    return (
        transactions.filter(
            F.col("customer_id").isNotNull()
            & (F.col("datetime") < reference_timestamp(reference))
        )
        .join(dimension.select(key, F.col(label).alias("label")), key, "left")
        .groupBy("customer_id", "label")
        .agg(*E.sum_units(revenue, "revenue"))
    )


#: Labels that one aggregation sums side by side (``spend_wide``), and that are pivoted from long
#: form at most (``spend_by``). Spend by still more labels stays long, as ``spend_parts`` has it.
MOST_LABELS, MOST_PIVOTED = 200, 10_000


class TooManyLabels(ValueError):
    """A dimension has more labels than a table should have columns."""


def label_names(labels: DataFrame, most: int = MOST_LABELS) -> list[str]:
    """The labels, one row each, that get a column."""
    rows = labels.filter(labels[0].isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise TooManyLabels(f"more than {most} labels of {labels.columns[0]}")
    return sorted(row[0] for row in rows)


def label_sums(units: Column, label: Column, names: Sequence[str]) -> list[Column]:
    """Exact sums per label, and over all lines whatever their label, of one aggregation."""
    each = [E.sum_units(F.when(label == name, units), f"spend{i}") for i, name in enumerate(names)]
    return [part for parts in (*each, E.sum_units(units, "spend")) for part in parts]


def label_parts(names: Sequence[str]) -> list[Column]:
    """Add up sums of ``label_sums`` once more."""
    each = [E.sum_parts(f"spend{i}") for i in range(len(names))]
    return [part for parts in (*each, E.sum_parts("spend")) for part in parts]


def spend_wide(sums: DataFrame, customers: DataFrame, names: Sequence[str]) -> DataFrame:
    """Spend per customer, one column per label, plus the total, from ``label_sums`` per customer."""
    spend = lambda name: F.coalesce(E.from_parts(name, E.REVENUE_PLACES), F.lit(0.0))
    return customers.select("customer_id").join(sums, "customer_id", "left").select(
        "customer_id",
        *[spend(f"spend{i}").alias(f"spend_{name}") for i, name in enumerate(names)],
        spend("spend").alias(f"spend_{TOTAL}"),
    )


TOTAL = "total"


def spend_by(parts: DataFrame, customers: DataFrame, labels: DataFrame) -> DataFrame:
    """Spend per customer, one column per label, plus the total.

    ``parts`` has (customer_id, label, revenue_high, revenue_low); a null label counts in the
    total only. ``labels`` has the labels that get a column, ``MOST_PIVOTED`` at most.
    """
    names = label_names(labels, MOST_PIVOTED)
    # The total is one more label, told apart by a prefix.
    tagged = F.concat(F.lit("="), F.col("label"))
    both = parts.withColumn("label", F.explode(F.array(tagged, F.lit(TOTAL)))).filter(
        F.col("label").isNotNull()
    )
    tags = [f"={n}" for n in names] + [TOTAL]
    wide = both.groupBy("customer_id").pivot("label", tags).agg(*E.sum_parts("revenue"))
    spend = wide.select(
        "customer_id",
        *[
            E.from_columns(
                F.col(f"`{tag}_revenue_high`"), F.col(f"`{tag}_revenue_low`"), E.REVENUE_PLACES
            ).alias(f"spend_{tag.removeprefix('=')}")
            for tag in tags
        ],
    )
    columns = spend.columns[1:]
    return customers.select("customer_id").join(spend, "customer_id", "left").select(
        "customer_id", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in columns]
    )
