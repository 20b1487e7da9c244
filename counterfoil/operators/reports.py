"""Counts, segment summaries and the feature profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import expressions as E
from counterfoil.operators import ranking
from counterfoil.operators.value import EXACT_PLACES


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .orderBy(F.desc("n_customers"), column)
    )


def segment_means(rows: DataFrame) -> DataFrame:
    """Mean uplift and profit per customer segment."""
    n = F.count(F.lit(1))
    return rows.groupBy("customer_taxonomies").agg(
        n.alias("n_customers"),
        E.ratio(E.exact_sum(F.col("uplift_score"), EXACT_PLACES), n).alias("mean_uplift"),
        E.ratio(E.exact_sum(F.col("expected_incremental_profit"), EXACT_PLACES), n).alias("mean_profit"),
    )


def segment_profit(rows: DataFrame) -> DataFrame:
    return rows.groupBy("customer_taxonomies").agg(
        E.exact_sum(F.col("expected_incremental_profit"), EXACT_PLACES).alias("total_profit")
    )


def quadrant_confusion(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Customers per true and predicted quadrant."""
    return (
        rows.select("customer_id", "uplift_segment")
        .join(truth.select("customer_id", "true_uplift_segment"), "customer_id")
        .groupBy("true_uplift_segment", F.col("uplift_segment").alias("predicted_uplift_segment"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )


QUARTILES = (1, 2, 3)


def feature_profile(
    features: DataFrame,
    columns: list[str],
    id_column: str = "customer_id",
    cells: int | None = None,
) -> DataFrame:
    """Count, mean, deviation, range and exact quartiles of each column, one row per column.

    An exact percentile aggregate would hold every distinct value in one task. Here the rows
    on both sides of each quartile are located by counting, then interpolated.
    """
    long = features.select(
        id_column, *[F.col(c).cast("double").alias(c) for c in columns]
    ).unpivot(id_column, columns, "feature", "value")

    def neighbours(total: int) -> list[int]:
        places = []
        for q in QUARTILES:
            low, rest = divmod((total - 1) * q, 4)
            places += [low + 1, low + 1 + (rest > 0)]
        return places

    found = ranking.rank_cuts(
        long, "value", id_column, neighbours, groups=["feature"], descending=False, cells=cells
    )

    def quartile(column: str, index: int, n: Column) -> Column:
        cuts = found.get((column,))
        if not cuts:
            return F.lit(None).cast("double")
        low, high = cuts[2 * index].score, cuts[2 * index + 1].score
        weight = ((n - 1) * QUARTILES[index] % 4) / F.lit(4.0)
        return F.lit(low) + F.lit(high - low) * weight

    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        n = F.count(value)
        parts.append(
            F.struct(
                F.lit(c).alias("feature"),
                n.alias("n"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                *[
                    quartile(c, i, n).alias(f"q{25 * q}")
                    for i, q in enumerate(QUARTILES)
                ],
                F.max(value).alias("max"),
            )
        )
    return features.agg(F.array(*parts).alias("__all")).select(F.inline("__all"))
