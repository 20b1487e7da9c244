"""Targeting policies and what they are worth, and the cumulative profit curve.

Each function takes the targeting rows of one promotion, so that customer ids are unique.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.operators import ranking
from counterfoil.operators.value import EXACT_PLACES, Terms

# Running sums may pass 64 bits.
WIDE = "decimal(19,0)"


def policy_report(rows: DataFrame, policies: Mapping[str, Column], terms: Terms) -> DataFrame:
    """Audience, revenue, profit and spend of each policy, one row per policy.

    All policies are conditional sums of one pass. The shares compare with promoting to
    everybody; the revenue share is null when that earns nothing.
    """
    discount = terms.price * terms.discount_rate

    def total(column: str, keep: Column) -> Column:
        return F.coalesce(E.exact_sum(F.col(column), EXACT_PLACES, keep), F.lit(0.0))

    def spend(keep: Column) -> Column:
        sent = F.count(F.when(keep, 1)) * terms.campaign_cost
        return E.round_half_even(sent + total("p_buy_treatment", keep) * discount, EXACT_PLACES)

    everybody = F.lit(True)
    parts = [
        F.struct(
            F.lit(name).alias("policy"),
            F.count(F.when(keep, 1)).alias("n_targeted"),
            total("expected_incremental_revenue", keep).alias("revenue"),
            total("expected_incremental_profit", keep).alias("profit"),
            spend(keep).alias("spend"),
        )
        for name, keep in policies.items()
    ]
    each = rows.agg(
        F.array(*parts).alias("__all"),
        total("expected_incremental_revenue", everybody).alias("uniform_revenue"),
        spend(everybody).alias("uniform_spend"),
    ).select(F.inline("__all"), "uniform_revenue", "uniform_spend")
    return each.select(
        "policy",
        "n_targeted",
        "revenue",
        "profit",
        "spend",
        F.when(
            F.col("uniform_revenue") > 0,
            (E.ratio(F.col("revenue"), F.col("uniform_revenue")) - 1) * 100,
        ).alias("revenue_uplift_pct"),
        ((1 - E.ratio(F.col("spend"), F.col("uniform_spend"))) * 100).alias("spend_saved_pct"),
    )


def top_uplift(rows: DataFrame, share: str = C.TOP_SHARE, cells: int | None = None) -> Column:
    """Condition for the customers in the top share by uplift, ties by id."""
    cut = ranking.top_share(rows, "uplift_score", "customer_id", share, cells)
    return cut.covers("uplift_score", "customer_id")


def top_share_list(
    rows: DataFrame, share: str = C.TOP_SHARE, cells: int | None = None
) -> DataFrame:
    """The customers of the top-share policy with their rank.

    The share is cut off first, so only its customers are shuffled for the rank.
    """
    cut = ranking.top_share(rows, "uplift_score", "customer_id", share, cells)
    chosen = rows.filter(cut.covers("uplift_score", "customer_id")).select(
        "customer_id", "customer_taxonomies", "uplift_score"
    )
    return ranking.running_totals(
        chosen, "uplift_score", "customer_id", cells=cells, rows=cut.position
    )


def profit_curve(rows: DataFrame, cells: int | None = None) -> DataFrame:
    """Cumulative revenue and profit in profit order, one row per customer."""
    total = rows.count()
    revenue = F.col("expected_incremental_revenue")
    profit = F.col("expected_incremental_profit")
    curve = ranking.running_totals(
        rows.select(
            "customer_id", "expected_incremental_revenue", "expected_incremental_profit"
        ),
        "expected_incremental_profit",
        "customer_id",
        {
            "revenue_units": E.to_units(revenue, EXACT_PLACES).cast(WIDE),
            "profit_units": E.to_units(profit, EXACT_PLACES).cast(WIDE),
        },
        cells=cells,
        rows=total,
    )
    return curve.select(
        "customer_id",
        "expected_incremental_revenue",
        "expected_incremental_profit",
        "n_pop",
        E.from_units(F.col("revenue_units"), EXACT_PLACES).alias("cum_revenue"),
        E.from_units(F.col("profit_units"), EXACT_PLACES).alias("cum_profit"),
        (F.col("n_pop").cast("double") / F.lit(float(total or 1)) * 100).alias("pct_population"),
    )


def best_cutoff(rows: DataFrame) -> DataFrame:
    """The smallest share of customers with the largest cumulative profit.

    In profit order the running sum rises exactly as long as profits are positive, so the
    cut lies after the last positive profit - or at the first customer, if there is none.
    That makes it one aggregation; the curve itself is not needed.
    """
    profit = F.col("expected_incremental_profit")
    units = E.to_units(profit, EXACT_PLACES)
    positive = units > 0
    sums = rows.agg(
        F.count(units).alias("n"),
        F.count(F.when(positive, 1)).alias("n_positive"),
        E.exact_sum(profit, EXACT_PLACES, positive).alias("gain"),
        E.from_units(F.max(units), EXACT_PLACES).alias("best"),
    ).filter(F.col("n") > 0)
    place = F.greatest(F.col("n_positive"), F.lit(1).cast("bigint"))
    return sums.select(
        place.alias("n_pop"),
        (place.cast("double") / F.col("n").cast("double") * 100).alias("pct_population"),
        F.coalesce("gain", "best").alias("max_profit"),
    )
