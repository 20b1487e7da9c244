"""Money: expected incremental revenue and profit, actions, what-if scenarios."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.sources.storage import local_table

# Decimals carried by what-if money: 4 (probability) + 2 (price) + 2 (rate).
EXACT_PLACES = 8


@dataclass(frozen=True)
class Terms:
    """Economics of one promotion."""

    promotion_id: str
    price: float
    cogs: float
    discount_rate: float
    campaign_cost: float = C.DEFAULT_CAMPAIGN_COST


def promotion_terms(
    promotions: DataFrame,
    products: DataFrame,
    promotion_ids: Sequence[str],
    campaign_cost: float = C.DEFAULT_CAMPAIGN_COST,
) -> list[Terms]:
    """Price, cost and discount of the named promotions, from the product table.

    At most one row per requested name comes back, so this is a lookup of parameters.
    """
    wanted = promotions.filter(F.col("promotion_id").isin(list(promotion_ids)))
    rows = (
        products.select("product_id", "price", "cogs")
        .join(wanted.select("promotion_id", "discount", "product_id"), "product_id")
        .limit(len(promotion_ids) + 1)
        .collect()
    )
    found = {r["promotion_id"]: r for r in rows}
    if len(rows) != len(found) or set(found) != set(promotion_ids):
        raise ValueError(f"need exactly one product for each of {list(promotion_ids)}")
    if any(not r["price"] for r in rows):
        raise ValueError("a promoted product needs a price")
    return [
        Terms(p, found[p]["price"], found[p]["cogs"], found[p]["discount"], campaign_cost)
        for p in promotion_ids
    ]


def value_scores(
    p_treatment: Column,
    uplift: Column,
    price: Column,
    discount_rate: Column,
    cogs_rate: Column,
    campaign_cost: Column,
) -> tuple[Column, Column]:
    """Expected incremental revenue and profit of promoting to one customer."""
    discount = price * discount_rate
    cogs = price * cogs_rate
    revenue = uplift * price - discount * p_treatment
    profit = uplift * (price - cogs) - discount * p_treatment - campaign_cost
    return revenue, profit


def promotion_values(scored: DataFrame, terms: Sequence[Terms]) -> DataFrame:
    """Unrounded value scores of every customer for each of the given promotions.

    The promotions are an array of constants; one pass over the customers values them all.
    """
    offers = F.array(
        *[
            F.struct(
                F.lit(t.promotion_id).alias("promotion_id"),
                F.lit(t.price).alias("price"),
                F.lit(t.discount_rate).alias("discount_rate"),
                F.lit(t.cogs / t.price).alias("cogs_rate"),
                F.lit(t.campaign_cost).alias("campaign_cost"),
            )
            for t in terms
        ]
    )
    each = scored.withColumn("__offer", F.explode(offers))
    eir, eip = value_scores(
        F.col("p_treatment"),
        F.col("uplift"),
        *[
            F.col(f"__offer.{name}")
            for name in ("price", "discount_rate", "cogs_rate", "campaign_cost")
        ],
    )
    return each.select(
        *scored.columns,
        F.col("__offer.promotion_id").alias("promotion_id"),
        eir.alias("eir"),
        eip.alias("eip"),
    )


def label_scores(valued: DataFrame) -> DataFrame:
    """Round the scores, then derive quadrant and action from the *rounded* columns."""
    probability, money = C.PROBABILITY_PLACES, C.MONEY_PLACES
    raw = ("p_treatment", "p_control", "uplift", "eir", "eip")
    rounded = valued.select(
        *[c for c in valued.columns if c not in raw],
        E.round_half_even(F.col("p_treatment"), probability).alias("p_buy_treatment"),
        E.round_half_even(F.col("p_control"), probability).alias("p_buy_control"),
        E.round_half_even(F.col("uplift"), probability).alias("uplift_score"),
        E.round_half_even(F.col("eir"), money).alias("expected_incremental_revenue"),
        E.round_half_even(F.col("eip"), money).alias("expected_incremental_profit"),
    )
    uplift = F.col("uplift_score")
    return rounded.withColumns(
        {
            "uplift_segment": E.quadrant(uplift, F.col("p_buy_control")),
            "recommended_action": E.action(uplift, F.col("expected_incremental_profit")),
        }
    )


TARGETING_COLUMNS = [
    "customer_id",
    "promotion_id",
    "customer_taxonomies",
    "recency_days",
    "total_spend",
    "p_buy_treatment",
    "p_buy_control",
    "uplift_score",
    "uplift_segment",
    "expected_incremental_revenue",
    "expected_incremental_profit",
    "recommended_action",
]


def targeting_rows(scored: DataFrame, terms: Sequence[Terms]) -> DataFrame:
    """The targeting list before sorting, one row per customer and promotion."""
    return label_scores(promotion_values(scored, terms)).select(*TARGETING_COLUMNS)


def profit_order() -> list[Column]:
    """By profit; the ids as last keys let the range sort split equal profits."""
    return [
        F.col("expected_incremental_profit").desc(),
        F.col("customer_id"),
        F.col("promotion_id"),
    ]


def by_profit(rows: DataFrame) -> DataFrame:
    return rows.orderBy(*profit_order())


def top_by_profit(rows: DataFrame, n: int = 100) -> DataFrame:
    return by_profit(rows).limit(n).select(
        "customer_id",
        "customer_taxonomies",
        "uplift_score",
        "expected_incremental_profit",
        "recommended_action",
    )


@dataclass(frozen=True)
class Scenario:
    """Campaign parameters to try on a saved targeting list."""

    scenario_id: int
    price: float
    discount_rate: float
    cogs: float
    campaign_cost: float = C.DEFAULT_CAMPAIGN_COST


def scenario_money(scenario: Scenario) -> tuple[Column, Column]:
    """Revenue and profit from the saved (rounded) probabilities; not rounded again."""
    uplift, p_treatment = F.col("uplift_score"), F.col("p_buy_treatment")
    discount = scenario.price * scenario.discount_rate
    revenue = uplift * scenario.price - discount * p_treatment
    profit = (
        uplift * (scenario.price - scenario.cogs)
        - discount * p_treatment
        - scenario.campaign_cost
    )
    return revenue, profit


def what_if(rows: DataFrame, scenario: Scenario) -> DataFrame:
    """The targeting list with revenue, profit and action recomputed for a scenario.

    Quadrants depend on probabilities only and stay as they are.
    """
    revenue, profit = scenario_money(scenario)
    return rows.withColumns(
        {
            "expected_incremental_revenue": revenue,
            "expected_incremental_profit": profit,
            "recommended_action": E.action(F.col("uplift_score"), profit),
        }
    )


def _sum_of(column: str, keep: Column | None = None) -> Column:
    return F.coalesce(E.exact_sum(F.col(column), C.PROBABILITY_PLACES, keep), F.lit(0.0))


def campaign_kpis(rows: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Uniform campaign against targeting, one row per scenario.

    Revenue, profit and spend are linear in uplift and probability. So one pass adds up these
    two, over everybody and over each scenario's targets, and the money of every scenario
    follows from the sums. No customer is copied per scenario; one row leaves each task.
    """
    targets = []
    for s in scenarios:
        _, profit = scenario_money(s)
        target = E.action(F.col("uplift_score"), profit) == C.TARGET
        targets.append(
            F.struct(
                F.count(F.when(target, 1)).alias("n_target"),
                _sum_of("uplift_score", target).alias("u_target"),
                _sum_of("p_buy_treatment", target).alias("p_target"),
            )
        )
    sums = rows.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count(F.when(F.col("uplift_score") < 0, 1)).alias("n_sleeping"),
        _sum_of("uplift_score").alias("u"),
        _sum_of("p_buy_treatment").alias("p"),
        F.array(*targets).alias("targets"),
    ).select("n_customers", "n_sleeping", "u", "p", F.posexplode("targets").alias("i", "t"))
    parameters = local_table(
        rows.sparkSession,
        [
            (
                i,
                s.scenario_id,
                float(s.price),
                float(s.discount_rate),
                float(s.cogs),
                float(s.campaign_cost),
                float(s.price * s.discount_rate),
                float(s.price - s.cogs),
            )
            for i, s in enumerate(scenarios)
        ],
        T.StructType.fromDDL(
            "i int, scenario_id int, price double, discount_rate double, cogs double, "
            "campaign_cost double, discount double, margin double"
        ),
    )

    def money(n: str, u: str, p: str) -> tuple[Column, Column, Column]:
        rebate = F.col(p) * F.col("discount")
        sending = F.col(n) * F.col("campaign_cost")
        amounts = (
            F.col(u) * F.col("price") - rebate,
            F.col(u) * F.col("margin") - rebate - sending,
            sending + rebate,
        )
        return tuple(E.round_half_even(amount, EXACT_PLACES) for amount in amounts)

    kinds = ("revenue", "profit", "spend")
    uniform = money("n_customers", "u", "p")
    optimized = money("t.n_target", "t.u_target", "t.p_target")
    each = sums.join(F.broadcast(parameters), "i").select(
        "*",
        "t.n_target",
        (F.col("n_customers") - F.col("t.n_target") - F.col("n_sleeping")).alias("n_skip"),
        *[column.alias(f"uniform_{kind}") for kind, column in zip(kinds, uniform)],
        *[column.alias(f"optimized_{kind}") for kind, column in zip(kinds, optimized)],
    )
    saved = F.col("uniform_spend") - F.col("optimized_spend")
    return each.select(
        "scenario_id",
        "price",
        "discount_rate",
        "cogs",
        "campaign_cost",
        "n_customers",
        "n_target",
        "n_sleeping",
        "n_skip",
        (F.col("n_sleeping") + F.col("n_skip")).alias("n_not_targeted"),
        "uniform_revenue",
        "uniform_profit",
        "uniform_spend",
        "optimized_revenue",
        "optimized_profit",
        "optimized_spend",
        (F.col("optimized_profit") - F.col("uniform_profit")).alias("profit_lift"),
        F.coalesce(
            (E.ratio(F.col("optimized_profit"), F.col("uniform_profit")) - 1) * 100, F.lit(0.0)
        ).alias("profit_lift_pct"),
        F.when(
            F.col("uniform_spend") > 0,
            (1 - E.ratio(F.col("optimized_spend"), F.col("uniform_spend"))) * 100,
        )
        .otherwise(0.0)
        .alias("waste_saved_pct"),
        saved.alias("spend_saved"),
    )
