"""One promotion per customer at most, for the most profit within a budget.

At a price of money m every customer takes, on their own, the promotion of the largest
profit - m * spend, or none if that is not positive. The dearer money is, the less is spent, so the
lowest price at which the budget holds is found by dividing a range of prices: one pass over the
customers adds up the spend at many prices, each pass narrows the range by that factor. The
assignment at that price is a narrow map.

Customers who would take more at the next lower price are at the margin: they are upgraded in the
order of their ids while the budget lasts. What is left unspent is less than one upgrade.

Money is in whole cents and prices are whole multiples of 1 / ``GRID``, so all comparisons are
exact and do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.operators import ranking
from counterfoil.operators.value import Terms, value_scores
from counterfoil.sources.storage import store

#: Steps of the price of money: 1 / GRID of a cent of profit for a cent spent.
GRID = 1 << 20
#: Prices that one pass tries.
TRIED = 32


def offers(rows: DataFrame, terms: Sequence[Terms], customer: str = "customer_id") -> DataFrame:
    """(customer, ``offers``): each promotion's profit and spend in cents, for scored customers.

    The promotions are constants of the plan, so this is a narrow map: no customer is copied per
    promotion. Promotions that earn nothing are left out.
    """
    each = []
    for t in sorted(terms, key=lambda t: t.promotion_id):
        _, profit = value_scores(
            F.col("p_treatment"),
            F.col("uplift"),
            F.lit(t.price),
            F.lit(t.discount_rate),
            F.lit(t.cogs / t.price),
            F.lit(t.campaign_cost),
        )
        spend = F.lit(t.campaign_cost) + F.lit(t.price * t.discount_rate) * F.col("p_treatment")
        each.append(
            F.struct(
                F.lit(t.promotion_id).alias("promotion_id"),
                E.to_units(profit, C.MONEY_PLACES).alias("profit"),
                E.to_units(spend, C.MONEY_PLACES).alias("spend"),
            )
        )
    listed = F.filter(F.array(*each), lambda o: o["profit"] > 0)
    return rows.filter(F.col(customer).isNotNull()).select(F.col(customer), listed.alias("offers"))


def choice(price: Column) -> Column:
    """The offer taken at ``price`` / GRID, null for none; of equally good ones the cheapest, then
    the smallest id."""
    worth = F.transform(
        "offers",
        lambda o: F.struct(
            (o["profit"] * F.lit(GRID) - o["spend"] * price).alias("worth"),
            (-o["spend"]).alias("cheap"),
            o["promotion_id"].alias("promotion_id"),
            o["profit"].alias("profit"),
            o["spend"].alias("spend"),
        ),
    )
    better = lambda a, b: F.when(
        a.isNull()
        | (b["worth"] > a["worth"])
        | ((b["worth"] == a["worth"]) & (b["cheap"] > a["cheap"])),
        b,
    ).otherwise(a)
    good = F.filter(worth, lambda o: o["worth"] > 0)
    return F.reduce(good, F.get(good, F.lit(0)), better)


def _spent(people: DataFrame, prices: Sequence[int]) -> list[int]:
    """Total spend at each price, in one pass."""
    tried = F.array(*[F.lit(p).cast("bigint") for p in prices])
    each = people.select(F.transform(tried, lambda p: choice(p)["spend"]).alias("spends"))
    sums = [F.sum(F.get("spends", F.lit(i))) for i in range(len(prices))]
    row = each.agg(*[F.coalesce(s, F.lit(0)).alias(f"s{i}") for i, s in enumerate(sums)])
    return list(row.first())


def price_of_money(people: DataFrame, budget: int) -> tuple[int, int]:
    """The lowest price (in steps of 1 / GRID) at which the budget holds, and the spend there."""
    (free,) = _spent(people, [0])
    if free <= budget:
        return 0, free
    dear = people.select(
        F.array_max(
            F.transform("offers", lambda o: E.ratio(o["profit"], F.greatest(o["spend"], F.lit(1))))
        ).alias("ratio")
    ).agg(F.max("ratio")).first()[0]
    # Above this price nobody takes anything that costs money.
    low, high, spent = 0, int(dear * GRID) + 2, 0
    while high - low > 1:
        tries = sorted({low + (high - low) * i // (TRIED + 1) for i in range(1, TRIED + 1)} - {low})
        for price, total in zip(tries, _spent(people, tries), strict=True):
            if total <= budget:
                high, spent = price, total
                break
            low = price
    return high, spent


def allocate(people: DataFrame, budget: int, customer: str = "customer_id") -> DataFrame:
    """(customer, promotion_id, profit, spend) of those who get a promotion, in cents.

    ``people`` has the customer and ``offers``, each customer once; it is read about ten times, so
    pass a stored table. The spend never exceeds ``budget`` cents, where offers cost something;
    offers that cost nothing are always taken.
    """
    price, spent = price_of_money(people, budget)
    taken = people.select(
        customer, choice(F.lit(price)).alias("offer"), choice(F.lit(max(price - 1, 0))).alias("more")
    )
    chosen = ["promotion_id", "profit", "spend"]
    extra = F.coalesce(F.col("more.spend"), F.lit(0)) - F.coalesce(F.col("offer.spend"), F.lit(0))
    if price:
        marginal = store(
            taken.filter(extra > 0).select(customer, extra.alias("extra"), "more"), "marginal"
        )
        upgraded = ranking.running_totals(
            marginal.withColumn("__same", F.lit(0.0)), "__same", customer, {"upto": F.col("extra")}
        ).filter(F.col("upto") <= budget - spent)
        better = upgraded.select(customer, F.col("more").alias("upgrade"))
        taken = taken.join(better, customer, "left")
        offer = F.coalesce("upgrade", "offer")
    else:
        offer = F.col("offer")
    return taken.select(customer, offer.alias("offer")).filter(F.col("offer").isNotNull()).select(
        customer, *[F.col(f"offer.{c}").alias(c) for c in chosen]
    )


def summary(allocated: DataFrame) -> DataFrame:
    """Customers, profit and spend per promotion."""
    return allocated.groupBy("promotion_id").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("profit").alias("profit_cents"),
        F.sum("spend").alias("spend_cents"),
    )
