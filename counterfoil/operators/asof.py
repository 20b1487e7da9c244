"""Features as of many reference dates, from one scan of the transactions.

A campaign log may hold several campaigns. Taking all features as of one date would let earlier
campaigns see their own future, and computing them date by date would scan the history once per
campaign. Here the history shrinks to one row per customer and day; *probes* - the dates a
customer's features are asked for, and the starts of their windows - are sorted in between, and
running totals over that order are read off at the probes. A window's sum is the difference of the
totals at its two ends.

A customer holds at most one row per day of history and three per reference date, however many
lines they bought, so no task gets more than that of one customer.

Distinct baskets have no running total as such: a basket with lines on several days must count
once per window. Its days are chained: the number of a basket's days in a window, less the number
of neighbouring days both in it, is 1 if any day is. Neighbours further apart than the window are
never both in it and are left out; of the others, those in a window are those that *end* before
its end, less those that *start* before its start - again a difference of two running totals.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.operators import features
from counterfoil.sources.storage import small_side

DATE = "reference_date"
#: Exact sums per day.
SUMS = ["revenue_high", "revenue_low", "items", "promo_lines", "lines"]
#: Baskets that appear first on the day, basket days, and chained basket days that end or start.
BASKETS = ["visits", "basket_days", "chain_ends", "chain_starts"]

#: Which window a probe is the start of; AT is the reference date itself.
AT, RECENT, MONTH = 0, 1, 2
OFFSETS = {AT: 0, RECENT: C.MONETARY_DAYS, MONTH: C.FREQUENCY_DAYS}


def _day(moment: Column) -> Column:
    return F.unix_date(F.to_date(moment))


def basket_days(transactions: DataFrame, before: date | None = None) -> DataFrame:
    """Lines added up per (customer, basket, day), with the basket's chain of days.

    Keyed by basket and day, so neither a customer nor a basket with a large share of all lines
    lands in one task; the chains need one row per basket and day only. ``before`` cuts the history
    at the scan: no reference date may lie after it.

    The basket is grouped by as a struct. By its plain id Spark would do all of this where lines
    joined by that id already are: the join's sorts, both halves of the sums and the chains in one
    task, which holds them all at once, and a skewed basket could not be split in the join.
    """
    moment = F.col("datetime")
    kept = F.col("customer_id").isNotNull() & moment.isNotNull()
    if before is not None:
        kept = kept & (moment < F.lit(before.isoformat()).cast("timestamp_ntz"))
    units = E.to_units(F.col("price") * F.col("qty"), E.REVENUE_PLACES)
    days = (
        transactions.filter(kept)
        .groupBy("customer_id", F.struct("po_id").alias("basket"), _day(moment).alias("day"))
        .agg(
            F.max(moment).alias("last_purchase"),
            *E.sum_units(units, "revenue"),
            F.sum(F.col("qty").cast("bigint")).alias("items"),
            F.sum(E.has_promotion(F.col("promotion_id")).cast("bigint")).alias("promo_lines"),
            F.count(F.lit(1)).alias("lines"),
        )
        .withColumn("po_id", F.col("basket.po_id"))
    )
    chain = Window.partitionBy("customer_id", "po_id").orderBy("day")
    named = F.col("po_id").isNotNull()
    count = lambda condition: (named & F.coalesce(condition, F.lit(False))).cast("bigint")
    since, until = F.col("day") - F.lag("day").over(chain), F.lead("day").over(chain) - F.col("day")
    return days.select(
        "customer_id",
        "day",
        "last_purchase",
        *SUMS,
        count(F.lag("day").over(chain).isNull()).alias("visits"),
        count(F.lit(True)).alias("basket_days"),
        count(since < C.FREQUENCY_DAYS).alias("chain_ends"),
        count(until < C.FREQUENCY_DAYS).alias("chain_starts"),
    )


def single_day_baskets(baskets: DataFrame) -> DataFrame:
    """The same from baskets that are known to lie on one day, such as orders with a head:
    ``customer_id, po_id, last_purchase`` and the sums; no chains, so no window over baskets."""
    one = F.col("po_id").isNotNull().cast("bigint")
    none = F.lit(0).cast("bigint")
    return baskets.select(
        "customer_id",
        _day(F.col("last_purchase")).alias("day"),
        "last_purchase",
        *SUMS,
        one.alias("visits"),
        one.alias("basket_days"),
        none.alias("chain_ends"),
        none.alias("chain_starts"),
    )


def day_buckets(days: DataFrame) -> DataFrame:
    """One row per customer and day."""
    return days.groupBy("customer_id", "day").agg(
        F.max("last_purchase").alias("last_purchase"),
        *[F.sum(c).alias(c) for c in (*SUMS, *BASKETS)],
    )


def _probes(log: DataFrame) -> DataFrame:
    """The days at which a customer's running totals are read."""
    wanted = log.filter(F.col("customer_id").isNotNull() & F.col(DATE).isNotNull())
    at = [
        F.struct(F.lit(kind).alias("kind"), F.date_sub(DATE, days).alias("probe"))
        for kind, days in OFFSETS.items()
    ]
    return (
        wanted.select("customer_id", F.col(DATE).cast("date").alias(DATE))
        .distinct()
        .select("customer_id", DATE, F.inline(F.array(*at)))
        .select("customer_id", DATE, "kind", F.unix_date("probe").alias("day"))
    )


def features_as_of(buckets: DataFrame, log: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per (customer, ``reference_date``) of the log, features as of that date.

    The history of a date ends before its midnight. Rows of the log without a customer, without a
    date, or with a customer who is not in ``customers`` give none; those that repeat give one.
    """
    both = buckets.unionByName(_probes(log), allowMissingColumns=True)
    # A probe comes before the bucket of its own day: that day is not history yet.
    so_far = (
        Window.partitionBy("customer_id")
        .orderBy("day", F.col("kind").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    read = both.select(
        "customer_id",
        DATE,
        "kind",
        F.max("last_purchase").over(so_far).alias("last_purchase"),
        *[F.sum(c).over(so_far).alias(c) for c in (*SUMS, *BASKETS)],
    ).filter(F.col("kind").isNotNull())

    def total(name: str, kind: int = AT) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.coalesce(F.col(name), F.lit(0))))

    totals = read.groupBy("customer_id", DATE).agg(
        F.max(F.when(F.col("kind") == AT, F.col("last_purchase"))).alias("last_purchase"),
        *[total(c).alias(c) for c in SUMS],
        *[
            (total(f"revenue_{part}") - total(f"revenue_{part}", RECENT)).alias(f"recent_{part}")
            for part in ("high", "low")
        ],
        total("visits").alias("visits"),
        (
            total("basket_days")
            - total("basket_days", MONTH)
            - (total("chain_ends") - total("chain_starts", MONTH))
        ).alias("recent_visits"),
    )
    return totals.join(customers, "customer_id").select(
        "customer_id",
        DATE,
        *features.finished(F.col(DATE).cast("timestamp_ntz")),
    )


def with_start(campaign: DataFrame, promotions: DataFrame) -> DataFrame:
    """The campaign log with the start of each row's promotion as its reference date; null where
    the promotion is unknown or has no start."""
    starts = promotions.select(
        F.col("promotion_id").alias("__offer"), F.col("start_date").cast("date").alias(DATE)
    )
    offered = E.join_key(F.col("promotion_id"), F.col("customer_id")) == F.col("__offer")
    dated = campaign.join(small_side(starts, bound=promotions), offered, "left")
    return dated.select(*campaign.columns, DATE)


def training_set(dated: DataFrame, as_of: DataFrame) -> DataFrame:
    """The rows of a dated log with the features of their customers as of their own date."""
    return dated.join(as_of, ["customer_id", DATE])
