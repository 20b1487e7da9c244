"""Scalar expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from counterfoil.functions import constants as C


def round_half_even(value: Column, places: int) -> Column:
    """Round the binary double half to even; -0.0 becomes 0.0.

    ``bround`` works on the decimal text of the number and gives other results on ties.
    """
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


#: Decimals of line revenue: prices times quantities are added up to this precision.
REVENUE_PLACES = 4


def to_units(value: Column, places: int) -> Column:
    """A double as a whole number of 10^-places, so that sums do not depend on row order."""
    return F.rint(value * F.lit(float(10**places))).cast("bigint")


def from_units(units: Column, places: int) -> Column:
    return units.cast("double") / F.lit(float(10**places))


# Sums of whole numbers can outgrow 64 bits when one key holds much of the data, and decimal
# sums cost a third of an aggregation. So the upper part and the lower 20 bits are added up
# apart, as plain 64-bit sums, and put together once per group.
LOW_BITS = 20


def sum_units(units: Column, name: str) -> list[Column]:
    """Exact sum as two columns, ``name_high`` and ``name_low``."""
    low = F.lit((1 << LOW_BITS) - 1).cast("bigint")
    return [
        F.sum(F.shiftright(units, LOW_BITS)).alias(f"{name}_high"),
        F.sum(units.bitwiseAND(low)).alias(f"{name}_low"),
    ]


def sum_parts(name: str) -> list[Column]:
    """Add up sums of ``sum_units`` once more."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("high", "low")]


def _whole(high: Column, low: Column) -> Column:
    wide = "decimal(20,0)"
    return high.cast(wide) * F.lit(1 << LOW_BITS).cast("decimal(7,0)") + low.cast(wide)


def from_columns(high: Column, low: Column, places: int) -> Column:
    return from_units(_whole(high, low), places)


def from_parts(name: str, places: int) -> Column:
    return from_columns(F.col(f"{name}_high"), F.col(f"{name}_low"), places)


def exact_sum(value: Column, places: int, keep: Column | None = None) -> Column:
    """Order-independent sum of doubles with at most ``places`` decimals, where ``keep``.

    Finer values are rounded one by one, so ``places`` must be the precision of the input.
    """
    units = to_units(value, places)
    high, low = sum_units(units if keep is None else F.when(keep, units), "sum")
    return from_units(_whole(high, low), places)


def has_promotion(promotion_id: Column) -> Column:
    """1 when a promotion is named; null and the empty string both mean none."""
    return (F.coalesce(promotion_id, F.lit("")) != "").cast("int")


def elapsed_days(since: Column, until: Column) -> Column:
    """Whole elapsed days, not calendar days: 23:00 to the next midnight is 0.

    The day field of the interval between two zone-less times; no session zone is involved.
    """
    return F.extract(F.lit("DAY"), until - since)


def segment_code(segment: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in C.SEGMENT_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, segment), F.lit(C.UNKNOWN_SEGMENT)).cast("int")


def hash_modulo(salt: str, key: Column, kinds: int) -> Column:
    """A stable draw from 0..kinds-1 for a key: the same in every run, task and engine."""
    digest = F.md5(F.concat(F.lit(salt + ":"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(kinds)


def hash_percent(salt: str, key: Column) -> Column:
    return hash_modulo(salt, key, 100)


def join_key(value: Column, row: Column) -> Column:
    """``value`` as a key that depends on the row, for a side that may hold one literal value.

    The optimizer folds a literal key away, and an equal join becomes a loop over all pairs.
    """
    return F.concat(value, F.substring(F.coalesce(row.cast("string"), F.lit("")), 1, 0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null, not an error, on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def quadrant(uplift: Column, p_control: Column) -> Column:
    return (
        F.when(uplift >= C.UPLIFT_MARGIN, C.PERSUADABLE)
        .when(uplift <= -C.UPLIFT_MARGIN, C.SLEEPING_DOG)
        .when(p_control >= C.SURE_PROBABILITY, C.SURE_THING)
        .otherwise(C.LOST_CAUSE)
    )


def action(uplift: Column, profit: Column) -> Column:
    return (
        F.when(uplift < 0, C.DO_NOT_DISTURB).when(profit > 0, C.TARGET).otherwise(C.SKIP)
    )


def recency_band(recency_days: Column) -> Column:
    return (
        F.when(recency_days <= 30, 0)
        .when(recency_days <= 90, 1)
        .when(recency_days <= 180, 2)
        .otherwise(3)
    )


def frequency_band(frequency_30d: Column) -> Column:
    return F.least(frequency_30d, F.lit(2)).cast("int")
