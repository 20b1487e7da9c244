"""Nearest controls within a caliper, for campaigns without a randomized hold-out.

Customers become points with whole coordinates (scaled behaviour) inside a stratum. Treated
customers at one point share their match and controls at one point share their distance, so only
*distinct* points are compared: however many customers sit on the commonest point, it is one row.

Points are laid on a grid of cells and meet the controls of their own and the adjacent cells by an
equal join; cells are as wide as the radius looked for, so nothing within it lies elsewhere. The
radius starts at 1 and doubles up to the caliper, and only points without a control so far go on.
A cell of width w has at most w**d distinct points of d whole coordinates, so a point meets at most
(3 w)**d controls whatever the size of the tables, and no key of the join is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import expressions as E
from counterfoil.sources.storage import store

#: Scale of each coordinate: a difference of one is what counts as one step apart.
SCALES = {"recency_days": 0.1, "frequency_30d": 3.0, "monetary_90d": 0.00005}
STRATA = ["customer_segment_code"]
CALIPER = 4
MOST_DIMENSIONS = 4


def radii(caliper: int) -> list[int]:
    """1, 2, 4... and the caliper."""
    out = [1 << k for k in range(max(caliper, 1).bit_length()) if 1 << k < caliper]
    return [*out, caliper]


def _points(rows: DataFrame, scales: Mapping[str, float], strata: Sequence[str]) -> DataFrame:
    """The rows with whole coordinates ``__x0``...; null where a feature is."""
    at = {
        f"__x{i}": F.rint(F.col(name) * F.lit(float(scale))).cast("bigint")
        for i, (name, scale) in enumerate(scales.items())
    }
    return rows.withColumns(at)


def _whole(strata: Sequence[str], axes: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in (*strata, *axes)])


def nearest_points(
    asked: DataFrame, controls: DataFrame, strata: Sequence[str], axes: Sequence[str], caliper: int
) -> DataFrame:
    """For distinct points ``asked`` the nearest row of ``controls`` (distinct points with
    ``control``), as (strata, axes, ``square``, ``control``); points without any are absent."""
    key = [*strata, *axes]
    cells = [f"__c{i}" for i in range(len(axes))]
    found = []
    for radius in radii(caliper):
        cell = [F.floor(F.col(x) / F.lit(radius)).cast("bigint") for x in axes]
        around = F.array(
            *[
                F.struct(*[(c + F.lit(s)).alias(n) for c, s, n in zip(cell, step, cells, strict=True)])
                for step in product((-1, 0, 1), repeat=len(axes))
            ]
        )
        near = asked.select(*key, F.inline(around))
        there = controls.select(
            *strata,
            *[F.col(x).alias(f"{x}_there") for x in axes],
            *[c.alias(n) for c, n in zip(cell, cells, strict=True)],
            "control",
        )
        gaps = [F.col(x) - F.col(f"{x}_there") for x in axes]
        square = reduce(Column.__add__, [g * g for g in gaps])
        best = (
            near.join(there, [*strata, *cells])
            .select(*key, square.alias("square"), "control")
            .filter(F.col("square") <= radius * radius)
            .groupBy(*key)
            .agg(F.min(F.struct("square", "control")).alias("best"))
            .select(*key, "best.*")
        )
        best = store(best, f"nearest-{radius}")
        found.append(best)
        if radius < caliper:
            asked = store(asked.join(best.select(*key), key, "left_anti"), f"open-{radius}")
    return reduce(DataFrame.unionByName, found)


def nearest_controls(
    training: DataFrame,
    scales: Mapping[str, float] = SCALES,
    strata: Sequence[str] = STRATA,
    caliper: int = CALIPER,
    id_column: str = "customer_id",
) -> DataFrame:
    """One row per treated row: id, ``control_id``, ``square`` (squared distance in steps),
    ``bought`` and ``control_bought``.

    The control is the nearest one of the same stratum at most ``caliper`` steps away, of equally
    near ones the smallest id; a control may serve many. Without one, or with a null stratum or
    feature, the last columns but ``bought`` are null. Customers' labels must not be null.
    ``training`` is read three times: pass a stored table.
    """
    if not 1 <= len(scales) <= MOST_DIMENSIONS or caliper < 1:
        raise ValueError(f"1 to {MOST_DIMENSIONS} features and a caliper of 1 or more")
    axes = [f"__x{i}" for i in range(len(scales))]
    rows = _points(training, scales, strata)
    key = [*strata, *axes]
    treated = rows.filter(F.col("is_treatment") == 1)
    control = F.struct(F.col(id_column).alias("id"), F.col("bought_after_promo").alias("bought"))
    controls = store(
        rows.filter((F.col("is_treatment") == 0) & F.col(id_column).isNotNull() & _whole(strata, axes))
        .groupBy(*key)
        .agg(F.min(control).alias("control")),
        "control-points",
    )
    asked = store(treated.filter(_whole(strata, axes)).select(*key).distinct(), "treated-points")
    matched = nearest_points(asked, controls, strata, axes, caliper)
    return treated.join(matched, key, "left").select(
        id_column,
        F.col("control.id").alias("control_id"),
        "square",
        F.col("bought_after_promo").alias("bought"),
        F.col("control.bought").alias("control_bought"),
    )


def nearest_effect(matches: DataFrame) -> DataFrame:
    """Effect on the treated that have a control, and how many have none."""
    both = F.col("control_id").isNotNull()
    count = F.count(F.when(both, 1))
    bought = F.sum(F.when(both, F.col("bought").cast("bigint")))
    there = F.sum(F.when(both, F.col("control_bought").cast("bigint")))
    return matches.agg(
        count.alias("n_matched"),
        F.count(F.when(~both, 1)).alias("n_unmatched"),
        F.count_distinct("control_id").alias("n_controls"),
        F.coalesce(bought, F.lit(0)).alias("buyers"),
        F.coalesce(there, F.lit(0)).alias("control_buyers"),
        E.ratio(bought - there, count).alias("matched_effect"),
    )
