"""Intervals by a Poisson bootstrap: every replicate weighs the customers anew, none is moved.

A resample of n of n customers gives each a count that is nearly Poisson(1). Here the count of a
customer in a replicate is read off a hash of the two, so a replicate needs no draw, no shuffle and
no copy of the rows: its sums are further columns of one aggregation, and any engine that can hash
gets the same ones. All rows of one customer share a count, as they are resampled together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import expressions as E
from counterfoil.operators import ranking

REPLICATES = 40
#: Replicates whose hash numbers come from one SHA-256: 64 hex digits in groups of 8.
PER_DIGEST = 8
#: Of a hash number of 32 bits, from where on the count is 1, 2...: floor(2**32 P(count <= k)).
STEPS = [
    math.floor(2**32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)))
    for k in range(12)
]


def weights(salt: str, key: Column, replicates: int) -> list[Column]:
    """A count per replicate, Poisson with mean 1."""
    digests = [
        F.sha2(F.concat(F.lit(f"{salt}:{d}:"), key.cast("string")).cast("binary"), 256)
        for d in range(-(-replicates // PER_DIGEST))
    ]
    out = []
    for r in range(replicates):
        digest, at = digests[r // PER_DIGEST], 8 * (r % PER_DIGEST)
        number = F.conv(F.substring(digest, at + 1, 8), 16, 10).cast("bigint")
        out.append(sum(((number >= s).cast("bigint") for s in STEPS[1:]), (number >= STEPS[0]).cast("bigint")))
    return out


def replicated_sums(
    rows: DataFrame,
    groups: Sequence[str],
    measures: Mapping[str, Column],
    salt: str,
    replicates: int = REPLICATES,
    id_column: str = "customer_id",
) -> DataFrame:
    """Per group the sum of every measure (whole numbers) and, as ``<name>_all``, an array of its
    sums in the replicates. Partial sums before the shuffle; groups are few."""
    counts = [f"__w{r}" for r in range(replicates)]
    # The counts are columns of a narrow map, so each is worked out once per row.
    drawn = weights(salt, F.col(id_column), replicates)
    named = rows.select(
        *groups,
        *[value.cast("bigint").alias(name) for name, value in measures.items()],
        *[w.alias(c) for w, c in zip(drawn, counts, strict=True)],
    )
    sums = named.groupBy(*groups).agg(
        *[F.sum(name).alias(name) for name in measures],
        *[F.sum(F.col(name) * F.col(c)).alias(f"{name}{c}") for name in measures for c in counts],
    )
    return sums.select(
        *groups,
        *measures,
        *[F.array(*[F.col(f"{name}{c}") for c in counts]).alias(f"{name}_all") for name in measures],
    )


def bounds(values: Column, percent: int) -> tuple[Column, Column]:
    """The ends of the middle ``percent`` of an array's values, which may be null: order
    statistics, no interpolation, so that engines agree."""
    good = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    n = F.size(good)
    cut = F.floor(n * F.lit((100 - percent) / 200)).cast("int")
    return F.get(good, cut), F.get(good, n - 1 - cut)


def arm_measures() -> dict[str, Column]:
    treated, bought = F.col("is_treatment") == 1, F.col("bought_after_promo") == 1
    return {
        "n_treated": treated.cast("bigint"),
        "buyers_treated": (treated & bought).cast("bigint"),
        "n_control": (~treated).cast("bigint"),
        "buyers_control": (~treated & bought).cast("bigint"),
    }


def _uplift(n_t: Column, y_t: Column, n_c: Column, y_c: Column) -> Column:
    return E.ratio(y_t, n_t) - E.ratio(y_c, n_c)


def _qini(n_t: Column, y_t: Column, n_c: Column, y_c: Column) -> Column:
    return F.coalesce(y_t - y_c * E.ratio(n_t, n_c), y_t.cast("double"))


def _each(function, names: Sequence[str]) -> Column:
    """``function`` of the measures of every replicate."""
    rows = F.arrays_zip(*[F.col(f"{name}_all") for name in names])
    return F.transform(rows, lambda x: function(*[x[f"{name}_all"] for name in names]))


def uplift_intervals(
    scored: DataFrame,
    shares: Sequence[str],
    salt: str,
    replicates: int = REPLICATES,
    percent: int = 95,
    score: str = "uplift",
    id_column: str = "customer_id",
    cells: int | None = None,
) -> DataFrame:
    """Uplift and Qini value of each top share with their intervals, one row per share.

    The shares are those of the scores as given; replicates weigh the customers inside them. Bands
    between two cuts are summed once and added up over the shares, so the work does not grow with
    the number of shares. Without rows there are no shares.
    """
    wanted = sorted(shares, key=float)
    found = ranking.rank_cuts(
        scored, score, id_column, lambda n: [ranking.share_position(s, n) for s in wanted], cells=cells
    ).get((), [])
    band = F.lit(len(found))
    for i in range(len(found) - 1, -1, -1):
        band = F.when(found[i].covers(score, id_column), i).otherwise(band)
    names = list(arm_measures())
    rows = scored.withColumn("__band", band).filter(F.col("__band") < len(found))
    sums = replicated_sums(rows, ["__band"], arm_measures(), salt, replicates, id_column)
    # A handful of rows: a share has the bands up to its own.
    spread = sums.withColumn(
        "share", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("share")) for i, s in enumerate(wanted)]))
    ).filter(F.col("__band") <= F.col("share.i"))
    added = spread.groupBy("share").agg(
        *[F.sum(name).alias(name) for name in names],
        *[
            F.array(*[F.sum(F.get(f"{name}_all", F.lit(r))) for r in range(replicates)]).alias(f"{name}_all")
            for name in names
        ],
    )
    return _with_bounds(
        added.select(F.col("share.share").alias("share"), *names, *[f"{n}_all" for n in names]),
        ["share", *names],
        {"uplift": _uplift, "qini": _qini},
        names,
        percent,
    )


def rate_intervals(
    rows: DataFrame,
    group: str,
    salt: str,
    replicates: int = REPLICATES,
    percent: int = 95,
    id_column: str = "customer_id",
) -> DataFrame:
    """Arm sizes, response rates and their difference per group, with intervals."""
    names = list(arm_measures())
    sums = replicated_sums(rows, [group], arm_measures(), salt, replicates, id_column)
    return _with_bounds(
        sums,
        [group, *names],
        {
            "rate_treated": lambda n_t, y_t, n_c, y_c: E.ratio(y_t, n_t),
            "rate_control": lambda n_t, y_t, n_c, y_c: E.ratio(y_c, n_c),
            "effect": _uplift,
        },
        names,
        percent,
    )


def _with_bounds(df, kept, values, names, percent) -> DataFrame:
    out = []
    for name, function in values.items():
        low, high = bounds(_each(function, names), percent)
        out += [
            function(*[F.col(n) for n in names]).alias(name),
            low.alias(f"{name}_low"),
            high.alias(f"{name}_high"),
        ]
    return df.select(*kept, *out)
