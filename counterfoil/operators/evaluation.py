"""How good are the scores: Qini curve, uplift at k, AUC, precision, RFM quartiles.

Rankings break ties by customer id, so evaluate the log of one campaign at a time or name
another id column that is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import expressions as E
from counterfoil.operators import ranking
from counterfoil.sources.storage import store


def qini_curve(
    scored: DataFrame,
    y: str = "bought_after_promo",
    w: str = "is_treatment",
    score: str = "uplift",
    id_column: str = "customer_id",
    cells: int | None = None,
) -> DataFrame:
    """One row per ranked customer: running counts, Qini value and the random line.

    Without a control so far the Qini value is ``y_t``; without any control at all the
    random line is null. ``scored`` is read several times, see ``ranking``.
    """
    rows = scored.select(
        id_column,
        F.col(y).cast("bigint").alias("y"),
        F.col(w).cast("bigint").alias("w"),
        F.col(score).alias("score"),
    ).filter(F.col("score").isNotNull())
    totals = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("w").alias("t"),
        F.sum(F.col("y") * F.col("w")).alias("y_t"),
        F.sum(F.col("y") * (1 - F.col("w"))).alias("y_c"),
    ).first()
    slope = None
    if totals["n"] and totals["n"] > totals["t"]:
        slope = totals["y_t"] - totals["y_c"] * (totals["t"] / (totals["n"] - totals["t"]))
    ranked = ranking.running_totals(
        rows,
        "score",
        id_column,
        {
            "n_t": F.col("w"),
            "y_t": F.col("y") * F.col("w"),
            "y_c": F.col("y") * (1 - F.col("w")),
        },
        cells=cells,
        rows=totals["n"],
    )
    n_c = F.col("n_pop") - F.col("n_t")
    gain = F.col("y_t") - F.col("y_c") * E.ratio(F.col("n_t"), n_c)
    return ranked.select(
        id_column,
        "y",
        "w",
        "score",
        "n_pop",
        "n_t",
        n_c.alias("n_c"),
        "y_t",
        "y_c",
        F.coalesce(gain, F.col("y_t").cast("double")).alias("qini"),
        (F.col("n_pop").cast("double") / F.lit(float(totals["n"] or 1)) * F.lit(slope))
        .cast("double")
        .alias("random"),
    )


def qini_curves(
    scored: DataFrame,
    groups: Sequence[str],
    y: str = "bought_after_promo",
    w: str = "is_treatment",
    score: str = "uplift",
    id_column: str = "customer_id",
    hot_rows: int | None = None,
) -> DataFrame:
    """One Qini curve per group, such as (campaign, promotion), all in one pass.

    Groups may be many and some of them large, see ``ranking.grouped_totals``; ids are unique
    within a group. The columns are those of ``qini_curve`` after the group's.
    """
    rows = scored.select(
        *groups,
        id_column,
        F.col(y).cast("bigint").alias("y"),
        F.col(w).cast("bigint").alias("w"),
        F.col(score).alias("score"),
    ).filter(F.col("score").isNotNull())
    sums = {
        "n_t": F.col("w"),
        "y_t": F.col("y") * F.col("w"),
        "y_c": F.col("y") * (1 - F.col("w")),
    }
    ranked = ranking.grouped_totals(rows, "score", id_column, groups, sums, hot_rows=hot_rows)
    names = [f"__of{i}" for i in range(len(groups))]
    ends = rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__{c}") for c, v in sums.items()]
    )
    ends = ends.select(
        *[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)],
        F.col("__n").cast("double").alias("__n"),
        (
            F.col("__y_t")
            - F.col("__y_c") * E.ratio(F.col("__n_t"), F.col("__n") - F.col("__n_t"))
        ).alias("__slope"),
    )
    n_c = F.col("n_pop") - F.col("n_t")
    gain = F.col("y_t") - F.col("y_c") * E.ratio(F.col("n_t"), n_c)
    return ranked.join(ends, ranking.same_groups(groups, names)).select(
        *groups,
        id_column,
        "y",
        "w",
        "score",
        "n_pop",
        "n_t",
        n_c.alias("n_c"),
        "y_t",
        "y_c",
        F.coalesce(gain, F.col("y_t").cast("double")).alias("qini"),
        (F.col("n_pop").cast("double") / F.col("__n") * F.col("__slope")).alias("random"),
    )


def _arm_counts(keep: Column) -> list[Column]:
    y, treated = F.col("bought_after_promo"), F.col("is_treatment") == 1
    return [
        F.count(F.when(keep & treated, 1)).alias("n_treated"),
        F.count(F.when(keep & treated & (y == 1), 1)).alias("buyers_treated"),
        F.count(F.when(keep & ~treated, 1)).alias("n_control"),
        F.count(F.when(keep & ~treated & (y == 1), 1)).alias("buyers_control"),
    ]


def uplift_at_k(
    scored: DataFrame,
    shares: Sequence[str],
    score: str = "uplift",
    id_column: str = "customer_id",
    cells: int | None = None,
) -> DataFrame:
    """Treated minus control response rate inside each top share; null if an arm is empty.

    The shares are found as cut rows and counted together in one pass.
    """
    cuts = ranking.rank_cuts(
        scored,
        score,
        id_column,
        lambda n: [ranking.share_position(s, n) for s in shares],
        cells=cells,
    ).get((), [ranking.Cut(0)] * len(shares))
    parts = [
        F.struct(
            F.lit(float(share)).alias("share"),
            F.lit(cut.position).cast("bigint").alias("n_top"),
            *_arm_counts(cut.covers(score, id_column)),
        )
        for share, cut in zip(shares, cuts, strict=True)
    ]
    return (
        scored.agg(F.array(*parts).alias("__all"))
        .select(F.inline("__all"))
        .withColumn(
            "uplift_at_k",
            E.ratio(F.col("buyers_treated"), F.col("n_treated"))
            - E.ratio(F.col("buyers_control"), F.col("n_control")),
        )
    )


def _response_score() -> Column:
    """The probability of the arm the customer was in."""
    return F.when(F.col("is_treatment") == 1, F.col("p_treatment")).otherwise(F.col("p_control"))


def auc(scored: DataFrame, cells: int | None = None) -> DataFrame:
    """Exact area under the ROC curve per arm, equal scores sharing their middle rank.

    Customers first shrink to one row per arm and distinct score; ranks are then running
    counts over those rows. Everything is whole numbers up to one final division.
    """
    counts = store(
        scored.select("is_treatment", "bought_after_promo", _response_score().alias("score"))
        .groupBy("is_treatment", "score")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bought_after_promo").alias("pos")),
        "auc",
    )
    running = ranking.running_totals(
        counts,
        "score",
        "score",
        {"n_upto": F.col("n")},
        groups=["is_treatment"],
        descending=False,
        rank="place",
        cells=cells,
    )
    wide = "decimal(19,0)"
    twice_rank = (2 * F.col("n_upto") - F.col("n") + 1).cast(wide)
    sums = running.groupBy("is_treatment").agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("positives"),
        F.sum(F.col("pos").cast(wide) * twice_rank).alias("twice_rank_sum"),
    )
    p = F.col("positives").cast(wide)
    pairs = 2 * p.cast("double") * (F.col("n") - F.col("positives")).cast("double")
    return sums.select(
        "is_treatment",
        "n",
        "positives",
        E.ratio(F.col("twice_rank_sum") - p * (p + 1), pairs).alias("auc"),
    )


def precision_at(
    scored: DataFrame, share: str, id_column: str = "customer_id", cells: int | None = None
) -> DataFrame:
    """Mean label in each arm's top share by the arm's own response score."""
    rows = scored.withColumn("__score", _response_score())
    by_arm = ranking.rank_cuts(
        rows,
        "__score",
        id_column,
        lambda n: [ranking.share_position(share, n)],
        groups=["is_treatment"],
        cells=cells,
    )
    keep = F.lit(False)
    for (arm,), (cut,) in by_arm.items():
        keep = keep | ((F.col("is_treatment") == arm) & cut.covers("__score", id_column))
    bought = F.col("bought_after_promo").cast("bigint")
    return (
        rows.groupBy("is_treatment")
        .agg(
            F.count(F.when(keep, 1)).alias("n_top"),
            F.coalesce(F.sum(F.when(keep, bought)), F.lit(0)).alias("buyers"),
        )
        .withColumn("precision", E.ratio(F.col("buyers"), F.col("n_top")))
    )


def rfm_quartiles(
    people: DataFrame, id_column: str = "customer_id", cells: int | None = None
) -> DataFrame:
    """Add the quartiles of recency, frequency and spend, their sum, and its quartile.

    1 is best. Each quartile is an exact ``ntile(4)`` with ties by id, decided by comparing a
    row with three cut rows. The three base metrics are cut together, in long form: the long
    rows are only counted, the customers themselves are never moved.
    """
    signed = {
        "r_quartile": F.col("recency_days").cast("double"),
        "f_quartile": -F.col("frequency_30d").cast("double"),
        "m_quartile": -F.col("monetary_90d").cast("double"),
    }
    keyed = people.withColumns({f"__{name}": value for name, value in signed.items()})
    long = keyed.unpivot(id_column, [f"__{name}" for name in signed], "metric", "value")
    ends = ranking.tile_ends(4)
    by_metric = ranking.rank_cuts(
        long, "value", id_column, ends, groups=["metric"], descending=False, cells=cells
    )
    for name in signed:
        cuts = by_metric.get((f"__{name}",), [])
        keyed = keyed.withColumn(name, ranking.tile(cuts, f"__{name}", id_column))
    scored = keyed.withColumn(
        "rfm_score", F.col("r_quartile") + F.col("f_quartile") + F.col("m_quartile")
    )
    overall = ranking.rank_cuts(
        scored, "rfm_score", id_column, ends, descending=False, cells=cells
    )
    return scored.drop(*[f"__{name}" for name in signed]).withColumn(
        "rfm_quartile", ranking.tile(overall.get((), []), "rfm_score", id_column)
    )


def quartile_redemption(pilot: DataFrame) -> DataFrame:
    """Redemption of the treated arm per RFM quartile."""
    return (
        pilot.filter(F.col("is_treatment") == 1)
        .groupBy("rfm_quartile")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("bought_after_promo").cast("bigint")).alias("buyers"),
        )
        .withColumn("redemption_rate", E.ratio(F.col("buyers"), F.col("n")))
    )


def response_signal(pilot: DataFrame) -> DataFrame:
    """Two-proportion z of quartile 1 against quartile 4, treated arm."""
    arm = pilot.filter(F.col("is_treatment") == 1)

    def counts(q: int) -> list[Column]:
        here = F.col("rfm_quartile") == q
        return [
            F.count(F.when(here, 1)).alias(f"n_q{q}"),
            F.count(F.when(here & (F.col("bought_after_promo") == 1), 1)).alias(f"buyers_q{q}"),
        ]

    n1, n4, b1, b4 = (F.col(c) for c in ("n_q1", "n_q4", "buyers_q1", "buyers_q4"))
    pooled = E.ratio(b1 + b4, n1 + n4)
    spread = F.sqrt(pooled * (1 - pooled) * (E.ratio(F.lit(1), n1) + E.ratio(F.lit(1), n4)))
    return arm.agg(*counts(1), *counts(4)).select(
        "*",
        E.ratio(b1, n1).alias("rate_q1"),
        E.ratio(b4, n4).alias("rate_q4"),
        E.ratio(E.ratio(b1, n1) - E.ratio(b4, n4), spread).alias("z"),
    )
