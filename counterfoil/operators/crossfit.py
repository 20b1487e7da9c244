"""Out-of-fold scores: every row of the log is scored by a model that has not seen it.

A model that is judged on its own training rows looks better than it is. A single split wastes the
test rows for fitting and the training rows for judging; here each row is scored by the model of
the other folds, so the whole log is evaluated and no score knows its own label.

Folds are drawn by a hash of the customer, independently of the arm, so all rows of a customer are
in one fold and the draw is the same anywhere.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions import expressions as E
from counterfoil.operators.learners import StratifiedTLearner, TreeTLearner
from counterfoil.sources.storage import local_table, store

FOLD = "fold"
#: Models that are fitted at the same time; each is a sequence of small jobs.
AT_ONCE = 3


def fold(campaign_id: str, folds: int, key: str = "customer_id") -> Column:
    """0 to ``folds`` - 1."""
    return E.hash_modulo(f"{campaign_id}:crossfit", F.col(key), folds).cast("int")


def crossfit(
    pilot: DataFrame,
    campaign_id: str,
    folds: int = 5,
    learner: StratifiedTLearner | TreeTLearner | None = None,
) -> DataFrame:
    """The pilot rows with ``fold``, p_treatment, p_control and uplift, all out of fold.

    ``pilot`` is read twice by the stratified learner and 2 x ``folds`` times by trees: pass a
    stored table. Rows with a null customer are left out.
    """
    if folds < 2:
        raise ValueError("folds must be 2 at least")
    rows = pilot.filter(F.col("customer_id").isNotNull()).withColumn(FOLD, fold(campaign_id, folds))
    if learner is None or isinstance(learner, StratifiedTLearner):
        return _stratified(rows, folds)
    return _refitted(rows, folds, learner)


def _stratified(rows: DataFrame, folds: int) -> DataFrame:
    """One aggregation for all folds: a fold's model is the totals less the fold's own sums."""
    band = E.recency_band(F.col("recency_days"))
    told = (
        rows.groupBy("customer_segment_code", band.alias("band"), "is_treatment", FOLD)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("bought_after_promo").cast("bigint")).alias("buyers"),
        )
        .collect()  # strata x arms x folds
    )
    own = {tuple(r)[:4]: (r["n"], r["buyers"]) for r in told}
    totals: dict[tuple, tuple[int, int]] = {}
    for (code, band_, arm, _), (n, buyers) in own.items():
        a, b = totals.get((code, band_, arm), (0, 0))
        totals[code, band_, arm] = (a + n, b + buyers)

    def rate(code, band_, arm, fold_) -> float:
        n, buyers = totals.get((code, band_, arm), (0, 0))
        m, own_buyers = own.get((code, band_, arm, fold_), (0, 0))
        return (buyers - own_buyers + 1) / (n - m + 2)

    strata = sorted({(code, band_) for code, band_, _ in totals})
    table = [
        (code, band_, f, rate(code, band_, 1, f), rate(code, band_, 0, f))
        for code, band_ in strata
        for f in range(folds)
    ]
    schema = T.StructType.fromDDL(
        f"customer_segment_code int, __band int, {FOLD} int, p_treatment double, p_control double"
    )
    rates = F.broadcast(local_table(rows.sparkSession, table, schema))
    joined = rows.withColumn("__band", band).join(rates, ["customer_segment_code", "__band", FOLD])
    return joined.select(*rows.columns, "p_treatment", "p_control").withColumn(
        "uplift", F.col("p_treatment") - F.col("p_control")
    )


def _refitted(rows: DataFrame, folds: int, learner: TreeTLearner) -> DataFrame:
    """One model per fold on the rows of all others; what it scores is stored."""

    def one(number: int) -> DataFrame:
        model = learner.fit(rows.filter(F.col(FOLD) != number))
        return store(model.transform(rows.filter(F.col(FOLD) == number)), f"fold-{number}")

    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        run = inheritable_thread_target(rows.sparkSession)(one)
        return reduce(DataFrame.unionByName, pool.map(run, range(folds)))
