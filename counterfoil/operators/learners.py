"""T-learners: one response model per arm, uplift as the difference of the probabilities."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.sources.storage import local_table, shared_folder

ROWS_PER_PARTITION = 20_000


class ArmError(ValueError):
    """An arm has no rows, or all its rows carry the same label."""


def _with_uplift(scored: DataFrame) -> DataFrame:
    return scored.withColumn("uplift", F.col("p_treatment") - F.col("p_control"))


@dataclass(frozen=True)
class StratifiedTLearner:
    """Smoothed response rate (buyers + 1) / (n + 2) per arm, segment and recency band.

    A plain aggregation, so its result can be checked value by value. There are at most
    5 segment codes x 4 bands x 2 arms, so the fitted model is a handful of rows.
    """

    def fit(self, training: DataFrame) -> StratifiedModel:
        rows = (
            training.groupBy(
                "customer_segment_code",
                E.recency_band(F.col("recency_days")).alias("recency_band"),
                "is_treatment",
            )
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("bought_after_promo").cast("bigint")).alias("buyers"),
            )
            .collect()
        )
        strata: dict[tuple[int, int], dict[int, float]] = {}
        for r in rows:
            strata.setdefault(r[:2], {})[r["is_treatment"]] = (r["buyers"] + 1) / (r["n"] + 2)
        return StratifiedModel(
            [(*key, arms.get(1, 0.5), arms.get(0, 0.5)) for key, arms in strata.items()]
        )


@dataclass(frozen=True)
class StratifiedModel:
    """Rows of (segment code, recency band, treated rate, control rate)."""

    strata: list[tuple[int, int, float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add p_treatment, p_control and uplift; a stratum without rows has rate 1/2."""
        schema = T.StructType.fromDDL(
            "customer_segment_code int, __band int, p_treatment double, p_control double"
        )
        rates = local_table(df.sparkSession, self.strata, schema)
        banded = df.withColumn("__band", E.recency_band(F.col("recency_days")))
        joined = banded.join(F.broadcast(rates), ["customer_segment_code", "__band"], "left")
        return _with_uplift(
            joined.select(
                *df.columns,
                F.coalesce("p_treatment", F.lit(0.5)).alias("p_treatment"),
                F.coalesce("p_control", F.lit(0.5)).alias("p_control"),
            )
        )


def check_arms(training: DataFrame) -> dict[int, int]:
    """Rows per arm; raises when an arm cannot be fitted."""
    sizes = {
        r["is_treatment"]: (r["n"], r["buyers"])
        for r in training.groupBy("is_treatment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("bought_after_promo").cast("bigint")).alias("buyers"),
        )
        .collect()
    }
    for arm, name in ((1, "treated"), (0, "control")):
        n, buyers = sizes.get(arm, (0, 0))
        if n == 0:
            raise ArmError(f"the {name} arm has no rows")
        if buyers in (0, n):
            raise ArmError(f"all {n} rows of the {name} arm have the same label")
    return {arm: sizes[arm][0] for arm in (0, 1)}


def _partitions(rows: int) -> int:
    """From the rows alone: bagging and split candidates are drawn per partition, so a count
    that depended on the cluster would give another model on another cluster."""
    return max(1, -(-rows // ROWS_PER_PARTITION))


@dataclass(frozen=True)
class TreeTLearner:
    """Two distributed tree models, "boosted" or "forest"."""

    kind: str = "boosted"

    def _estimator(self):
        if self.kind == "boosted":
            return GBTClassifier(labelCol="bought_after_promo", **C.BOOSTED_TREES)
        if self.kind == "forest":
            return RandomForestClassifier(labelCol="bought_after_promo", **C.FOREST)
        raise ValueError(f"kind must be boosted or forest, not {self.kind!r}")

    def fit(self, training: DataFrame) -> TreeModel:
        """Fit both arms at the same time; each is a Spark job sequence of its own."""
        estimator = self._estimator()
        sizes = check_arms(training)
        shared_folder(training.sparkSession)
        assembler = VectorAssembler(inputCols=C.FEATURE_COLUMNS, outputCol="features")

        def fit_arm(arm: int) -> PipelineModel:
            columns = ["customer_id", *C.FEATURE_COLUMNS, "bought_after_promo"]
            rows = training.filter(F.col("is_treatment") == arm).select(*columns)
            # The same rows in the same order in each partition, wherever they come from.
            spread = rows.repartition(_partitions(sizes[arm]), "customer_id")
            return Pipeline(stages=[assembler, estimator]).fit(
                spread.sortWithinPartitions(*columns)
            )

        with ThreadPoolExecutor(max_workers=2) as pool:
            run = inheritable_thread_target(training.sparkSession)(fit_arm)
            treated, control = pool.map(run, (1, 0))
        return TreeModel(treated, control)


@dataclass(frozen=True)
class TreeModel:
    treated: PipelineModel
    control: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        """Add p_treatment, p_control and uplift to every row, in place: a narrow map."""
        helpers = ["features", "rawPrediction", "probability", "prediction"]
        for model, name in ((self.treated, "p_treatment"), (self.control, "p_control")):
            df = model.transform(df).withColumn(name, vector_to_array("probability")[1])
            df = df.drop(*helpers)
        return _with_uplift(df)
