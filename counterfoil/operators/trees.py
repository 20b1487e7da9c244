"""A fitted tree ensemble as a table of nodes, scored by DataFrame functions.

A table outlives the session and the library that fitted it: it can be stored beside the lists it
made, compared between campaigns, checked by SQL, and scored without the model classes. There is
one row per node of every tree of an arm. Its size is that of the ensemble (trees times nodes),
whatever the number of customers, so its columns are constants of the scoring plan: a narrow map,
no join, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions import constants as C
from counterfoil.operators.learners import TreeModel
from counterfoil.sources.storage import local_table, new_path

#: Leaves have feature -1 and no children. ``value`` is a leaf's share of its tree's vote,
#: ``weight`` the tree's, ``link`` how the votes of an arm become a probability.
SCHEMA = (
    "arm int, tree int, node int, feature int, threshold double, left int, right int, "
    "value double, weight double, link string"
)
#: Sum of votes v to probability: 1 / (1 + exp(-2 v)), or the mean vote.
LOGISTIC, MEAN = "logistic", "mean"
MOST_NODES = 200_000
ARMS = {1: "p_treatment", 0: "p_control"}


class TableError(ValueError):
    """The node table does not describe two whole ensembles."""


def _arm_nodes(spark: SparkSession, model: PipelineModel, arm: int) -> DataFrame:
    """The nodes of one arm, from what Spark ML saves."""
    ensemble = model.stages[-1]
    path = new_path(spark, f"model-arm-{arm}")
    ensemble.write().save(path)
    schema = T.StructType.fromDDL("tree int, weight double")
    weights = local_table(spark, list(enumerate(map(float, ensemble.treeWeights))), schema)
    boosted = not hasattr(ensemble, "numClasses") or "GBT" in type(ensemble).__name__
    node = F.col("nodeData")
    split = node["split"]
    stats = node["impurityStats"]
    share = F.get(stats, 1) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    leaf = node["leftChild"] < 0
    return (
        spark.read.parquet(f"{path}/data")
        .withColumnRenamed("treeID", "tree")
        .join(F.broadcast(weights), "tree")
        .select(
            F.lit(arm).alias("arm"),
            "tree",
            node["id"].alias("node"),
            F.when(leaf, -1).otherwise(split["featureIndex"]).alias("feature"),
            # A categorical split is refused below, by having no threshold.
            F.when(split["numCategories"] == -1, F.get(split["leftCategoriesOrThreshold"], 0))
            .alias("threshold"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            F.when(leaf, node["prediction"] if boosted else share).alias("value"),
            "weight",
            F.lit(LOGISTIC if boosted else MEAN).alias("link"),
        )
    )


def node_table(spark: SparkSession, model: TreeModel) -> DataFrame:
    """Both arms of a fitted T-learner."""
    return _arm_nodes(spark, model.treated, 1).unionByName(_arm_nodes(spark, model.control, 0))


def write_table(nodes: DataFrame, path: str) -> str:
    """Save a node table as one small Parquet folder."""
    nodes.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> "TableModel":
    return table_model(spark.read.schema(SCHEMA).parquet(path))


@dataclass(frozen=True)
class Ensemble:
    """The trees of an arm one after another: every list has one entry per node."""

    roots: list[int]
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    vote: list[float]
    depth: int
    link: str

    def probability(self, inputs: Column) -> Column:
        """Walk every tree from its root to a leaf, add up the leaves' votes."""
        feature, threshold = _constant(self.feature, "int"), _constant(self.threshold, "double")
        left, right = _constant(self.left, "int"), _constant(self.right, "int")
        vote = _constant(self.vote, "double")
        steps = F.array_repeat(F.lit(0), self.depth)

        def step(at: Column, _: Column) -> Column:
            asked = F.get(feature, at)
            below = F.get(inputs, asked) <= F.get(threshold, at)
            return F.when(asked < 0, at).when(below, F.get(left, at)).otherwise(F.get(right, at))

        total = F.aggregate(
            _constant(self.roots, "int"),
            F.lit(0.0),
            lambda sum_, root: sum_ + F.get(vote, F.aggregate(steps, root, step)),
        )
        if self.link == LOGISTIC:
            return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))
        return total / F.lit(float(len(self.roots)))


def _constant(values: Sequence, kind: str) -> Column:
    """An array of the plan from one literal, folded once by the optimizer."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


@dataclass(frozen=True)
class TableModel:
    """Scores like the models it was read from."""

    arms: dict[int, Ensemble]
    columns: tuple[str, ...] = tuple(C.FEATURE_COLUMNS)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add p_treatment, p_control and uplift to every row: a narrow map.

        A missing input goes right at every split that asks for it, as NaN does in Spark ML.
        """
        inputs = F.array(*[F.col(c).cast("double") for c in self.columns])
        scored = df.withColumns(
            {name: self.arms[arm].probability(inputs) for arm, name in ARMS.items()}
        )
        return scored.withColumn("uplift", F.col("p_treatment") - F.col("p_control"))


def table_model(nodes: DataFrame, columns: Sequence[str] = C.FEATURE_COLUMNS) -> TableModel:
    """Check a node table and make it scoreable. Its rows, ``MOST_NODES`` at most, are read by the
    driver; more are refused, as is whatever is no set of whole trees."""
    rows = nodes.select(T.StructType.fromDDL(SCHEMA).names).limit(MOST_NODES + 1).collect()
    if len(rows) > MOST_NODES:
        raise TableError(f"more than {MOST_NODES} nodes")
    arms: dict[int, dict[tuple[int, int], object]] = {arm: {} for arm in ARMS}
    for r in rows:
        if r.arm not in arms or (r.tree, r.node) in arms[r.arm]:
            raise TableError(f"unknown arm or repeated node: {r}")
        arms[r.arm][r.tree, r.node] = r
    return TableModel({a: _ensemble(held, len(columns)) for a, held in arms.items()}, tuple(columns))


def _ensemble(held: dict, width: int) -> Ensemble:
    if not held:
        raise TableError("an arm has no trees")
    links = {r.link for r in held.values()}
    if len(links) > 1 or not links <= {LOGISTIC, MEAN}:
        raise TableError(f"links {sorted(map(str, links))}")
    order = sorted(held)
    place = {key: i for i, key in enumerate(order)}
    roots, depth, seen = [], 0, set()
    for tree in sorted({t for t, _ in order}):
        if (tree, 0) not in held:
            raise TableError(f"tree {tree} has no root")
        roots.append(place[tree, 0])
        level = [0]
        for reached in range(len(order) + 1):
            seen |= {(tree, n) for n in level}
            depth = max(depth, reached)
            inner = [held[tree, n] for n in level if held[tree, n].feature >= 0]
            level = [n for r in inner for n in (r.left, r.right)]
            if not level:
                break
            if any((tree, n) not in held or (tree, n) in seen for n in level):
                raise TableError(f"tree {tree} is not whole")
            if any(r.threshold is None or r.feature >= width for r in inner):
                raise TableError(f"tree {tree} has a split without threshold or input")
    if len(seen) < len(held):
        raise TableError("nodes that no root leads to")
    rows = [held[key] for key in order]
    if any(r.feature < 0 and r.value is None for r in rows):
        raise TableError("a leaf has no value")
    child = lambda r, n: place[r.tree, n] if r.feature >= 0 else -1
    return Ensemble(
        roots,
        [r.feature for r in rows],
        [r.threshold if r.feature >= 0 else 0.0 for r in rows],
        [child(r, r.left) for r in rows],
        [child(r, r.right) for r in rows],
        [(r.value * (r.weight if r.link == LOGISTIC else 1.0)) if r.feature < 0 else 0.0 for r in rows],
        depth,
        links.pop(),
    )
