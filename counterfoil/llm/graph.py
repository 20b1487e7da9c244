"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import salted_join
from counterfoil.sources.storage import store


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the least node.

    Each round every node points at the least node seen among its neighbours, and every link
    is replaced by one between the two nodes pointed at (alternating stars), so the number of
    rounds grows with the logarithm of a component's size. A node with very many links is
    dealt out by ``salted_join``. The driver sees one count per round.
    """
    links = store(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        "links",
    )
    nodes = store(
        links.select(F.col("a").alias("node")).unionAll(links.select("b")).distinct(), "nodes"
    )
    while not nodes.isEmpty():
        # Large star: neighbours above a node point at the least node around it.
        both = store(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("least"))
        large = store(
            salted_join(both.filter("b > a"), least, "a")
            .select(F.col("least").alias("a"), "b")
            .distinct(),
            "large-star",
        )
        # Small star: of a node's lower neighbours all point at the least one.
        least = large.groupBy("b").agg(F.min("a").alias("least"))
        told = salted_join(large, least, "b")
        small = store(
            told.select(F.col("least").alias("a"), "b")
            .unionAll(told.select(F.col("least").alias("a"), F.col("a").alias("b")))
            .filter("a < b")
            .distinct(),
            "small-star",
        )
        # A star forest: no node is both above one node and below another, none has two tops.
        tops = small.select("a").distinct()
        several = small.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        done = several.isEmpty() and small.join(tops.withColumnRenamed("a", "b"), "b", "semi").isEmpty()
        links = small
        if done:
            break
    return nodes.join(links.select(F.col("b").alias("node"), F.col("a").alias("label")), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")
    )
