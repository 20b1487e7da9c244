"""Exact duplicates by content hash, with the texts of a group compared byte by byte.

One aggregation by ``(hash, text)`` does both: the hash is the 128-bit content hash that deals
the rows out, and the text in the grouping key keeps rows with equal hashes and different bytes
apart. Equal rows of one input partition meet before the shuffle, so a large group of copies
sends a few rows per task. All steps are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import ascii_lower, salted_join, whole_text
from counterfoil.sources.storage import store


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: its id, the id that stays, the group's size, kept, the digest.

    Texts are equal when identical after lower-casing A-Z. Null counts as empty, so null and
    empty texts are one group. The row with the largest (``keep="smallest"``: smallest) id
    stays; a null id stays only if its whole group has none. Rows with equal id and text are
    all marked as kept; ``deduplicate`` leaves one of them. Other columns are not read, so
    their names cannot clash. An empty table gives an empty result.
    """
    norm = ascii_lower(whole_text(text_column))
    rows = docs.select(F.col(id_column).alias("id"), norm.alias("norm")).withColumn(
        "hash", content_hash(F.col("norm"))
    )
    pick = F.max if keep == "largest" else F.min
    groups = rows.groupBy("hash", "norm").agg(
        pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = store(
        groups.select(
            "hash", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256")
        ),
        "exact-groups",
    )
    clashes = groups.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    if clashes.isEmpty():
        found = salted_join(rows.select("id", "hash"), groups, "hash")
    else:  # different texts under one hash: the digest tells their rows apart
        told = rows.select("id", F.sha2("norm", 256).alias("text_sha256"))
        found = salted_join(told, groups.drop("hash"), "text_sha256")
    return found.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.expr("id <=> keep_id").alias("kept"),
        "text_sha256",
    )


def deduplicate(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
) -> DataFrame:
    """The rows that stay, with all their columns.

    The same groups as ``exact_groups``, in one shuffle: the whole row that stays travels with
    its group. Among rows with equal id and text the largest by the remaining columns stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = [
        F.col(f"`{f.name}`")
        for f in docs.schema
        if f.name not in (id_column, text_column) and f.dataType.typeName() not in ("map", "variant")
    ]
    # Nulls sort first; so a null id loses to any other if the largest stays.
    order = F.struct(F.col(id_column), F.col(text_column), *plain)
    if keep != "largest":
        order = F.struct(F.col(id_column).isNull(), F.col(id_column), F.col(text_column), *plain)
    pick = F.max_by if keep == "largest" else F.min_by
    norm = ascii_lower(whole_text(text_column))
    return (
        docs.select(
            F.md5(norm).alias("hash"),
            norm.alias("norm"),
            F.struct(*columns).alias("row"),
            order.alias("order"),
        )
        .groupBy("hash", "norm")
        .agg(pick("row", "order").alias("row"))
        .select("row.*")
    )
