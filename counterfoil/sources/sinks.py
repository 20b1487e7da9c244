"""Writing lists for other tools and reading a saved list back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.functions import constants as C


def write_list(rows: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write a list as a folder of part files, each in the row order given.

    Part files are not read back in the order of writing: give ``read_list`` the order.
    """
    writer = rows.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def read_list(
    spark: SparkSession, path: str, schema, fmt: str = "csv", order: Sequence[Column] = ()
) -> DataFrame:
    """A saved list, sorted by ``order``."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return _sorted(reader.load(path), order)


def _sorted(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    return rows.orderBy(*order) if order else rows


def export_targets(
    rows: DataFrame, path: str, fmt: str = "csv", order: Sequence[Column] = ()
) -> str:
    """Only the customers to contact, sorted, for the tool that sends the messages."""
    targets = rows.filter(F.col("recommended_action") == C.TARGET)
    return write_list(_sorted(targets, order), path, fmt)


def saved_or_computed(
    spark: SparkSession,
    path: str,
    compute: Callable[[], DataFrame],
    order: Sequence[Column] = (),
) -> DataFrame:
    """The list saved at ``path``, sorted; computed and saved there first when it is absent.

    A folder without data, as a write that died leaves it, counts as absent.
    """
    try:
        return _sorted(spark.read.parquet(path), order)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    write_list(compute(), path, "parquet")
    return _sorted(spark.read.parquet(path), order)
