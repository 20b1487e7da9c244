"""Intermediate results that are read more than once, kept on storage all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of its own. A cluster session
    without the setting is refused, since no machine's own disk outlives its executor. A
    ``file:`` folder is taken as a mount that all machines share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="counterfoil-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/counterfoil/{spark.sparkContext.applicationId}"


#: Where the paths made by the innermost ``settled`` are noted.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once as Parquet and read back.

    Cuts the lineage like a checkpoint, and later passes still prune columns and push
    filters. A lost executor costs a re-read, not a recomputation of the base tables.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(
    spark: SparkSession, build: Callable[[], DataFrame], label: str
) -> tuple[DataFrame, str]:
    """What ``build`` returns, stored, and its path; what was stored on the way is deleted."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        df = build()
        _MADE.reset(token)
        path = new_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path
    finally:
        if _MADE.get() is made:
            _MADE.reset(token)
        for old in made:
            delete(spark, old)


def delete(spark: SparkSession, path: str) -> None:
    """Tables read from there end with it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a plan constant: no job, and a size the optimizer knows."""
    columns = [
        pa.array([row[i] for row in rows], type=to_arrow_type(f.dataType))
        for i, f in enumerate(schema)
    ]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


#: Estimated bytes up to which a side is broadcast.
SMALL_BYTES = 32 << 20


def small_side(df: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint if the optimizer's estimate of its bytes is small.

    ``bound`` is a table with at least as many rows, whose estimate is nearer to the truth than
    that of a join. The estimate comes from file sizes, limits and constants; no job runs. A
    larger side is left to Spark.
    """
    plan = (bound if bound is not None else df)._jdf.queryExecution().optimizedPlan()
    few = int(str(plan.stats().sizeInBytes())) <= SMALL_BYTES
    return F.broadcast(df) if few else df


def clear(spark: SparkSession) -> None:
    """Delete what this application has stored. Tables read from there end with it."""
    delete(spark, _own_folder(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """For jobs: what is stored inside the block is deleted at its end."""
    try:
        yield
    finally:
        clear(spark)
