"""The six retail tables and the scored list: schemas, loading, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.sources.storage import local_table, store

SCHEMAS: dict[str, str] = {
    "customers": "customer_id string, customer_taxonomies string",
    "products": "product_id string, price double, cogs double, product_taxonomies string",
    "stores": "store_id string, store_taxonomies string",
    "promotions": (
        "promotion_id string, discount double, product_id string, start_date date, end_date date"
    ),
    "transactions": (
        "datetime timestamp_ntz, product_id string, price double, qty int, customer_id string, "
        "promotion_id string, store_id string, po_id string"
    ),
    "campaign": (
        "campaign_id string, customer_id string, promotion_id string, is_treatment int, "
        "bought_after_promo int"
    ),
}
#: Columns without which a row of a table says nothing.
KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "products": ["product_id", "price"],
    "stores": ["store_id"],
    "promotions": ["promotion_id", "product_id"],
    "transactions": ["datetime", "product_id", "price", "qty"],
    "campaign": ["customer_id", "promotion_id", "is_treatment"],
}
TRUTH_SCHEMA = "customer_id string, customer_taxonomies string, true_uplift_segment string"


class MissingInput(FileNotFoundError):
    """A table is absent, or lacks a column its schema names."""


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """Read one table with a declared schema; no inference pass over the data.

    Columns are matched by name, so a missing column is reported and an extra or reordered
    one does no harm. For CSV only the header line is looked at for that, and a value that
    does not parse stops the job; formats that carry types are cast to the declared ones.
    """
    declared = T.StructType.fromDDL(schema)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    try:
        present = reader.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"table not found: {path}") from error
        raise
    absent = [f.name for f in declared if f.name not in present.names]
    if absent:
        raise MissingInput(f"{path}: missing columns {absent}")
    if fmt != "csv":
        # Such files carry types; a cast to the same type disappears from the plan.
        return reader.format(fmt).load(path).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared]
        )
    by_name = {f.name: f for f in declared}
    in_file_order = T.StructType([by_name.get(f.name, f) for f in present])
    return reader.schema(in_file_order).format(fmt).load(path).select(*declared.names)


REJECTED = "rejected_line"


class TooManyRejects(ValueError):
    """More lines of a table are malformed than the job accepts."""


@dataclass(frozen=True)
class Checked:
    """A table's good rows, and the lines that do not parse, as they stand in the file."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejected: int


def read_checked(
    spark: SparkSession,
    path: str,
    schema: str,
    limit: float = 0.01,
    required: Sequence[str] = (),
) -> Checked:
    """Read a CSV table, malformed lines apart from good ones.

    A line is malformed if a value does not parse as the declared type, if it has another number
    of fields than the header, or if a ``required`` column is empty. ``rejects`` has the line and
    the file it is from. Beyond ``limit``, a share of all lines below 1 or else a number of lines,
    the job stops. The files are parsed once, into shared storage; counts come from there.
    """
    declared = T.StructType.fromDDL(schema)
    header = _csv_header(spark, path, declared)
    by_name = {f.name: f for f in declared}
    in_file_order = T.StructType([by_name.get(f.name, f) for f in header])
    whole = T.StructType([*in_file_order, T.StructField(REJECTED, T.StringType())])
    parsed = (
        spark.read.schema(whole)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )
    empty = reduce(Column.__or__, [F.col(c).isNull() for c in required], F.lit(False))
    names = in_file_order.names
    line = F.when(
        F.col(REJECTED).isNotNull() | empty,
        F.coalesce(REJECTED, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]))),
    )
    # All columns are needed to tell a malformed line, so they are parsed and kept together.
    kept = store(
        parsed.select(
            *declared.names, line.alias(REJECTED), F.col("_metadata.file_path").alias("file")
        ),
        "checked",
    )
    bad = F.col(REJECTED).isNotNull()
    total, rejected = kept.agg(F.count(F.lit(1)), F.count(REJECTED)).first()
    most = limit * total if limit < 1 else limit
    if rejected > most:
        raise TooManyRejects(f"{path}: {rejected} of {total} lines are malformed")
    return Checked(
        kept.filter(~bad).select(*declared.names),
        kept.filter(bad).select("file", REJECTED),
        total - rejected,
        rejected,
    )


def _csv_header(spark: SparkSession, path: str, declared: T.StructType) -> T.StructType:
    try:
        present = spark.read.option("header", True).csv(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"table not found: {path}") from error
        raise
    absent = [f.name for f in declared if f.name not in present.names]
    if absent:
        raise MissingInput(f"{path}: missing columns {absent}")
    return present


def reject_summary(tables: Mapping[str, Checked]) -> DataFrame:
    """Good and rejected lines per table."""
    session = next(iter(tables.values())).rows.sparkSession
    counts = [(name, t.n_rows, t.n_rejected) for name, t in sorted(tables.items())]
    schema = "table_name string, n_rows bigint, n_rejected bigint"
    return local_table(session, counts, T.StructType.fromDDL(schema))


def load_checked(
    spark: SparkSession,
    data_dir: str,
    limit: float = 0.01,
    files: Mapping[str, str] | None = None,
) -> dict[str, Checked]:
    """``load_catalog`` for CSV files that may hold malformed lines; ids must not be empty."""
    names = {table: f"{table}.csv" for table in SCHEMAS} | dict(files or {})
    return {
        table: read_checked(spark, f"{data_dir.rstrip('/')}/{names[table]}", schema, limit, KEYS[table])
        for table, schema in SCHEMAS.items()
    }


def load_catalog(
    spark: SparkSession,
    data_dir: str,
    files: Mapping[str, str] | None = None,
    fmt: str = "csv",
    views: bool = False,
    formats: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Load the six tables from ``data_dir``.

    ``files`` maps a table to its file or folder name; by default ``<table>.<format>``.
    ``formats`` names the formats of tables that differ from ``fmt``. With
    ``views`` each table is also registered as a temporary view for SQL.
    """
    kinds = dict.fromkeys(SCHEMAS, fmt) | dict(formats or {})
    names = {table: f"{table}.{kinds[table]}" for table in SCHEMAS} | dict(files or {})
    tables = {
        table: read_table(spark, f"{data_dir.rstrip('/')}/{names[table]}", schema, kinds[table])
        for table, schema in SCHEMAS.items()
    }
    if views:
        for table, df in tables.items():
            df.createOrReplaceTempView(table)
    return tables


def load_truth(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The true quadrant of each customer, where one is known."""
    return read_table(spark, path, TRUTH_SCHEMA, fmt)


def table_summary(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and key range of each (table, key column); keys are compared as given."""
    summary = None
    for name, (df, key) in tables.items():
        one = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(key).cast("string").alias("min_key"),
            F.max(key).cast("string").alias("max_key"),
        ).select(F.lit(name).alias("table_name"), "n_rows", "min_key", "max_key")
        summary = one if summary is None else summary.unionByName(one)
    return summary
