"""Reading, writing and probing the canonical tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearyard.sources.schema import OPTIONAL_OFFER_COLUMNS, TABLES, ddl

Tables = Mapping[str, DataFrame]


def load_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One lazy DataFrame per canonical table stored under ``folder``."""
    return {
        name: spark.read.schema(ddl(name)).parquet(f"{folder.rstrip('/')}/{name}") for name in TABLES
    }


# Tables read through a time window, with their time and a column that tells equal times apart.
_CLUSTERED = {
    "dispatches": ("validated_at", "item_id"),
    "gearbox_dispatches": ("validated_at", "gearbox_id"),
    "receipts": ("purchased_at", "receipt_id"),
    "targeted_offers": ("created_at", "id"),
    "free_offers": ("created_at", "id"),
}


def save_tables(tables: Tables, folder: str) -> None:
    """Store the canonical tables as Parquet.

    Tables that are read through a time window are clustered by time, so that
    file and row-group statistics skip what lies before the window. The second
    range column lets one very frequent moment fill several files.
    """
    for name, schema in TABLES.items():
        rows = tables[name].select(*[F.col(column).cast(kind) for column, kind in schema.items()])
        if name in _CLUSTERED:
            rows = rows.repartitionByRange(*_CLUSTERED[name]).sortWithinPartitions(*_CLUSTERED[name])
        rows.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def save_colocated(tables: Tables, database: str, buckets: int) -> None:
    """Store items, receipts and dispatches as bucketed tables.

    Items and dispatches share buckets of the item key, so the item joins of
    every sales, stock and availability report read them without a shuffle.
    """
    for name, key in (("items", "item_id"), ("dispatches", "item_id"), ("receipts", "receipt_id")):
        (
            tables[name].repartition(buckets, key)
            .write.mode("overwrite").format("parquet")
            .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")
        )


def load_colocated(spark: SparkSession, database: str, others: Tables) -> dict[str, DataFrame]:
    """``others`` with the bucketed tables of :func:`save_colocated` in place."""
    stored = {name: spark.table(f"{database}.{name}") for name in ("items", "dispatches", "receipts")}
    return {**others, **stored}


def table_counts(tables: Tables, names: list[str] | None = None) -> DataFrame:
    """(table_name, n_rows) of the named tables, by default the core four."""
    names = names or ["items", "item_types", "brands", "dispatches"]
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def table_peek(table: DataFrame, order: list[str] | None = None, rows: int = 5) -> DataFrame:
    """A few rows of a table: any that come first, or, at the cost of a scan,
    the first in a stated order so that the peek is repeatable."""
    return (table.orderBy(*order) if order else table).limit(rows)


def add_missing_columns(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The table with any absent optional text column added as NULL."""
    columns = OPTIONAL_OFFER_COLUMNS if columns is None else columns
    absent = {name: F.lit(None).cast("string") for name in columns if name not in table.columns}
    return table.withColumns(absent) if absent else table


def select_existing(table: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted columns the table has, in the wanted order."""
    return table.select(*[name for name in columns if name in table.columns])


def run_query(spark: SparkSession, text: str, params: dict | None = None) -> DataFrame:
    """Run one read-only query with named ``:markers`` on the registered views.

    The text runs as a subquery, where no statement but a query can stand.
    """
    head = text.lstrip().split(None, 1)[0].upper() if text.strip() else ""
    if head not in {"SELECT", "WITH"}:
        raise ValueError("only SELECT or WITH queries are allowed")
    return spark.sql(f"SELECT * FROM (\n{text.rstrip().rstrip(';')}\n)", args=params or {})
