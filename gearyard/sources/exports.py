"""Export files: ingest, price catalogue, item export, CSV output."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearyard.functions.text import sanitize_table_name

# Doubled quotes inside quoted fields, and field spaces kept, as other tools write and read CSV.
_CSV = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "multiLine": "true",  # a quoted field may hold line breaks; a file is then read by one task
}

# Accepted headers of the catalogue's type column.
CATALOGUE_HEADERS = ("type moteur", "type_moteur", "typemoteur")
# Required headers of the item export, and our names for them.
ITEM_EXPORT_HEADERS = {"N_TypeMoteur": "type_id", "CodeMoteur": "code"}


def _export_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the ``*.csv`` entries (files or folders of parts) in a folder.

    Only paths are read, one per export file; no file content is loaded.
    """
    paths = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv").load(folder).select("path")
    )
    root = unquote(urlparse(folder).path).rstrip("/")
    entry = F.substring_index(F.element_at(F.split(F.col("path"), f"\\Q{root}/\\E"), -1), "/", 1)
    return sorted(unquote(row.entry) for row in paths.select(entry.alias("entry")).distinct().toLocalIterator())


def ingest_exports(spark: SparkSession, in_folder: str, out_folder: str,
                   schemas: dict[str, T.StructType | str] | None = None) -> DataFrame:
    """Store every export of a folder as a Parquet table, replacing older ones.

    Returns (table_name, n_rows, n_columns). An export may be one CSV file or a
    folder of CSV parts. Give ``schemas`` for large exports: without one, Spark
    reads the file twice to infer the types. A schema's columns are found in
    the header by name. Exports whose table names coincide are refused.
    """
    names = _export_names(spark, in_folder)
    if not names:
        raise FileNotFoundError(f"no .csv export in {in_folder}")
    tables = [sanitize_table_name(name.removesuffix(".csv")) for name in names]
    if twice := sorted({table for table in tables if tables.count(table) > 1}):
        raise ValueError(f"several exports would become {twice}")
    summary = []
    for name, table in zip(names, tables):
        reader = spark.read.options(**_CSV)
        schema = (schemas or {}).get(table)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            header = spark.read.options(**_CSV).csv(f"{in_folder.rstrip('/')}/{name}").columns
            if sorted(header) != sorted(schema.names):
                raise ValueError(f"{name} has columns {header}, its schema {schema.names}")
            reader = reader.schema(T.StructType([schema[column] for column in header]))
        target = f"{out_folder.rstrip('/')}/{table}"
        reader.csv(f"{in_folder.rstrip('/')}/{name}").write.mode("overwrite").parquet(target)
        stored = spark.read.parquet(target)
        summary.append((table, stored.count(), len(stored.columns)))
    return spark.createDataFrame(summary, "table_name string, n_rows bigint, n_columns int")


def catalogue_from(table: DataFrame) -> DataFrame:
    """The catalogue with its type column named ``type_text``; NULL rows out."""
    found = [name for name in table.columns if name.strip().lower() in CATALOGUE_HEADERS]
    if not found:
        raise ValueError(f"no type column in the catalogue: {table.columns}")
    return table.withColumnRenamed(found[0], "type_text").filter(F.col("type_text").isNotNull())


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    if kind == "csv":
        return spark.read.options(**_CSV).csv(path)
    return spark.read.format(kind).load(path)


def read_catalogue(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """A price catalogue stored as CSV, or any other format Spark reads by name."""
    return catalogue_from(_read(spark, path, kind))


def items_export_from(table: DataFrame) -> DataFrame:
    absent = [name for name in ITEM_EXPORT_HEADERS if name not in table.columns]
    if absent:
        raise ValueError(f"item export lacks {absent}")
    return table.select(*[F.col(name).alias(ours) for name, ours in ITEM_EXPORT_HEADERS.items()])


def read_items_export(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    return items_export_from(_read(spark, path, kind))


def write_csv(table: DataFrame, path: str) -> None:
    """UTF-8 CSV with a header, one part per task."""
    table.write.mode("overwrite").options(**_CSV).csv(path)


def read_written_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read what :func:`write_csv` wrote.

    NULL is written as nothing and an empty text as ``""``; naming another NULL
    text keeps the reader from taking both for NULL.
    """
    return spark.read.options(**_CSV).option("nullValue", "\u0000").schema(schema).csv(path)
