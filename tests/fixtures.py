"""Small hand-made canonical tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearyard.sources.schema import TABLES


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """A canonical table from partial rows; absent columns are NULL."""
    columns = TABLES[name]
    text = [{c: None if row.get(c) is None else str(row[c]) for c in columns} for row in rows]
    raw = spark.createDataFrame(text, ", ".join(f"{c} string" for c in columns))
    return raw.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns.items()])


def tables(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    return {name: table(spark, name, rows.get(name, [])) for name in TABLES}


def values(df: DataFrame, *columns: str) -> list[tuple]:
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    return [tuple(plain(v) for v in row) for row in df.select(*columns).collect()]


def column_of(spark: SparkSession, texts: list, expression) -> list:
    """Results of a column expression over texts, in their order."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]
