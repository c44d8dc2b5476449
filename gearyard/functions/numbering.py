"""Dense serial numbers without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 3
BUCKETS = 16**_DIGITS
_CHUNK = 10_000


def copies(rows: DataFrame, first: Column, last: Column, out: str) -> DataFrame:
    """Each row once for every number from ``first`` to ``last``.

    In two steps, so that no array is longer than a chunk however many copies
    a row stands for.
    """
    chunks = rows.withColumn("_last", last).withColumn("_chunk", F.explode(F.sequence(first, F.col("_last"), F.lit(_CHUNK))))
    numbers = F.sequence(F.col("_chunk"), F.least(F.col("_chunk") + (_CHUNK - 1), F.col("_last")))
    return chunks.withColumn(out, F.explode(numbers)).drop("_last", "_chunk")


def dense_numbers(rows: DataFrame, key: Column, out: str, order: Sequence[str] | None = None,
                  start: Column | None = None) -> DataFrame:
    """Number all rows 1, 2, 3, … after ``start``.

    Rows spread over a fixed number of md5 buckets of ``key``; each bucket is
    numbered on its own and shifted by the size of the buckets before it (a
    running sum over at most ``BUCKETS`` rows). Identical rows are collapsed to
    one row with a count first, so a hot group of copies stays one row until
    its numbers are known. Everything depends on row content only, so a
    recomputed task yields the same numbers.
    """
    columns = rows.columns
    order = list(order or columns)
    grouped = (
        rows.withColumn("_bucket", F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, _DIGITS))
        .groupBy("_bucket", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    sizes = grouped.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    base = F.lit(0) if start is None else F.coalesce(start, F.lit(0))
    placed = grouped.withColumn("_end", F.sum("_copies").over(within)).join(F.broadcast(shifts), "_bucket")  # at most BUCKETS rows
    return copies(placed, F.col("_end") - F.col("_copies") + 1, F.col("_end"), "_nth").select(
        (base + F.col("_shift") + F.col("_nth")).cast("bigint").alias(out), *columns
    )


def numbered_in_order(rows: DataFrame, order: Sequence[Column], out: str, folder: str) -> DataFrame:
    """Rows numbered 1, 2, 3, … in a total order, without all of them in one task.

    Sorted by ranges and written to ``folder`` with the place in the range: drawn
    again, the ranges could differ. A running sum over the ranges' sizes (a row
    for each range) gives the rest.
    """
    placed = rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(folder)
    kept = rows.sparkSession.read.schema(placed.schema).parquet(folder)
    part = F.shiftright("_place", 33)  # as the function is defined: the partition, then 33 bits of row number
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    number = F.col("_shift") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return kept.withColumn("_part", part).join(F.broadcast(shifts), "_part").select(*rows.columns, number.alias(out))
