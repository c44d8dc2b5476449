"""Words, shared scratch tables and small helpers of the text operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    """Number of words, without building a second array for the empty ends."""
    text = F.coalesce(text, F.lit(""))
    parts = F.split(text, SPACE)
    ends = F.when(F.size(parts) == 1, 0).otherwise((F.element_at(parts, -1) == "").cast("int"))
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ends).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Unset in local tests only, where driver and executors are one process; a
    folder made there goes into the setting, so that a session makes one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="gearyard-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, codec: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back.

    What follows is planned on measured sizes, runs the work above once, and
    outlives any executor. ``group_rows``: the most rows of a row group.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def bottom_k(rows: DataFrame, group: str, order: str, k: int, spare: float = 4.0) -> DataFrame:
    """The rows whose ``order`` (a 64-bit hash, distinct within ``group``) is
    among the ``k`` smallest of their group: exact, without a window over a
    whole group.

    Each group is counted; a cut at ``spare * k / n`` of the hash range leaves
    some ``spare * k`` of its n rows, which a window then ranks. A group left
    with fewer than ``min(k, n)`` is cut again with four times the range. A
    NULL group is a group of its own.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    place = (F.col(order).cast("double") + 9.223372036854775808e18) / 1.8446744073709551616e19
    kept, wanted = None, counts
    while True:
        cut = wanted.select(F.col(group).alias("_g"), "_n", F.least(F.lit(1.0), spare * k / F.col("_n")).alias("_cut"))
        near = rows.join(cut, rows[group].eqNullSafe(F.col("_g"))).filter(place <= F.col("_cut"))
        ranked = near.withColumn("_rank", F.row_number().over(Window.partitionBy("_g").orderBy(order)))
        part = ranked.filter(F.col("_rank") <= k)
        got = part.groupBy("_g").agg(F.count(F.lit(1)).alias("_got"), F.first("_n").alias("_n"), F.first("_cut").alias("_cut"))
        short = got.filter(F.col("_got") < F.least(F.lit(k), F.col("_n")))
        missing = cut.join(got.select(F.col("_g").alias("_h")), F.col("_g").eqNullSafe(F.col("_h")), "left_anti")
        again = short.select("_g", "_n", "_cut").unionByName(missing.select("_g", "_n", "_cut")).filter(F.col("_cut") < 1.0)
        done = part.join(again.select(F.col("_g").alias("_a")), F.col("_g").eqNullSafe(F.col("_a")), "left_anti")
        done = done.drop("_g", "_n", "_cut", "_rank")
        kept = done if kept is None else kept.unionByName(done)
        if again.isEmpty():
            return kept
        wanted = again.select(F.col("_g").alias(group), "_n")
        spare *= 4
