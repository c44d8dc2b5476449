"""A join that spreads hot keys of its left side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than 1/HOT_SHARE of all rows is hot: fewer than HOT_SHARE keys can be.
HOT_SHARE = 1000
# Below this many rows of one key, a single task handles it easily.
HOT_ROWS = 100_000


def _matches(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(keys…, _salts) of the hot keys: always fewer than HOT_SHARE rows.

    The counts are combined before their shuffle, so that they do not suffer
    from the skew they look for.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = F.col("_n") * F.lit(float(HOT_SHARE)) / counts.agg(F.sum("_n")).scalar()
    return (
        counts.withColumn("_salts", F.ceil(share).cast("int"))
        .filter((F.col("_salts") > 1) & (F.col("_n") > hot_rows))
        .select(*keys, "_salts")
    )


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, spread: Sequence[str],
                null_safe: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` joined (inner or left) to ``right`` on ``keys``, all columns of
    both, the keys once.

    Adaptive execution splits a hot partition only where a shuffle lies right
    below both sides of a join. Where the right side comes out of an aggregate
    it does not; there this join cuts the left rows of a hot key by a hash of
    the ``spread`` columns and repeats that key's right rows for every cut.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    hot = F.broadcast(hot_keys(left, keys, hot_rows).alias("h"))  # fewer than HOT_SHARE rows

    def looked_up(rows: DataFrame, side: str) -> DataFrame:
        return rows.alias(side).join(hot, _matches(side, "h", keys, True), "left")

    salted = looked_up(left, "l").select(
        "l.*", F.pmod(F.xxhash64(*[F.col(f"l.{c}") for c in spread]), F.coalesce(F.col("_salts"), F.lit(1)))
        .cast("int").alias("_salt")
    )
    repeated = looked_up(right, "r").select(
        "r.*", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)).alias("_salt")
    )
    condition = _matches("l", "r", keys, null_safe) & (F.col("l._salt") == F.col("r._salt"))
    extra = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return salted.alias("l").join(repeated.alias("r"), condition, how).select(
        *[F.col(f"l.{c}") for c in left.columns], *extra
    )
