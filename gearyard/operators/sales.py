"""Recent sales and their rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.clock import month_of, months_before
from gearyard.functions.text import has_text
from gearyard.operators.views import enrich, folded_code, latest_ties
from gearyard.sources.tables import Tables


def recent_dispatches(tables: Tables, as_of, n_months: int, name: str = "dispatches") -> DataFrame:
    """Dispatches since ``n_months`` before ``as_of``; later dates count too."""
    return tables[name].filter(F.col("validated_at") >= months_before(as_of, n_months))


def _month(day: str) -> Column:
    return month_of(day).alias("month")


def _item_days(dispatches: DataFrame) -> DataFrame:
    """Dispatches per item and day, so that the item join sees no hot item."""
    return dispatches.groupBy("item_id", F.to_date("validated_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def sales_recent(tables: Tables, as_of, n_months: int = 3) -> DataFrame:
    """Sales by day, month, code, brand and energy.

    A sale counts once per availability row of its item, i.e. once per dispatch
    at the item's latest date. That date lies in the window whenever any sale
    does, so the weight comes from the windowed dispatches alone.
    """
    recent = recent_dispatches(tables, as_of, n_months).select("item_id", "validated_at")
    items = tables["items"].select("item_id", folded_code().alias("code"), "type_id")
    per_type = (
        _item_days(recent).join(latest_ties(recent), "item_id").join(items, "item_id")
        .groupBy("day", "code", "type_id").agg(F.sum(F.col("n") * F.col("n_ties")).alias("n"))
    )
    return (
        enrich(per_type, tables).groupBy("day", "code", "brand", "energy").agg(F.sum("n").alias("n_sold"))
        .select("day", _month("day"), "code", "brand", "energy", "n_sold")
    )


def sales_recent_by_type(tables: Tables, as_of, n_months: int = 3) -> DataFrame:
    """Sales by day, month and type, with the three-character type prefix."""
    per_type = (
        _item_days(recent_dispatches(tables, as_of, n_months))
        .join(tables["items"].select("item_id", "type_id"), "item_id")
        .groupBy("day", "type_id").agg(F.sum("n").alias("n"))
    )
    return (
        enrich(per_type, tables).filter(has_text(F.col("type_name")))
        .groupBy("day", "type_name", "brand", "energy").agg(F.sum("n").alias("n_sold"))
        .select("day", _month("day"), "type_name", "brand", "energy",
                F.substring("type_name", 1, 3).alias("type_prefix"), "n_sold")
    )


def sales_recent_gearboxes(tables: Tables, as_of, n_months: int = 3) -> DataFrame:
    recent = recent_dispatches(tables, as_of, n_months, "gearbox_dispatches")
    return (
        recent.groupBy(F.to_date("validated_at").alias("day"), "gearbox_id").agg(F.count(F.lit(1)).alias("n_sold"))
        .select("day", _month("day"), F.col("gearbox_id").cast("string").alias("gearbox_code"), "n_sold")
    )


def _sold_by(sales: DataFrame, key: str) -> DataFrame:
    return sales.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n_sold").alias("n_sold"))


def _top(ranked: DataFrame, key: str, k: int) -> DataFrame:
    return ranked.orderBy(F.desc("n_sold"), F.asc(key)).limit(k)


def sales_by_month(sales: DataFrame) -> DataFrame:
    return _sold_by(sales, "month").orderBy("month")


def top_codes(sales: DataFrame, k: int = 20, key: str = "code") -> DataFrame:
    """Best-selling codes; ``key`` is ``gearbox_code`` for gearbox sales."""
    return _top(_sold_by(sales, key), key, k)


def top_types(sales: DataFrame, k: int = 20) -> DataFrame:
    return _top(_sold_by(sales, "type_prefix"), "type_prefix", k)


def top_brands_sold(sales: DataFrame, k: int = 15) -> DataFrame:
    return _top(_sold_by(sales.filter(F.col("brand") != ""), "brand"), "brand", k)


def sales_detail(sales: DataFrame) -> DataFrame:
    rest = [F.asc_nulls_last(c) for c in sales.columns if c not in ("month", "n_sold")]
    return sales.orderBy(F.desc("month"), F.desc("n_sold"), *rest)
