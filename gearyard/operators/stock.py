"""Stock counts, breakdowns and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearyard.functions.text import has_text
from gearyard.operators.views import (
    DESCRIPTORS,
    LATEST,
    availability_rows,
    availability_weights,
    enrich,
    folded_code,
    live_stock,
    unsold_items,
)
from gearyard.sources.tables import Tables


def _kpis(rows: DataFrame, weight) -> DataFrame:
    def counted(flag):
        return F.coalesce(F.sum(F.when(flag, weight)), F.lit(0)).cast("bigint")

    return rows.agg(
        counted(F.col("is_available") == 1).alias("available"),
        counted(F.col("is_available") == 0).alias("sold"),
        counted(F.lit(True)).alias("total"),
    )


def kpis(view: DataFrame) -> DataFrame:
    """available, sold, total over any view with an availability flag."""
    return _kpis(view, F.lit(1))


def kpi_stock(tables: Tables) -> DataFrame:
    return _kpis(availability_weights(tables), F.col("n_rows"))


def availability_counts(tables: Tables) -> DataFrame:
    return availability_weights(tables).groupBy("is_available").agg(F.sum("n_rows").alias("n"))


def latest_dispatched(tables: Tables, n: int = 5) -> DataFrame:
    """The n availability rows dispatched last; only those n meet the type tables."""
    narrow = availability_rows(tables, tables["items"].select("item_id", "code", "type_id"))
    order = [F.desc_nulls_last("last_dispatch_at"), F.asc("item_id"), F.asc_nulls_last("last_sale_price")]
    return enrich(narrow.orderBy(*order).limit(n), tables).select(
        "item_id", "code", "brand", "energy", "is_available", "last_dispatch_at", "last_sale_price"
    ).orderBy(*order)


def stock_by_code(tables: Tables, rule: str = LATEST) -> DataFrame:
    items = tables["items"].filter(has_text(F.col("code")))
    return live_stock(tables, items, rule).groupBy(folded_code().alias("code")).agg(F.count(F.lit(1)).alias("stock"))


def stock_breakdown(tables: Tables, rule: str = LATEST) -> DataFrame:
    """Live stock by brand and energy, counted per type before the type join."""
    per_type = live_stock(tables, rule=rule).groupBy("type_id").agg(F.count(F.lit(1)).alias("n"))
    return enrich(per_type, tables).groupBy("brand", "energy").agg(F.sum("n").alias("n"))


def _filled(column: str):
    return F.col(column).isNotNull() & (F.col(column) != "")


def top_brands_stock(breakdown: DataFrame, k: int = 15) -> DataFrame:
    brands = breakdown.filter(_filled("brand")).groupBy("brand").agg(F.sum("n").alias("n"))
    return brands.orderBy(F.desc("n"), F.asc("brand")).limit(k)


def energy_share(breakdown: DataFrame) -> DataFrame:
    """Stock by energy with its share of the total."""
    filled = breakdown.filter(_filled("energy"))
    total = filled.agg(F.sum("n").cast("double")).scalar()
    return (
        filled.groupBy("energy").agg(F.sum("n").alias("n"))
        .select("energy", "n", F.try_divide(F.col("n").cast("double"), total).alias("share"))
    )


def price_histogram(tables: Tables, bins: int = 40, rule: str = LATEST) -> DataFrame:
    """Equal-width bins over the positive purchase prices of available items."""
    price = F.col("purchase_price").cast("double")
    prices = unsold_items(tables, tables["items"].filter(F.col("purchase_price") > 0), rule).select(price.alias("price"))
    bounds = prices.agg(F.struct(F.min("price").alias("low"), F.max("price").alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    width = (high - low) / F.lit(float(bins))
    slot = F.coalesce(F.floor(F.try_divide(F.col("price") - low, width)), F.lit(0)) + 1
    # Prices are almost all different: they are binned as they come, a few partial rows per task.
    binned = prices.groupBy(F.least(slot, F.lit(bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return binned.select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("lo"),
        (low + F.col("bin") * width).alias("hi"),
        "n",
    )


def code_info(tables: Tables) -> DataFrame:
    """Largest descriptor values per code, each on its own.

    Repeated availability rows cannot change a maximum, so only distinct
    (code, type) pairs meet the type tables and no dispatch is read.
    """
    pairs = (
        tables["items"].filter(has_text(F.col("code")))
        .select(folded_code().alias("code"), "type_id").distinct()
    )
    return enrich(pairs, tables).groupBy("code").agg(*[F.max(c).alias(c) for c in DESCRIPTORS])
