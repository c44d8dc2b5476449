"""Demand ranking: what sold recently against what is left in stock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.clock import months_before
from gearyard.functions.measures import mean, round_half_away, round_half_even
from gearyard.functions.text import has_text
from gearyard.operators.sales import recent_dispatches
from gearyard.operators.views import DESCRIPTORS, LATEST, enrich, folded_code, live_stock
from gearyard.sources.tables import Tables, select_existing

PAGE_SIZE = 20


def _sold_items(tables: Tables, as_of) -> DataFrame:
    """Dispatches of the last three months per item.

    Counting by item first is combined before the shuffle the item join needs
    anyway, so an item with very many dispatches costs one row per task.
    """
    return recent_dispatches(tables, as_of, 3).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


def _first(rows: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    """The first n rows of an order; all, unordered, for None."""
    return rows if n is None else rows.orderBy(*order).limit(n)


def _only(rows: DataFrame, key: Column, top: DataFrame, key_name: str) -> DataFrame:
    """Rows whose key is in the top list: what the list cannot use is dropped
    before its shuffle. Adaptive execution broadcasts a list it finds small."""
    wanted = top.select(F.col(key_name).alias("_wanted")).distinct()
    return rows.join(wanted, key == F.col("_wanted"), "left_semi")


def _purchases(tables: Tables, as_of, top: DataFrame) -> DataFrame:
    """Average purchase price of 3, 6 and 12 months per code.

    Older lots only ever add NULL to these averages, so lots are cut at 12
    months; a code without a lot is NULL after the left join either way.
    """
    lots = tables["receipts"].filter(F.col("purchased_at") >= months_before(as_of, 12))
    bought = _only(
        tables["items"].filter(F.col("purchase_price").isNotNull()), folded_code(), top, "code"
    ).select("receipt_id", folded_code().alias("code"), "purchase_price")

    def average(months: int) -> Column:
        price = F.when(F.col("purchased_at") >= months_before(as_of, months), F.col("purchase_price"))
        return round_half_away(mean(F.sum(price), F.count(price)), 2).alias(f"avg_purchase_{months}m")

    return (
        bought.join(lots.select("receipt_id", "purchased_at"), "receipt_id")
        .groupBy("code").agg(average(3), average(6), average(12))
    )


def _stock(tables: Tables, top: DataFrame, rule: str) -> DataFrame:
    items = _only(tables["items"], folded_code(), top, "code")
    per_type = (
        live_stock(tables, items, rule).groupBy(folded_code().alias("code"), "type_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return enrich(per_type, tables).groupBy("code").agg(
        *[F.max(c).alias(c) for c in DESCRIPTORS], F.sum("n").alias("stock")
    )


def urgency(sold: Column, stock: Column) -> Column:
    return round_half_even(sold.cast("double") / (stock + 1).cast("double"), 2)


def urgency_tier(score: Column) -> Column:
    return F.when(score > 5, "very urgent").when(score > 2, "urgent").otherwise("normal")


def _ranked(needs: DataFrame) -> DataFrame:
    return needs.orderBy(*need_order(needs))


def need_order(needs: DataFrame) -> list[Column]:
    """Most urgent first, then most sold; keys settle ties."""
    keys = [c for c in ("code", "gearbox_code", "type_name", "type_prefix") if c in needs.columns]
    return [F.desc("urgency"), F.desc("sold_3m"), *[F.asc_nulls_last(c) for c in keys]]


def _with_details(top: DataFrame, tables: Tables, as_of, rule: str) -> DataFrame:
    joined = (
        top.join(_purchases(tables, as_of, top), "code", "left")
        .join(_stock(tables, top, rule), "code", "left")
    )
    filled = {c: F.coalesce(F.col(c), F.lit("")) for c in DESCRIPTORS}
    return joined.withColumns({**filled, "stock": F.coalesce(F.col("stock"), F.lit(0)).cast("bigint")}).withColumn(
        "urgency", urgency(F.col("sold_3m"), F.col("stock"))
    )


def needs_items(tables: Tables, as_of, top_n: int | None = 50, rule: str = LATEST) -> DataFrame:
    """The ``top_n`` best-selling codes of three months (None: all), most urgent first.

    The list is cut by sales before it is sorted by urgency. Cutting it first
    is also what keeps the plan small: purchases and stock are then only
    gathered for the listed codes. A NULL code is listed but matches no stock.
    """
    sold = (
        _sold_items(tables, as_of)
        .join(tables["items"].select("item_id", folded_code().alias("code")), "item_id")
        .groupBy("code").agg(F.sum("n").alias("sold_3m"))
    )
    top = _first(sold, [F.desc("sold_3m"), F.asc_nulls_last("code")], top_n)
    return _ranked(_with_details(top, tables, as_of, rule).select(
        "code", *DESCRIPTORS, "sold_3m", "stock",
        "avg_purchase_3m", "avg_purchase_6m", "avg_purchase_12m", "urgency",
    ))


def needs_items_by_type(tables: Tables, as_of, top_n: int | None = 50, rule: str = LATEST) -> DataFrame:
    """Needs by (code, type); stock and prices stay per code, so they repeat."""
    items = tables["items"].filter(has_text(F.col("code"))).select("item_id", folded_code().alias("code"), "type_id")
    sold = (
        _sold_items(tables, as_of).join(items, "item_id")
        .groupBy("code", "type_id").agg(F.sum("n").alias("sold_3m"))
    )
    top = _first(sold, [F.desc("sold_3m"), F.asc("code"), F.asc_nulls_last("type_id")], top_n)
    detailed = _with_details(top, tables, as_of, rule)
    return _ranked(detailed.select(
        "code", F.substring("type_name", 1, 3).alias("type_prefix"), *DESCRIPTORS, "sold_3m", "stock",
        "avg_purchase_3m", "avg_purchase_6m", "avg_purchase_12m", "urgency",
    ))


def needs_gearboxes(tables: Tables, as_of, top_n: int | None = 50) -> DataFrame:
    box = F.col("gearbox_id").cast("string")
    sold = (
        recent_dispatches(tables, as_of, 3, "gearbox_dispatches")
        .groupBy(box.alias("gearbox_code")).agg(F.count(F.lit(1)).alias("sold_3m"))
    )
    top = _first(sold, [F.desc("sold_3m"), F.asc_nulls_last("gearbox_code")], top_n)
    free = tables["gearboxes"].filter(F.col("in_stock") & ~F.coalesce(F.col("sold"), F.lit(False)))
    stock = (
        _only(free, box, top, "gearbox_code")
        .groupBy(box.alias("gearbox_code")).agg(F.count(F.lit(1)).alias("stock"))
    )
    needs = top.join(stock, "gearbox_code", "left").withColumn("stock", F.coalesce(F.col("stock"), F.lit(0)).cast("bigint"))
    return _ranked(needs.withColumn("urgency", urgency(F.col("sold_3m"), F.col("stock"))))


def urgency_scores(needs: DataFrame) -> DataFrame:
    return needs.select("code", "urgency")


def urgency_tiers(needs: DataFrame) -> DataFrame:
    return needs.select("code", "urgency", urgency_tier(F.col("urgency")).alias("tier"))


def needs_summary(needs: DataFrame) -> DataFrame:
    price = F.col("avg_purchase_3m").cast("decimal(18,2)")  # two decimals already: an exact sum
    return needs.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count(F.when(F.col("urgency") > 5, 1)).alias("n_urgent"),
        mean(F.sum(price), F.count(price)).alias("avg_price_3m"),
    )


def needs_top_urgent(needs: DataFrame, k: int = 20) -> DataFrame:
    return _ranked(needs).limit(k)


def urgency_by_type(needs: DataFrame, k: int = 50, key: str = "type_prefix") -> DataFrame:
    best = needs.groupBy(key).agg(F.max("urgency").alias("urgency"))
    return best.orderBy(F.desc("urgency"), F.asc_nulls_last(key)).limit(k)


def needs_page(needs: DataFrame, page: int, size: int = PAGE_SIZE) -> DataFrame:
    return _ranked(needs).offset((page - 1) * size).limit(size)


def needs_table(needs: DataFrame) -> DataFrame:
    """The columns a needs list shows, in display order, as far as it has them."""
    return select_existing(needs, ["code", "gearbox_code", "sold_3m", "stock", "urgency", *DESCRIPTORS])


def needs_pages(needs: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """One row: how many pages there are, at least one."""
    return needs.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).cast("bigint").alias("pages"))
