"""Price trends and movers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.clock import month_of, months_before
from gearyard.functions.measures import mean, round_half_away
from gearyard.functions.text import has_text
from gearyard.operators.sales import recent_dispatches
from gearyard.operators.views import DESCRIPTORS, folded_code
from gearyard.sources.tables import Tables

MOVER_COLUMNS = ["n_recent", "n_prev", "avg_prev", "avg_recent", "delta", "pct"]


def _average(column: str) -> Column:
    return mean(F.sum(column), F.count(column))


def _coded(tables: Tables) -> DataFrame:
    return tables["items"].select("item_id", folded_code().alias("code"))


def _purchases(tables: Tables, as_of, months: int) -> DataFrame:
    """(code, at, price) of positive purchases since ``months`` before ``as_of``."""
    lots = tables["receipts"].filter(F.col("purchased_at") >= months_before(as_of, months))
    priced = tables["items"].filter(F.col("purchase_price") > 0)
    return priced.join(lots, "receipt_id").select(
        folded_code().alias("code"), F.col("purchased_at").alias("at"), F.col("purchase_price").alias("price")
    )


def _sales(tables: Tables, as_of, months: int) -> DataFrame:
    return recent_dispatches(tables, as_of, months).filter(F.col("sale_price") > 0).select(
        "item_id", F.col("validated_at").alias("at"), F.col("sale_price").alias("price")
    )


def sale_price_avg_3m(tables: Tables, as_of) -> DataFrame:
    """Average and number of positive sale prices per code, three months.

    Totals per item come first: they are combined before the item join's shuffle.
    """
    per_item = _sales(tables, as_of, 3).groupBy("item_id").agg(
        F.sum("price").alias("total"), F.count("price").alias("n")
    )
    items = tables["items"].filter(has_text(F.col("code"))).select("item_id", folded_code().alias("code"))
    return per_item.join(items, "item_id").groupBy("code").agg(
        mean(F.sum("total"), F.sum("n")).alias("avg_sale_3m"), F.sum("n").alias("n_sales_3m")
    )


def purchase_price_monthly(tables: Tables, as_of, n_months: int = 12) -> DataFrame:
    return (
        _purchases(tables, as_of, n_months).groupBy(month_of(F.col("at")).alias("month"))
        .agg(_average("price").alias("avg_purchase")).orderBy("month")
    )


def sale_price_monthly(tables: Tables, as_of, n_months: int = 12) -> DataFrame:
    return (
        _sales(tables, as_of, n_months).groupBy(month_of(F.col("at")).alias("month"))
        .agg(_average("price").alias("avg_sale")).orderBy("month")
    )


def _by_code(rows: DataFrame, code: str | None) -> DataFrame:
    """Keep one folded code, or every non-NULL code when none is named."""
    return rows.filter(F.col("code").isNotNull() if code is None else F.col("code") == code.upper())


def purchase_price_monthly_code(tables: Tables, as_of, n_months: int = 12, code: str | None = None) -> DataFrame:
    """Monthly average purchase price of one code, or of all codes at once."""
    rows = _by_code(_purchases(tables, as_of, n_months), code)
    return rows.groupBy("code", month_of(F.col("at")).alias("month")).agg(_average("price").alias("avg_purchase"))


def sale_price_monthly_code(tables: Tables, as_of, n_months: int = 12, code: str | None = None) -> DataFrame:
    """Monthly average sale price; totals per item and month meet the items."""
    per_item = _sales(tables, as_of, n_months).groupBy("item_id", month_of(F.col("at")).alias("month")).agg(
        F.sum("price").alias("total"), F.count("price").alias("n")
    )
    rows = per_item.join(_by_code(_coded(tables), code), "item_id")
    return rows.groupBy("code", "month").agg(mean(F.sum("total"), F.sum("n")).alias("avg_sale"))


def _with_margin(purchases: DataFrame, sales: DataFrame, keys: list[str]) -> DataFrame:
    return (
        purchases.join(sales, keys, "full_outer")
        .withColumn("margin", F.col("avg_sale") - F.col("avg_purchase")).orderBy(*keys)
    )


def price_evolution(tables: Tables, as_of, n_months: int = 12) -> DataFrame:
    """Monthly purchase and sale averages side by side, with the margin."""
    return _with_margin(
        purchase_price_monthly(tables, as_of, n_months), sale_price_monthly(tables, as_of, n_months), ["month"]
    )


def price_evolution_code(tables: Tables, as_of, n_months: int = 12, code: str | None = None) -> DataFrame:
    return _with_margin(
        purchase_price_monthly_code(tables, as_of, n_months, code),
        sale_price_monthly_code(tables, as_of, n_months, code),
        ["code", "month"],
    )


def _window_totals(as_of, window: int) -> list[Column]:
    """Sum and count of the recent and of the previous window, in one pass."""
    recent_from, prev_from = months_before(as_of, window), months_before(as_of, 2 * window)
    recent = F.when(F.col("at") >= recent_from, F.col("price"))
    prev = F.when((F.col("at") < recent_from) & (F.col("at") >= prev_from), F.col("price"))
    return [
        F.sum(recent).alias("sum_recent"), F.count(recent).alias("n_recent"),
        F.sum(prev).alias("sum_prev"), F.count(prev).alias("n_prev"),
    ]


def price_movers(tables: Tables, kind: str, as_of, window: int = 3, lookback: int = 12,
                 min_count: int = 5) -> DataFrame:
    """Price change per code between the last window and the one before it.

    Only rows of these two windows can count (a code needs both averages), so
    the scan is bounded by the shorter of the lookback and two windows.
    """
    months = min(lookback, 2 * window)
    if kind == "purchase":
        totals = _purchases(tables, as_of, months).groupBy("code").agg(*_window_totals(as_of, window))
    elif kind == "sale":
        per_item = _sales(tables, as_of, months).groupBy("item_id").agg(*_window_totals(as_of, window))
        totals = per_item.join(_coded(tables), "item_id").groupBy("code").agg(
            *[F.sum(c).alias(c) for c in ("sum_recent", "n_recent", "sum_prev", "n_prev")]
        )
    else:
        raise ValueError("kind is 'purchase' or 'sale'")
    averaged = totals.select(
        "code", "n_recent", "n_prev",
        mean(F.col("sum_prev"), F.col("n_prev")).alias("prev"),
        mean(F.col("sum_recent"), F.col("n_recent")).alias("recent"),
    ).filter(
        (F.col("n_recent") >= min_count) & (F.col("n_prev") >= min_count)
        & F.col("recent").isNotNull() & F.col("prev").isNotNull()
    )
    change = F.col("recent") - F.col("prev")
    return averaged.select(
        "code", "n_recent", "n_prev",
        round_half_away(F.col("prev"), 2).alias("avg_prev"),
        round_half_away(F.col("recent"), 2).alias("avg_recent"),
        round_half_away(change, 2).alias("delta"),
        F.when(F.col("prev") != 0, round_half_away(F.try_divide(change, F.col("prev")) * 100.0, 2)).alias("pct"),
    )


def default_lookback(window: int) -> int:
    return max(12, 4 * window)


def movers_enriched(movers: DataFrame, info: DataFrame) -> DataFrame:
    return movers.join(info, "code", "left").select("code", *DESCRIPTORS, *MOVER_COLUMNS)


def movers_up(movers: DataFrame, k: int = 20) -> DataFrame:
    return movers.orderBy(F.desc_nulls_last("pct"), F.asc_nulls_last("code")).limit(k)


def movers_down(movers: DataFrame, k: int = 20) -> DataFrame:
    return movers.orderBy(F.asc_nulls_last("pct"), F.asc_nulls_last("code")).limit(k)


def mover_candidates(purchase_movers: DataFrame, sale_movers: DataFrame, k: int = 200) -> DataFrame:
    """Distinct codes of both top lists, sorted."""
    listed = movers_up(purchase_movers, k).select("code").unionByName(movers_up(sale_movers, k).select("code"))
    return listed.filter(F.col("code") != "").distinct().orderBy("code")
