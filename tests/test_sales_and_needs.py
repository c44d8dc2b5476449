from __future__ import annotations

import pytest

from gearyard.functions.clock import months_before
from gearyard.functions.measures import round_half_away, round_half_even
from gearyard.operators import needs, prices, sales
from gearyard.sources.sample import sample_tables
from tests.fixtures import tables, values
from pyspark.sql import functions as F

AS_OF = "2001-08-01"


def _sold(item: int, times: int, code: str, at: str = "2001-07-01"):
    return [{"item_id": item, "code": code}], [{"item_id": item, "sale_price": 1, "validated_at": at}] * times


def test_month_end_is_clamped(spark):
    got = spark.range(1).select(months_before("2001-05-31", 3).cast("string").alias("d")).first().d
    assert got.startswith("2001-02-28")


def test_two_roundings(spark):
    row = spark.range(1).select(
        round_half_even(F.lit(0.125), 2).alias("even"), round_half_away(F.lit(0.125), 2).alias("away"),
        round_half_away(F.lit(-0.125), 2).alias("minus"),
    ).first()
    assert (row.even, row.away, row.minus) == (0.12, 0.13, -0.13)


def test_urgency_rounds_half_even(spark):
    t = tables(
        spark,
        items=[{"item_id": i, "code": "A"} for i in range(8)],
        dispatches=[{"item_id": 0, "validated_at": "2001-07-01"}],
    )
    assert values(needs.needs_items(t, AS_OF), "sold_3m", "stock", "urgency") == [(1, 7, 0.12)]


def test_list_is_cut_by_sales_then_sorted_by_urgency(spark):
    items, moved = [], []
    for n, (code, times) in enumerate([("A", 10), ("B", 9), ("C", 8)]):
        more_items, more_moved = _sold(n, times, code)
        items, moved = items + more_items, moved + more_moved
    items += [{"item_id": 100 + i, "code": "A"} for i in range(9)]
    t = tables(spark, items=items, dispatches=moved)
    assert values(needs.needs_items(t, AS_OF, 2), "code", "sold_3m", "urgency") == [("B", 9, 9.0), ("A", 10, 1.0)]


def test_null_code_is_listed_but_meets_no_stock(spark):
    t = tables(
        spark,
        items=[{"item_id": 1}, {"item_id": 2}, {"item_id": 3, "code": " ", "purchase_price": 4, "receipt_id": 3}],
        receipts=[{"receipt_id": 3, "purchased_at": "2001-07-30"}],
        dispatches=[{"item_id": 1, "validated_at": "2001-07-01"}, {"item_id": 3, "validated_at": "2001-07-01"}],
    )
    got = values(needs.needs_items(t, AS_OF), "code", "sold_3m", "stock", "avg_purchase_3m")
    assert sorted(got, key=str) == [(" ", 1, 0, 4.0), (None, 1, 0, None)]
    assert needs.needs_items_by_type(t, AS_OF).count() == 0


def test_future_sales_count_and_ties_multiply(spark):
    t = tables(
        spark,
        items=[{"item_id": 1, "code": "a"}],
        dispatches=[
            {"item_id": 1, "validated_at": "2002-01-01 10:00:00"},
            {"item_id": 1, "validated_at": "2002-01-01 10:00:00"},
            {"item_id": 1, "validated_at": "2001-07-01"},
            {"item_id": 1, "validated_at": "2001-01-01"},
        ],
    )
    got = sorted((str(d), n) for d, n in values(sales.sales_recent(t, AS_OF), "day", "n_sold"))
    assert got == [("2001-07-01", 2), ("2002-01-01", 4)]


def test_monthly_sales_add_up(spark):
    t = sample_tables(spark, "/root/testdata/sf0.001")
    recent = sales.sales_recent(t, "2001-08-01 00:00:00")
    by_month = sales.sales_by_month(recent).agg(F.sum("n_sold")).first()[0]
    assert by_month == recent.agg(F.sum("n_sold")).first()[0]


def test_mover_window_edges(spark):
    at = ["2001-05-01"] + ["2001-04-30"] + ["2001-02-01"] + ["2001-01-31"]
    t = tables(
        spark,
        items=[{"item_id": i, "receipt_id": i, "code": "A", "purchase_price": 10 * (i + 1)} for i in range(4)],
        receipts=[{"receipt_id": i, "purchased_at": d} for i, d in enumerate(at)],
    )
    got = values(prices.price_movers(t, "purchase", AS_OF, min_count=1), "n_recent", "n_prev", "avg_recent", "avg_prev", "pct")
    assert got == [(1, 2, 10.0, 25.0, -60.0)]


def test_unknown_mover_kind(spark):
    with pytest.raises(ValueError):
        prices.price_movers(tables(spark), "other", AS_OF)


def test_lookback_shorter_than_two_windows(spark):
    t = tables(
        spark,
        items=[{"item_id": i, "receipt_id": i, "code": "A", "purchase_price": 10} for i in range(2)],
        receipts=[{"receipt_id": 0, "purchased_at": "2001-07-30"}, {"receipt_id": 1, "purchased_at": "2001-02-02"}],
    )
    assert prices.price_movers(t, "purchase", AS_OF, window=3, lookback=4, min_count=1).count() == 0
    assert prices.price_movers(t, "purchase", AS_OF, window=3, lookback=6, min_count=1).count() == 1


def test_single_code_trend_is_the_bulk_trend_of_that_code(spark):
    t = sample_tables(spark, "/root/testdata/sf0.001")
    bulk = prices.price_evolution_code(t, "2001-08-01").filter(F.col("code") == "RED BOLT")
    one = prices.price_evolution_code(t, "2001-08-01", code="red bolt")
    assert sorted(map(str, bulk.collect())) == sorted(map(str, one.collect())) != []


def test_margin_is_null_on_a_one_sided_month(spark):
    t = tables(
        spark, items=[{"item_id": 1, "receipt_id": 1, "code": "A", "purchase_price": 3}],
        receipts=[{"receipt_id": 1, "purchased_at": "2001-07-01"}],
        dispatches=[{"item_id": 1, "sale_price": 5, "validated_at": "2001-06-01"}],
    )
    assert values(prices.price_evolution(t, AS_OF), "month", "avg_purchase", "avg_sale", "margin") == [
        ("2001-06", None, 5.0, None), ("2001-07", 3.0, None, None),
    ]


def test_pages(spark):
    rows = spark.createDataFrame([(f"C{i:02d}", i, float(i)) for i in range(45)], "code string, sold_3m long, urgency double")
    assert needs.needs_pages(rows).first().pages == 3
    assert needs.needs_pages(rows.limit(0)).first().pages == 1
    assert [r.code for r in needs.needs_page(rows, 3).collect()] == [f"C{i:02d}" for i in (4, 3, 2, 1, 0)]
