from __future__ import annotations

from gearyard.operators import stock, views
from tests.fixtures import tables, values


def test_tie_at_latest_date_repeats_item_only_under_default_rule(spark):
    t = tables(
        spark,
        items=[{"item_id": 1, "code": "A"}],
        dispatches=[
            {"item_id": 1, "sale_price": 10, "validated_at": "2001-05-02"},
            {"item_id": 1, "sale_price": 12, "validated_at": "2001-05-02"},
            {"item_id": 1, "sale_price": 99, "validated_at": "2001-05-01"},
        ],
    )
    latest = values(views.availability_latest(t), "item_id", "is_available", "last_sale_price")
    assert sorted(latest) == [(1, 0, 10.0), (1, 0, 12.0)]
    assert values(views.availability_exists(t), "item_id", "is_available") == [(1, 0)]
    assert values(stock.kpi_stock(t), "available", "sold", "total") == [(0, 2, 2)]


def test_equal_tied_rows_stay_separate(spark):
    twice = {"item_id": 1, "sale_price": 10, "validated_at": "2001-05-02"}
    t = tables(spark, items=[{"item_id": 1}], dispatches=[twice, twice, {**twice, "sale_price": None}])
    got = sorted(values(views.availability_latest(t), "last_sale_price"), key=str)
    assert got == [(10.0,), (10.0,), (None,)]


def test_only_undated_dispatches(spark):
    t = tables(spark, items=[{"item_id": 1}], dispatches=[{"item_id": 1, "sale_price": 5}])
    assert values(views.availability_latest(t), "is_available", "last_dispatch_at") == [(1, None)]
    assert values(views.availability_exists(t), "is_available") == [(0,)]


def test_archived_is_three_valued(spark):
    t = tables(spark, items=[{"item_id": 1}, {"item_id": 2, "archived": False}, {"item_id": 3, "archived": True}])
    assert views.live_stock(t).count() == 2
    assert sorted(values(views.availability_exists(t), "item_id", "is_available")) == [(1, 1), (2, 1), (3, 0)]


def test_gearbox_flags(spark):
    flags = [True, False, None]
    rows = [
        {"gearbox_id": 3 * i + j, "in_stock": a, "sold": b} for i, a in enumerate(flags) for j, b in enumerate(flags)
    ]
    t = tables(spark, gearboxes=rows)
    free = {(r[0], r[1]) for r in values(views.gearboxes_available(t).filter("is_available = 1"), "in_stock", "sold")}
    assert free == {(True, False), (True, None)}


def test_kpis_of_an_empty_view_are_zero(spark):
    t = tables(spark)
    assert values(stock.kpi_stock(t), "available", "sold", "total") == [(0, 0, 0)]
    assert values(stock.kpis(views.gearboxes_available(t)), "available", "sold", "total") == [(0, 0, 0)]


def test_available_plus_sold_is_total(spark):
    from gearyard.sources.sample import sample_tables

    t = sample_tables(spark, "/root/testdata/sf0.001")
    [(available, sold, total)] = values(stock.kpi_stock(t), "available", "sold", "total")
    assert available + sold == total == views.availability_latest(t).count()


def test_histogram_of_one_price_and_of_none(spark):
    t = tables(spark, items=[{"item_id": 1, "purchase_price": 7}, {"item_id": 2, "purchase_price": 7}])
    assert values(stock.price_histogram(t), "bin", "lo", "hi", "n") == [(1, 7.0, 7.0, 2)]
    assert stock.price_histogram(tables(spark, items=[{"item_id": 1}])).count() == 0


def test_histogram_top_value_falls_in_last_bin(spark):
    t = tables(spark, items=[{"item_id": i, "purchase_price": i} for i in range(1, 42)])
    got = dict(values(stock.price_histogram(t), "bin", "n"))
    assert sum(got.values()) == 41 and max(got) == 40 and got[40] == 2


def test_shares_sum_to_one(spark):
    from gearyard.sources.sample import sample_tables

    t = sample_tables(spark, "/root/testdata/sf0.001")
    shares = [s for (s,) in values(stock.energy_share(stock.stock_breakdown(t)), "share")]
    assert abs(sum(shares) - 1) < 1e-9
