from __future__ import annotations

from gearyard.operators import pricing
from tests.fixtures import values

_NEED = "code string, sold_3m long, stock long, urgency double"
_SALE = "code string, avg_sale_3m double"


def _mapped(spark, rows):
    return spark.createDataFrame(rows, "type_text string, type_clean string, code_mapped string, mapping_status string")


def _decide(spark, code, need, sale, status="mapped", **margins):
    mapped = _mapped(spark, [("t", "T", code, status)])
    needs = spark.createDataFrame([need] if need else [], _NEED)
    sales = spark.createDataFrame([sale] if sale else [], _SALE)
    return values(pricing.proposals_from(mapped, needs, sales, **margins), "margin", "proposed_price", "decision")[0]


def test_catalogue_text_and_number(spark):
    lines = spark.createDataFrame([(" k9k 702\t",), (None,), ("none",)], "type_text string")
    mapped = pricing.catalogue_mapping(pricing.catalogue_clean(lines))
    got = values(mapped, "type_clean", "type_number", "mapping_status")
    assert sorted(got, key=str) == [("K9K 702", 9, "not mapped"), ("NONE", None, "not mapped")]


def test_number_too_large_is_not_found(spark):
    lines = spark.createDataFrame([("9" * 30,)], "type_text string")
    export = spark.createDataFrame([("1", "A")], "type_id string, code string")
    got = values(pricing.catalogue_mapping(pricing.catalogue_clean(lines), export), "type_number", "mapping_status")
    assert got == [(None, "not found")]


def test_modal_tie_goes_to_smallest_code(spark):
    rows = [("1", "b"), ("1", "a "), ("1", "B"), ("1", "A"), ("x", "A"), ("2", None), ("3.0", "c")]
    got = values(pricing.modal_code_per_type(spark.createDataFrame(rows, "type_id string, code string")), "type_id", "code", "n")
    assert sorted(got) == [(1, "A", 2), (3, "C", 1)]


def test_decision_order_and_edges(spark):
    assert _decide(spark, "A", ("A", 9, 0, 9.0), None)[2] == "no sales"
    assert _decide(spark, "A", ("A", 5, 0, 5.0), ("A", 10.0))[2] == "raise"
    assert _decide(spark, "A", ("A", 1, 3, 0.25), ("A", 10.0))[2] == "lower"
    assert _decide(spark, "A", ("A", 2, 3, 0.5), ("A", 10.0))[2] == "ok"
    assert _decide(spark, None, ("A", 9, 0, 9.0), ("A", 10.0), "not found")[2] == "no mapping"


def test_margin_is_clipped(spark):
    margin, price, _ = _decide(spark, "A", ("A", 8, 0, 8.0), ("A", 100.0), target=0.05, bonus=0.20)
    assert (margin, price) == (0.05, 95.0)


def test_price_rounds_half_even(spark):
    assert _decide(spark, "A", None, ("A", 5.0), target=0.5, bonus=0.0, malus=0.0)[1] == 2.0


def test_unmapped_line_meets_the_need_without_a_code(spark):
    mapped = _mapped(spark, [("t", "T", None, "not found")])
    needs = spark.createDataFrame([(None, 4, 1, 2.0)], _NEED)
    got = values(pricing.proposals_from(mapped, needs, spark.createDataFrame([], _SALE)), "sold_3m", "stock", "avg_sale_3m")
    assert got == [(4.0, 1.0, 0.0)]
