"""Plans and results under skew, with no side small enough to broadcast."""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from gearyard.functions.skew import HOT_SHARE, hot_keys, salted_join
from gearyard.operators import matching, needs, prices, sales, stock, views
from gearyard.plans.reports import REPORTS
from gearyard.sources.sample import AS_OF, sample_tables
from tests.fixtures import tables, values

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, how, null_safe):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise((F.col("id") % 50).cast("string"))
    left = spark.range(3000).select(F.col("id"), key.alias("k"))
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), ("5", 4), ("5", 4), ("unused", 5)], "k string, v int"
    )
    assert hot_keys(left, ["k"], hot_rows=10).filter("k = 'hot'").first()._salts == HOT_SHARE // 3 + 1
    got = salted_join(left, right, ["k"], how, ["id"], null_safe, hot_rows=10)
    on = left["k"].eqNullSafe(right["k"]) if null_safe else left["k"] == right["k"]
    want = left.join(right, on, how).select(left["id"], left["k"], right["v"])
    assert got.columns == ["id", "k", "v"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_salted_join_spreads_a_hot_key_over_tasks(spark):
    left = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    right = left.select("k").distinct().withColumn("v", F.lit(1))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        joined = salted_join(left, right, ["k"], "inner", ["id"], hot_rows=100)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 30000
    assert max(r["count"] for r in sizes) < 2 * 30000 / 8


def test_adaptive_skew_split_applies_to_the_sample_joins(spark):
    """A third of all orders of one customer: the join is split, the result whole."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1000",
    ):
        left = spark.range(0, 30000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("type_id"), F.col("id").alias("item_id")
        )
        types = spark.range(0, 1000, 1, 8).select(F.col("id").alias("type_id"), F.col("id").cast("string").alias("type_name"))
        joined = left.join(types, "type_id", "left")
        counted = joined.groupBy("type_name").count()
        counted.collect()
        assert "skew=true" in plan_of(counted)
        assert joined.count() == 30000


def test_window_bound_reaches_the_scan(spark):
    plan = plan_of(sales.sales_recent(sample_tables(spark, FOLDER), AS_OF))
    assert "GreaterThanOrEqual(l_shipdate,2001-05-01T00:00)" in plan
    assert "l_comment" not in plan and "l_tax" not in plan


def test_undated_branch_is_not_scanned_for_windowed_reports(spark):
    plan = plan_of(prices.sale_price_monthly(sample_tables(spark, FOLDER), AS_OF))
    assert plan.count("lineitem.parquet") == 1


def test_day_bound_reaches_the_scan(spark):
    from gearyard.operators import offers

    plan = plan_of(offers.vendor_day_stats(sample_tables(spark, FOLDER), "2024-01-15"))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan


def test_code_info_reads_no_dispatch(spark):
    assert "lineitem" not in plan_of(stock.code_info(sample_tables(spark, FOLDER)))


@pytest.mark.parametrize("name", sorted(set(REPORTS) - {"ingest_exports", "read_catalogue", "read_items_export", "write_csv"}))
def test_no_report_has_a_cross_join_or_python_worker(spark, name):
    plan = plan_of(REPORTS[name](spark, FOLDER))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert banned not in plan, (name, banned)
    spark.catalog.clearCache()


def test_hot_item_hot_code_and_hot_type(spark):
    """One item with a third of all dispatches, one code and type with most items."""
    items = [{"item_id": i, "code": "HOT" if i % 3 else f"C{i}", "type_id": 1 if i % 3 else i, "receipt_id": 1,
              "purchase_price": 10} for i in range(60)]
    moved = [{"item_id": 1, "sale_price": 10 + n % 3, "validated_at": f"2001-07-0{1 + n % 9}"} for n in range(90)]
    moved += [{"item_id": i, "sale_price": 7, "validated_at": "2001-06-15"} for i in range(0, 60, 2)]
    t = tables(
        spark, items=items, dispatches=moved, receipts=[{"receipt_id": 1, "purchased_at": "2001-07-01"}],
        item_types=[{"type_id": 1, "brand_id": 1, "type_name": "hot type"}], brands=[{"brand_id": 1, "brand": "B"}],
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        top = needs.needs_items(t, AS_OF, 1)
        code_of = {i["item_id"]: i["code"] for i in items}
        sold = Counter(code_of[m["item_id"]] for m in moved)
        assert values(top, "code", "sold_3m", "avg_purchase_3m") == [("HOT", sold["HOT"], 10.0)]
        ties = sum(1 for m in moved if m["item_id"] == 1 and m["validated_at"] == "2001-07-09")
        assert views.availability_latest(t).filter("item_id = 1").count() == ties == 10
        recent = sales.sales_recent(t, AS_OF).filter("code = 'HOT'").agg(F.sum("n_sold")).first()[0]
        assert recent == 90 * ties + sum(1 for m in moved[90:] if code_of[m["item_id"]] == "HOT")


def test_matching_with_a_hot_search(spark):
    from tests.test_matching import _needs, _searches

    asked = _searches(spark, ["k9k"] * 400 + [f"x{i}" for i in range(20)])
    got = matching.smart_match(asked, _needs(spark, [("K9K",), ("X1",)]))
    counts = Counter(values(got, "code"))
    assert counts[("K9K",)] == 400
