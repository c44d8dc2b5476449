from __future__ import annotations

from collections import Counter

import pytest

from gearyard.functions.numbering import dense_numbers
from gearyard.operators import offers
from gearyard.sources import tables as tb
from tests.fixtures import table, tables, values
from pyspark.sql import functions as F


def _names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_vendors_are_unique_and_numbered_on(spark):
    known = spark.createDataFrame([(4, "Ada")], "id long, name string")
    got = dict((n, i) for i, n in values(offers.resolve_vendors(known, _names(spark, ["Ada", " Bo ", "Cy", "Bo"])), "id", "name"))
    assert set(got) == {"Ada", "Bo", "Cy"} and got["Ada"] == 4 and {got["Bo"], got["Cy"]} == {5, 6}
    again = offers.resolve_vendors(known.limit(0), _names(spark, ["x"]))
    assert values(again, "id", "name") == [(1, "x")]


@pytest.mark.parametrize("blank", [" ", None])
def test_blank_vendor_is_an_error(spark, blank):
    known = spark.createDataFrame([(4, "Ada")], "id long, name string")
    with pytest.raises(Exception, match="blank"):
        offers.resolve_vendors(known, _names(spark, [blank])).collect()


def test_targeted_rules(spark):
    batch = spark.createDataFrame(
        [(1, " k9k ", "0", "  ", None), (1, None, "-3", " n ", 4)],
        "vendor_id long, code string, asked_price string, note string, qty int",
    )
    log = table(spark, "targeted_offers", [{"id": 9, "vendor_id": 2, "code": "A"}])
    got = values(offers.append_targeted_offers(log, batch), "id", "code", "asked_price", "note", "qty")
    assert (9, "A", None, None, None) in got and {r[0] for r in got} == {9, 10, 11}
    assert sorted(r[1:] for r in got if r[0] > 9) == [("", None, "n", 4), ("K9K", None, None, 1)]


def test_free_rules(spark):
    batch = spark.createDataFrame(
        [(1, " fiat 1.3 ", None, 5.0), (1, "near", "K9K", 0.0), (1, "  ", "K9K", 5.0), (1, None, None, 5.0)],
        "vendor_id long, text string, alternative_for string, asked_price double",
    )
    got = values(offers.append_free_offers(table(spark, "free_offers", []), batch), "text", "asked_price")
    assert sorted(got) == [("Alternative pour K9K: near", None), ("fiat 1.3", 5.0)]


def test_stored_log_grows_without_reusing_ids(spark, tmp_path):
    path = str(tmp_path / "log")
    table(spark, "targeted_offers", [{"id": 1, "code": "A"}]).write.parquet(path)
    batch = spark.createDataFrame([(7, "b"), (7, "b"), (7, "c")], "vendor_id long, code string")
    for _ in range(2):
        log = spark.read.parquet(path)
        offers.store_offers(log, batch, path, "targeted")
    stored = values(spark.read.parquet(path), "id", "code")
    assert sorted(i for i, _ in stored) == list(range(1, 8))
    assert Counter(c for _, c in stored) == {"A": 1, "B": 4, "C": 2}


def test_numbers_are_dense_with_a_third_equal_rows(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, "same").otherwise(F.col("id").cast("string")).alias("v"))
    got = values(dense_numbers(rows, F.col("v"), "n", start=F.lit(10)), "n", "v")
    assert sorted(n for n, _ in got) == list(range(11, 3011))
    assert Counter(v for _, v in got)["same"] == 1000


def test_missing_columns_are_added_once(spark):
    old = spark.createDataFrame([(1, "x")], "id long, vin string")
    new = tb.add_missing_columns(old)
    assert new.columns == ["id", "vin", "registration", "photo_engine_path", "photo_plate_path", "audio_path"]
    assert tb.add_missing_columns(new).columns == new.columns
    assert values(new, "vin", "audio_path") == [("x", None)]


def test_recent_offers_and_day_stats(spark):
    t = tables(
        spark,
        vendors=[{"id": 1, "name": "Ada"}, {"id": 2, "name": "Bo"}],
        targeted_offers=[{"id": i, "vendor_id": 1 + i % 2, "code": f"C{i}", "created_at": f"2024-01-1{i} 00:00:00"} for i in range(6)]
        + [{"id": 99, "vendor_id": 7, "code": "lost", "created_at": "2024-01-15"}],
        free_offers=[{"id": 1, "vendor_id": 2, "text": "t", "created_at": "2024-01-15 23:59:59.999"}],
    )
    assert values(offers.recent_targeted_offers(t, 2), "vendor", "code") == [("Bo", "C5"), ("Ada", "C4")]
    stats = values(offers.vendor_day_stats(t, "2024-01-15"), "vendor_id", "targeted", "free", "total")
    assert sorted(stats) == [(1, 0, 0, 0), (2, 1, 1, 2)]
    assert values(offers.vendor_day_stats(t, "2024-01-15", 1), "vendor_id", "total") == [(1, 0)]


def test_offers_need_a_vendor_and_may_get_a_time(spark):
    batch = spark.createDataFrame([(1, "k9k", None)], "vendor_id bigint, code string, created_at timestamp_ntz")
    row = offers.targeted_batch(batch, as_of="2001-08-01").first()
    assert str(row.created_at) == "2001-08-01 00:00:00"
    with pytest.raises(Exception):
        offers.targeted_batch(batch.withColumn("vendor_id", F.lit(None).cast("bigint"))).collect()


def test_many_equal_offers_are_numbered(spark):
    rows = spark.range(25_000).selectExpr("1 as vendor_id", "'k' as code")
    got = dense_numbers(rows, F.col("code"), "id", start=F.lit(5))
    assert got.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()[:] == (6, 25_005, 25_000)


def test_vendors_keep_their_time_and_can_be_stored(spark, tmp_path):
    import datetime as dt

    made = dt.datetime(2020, 5, 1, 8, 0)
    known = spark.createDataFrame([(4, "Ada", made)], "id long, name string, created_at timestamp_ntz")
    got = {r.name: (r.id, r.created_at) for r in offers.resolve_vendors(known, _names(spark, ["Ada", "Bo"]), "2024-01-15 09:30:00").collect()}
    assert got == {"Ada": (4, made), "Bo": (5, dt.datetime(2024, 1, 15, 9, 30))}
    untimed = offers.resolve_vendors(known.select("id", "name"), _names(spark, ["Bo"]))
    assert {r.name: r.created_at for r in untimed.collect()} == {"Ada": None, "Bo": None}
    path = str(tmp_path / "vendors")
    known.write.parquet(path)
    offers.store_vendors(spark.read.parquet(path), _names(spark, ["Bo", "Ada"]), path, "2024-01-15 09:30:00")
    stored = sorted((r.id, r.name) for r in spark.read.parquet(path).collect())
    assert stored == [(4, "Ada"), (5, "Bo")]
