"""Canonical tables derived from the generated order/part/event tables.

Rules and measured counts are in FIXTURES.md §2. Everything stays lazy, so a
query on one canonical column reads only the raw columns behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gearyard.functions.numbering import dense_numbers

AS_OF = "2001-08-01 00:00:00"
OFFER_DAY = "2024-01-15"

_PRICE = "decimal(12,2)"

RAW_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}

Raw = Callable[[str], DataFrame]


def _every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def _text(value: str) -> Column:
    return F.lit(value)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _item_rows(raw: Raw) -> DataFrame:
    return raw("orders").join(raw("part"), F.col("p_partkey") == F.col("o_custkey"))


def _items(raw: Raw) -> DataFrame:
    key_text = F.col("o_orderkey").cast("string")
    return _item_rows(raw).select(
        F.col("o_orderkey").alias("item_id"),
        F.concat(_text("I-"), key_text).alias("internal_no"),
        F.col("o_orderkey").alias("receipt_id"),
        F.concat(_text("SN"), key_text).alias("serial_no"),
        F.when(_every("o_orderkey", 31), -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("type_id"),  # some have no type
        F.when(_every("o_orderkey", 97), None).when(_every("o_orderkey", 89), " ")
        .otherwise(F.col("p_name")).alias("code"),
        F.col("p_name").alias("model_text"),
        (F.col("o_orderkey") % 3).cast("int").alias("composition"),
        (F.col("o_orderkey") % 4).cast("int").alias("state"),
        (F.col("o_orderkey") % 5).cast("int").alias("housing_state"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", None)
        .otherwise(F.col("o_orderpriority") == "5-LOW").alias("archived"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate")).alias("exit_date"),
        F.col("o_orderpriority").alias("notes"),
        F.when(~_every("o_orderkey", 53), F.col("o_totalprice").cast(_PRICE)).alias("purchase_price"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("reserved_at"),
        F.when(F.col("o_orderstatus") == "P", F.concat(_text("C-"), F.col("o_custkey").cast("string")))
        .alias("reserved_by"),
        F.when(_every("o_orderkey", 61), F.col("o_orderkey")).alias("dispatch_id"),
    )


def _item_types(raw: Raw) -> DataFrame:
    return raw("part").select(
        F.col("p_partkey").alias("type_id"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("brand_id"),
        F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("type_name"),
        F.col("p_name").alias("model"),
        F.col("p_type").alias("energy_id"),
        F.concat(_text("note "), F.col("p_type")).alias("energy_note"),
        (F.col("p_size") + 1980).cast("string").alias("year"),
        F.concat(_text("size "), F.col("p_size").cast("string")).alias("particularity"),
        F.concat(_text("EQ"), (F.col("p_partkey") % 50).cast("string")).alias("equivalence"),
        (F.col("p_retailprice") * 2).cast(_PRICE).alias("sale_price_with_box"),
        F.col("p_retailprice").cast(_PRICE).alias("sale_price_alone"),
        F.concat(_text("HS"), F.col("p_size").cast("string")).alias("hs_code"),
        F.col("p_retailprice").cast(_PRICE).alias("base_purchase_price"),
    )


def _brands(raw: Raw) -> DataFrame:
    return raw("part").select(
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("brand_id"),
        F.col("p_brand").alias("brand"),
    ).distinct()


def _energies(raw: Raw) -> DataFrame:
    return raw("part").select(F.col("p_type").alias("energy_id"), F.col("p_type").alias("energy")).distinct()


def _receipts(raw: Raw) -> DataFrame:
    return raw("orders").select(
        F.col("o_orderkey").alias("receipt_id"),
        F.col("o_custkey").alias("supplier_id"),
        F.col("o_orderdate").alias("purchased_at"),
        F.col("o_totalprice").cast(_PRICE).alias("amount"),
    )


def _dispatches(raw: Raw) -> DataFrame:
    """Dated and undated dispatches are separate branches of a union, so that a
    bound on validated_at reaches the scan of the first and empties the second."""
    owners = _item_rows(raw).select("o_orderkey", (F.length("p_name") % 2).alias("name_parity"))
    floor = F.when(F.col("name_parity") == 0, 10).otherwise(38)
    dated = (F.col("l_quantity") > floor) & (F.col("l_quantity") != 50)

    def dispatch_rows(which: Column, validated: Column) -> DataFrame:
        return (
            raw("lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
            .filter(which)
            .select(
                F.col("l_suppkey").alias("shipment_id"),
                F.col("l_orderkey").alias("item_id"),
                F.col("l_extendedprice").cast(_PRICE).alias("sale_price"),
                validated.alias("validated_at"),
            )
        )

    return dispatch_rows(dated, F.col("l_shipdate")).unionByName(
        dispatch_rows(~F.coalesce(dated, F.lit(False)), F.lit(None).cast("timestamp_ntz"))
    )


def _gearboxes(raw: Raw) -> DataFrame:
    return raw("customer").select(
        F.col("c_custkey").alias("gearbox_id"),
        (F.col("c_acctbal") > 0).alias("in_stock"),
        F.when(F.col("c_mktsegment") == "BUILDING", None)
        .otherwise(F.col("c_mktsegment") == "MACHINERY").alias("sold"),
    )


def _gearbox_dispatches(raw: Raw) -> DataFrame:
    return raw("orders").select(
        F.col("o_custkey").alias("gearbox_id"),
        F.col("o_orderdate").alias("validated_at"),
        F.col("o_totalprice").cast(_PRICE).alias("sale_price"),
    )


def _vendors(raw: Raw) -> DataFrame:
    return raw("events").groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("created_at")).select(
        "id", F.concat(_text("vendor-"), F.col("id").cast("string")).alias("name"), "created_at"
    )


def _event_text() -> Column:
    return F.col("event_id").cast("string")


def _offer_tail() -> list[Column]:
    def media(step: int, prefix: str, suffix: str) -> Column:
        return F.when(_every("event_id", step), F.concat(_text(prefix), _event_text(), _text(suffix)))

    return [
        F.when(~_every("event_id", 3), F.concat(_text("note "), _event_text())).alias("note"),
        media(2, "R-", "").alias("registration"),
        media(3, "VIN", "").alias("vin"),
        media(4, "photos/engine-", ".jpg").alias("photo_engine_path"),
        media(5, "photos/plate-", ".jpg").alias("photo_plate_path"),
        media(7, "audio/", ".m4a").alias("audio_path"),
        F.col("ts").alias("created_at"),
    ]


def _targeted_offers(raw: Raw) -> DataFrame:
    k = _k()
    return raw("events").filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("vendor_id"),
        F.concat(_text("K"), k.cast("string")).alias("code"),
        F.concat(_text("Brand#"), (k % 25 + 1).cast("string")).alias("brand"),
        F.when(k % 2 == 0, "DIESEL").otherwise("ESSENCE").alias("energy"),
        F.concat(_text("type "), k.cast("string")).alias("type_name"),
        F.concat(_text("model "), (k % 10).cast("string")).alias("type_model"),
        (k % 30 + 1990).cast("string").alias("type_year"),
        F.col("value").cast(_PRICE).alias("asked_price"),
        F.greatest(k, F.lit(1)).alias("qty"),
        *_offer_tail(),
    )


def _free_offers(raw: Raw) -> DataFrame:
    return raw("events").filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("vendor_id"),
        F.concat(_text("engine type "), _k().cast("string")).alias("text"),
        F.col("value").cast(_PRICE).alias("asked_price"),
        *_offer_tail(),
    )


def _plates(raw: Raw) -> DataFrame:
    """A fifth of the plates has no code, a fifteenth an unknown energy too, so
    that every matching tier is reached."""
    return raw("part").select(
        F.concat(_text("p-"), F.col("p_partkey").cast("string")).alias("plate"),
        F.when(_every("p_partkey", 5), "").otherwise(F.col("p_name")).alias("code"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("model"),
        (F.col("p_size") + 1980).cast("string").alias("year"),
        F.when(_every("p_partkey", 15), "UNKNOWN").otherwise(F.col("p_type")).alias("energy"),
    )


def _catalogue(raw: Raw) -> DataFrame:
    return raw("part").select(
        F.concat_ws(" ", F.col("p_type"), F.col("p_partkey").cast("string")).alias("Type moteur"),
        F.col("p_retailprice").alias("list_price"),
    )


def _items_export(raw: Raw) -> DataFrame:
    return _items(raw).select(F.col("type_id").alias("N_TypeMoteur"), F.col("code").alias("CodeMoteur"))


def _searches(raw: Raw) -> DataFrame:
    texts = raw("part").select(F.concat_ws(" ", "p_name", "p_type").alias("text")).distinct()
    return dense_numbers(texts, F.col("text"), "search_id")


def _plate_searches(raw: Raw) -> DataFrame:
    return raw("customer").select(
        F.col("c_custkey").alias("search_id"),
        F.concat(
            F.when(_every("c_custkey", 3), "P ").when(_every("c_custkey", 2), "P-").otherwise(" p"),
            F.col("c_custkey").cast("string"),
        ).alias("plate"),
    )


def _targeted_batch(raw: Raw) -> DataFrame:
    """Raw submissions for the ledger, from the view events."""
    k = _k()
    return raw("events").filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("vendor_id"),
        F.when(~_every("event_id", 11), F.concat(_text("  k"), k.cast("string"), _text(" "))).alias("code"),
        F.concat(_text("Brand#"), (k % 25 + 1).cast("string")).alias("brand"),
        F.when(k % 2 == 0, "DIESEL").alias("energy"),
        F.concat(_text("type "), k.cast("string")).alias("type_name"),
        (F.col("value") - 10).cast(_PRICE).alias("asked_price"),
        F.when(k > 1, k).alias("qty"),
        F.when(_every("event_id", 3), "  ").otherwise(F.concat(_text(" n"), _event_text())).alias("note"),
        F.col("ts").alias("created_at"),
    )


def _free_batch(raw: Raw) -> DataFrame:
    """Raw submissions for the ledger, from the error and signup events."""
    return raw("events").filter(F.col("event_type").isin("error", "signup")).select(
        F.col("user_id").alias("vendor_id"),
        F.when(F.col("event_type") == "error", F.concat(_text("K"), _k().cast("string"))).alias("alternative_for"),
        F.when(_every("event_id", 13), "   ").otherwise(F.concat(_text(" offer "), _event_text())).alias("text"),
        (F.col("value") - 10).cast(_PRICE).alias("asked_price"),
        F.when(_every("event_id", 3), "").otherwise(F.concat(_text("n"), _event_text())).alias("note"),
        F.col("ts").alias("created_at"),
    )


def _vendor_names(raw: Raw) -> DataFrame:
    """Names to look up: all suppliers, spelled with edge spaces, and all event users."""
    suppliers = raw("supplier").select(F.concat(_text(" "), F.col("s_name"), _text(" ")).alias("name"))
    users = raw("events").select(F.concat(_text("vendor-"), F.col("user_id").cast("string")).alias("name"))
    return suppliers.unionByName(users)


_BUILDERS: dict[str, Callable[[Raw], DataFrame]] = {
    "items": _items,
    "item_types": _item_types,
    "brands": _brands,
    "energies": _energies,
    "receipts": _receipts,
    "dispatches": _dispatches,
    "gearboxes": _gearboxes,
    "gearbox_dispatches": _gearbox_dispatches,
    "vendors": _vendors,
    "targeted_offers": _targeted_offers,
    "free_offers": _free_offers,
    "plates": _plates,
    "catalogue": _catalogue,
    "items_export": _items_export,
    "searches": _searches,
    "plate_searches": _plate_searches,
    "targeted_batch": _targeted_batch,
    "free_batch": _free_batch,
    "vendor_names": _vendor_names,
}


class SampleTables(Mapping):
    """The canonical tables of a folder; each is defined when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def _raw(self, name: str) -> DataFrame:
        return self._spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self._folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self._raw)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


def sample_tables(spark: SparkSession, folder: str) -> SampleTables:
    return SampleTables(spark, folder)
