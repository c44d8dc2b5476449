"""Ledger of vendor offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.clock import on_day
from gearyard.functions.numbering import dense_numbers
from gearyard.functions.text import blank_to_null, strip
from gearyard.sources.schema import TABLES
from gearyard.sources.tables import Tables

# Fixed value: how a free offer names the code it is an alternative for.
ALTERNATIVE_PREFIX = "Alternative pour "


def resolve_vendors(registry: DataFrame, names: DataFrame, as_of=None) -> DataFrame:
    """The registry (id, name, created_at) with an entry for every name, new
    ones numbered on and created at ``as_of`` (NULL if not given).

    Names are compared stripped and exactly; a blank name is an error. A
    registry without ``created_at`` has NULL there.
    """
    name = strip(F.col("name"))
    checked = names.select(
        F.when(name != "", name).otherwise(F.raise_error(F.lit("vendor name is blank"))).alias("name")
    )
    kind = TABLES["vendors"]["created_at"]
    made = F.col("created_at") if "created_at" in registry.columns else F.lit(None)
    known = registry.select("id", "name", made.cast(kind).alias("created_at"))
    new = checked.distinct().join(known, "name", "left_anti")
    numbered = dense_numbers(new, F.col("name"), "id", start=known.agg(F.max("id")).scalar())
    when = F.lit(None) if as_of is None else F.lit(as_of)
    return known.unionByName(numbered.select("id", "name", when.cast(kind).alias("created_at")))


def store_vendors(registry: DataFrame, names: DataFrame, path: str, as_of=None) -> None:
    """Append the vendors that ``names`` adds to a stored Parquet registry."""
    resolved = resolve_vendors(registry, names, as_of)
    resolved.join(registry.select("id"), "id", "left_anti").write.mode("append").parquet(path)


def _typed(rows: DataFrame, table: str) -> DataFrame:
    """The rows with all columns of the table but its id; absent ones are NULL."""
    return rows.select(*[
        (F.col(column) if column in rows.columns else F.lit(None)).cast(kind).alias(column)
        for column, kind in TABLES[table].items() if column != "id"
    ])


def _positive(price: Column) -> Column:
    return F.when(price > 0, price)


def _submitted(rows: DataFrame, as_of) -> DataFrame:
    """Rows with a vendor and a time: ``as_of``, if given, where they have none."""
    vendor = F.coalesce("vendor_id", F.raise_error(F.lit("an offer has no vendor")).cast("bigint"))
    when = F.coalesce("created_at", F.lit(as_of).cast("timestamp_ntz")) if as_of is not None else F.col("created_at")
    return rows.withColumns({"vendor_id": vendor, "created_at": when})


def targeted_batch(batch: DataFrame, as_of=None) -> DataFrame:
    """Submitted targeted offers as the ledger stores them, still without ids."""
    rows = _submitted(_typed(batch, "targeted_offers"), as_of)
    return rows.withColumns({
        "code": F.coalesce(F.upper(strip(F.col("code"))), F.lit("")),
        "qty": F.coalesce("qty", F.lit(1)),
        "note": blank_to_null(F.col("note")),
        "asked_price": _positive(F.col("asked_price")),
    })


def free_batch(batch: DataFrame, as_of=None) -> DataFrame:
    """Submitted free offers as the ledger stores them; empty texts are refused.

    A submission with ``alternative_for`` names the listed code it replaces.
    """
    text = F.col("text")
    if "alternative_for" in batch.columns:
        text = F.when(
            F.col("alternative_for").isNotNull(),
            F.concat(F.lit(ALTERNATIVE_PREFIX), F.col("alternative_for"), F.lit(": "), F.col("text")),
        ).otherwise(F.col("text"))
    accepted = batch.filter(strip(F.col("text")) != "").withColumn("text", strip(text))
    return _submitted(_typed(accepted, "free_offers"), as_of).withColumns({
        "note": blank_to_null(F.col("note")),
        "asked_price": _positive(F.col("asked_price")),
    })


def _numbered(log: DataFrame, rows: DataFrame, subject: str) -> DataFrame:
    order = ["created_at", "vendor_id", subject]
    key = F.concat_ws("|", F.date_format("created_at", "yyyyMMddHHmmssSSSSSS"), F.col("vendor_id").cast("string"), subject)
    rest = [c for c in rows.columns if c not in order]
    return dense_numbers(rows, key, "id", order=[*order, *rest], start=log.agg(F.max("id")).scalar())


def append_targeted_offers(log: DataFrame, batch: DataFrame, as_of=None) -> DataFrame:
    """The log with a batch of submissions, normalised and numbered on.

    A submission needs a vendor; one without a time gets ``as_of``, if given.
    """
    return log.unionByName(_numbered(log, targeted_batch(batch, as_of), "code"), allowMissingColumns=True)


def append_free_offers(log: DataFrame, batch: DataFrame, as_of=None) -> DataFrame:
    return log.unionByName(_numbered(log, free_batch(batch, as_of), "text"), allowMissingColumns=True)


def store_offers(log: DataFrame, rows: DataFrame, path: str, kind: str, as_of=None) -> None:
    """Append a batch to a stored Parquet log (``kind``: targeted or free)."""
    normalised, subject = (targeted_batch(rows, as_of), "code") if kind == "targeted" else (free_batch(rows, as_of), "text")
    _numbered(log, normalised, subject).write.mode("append").parquet(path)


def _recent(offers: DataFrame, vendors: DataFrame, n: int) -> DataFrame:
    """Last n offers with their vendor's name.

    Offers of known vendors are found on two narrow columns; only the n chosen
    ones get a name and are then read in full.
    """
    names = vendors.select(F.col("id").alias("vendor_id"), F.col("name").alias("vendor"))
    known = offers.select("id", "vendor_id").join(names, "vendor_id", "left_semi")
    chosen = known.orderBy(F.desc("id")).limit(n).join(names, "vendor_id").select("id", "vendor")
    details = [c for c in offers.columns if c not in ("id", "vendor_id", "created_at")]
    return (
        offers.join(chosen, "id").orderBy(F.desc("id")).select("created_at", "vendor", *details)
    )


def recent_targeted_offers(tables: Tables, n: int = 50) -> DataFrame:
    return _recent(tables["targeted_offers"], tables["vendors"], n)


def recent_free_offers(tables: Tables, n: int = 50) -> DataFrame:
    return _recent(tables["free_offers"], tables["vendors"], n)


def vendor_day_stats(tables: Tables, day, vendor_id: int | None = None) -> DataFrame:
    """Offers per vendor on a day: targeted, free, total; zero without offers."""

    def logged(name: str, targeted: int) -> DataFrame:
        log = tables[name].filter(on_day(F.col("created_at"), day))
        return log.select("vendor_id", F.lit(targeted).alias("is_targeted"))

    counts = logged("targeted_offers", 1).unionByName(logged("free_offers", 0)).groupBy("vendor_id").agg(
        F.sum("is_targeted").alias("targeted"), F.count(F.lit(1)).alias("total")
    )
    vendors = tables["vendors"].select(F.col("id").alias("vendor_id"))
    if vendor_id is not None:
        vendors = vendors.filter(F.col("vendor_id") == vendor_id)
    zero = F.lit(0).cast("bigint")
    targeted, total = F.coalesce("targeted", zero), F.coalesce("total", zero)
    return vendors.join(counts, "vendor_id", "left").select(
        "vendor_id", targeted.alias("targeted"), (total - targeted).alias("free"), total.alias("total")
    )
