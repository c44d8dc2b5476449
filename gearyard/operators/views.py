"""Derived views: item enrichment and availability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearyard.functions.numbering import copies
from gearyard.sources.tables import Tables

_TYPE_COLUMNS = {
    "brand_id": "type_brand_id",
    "type_name": "type_name",
    "model": "type_model",
    "energy_id": "type_energy_id",
    "energy_note": "type_energy_note",
    "year": "type_year",
    "particularity": "type_particularity",
    "equivalence": "type_equivalence",
    "sale_price_with_box": "type_sale_price_with_box",
    "sale_price_alone": "type_sale_price_alone",
    "hs_code": "type_hs_code",
    "base_purchase_price": "type_base_purchase_price",
}

# Availability rules: no dated dispatch, or no dispatch at all and neither archived nor assigned one.
LATEST, EXISTS = "latest", "exists"

DESCRIPTORS = ["brand", "energy", "type_name", "type_model", "type_year"]


def folded_code(code: Column | None = None) -> Column:
    return F.upper(F.col("code") if code is None else code)


def not_archived() -> Column:
    """Archived is three-valued: unknown counts as live."""
    return ~F.coalesce(F.col("archived"), F.lit(False))


def type_details(tables: Tables) -> DataFrame:
    """Item types with brand and energy names.

    The reference tables are joined among themselves first, so that a fact
    table meets them in one join instead of three.
    """
    return (
        tables["item_types"]
        .join(tables["brands"], "brand_id", "left")
        .join(tables["energies"], "energy_id", "left")
        .select(
            "type_id",
            *[F.col(name).alias(ours) for name, ours in _TYPE_COLUMNS.items()],
            "brand",
            "energy",
        )
    )


def enrich(rows: DataFrame, tables: Tables) -> DataFrame:
    """Any rows with a ``type_id``, plus the type's descriptors."""
    return rows.join(type_details(tables), "type_id", "left")


def items_enriched(tables: Tables) -> DataFrame:
    items = tables["items"]
    extra = [c for c in type_details(tables).columns if c != "type_id"]
    return enrich(items, tables).select(*items.columns, *extra)


def dated_dispatches(tables: Tables) -> DataFrame:
    return tables["dispatches"].filter(F.col("validated_at").isNotNull())


def unsold_items(tables: Tables, items: DataFrame | None = None, rule: str = LATEST) -> DataFrame:
    """Available items under a rule; no rule repeats an available item.

    An anti join against distinct keys: the distinct is combined before its
    shuffle and leaves the keys partitioned the way the join needs them.
    """
    rows = tables["items"] if items is None else items
    if rule == LATEST:
        moved = dated_dispatches(tables)
    elif rule == EXISTS:
        moved, rows = tables["dispatches"], rows.filter(not_archived() & F.col("dispatch_id").isNull())
    else:
        raise ValueError(f"rule is {LATEST!r} or {EXISTS!r}")
    return rows.join(moved.select("item_id").distinct(), "item_id", "left_anti")


def live_stock(tables: Tables, items: DataFrame | None = None, rule: str = LATEST) -> DataFrame:
    """Available items that are not archived."""
    rows = tables["items"] if items is None else items
    return unsold_items(tables, rows.filter(not_archived()), rule)


def latest_ties(dispatches: DataFrame) -> DataFrame:
    """(item_id, n_ties): dispatch rows of each item at its latest date.

    Two aggregations, both combined before their shuffle, so that an item with
    a large part of all dispatches is never gathered row by row.
    """
    moments = dispatches.groupBy("item_id", "validated_at").agg(F.count(F.lit(1)).alias("n"))
    return moments.groupBy("item_id").agg(F.max_by("n", "validated_at").alias("n_ties"))


def latest_dispatches(tables: Tables) -> DataFrame:
    """(item_id, last_dispatch_at, last_sale_price, n_copies) at the latest date.

    Ties at the latest date stay separate rows (with equal prices collapsed
    into a count), as the default availability rule repeats the item for them.
    """
    # Combined first, so that an item with very many equal rows costs one per
    # task; then the ranks are cut in every task before they meet by item.
    combined = dated_dispatches(tables).groupBy("item_id", "validated_at", "sale_price").agg(
        F.count(F.lit(1)).alias("n_copies")
    )
    newest = F.rank().over(Window.partitionBy("item_id").orderBy(F.desc("validated_at")))
    return combined.withColumn("_rank", newest).filter(F.col("_rank") == 1).select(
        "item_id",
        F.col("validated_at").alias("last_dispatch_at"),
        F.col("sale_price").alias("last_sale_price"),
        "n_copies",
    )


def availability_rows(tables: Tables, items: DataFrame | None = None) -> DataFrame:
    """Items with the default availability flag and their last dispatch, not enriched."""
    rows = tables["items"] if items is None else items
    joined = rows.join(latest_dispatches(tables), "item_id", "left")
    ties = F.coalesce(F.col("n_copies"), F.lit(1)).cast("bigint")
    return copies(joined, F.lit(1).cast("bigint"), ties, "_copy").select(
        *rows.columns,
        F.when(F.col("n_copies").isNull(), 1).otherwise(0).alias("is_available"),
        "last_dispatch_at",
        "last_sale_price",
    )


def availability_latest(tables: Tables) -> DataFrame:
    """Default rule: available unless a dated dispatch exists."""
    rows = availability_rows(tables)
    items, state = tables["items"].columns, ["is_available", "last_dispatch_at", "last_sale_price"]
    extra = [c for c in type_details(tables).columns if c != "type_id"]
    return enrich(rows, tables).select(*items, *extra, *state)


def availability_weights(tables: Tables) -> DataFrame:
    """(is_available, n_rows) per item: what the default view would hold for it.

    Reports that only count view rows read this instead of the view.
    """
    ties = latest_ties(dated_dispatches(tables))
    return tables["items"].select("item_id").join(ties, "item_id", "left").select(
        F.when(F.col("n_ties").isNull(), 1).otherwise(0).alias("is_available"),
        F.coalesce("n_ties", F.lit(1)).alias("n_rows"),
    )


def _own_descriptors(rows: DataFrame, tables: Tables) -> DataFrame:
    """Type name, model and year from the item itself: its type id, typed model
    and year of purchase."""
    bought = tables["receipts"].select("receipt_id", F.year("purchased_at").cast("string").alias("_year"))
    return rows.join(bought, "receipt_id", "left").withColumns({
        "type_name": F.col("type_id").cast("string"),
        "type_model": F.col("model_text"),
        "type_year": F.col("_year"),
    })


def availability_exists(tables: Tables, own_descriptors: bool = False) -> DataFrame:
    """Strict rule: any dispatch row, a dispatch id or archiving ends availability."""
    items = tables["items"]
    marked = items.join(
        tables["dispatches"].select("item_id").distinct().withColumn("_dispatched", F.lit(True)),
        "item_id",
        "left",
    )
    gone = (
        F.coalesce(F.col("archived"), F.lit(False))
        | F.col("dispatch_id").isNotNull()
        | F.col("_dispatched").isNotNull()
    )
    rows = marked.select(*items.columns, F.when(gone, 0).otherwise(1).alias("is_available"))
    extra = [c for c in type_details(tables).columns if c != "type_id"]
    enriched = enrich(rows, tables)
    if own_descriptors:
        enriched = _own_descriptors(enriched, tables)
    return enriched.select(*items.columns, *extra, "is_available")


def gearboxes_available(tables: Tables) -> DataFrame:
    boxes = tables["gearboxes"]
    free = F.col("in_stock") & ~F.coalesce(F.col("sold"), F.lit(False))
    return boxes.select("*", F.when(free, 1).otherwise(0).alias("is_available"))


def register_views(tables: Tables) -> dict[str, DataFrame]:
    """Register base tables and derived views for SQL; returns the derived views.

    ``items_available`` follows the default rule (the latest dispatch decides),
    ``items_available_strict`` the strict one (any dispatch ends availability).
    """
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    views = {
        "items_enriched": items_enriched(tables),
        "items_available": availability_latest(tables),
        "items_available_strict": availability_exists(tables),
        "gearboxes_available": gearboxes_available(tables),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
