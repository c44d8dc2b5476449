"""Every operator as a named report over a folder of generated tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearyard.functions import text as tx
from gearyard.operators import matching, needs, offers, prices, pricing, sales, stock, views
from gearyard.session import adapt, scratch_dir
from gearyard.sources import exports
from gearyard.sources import tables as tb
from gearyard.sources.sample import AS_OF, OFFER_DAY, sample_tables
from gearyard.sources.schema import OPTIONAL_OFFER_COLUMNS, TABLES

Report = Callable[[SparkSession, str], DataFrame]


def comparable(table: DataFrame) -> DataFrame:
    """Types that read the same from any engine: no decimals, dates or flags."""
    plain = {T.DecimalType: "double", T.DateType: "string", T.BooleanType: "int"}
    return table.select(*[
        F.col(f.name).cast(plain.get(type(f.dataType), f.dataType)).alias(f.name) for f in table.schema
    ])


def _over_tables(build: Callable[[tb.Tables], DataFrame]) -> Report:
    def report(spark: SparkSession, folder: str) -> DataFrame:
        adapt(spark)
        return comparable(build(sample_tables(spark, folder)))

    return report


def _needs(t: tb.Tables, n: int | None = 50) -> DataFrame:
    return needs.needs_items(t, AS_OF, n)


def _movers(t: tb.Tables, kind: str, window: int = 3, min_count: int = 5) -> DataFrame:
    return prices.price_movers(t, kind, AS_OF, window, prices.default_lookback(window), min_count)


def _enriched_movers(t: tb.Tables, kind: str) -> DataFrame:
    return prices.movers_enriched(_movers(t, kind), stock.code_info(t))


def _proposals(t: tb.Tables) -> DataFrame:
    catalogue = exports.catalogue_from(t["catalogue"])
    export = exports.items_export_from(t["items_export"])
    return pricing.price_proposals(catalogue, export, t, AS_OF)


def _mapping(t: tb.Tables) -> DataFrame:
    clean = pricing.catalogue_clean(exports.catalogue_from(t["catalogue"]))
    return pricing.catalogue_mapping(clean, exports.items_export_from(t["items_export"]))


def _reloaded(t: tb.Tables) -> tb.Tables:
    """The tables saved to the scratch folder and loaded from there."""
    spark = t["items"].sparkSession
    folder = scratch_dir(spark)
    tb.save_tables(t, folder)
    return tb.load_tables(spark, folder)


def _describe(t: tb.Tables) -> DataFrame:
    label = tx.describe_item(*[F.col(c) for c in ("code", "brand", "energy", "type_name", "type_model", "type_year")])
    return views.items_enriched(t).select("item_id", label.alias("result"))


def _evolve(t: tb.Tables) -> DataFrame:
    """Offers logged before the optional columns existed, next to newer ones."""
    log = t["targeted_offers"]
    cut = F.lit(OFFER_DAY).cast("timestamp_ntz")
    old = log.filter(F.col("created_at") < cut).drop(*OPTIONAL_OFFER_COLUMNS)
    new = log.filter((F.col("created_at") >= cut) | F.col("created_at").isNull())
    return tb.add_missing_columns(old).unionByName(new)


_TABLE_REPORTS: dict[str, Callable[[tb.Tables], DataFrame]] = {
    # sources
    "load_tables": lambda t: tb.table_counts(_reloaded(t), list(TABLES)),
    "table_counts": tb.table_counts,
    "table_peek": lambda t: tb.table_peek(t["item_types"], ["type_id"]),
    "table_peek_dispatches": lambda t: tb.table_peek(
        t["dispatches"], ["item_id", "validated_at", "sale_price", "shipment_id"]
    ),
    "schema_evolve": _evolve,
    "sanitize_table_name": lambda t: t["items"].select(
        "item_id", tx.sanitized_name(F.concat(F.lit(" tbl Réceptions à "), F.col("internal_no"))).alias("result")
    ),
    # derived views
    "items_enriched": views.items_enriched,
    "availability_latest": views.availability_latest,
    "availability_exists": views.availability_exists,
    "availability_exists_own": lambda t: views.availability_exists(t, own_descriptors=True),
    "gearboxes_available": views.gearboxes_available,
    # stock
    "kpi_stock": stock.kpi_stock,
    "kpi_stock_exists": lambda t: stock.kpis(views.availability_exists(t)),
    "kpi_gearboxes": lambda t: stock.kpis(views.gearboxes_available(t)),
    "availability_counts": stock.availability_counts,
    "latest_dispatched": stock.latest_dispatched,
    "stock_by_code": stock.stock_by_code,
    "stock_breakdown": stock.stock_breakdown,
    "stock_by_code_exists": lambda t: stock.stock_by_code(t, views.EXISTS),
    "stock_breakdown_exists": lambda t: stock.stock_breakdown(t, views.EXISTS),
    "top_brands_stock": lambda t: stock.top_brands_stock(stock.stock_breakdown(t)),
    "energy_share": lambda t: stock.energy_share(stock.stock_breakdown(t)),
    "price_histogram": stock.price_histogram,
    "code_info": stock.code_info,
    # sales
    "sales_recent": lambda t: sales.sales_recent(t, AS_OF),
    "sales_recent_by_type": lambda t: sales.sales_recent_by_type(t, AS_OF),
    "sales_recent_gearboxes": lambda t: sales.sales_recent_gearboxes(t, AS_OF),
    "sales_by_month": lambda t: sales.sales_by_month(sales.sales_recent(t, AS_OF)),
    "sales_by_month_gearboxes": lambda t: sales.sales_by_month(sales.sales_recent_gearboxes(t, AS_OF)),
    "top_codes": lambda t: sales.top_codes(sales.sales_recent(t, AS_OF)),
    "top_codes_gearboxes": lambda t: sales.top_codes(sales.sales_recent_gearboxes(t, AS_OF), key="gearbox_code"),
    "top_types": lambda t: sales.top_types(sales.sales_recent_by_type(t, AS_OF)),
    "top_brands_sold": lambda t: sales.top_brands_sold(sales.sales_recent(t, AS_OF)),
    "sales_detail": lambda t: sales.sales_detail(sales.sales_recent(t, AS_OF)),
    # needs
    "needs_items": _needs,
    "needs_items_by_type": lambda t: needs.needs_items_by_type(t, AS_OF),
    "needs_items_by_type_exists": lambda t: needs.needs_items_by_type(t, AS_OF, rule=views.EXISTS),
    "needs_gearboxes": lambda t: needs.needs_gearboxes(t, AS_OF),
    "urgency_score": lambda t: needs.urgency_scores(_needs(t, None)),
    "urgency_tier": lambda t: needs.urgency_tiers(_needs(t, None)),
    "needs_summary": lambda t: needs.needs_summary(_needs(t, None)),
    "needs_top_urgent": lambda t: needs.needs_top_urgent(_needs(t)),
    "needs_top_urgent_gearboxes": lambda t: needs.needs_top_urgent(needs.needs_gearboxes(t, AS_OF)),
    "needs_table": lambda t: needs.needs_table(_needs(t)),
    "urgency_by_type": lambda t: needs.urgency_by_type(needs.needs_items_by_type(t, AS_OF)),
    "needs_page": lambda t: needs.needs_page(_needs(t), 2),
    "needs_pages": lambda t: needs.needs_pages(_needs(t)),
    # prices
    "sale_price_avg_3m": lambda t: prices.sale_price_avg_3m(t, AS_OF),
    "purchase_price_monthly": lambda t: prices.purchase_price_monthly(t, AS_OF),
    "sale_price_monthly": lambda t: prices.sale_price_monthly(t, AS_OF),
    "purchase_price_monthly_code": lambda t: prices.purchase_price_monthly_code(t, AS_OF),
    "sale_price_monthly_code": lambda t: prices.sale_price_monthly_code(t, AS_OF),
    "price_evolution": lambda t: prices.price_evolution(t, AS_OF),
    "price_evolution_code": lambda t: prices.price_evolution_code(t, AS_OF),
    "price_movers_purchase": lambda t: _movers(t, "purchase"),
    "price_movers_sale": lambda t: _movers(t, "sale"),
    "movers_enriched": lambda t: _enriched_movers(t, "sale"),
    "movers_enriched_purchase": lambda t: _enriched_movers(t, "purchase"),
    "movers_up": lambda t: prices.movers_up(_enriched_movers(t, "sale")),
    "movers_up_purchase": lambda t: prices.movers_up(_enriched_movers(t, "purchase")),
    "movers_down": lambda t: prices.movers_down(_enriched_movers(t, "sale")),
    "movers_down_purchase": lambda t: prices.movers_down(_enriched_movers(t, "purchase")),
    "mover_candidates": lambda t: prices.mover_candidates(_movers(t, "purchase"), _movers(t, "sale")),
    # price proposals
    "catalogue_clean": lambda t: pricing.catalogue_clean(exports.catalogue_from(t["catalogue"])),
    "modal_code_per_type": lambda t: pricing.modal_code_per_type(exports.items_export_from(t["items_export"])),
    "catalogue_mapping": _mapping,
    "price_proposals": _proposals,
    "price_decision": lambda t: _proposals(t).select("type_text", "decision"),
    "proposal_columns": lambda t: pricing.proposal_columns(_proposals(t)),
    # matching
    "normalize_text": lambda t: t["items"].select(
        "item_id", tx.normalize_text(F.concat_ws("-", F.lit(" "), "code", "serial_no", F.lit("_. x "))).alias("result")
    ),
    "synonyms": lambda t: matching.synonym_hits(t["searches"]),
    "search_variants": lambda t: matching.search_variants(t["searches"]),
    "smart_match": lambda t: matching.smart_match(t["searches"], _needs(t, None)),
    "describe_item": _describe,
    "plate_lookup": lambda t: matching.plate_lookup(t["plate_searches"], t["plates"]),
    "needs_for_plate": lambda t: matching.needs_for_plate(t["plates"], _needs(t, None)),
    "normalize_code": lambda t: t["items"].select(
        "item_id",
        tx.normalize_code(
            F.when(F.col("item_id") % 3 == 0, F.col("item_id").cast("double").cast("string"))
            .when(F.col("item_id") % 3 == 1, F.concat_ws(",", F.col("item_id").cast("string"), F.lit("50")))
            .otherwise(F.col("code"))
        ).alias("result"),
    ),
    "clean_text": lambda t: t["items"].select("item_id", tx.clean_text(F.col("code")).alias("result")),
    # ledger
    "resolve_vendors": lambda t: offers.resolve_vendors(t["vendors"], t["vendor_names"], AS_OF),
    # an offer submitted without a time is taken in at the report's time, as the source's column default does
    "append_targeted_offers": lambda t: offers.append_targeted_offers(t["targeted_offers"], t["targeted_batch"], AS_OF),
    "append_free_offers": lambda t: offers.append_free_offers(t["free_offers"], t["free_batch"], AS_OF),
    "recent_targeted_offers": offers.recent_targeted_offers,
    "recent_free_offers": offers.recent_free_offers,
    "vendor_day_stats": lambda t: offers.vendor_day_stats(t, OFFER_DAY),
}


def _registered_views(spark: SparkSession, folder: str) -> DataFrame:
    views.register_views(sample_tables(spark, folder))
    return comparable(tb.run_query(spark, """
        SELECT 'items' AS view_name, is_available, count(*) AS n FROM items_available GROUP BY is_available
        UNION ALL
        SELECT 'items_strict', is_available, count(*) FROM items_available_strict GROUP BY is_available
        UNION ALL
        SELECT 'gearboxes', is_available, count(*) FROM gearboxes_available GROUP BY is_available
    """))


def _parameterised_query(spark: SparkSession, folder: str) -> DataFrame:
    views.register_views(sample_tables(spark, folder))
    return comparable(tb.run_query(
        spark,
        "SELECT item_id, code, brand FROM items_enriched WHERE upper(code) = :code AND type_year >= :year",
        {"code": "RED BOLT", "year": "2000"},
    ))


def _ingested(spark: SparkSession, folder: str) -> DataFrame:
    """Gearboxes and plates written as exports, ingested, and counted per table."""
    t, base = sample_tables(spark, folder), scratch_dir(spark)
    exports.write_csv(t["gearboxes"], f"{base}/in/tbl BOITES à trier.csv")
    exports.write_csv(t["plates"], f"{base}/in/tbl Plaques.csv")
    return comparable(exports.ingest_exports(spark, f"{base}/in", f"{base}/out"))


def _catalogue_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/catalogue"
    exports.write_csv(sample_tables(spark, folder)["catalogue"], path)
    return exports.read_catalogue(spark, path)


def _items_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/items"
    exports.write_csv(sample_tables(spark, folder)["items_export"], path)
    return exports.read_items_export(spark, path)


def _proposal_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/proposals"
    table = comparable(pricing.proposal_columns(_proposals(sample_tables(spark, folder))))
    exports.write_csv(table, path)
    return exports.read_written_csv(spark, path, table.schema)


REPORTS: dict[str, Report] = {
    **{name: _over_tables(build) for name, build in _TABLE_REPORTS.items()},
    "register_views": _registered_views,
    "run_query": _parameterised_query,
    "ingest_exports": _ingested,
    "read_catalogue": _catalogue_file,
    "read_items_export": _items_file,
    "write_csv": _proposal_file,
}
