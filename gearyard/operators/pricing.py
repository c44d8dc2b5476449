"""Purchase-price proposals for a price catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.measures import clip
from gearyard.functions.skew import salted_join
from gearyard.functions.text import strip
from gearyard.operators.needs import needs_items
from gearyard.operators.prices import sale_price_avg_3m
from gearyard.sources.tables import Tables

# The default margins.
TARGET_MARGIN, URGENCY_BONUS, OVERSTOCK_MALUS = 0.35, 0.08, 0.05

PROPOSAL_COLUMNS = [
    "type_text", "type_clean", "code_mapped", "mapping_status", "sold_3m", "stock", "urgency",
    "avg_sale_3m", "margin", "proposed_price", "decision",
]

_MAPPED, _NOT_FOUND, _NOT_MAPPED = "mapped", "not found", "not mapped"


def _tidy(text: Column) -> Column:
    """No-break spaces as spaces, stripped, upper-cased."""
    return F.upper(strip(F.translate(text, "\u00a0", " ")))


def catalogue_clean(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(F.col("type_text").isNotNull()).withColumn(
        "type_clean", _tidy(F.col("type_text").cast("string"))
    )


def modal_code_per_type(export: DataFrame) -> DataFrame:
    """(type_id, code, n): the most frequent code of each type, ties to the smallest.

    A minimum of (-n, code) instead of a ranking window: it is combined before
    the shuffle, so a type with very many codes is not sorted in one task.
    """
    rows = export.select(
        F.col("type_id").try_cast("double").try_cast("bigint").alias("type_id"),
        _tidy(F.col("code").cast("string")).alias("code"),
    ).dropna()
    counted = rows.groupBy("type_id", "code").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("code").alias("code")))
    return counted.groupBy("type_id").agg(best.alias("best")).select(
        "type_id", F.col("best.code").alias("code"), (-F.col("best.minus_n")).alias("n")
    )


def catalogue_mapping(clean: DataFrame, export: DataFrame | None = None) -> DataFrame:
    """Map each catalogue line to a code through the first number in its text."""
    digits = F.regexp_extract("type_clean", "([0-9]+)", 1)
    numbered = clean.withColumn("type_number", F.when(digits != "", digits).try_cast("bigint"))
    if export is None:
        return numbered.withColumns(
            {"code_mapped": F.lit(None).cast("string"), "mapping_status": F.lit(_NOT_MAPPED)}
        )
    modal = modal_code_per_type(export).select(
        F.col("type_id").alias("type_number"), F.col("code").alias("code_mapped")
    )
    joined = salted_join(numbered, modal, ["type_number"], "left", spread=["type_text"])
    return joined.withColumn(
        "mapping_status", F.when(F.col("code_mapped").isNotNull(), _MAPPED).otherwise(_NOT_FOUND)
    ).select(*numbered.columns, "code_mapped", "mapping_status")


def effective_margin(urgency: Column, stock: Column, sold: Column, target: float, bonus: float,
                     malus: float) -> Column:
    """Target margin, lowered for urgent codes and raised for overstocked ones."""
    pressing = clip(urgency / 8.0, 0.0, 1.0)
    overstock = clip(stock / (sold + 1.0) / 5.0, 0.0, 1.0)
    return clip(F.lit(target) - F.lit(bonus) * pressing + F.lit(malus) * overstock, 0.05, 0.9)


def price_decision(status: Column, price: Column, urgency: Column, stock: Column, sold: Column) -> Column:
    """What to do with the price; the first rule that applies wins."""
    return (
        F.when(status != _MAPPED, "no mapping")
        .when(price == 0, "no sales")
        .when(urgency >= 5, "raise")
        .when((stock >= 3) & (sold <= 1), "lower")
        .otherwise("ok")
    )


def proposals_from(mapped: DataFrame, needs: DataFrame, prices: DataFrame, target: float = TARGET_MARGIN,
                   bonus: float = URGENCY_BONUS, malus: float = OVERSTOCK_MALUS) -> DataFrame:
    """Proposals for mapped catalogue lines from given needs and sale averages.

    The joins treat NULL keys as equal: an unmapped line meets the need without
    a code, if there is one.
    """
    need = needs.select("code", "sold_3m", "stock", "urgency")
    sale = prices.select("code", "avg_sale_3m")
    # Both describe one code: joined to each other first, the catalogue meets them once.
    known = need.join(sale, need["code"].eqNullSafe(sale["code"]), "full_outer").select(
        F.coalesce(need["code"], sale["code"]).alias("code_mapped"), "sold_3m", "stock", "urgency", "avg_sale_3m"
    )
    joined = salted_join(mapped, known, ["code_mapped"], "left", spread=["type_text"], null_safe=True)
    zeroed = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("sold_3m", "stock", "urgency", "avg_sale_3m")}
    margin = effective_margin(F.col("urgency"), F.col("stock"), F.col("sold_3m"), target, bonus, malus)
    return (
        joined.withColumns(zeroed)
        .withColumn("margin", margin)
        .withColumn("proposed_price", F.rint(F.col("avg_sale_3m") * (F.lit(1.0) - F.col("margin"))))
        .withColumn("decision", price_decision(
            F.col("mapping_status"), F.col("avg_sale_3m"), F.col("urgency"), F.col("stock"), F.col("sold_3m")
        ))
    )


def price_proposals(catalogue: DataFrame, export: DataFrame | None, tables: Tables, as_of,
                    target: float = TARGET_MARGIN, bonus: float = URGENCY_BONUS,
                    malus: float = OVERSTOCK_MALUS, needs_considered: int | None = None) -> DataFrame:
    """Proposals for a catalogue from all needs, or from the best-selling ones only."""
    return proposals_from(
        catalogue_mapping(catalogue_clean(catalogue), export),
        needs_items(tables, as_of, needs_considered),
        sale_price_avg_3m(tables, as_of),
        target, bonus, malus,
    )


def proposal_columns(proposals: DataFrame) -> DataFrame:
    return proposals.select(*PROPOSAL_COLUMNS)
