"""Column types of the canonical tables."""

from __future__ import annotations

_PRICE = "decimal(12,2)"
_TIME = "timestamp_ntz"

# Columns added to both offer logs after their first release.
_OPTIONAL_OFFER = {
    "registration": "string",
    "vin": "string",
    "photo_engine_path": "string",
    "photo_plate_path": "string",
    "audio_path": "string",
}
OPTIONAL_OFFER_COLUMNS = list(_OPTIONAL_OFFER)

TABLES: dict[str, dict[str, str]] = {
    "items": {
        "item_id": "bigint",
        "internal_no": "string",
        "receipt_id": "bigint",
        "serial_no": "string",
        "type_id": "bigint",
        "code": "string",
        "model_text": "string",
        "composition": "int",
        "state": "int",
        "housing_state": "int",
        "archived": "boolean",
        "exit_date": _TIME,
        "notes": "string",
        "purchase_price": _PRICE,
        "reserved_at": _TIME,
        "reserved_by": "string",
        "dispatch_id": "bigint",
    },
    "item_types": {
        "type_id": "bigint",
        "brand_id": "int",
        "type_name": "string",
        "model": "string",
        "energy_id": "string",
        "energy_note": "string",
        "year": "string",
        "particularity": "string",
        "equivalence": "string",
        "sale_price_with_box": _PRICE,
        "sale_price_alone": _PRICE,
        "hs_code": "string",
        "base_purchase_price": _PRICE,
    },
    "brands": {"brand_id": "int", "brand": "string"},
    "energies": {"energy_id": "string", "energy": "string"},
    "receipts": {
        "receipt_id": "bigint",
        "supplier_id": "bigint",
        "purchased_at": _TIME,
        "amount": _PRICE,
    },
    "dispatches": {
        "shipment_id": "bigint",
        "item_id": "bigint",
        "sale_price": _PRICE,
        "validated_at": _TIME,
    },
    "gearboxes": {"gearbox_id": "bigint", "in_stock": "boolean", "sold": "boolean"},
    "gearbox_dispatches": {"gearbox_id": "bigint", "validated_at": _TIME, "sale_price": _PRICE},
    "vendors": {"id": "bigint", "name": "string", "created_at": _TIME},
    "targeted_offers": {
        "id": "bigint",
        "vendor_id": "bigint",
        "code": "string",
        "brand": "string",
        "energy": "string",
        "type_name": "string",
        "type_model": "string",
        "type_year": "string",
        "asked_price": _PRICE,
        "qty": "int",
        "note": "string",
        **_OPTIONAL_OFFER,
        "created_at": _TIME,
    },
    "free_offers": {
        "id": "bigint",
        "vendor_id": "bigint",
        "text": "string",
        "asked_price": _PRICE,
        "note": "string",
        **_OPTIONAL_OFFER,
        "created_at": _TIME,
    },
    "plates": {
        "plate": "string",
        "code": "string",
        "brand": "string",
        "model": "string",
        "year": "string",
        "energy": "string",
    },
}


def ddl(table: str) -> str:
    """The table's schema as text for ``spark.read.schema``."""
    return ", ".join(f"{column} {kind}" for column, kind in TABLES[table].items())
