"""Text clean-up as column expressions (no Python runs per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in a Unicode-aware strip.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"

# Canonical term -> spellings vendors use for it.
SYNONYMS: dict[str, tuple[str, ...]] = {
    "RENAULT": ("REN", "RENO", "R"),
    "PEUGEOT": ("PEU", "PSA", "P"),
    "CITROEN": ("CIT", "CITRO", "C"),
    "VOLKSWAGEN": ("VW", "VOLKS"),
    "MERCEDES": ("MERC", "MB", "MERCEDES-BENZ"),
    "BMW": ("BM",),
    "AUDI": ("AUD",),
    "FORD": ("F",),
    "OPEL": ("OP",),
    "FIAT": ("FIA",),
    "DIESEL": ("GASOIL", "GAZOLE", "HDI", "DCI", "TDI", "CDI", "TDCI", "D"),
    "ESSENCE": ("ESS", "E", "TSI", "TFSI", "TCE"),
    "ELECTRIQUE": ("ELEC", "EV", "ELECTRIC"),
    "HYBRIDE": ("HYB", "HYBRID"),
    "TURBO": ("T", "TURB"),
    "INJECTION": ("INJ", "I"),
    "COMMON RAIL": ("CR", "COMMONRAIL"),
    "BOITE": ("BV", "BA", "GEARBOX"),
    "AUTOMATIQUE": ("AUTO", "AT", "BVA"),
    "MANUELLE": ("MAN", "MT", "BVM"),
}

# Energy spellings that name a fuel family, first family wins.
ENERGY_FAMILIES = {
    "Diesel": ("DIESEL", "DCI", "HDI"),
    "Essence": ("ESSENCE", "TSI", "TCE"),
}

# Fixed value: what an empty field shows.
EMPTY_MARK = "—"

_ACCENTS, _PLAIN = "éèêàç", "eeeac"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(E[+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def has_text(text: Column) -> Column:
    """Filter predicate: neither NULL nor only spaces (the SQL TRIM rule)."""
    return F.trim(text) != ""


def blank_to_null(text: Column) -> Column:
    stripped = strip(text)
    return F.when(stripped != "", stripped)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def normalize_text(text: Column) -> Column:
    """Upper-cased, stripped, ``- _ .`` as spaces, runs of spaces collapsed.

    Stripping comes first, so a leading or trailing ``-`` leaves one space.
    """
    spaced = F.translate(strip(F.upper(text)), "-_.", "   ")
    return F.coalesce(F.regexp_replace(spaced, f"{SPACE}+", " "), F.lit(""))


def synonym_pairs() -> Column:
    """The synonym list as one constant array of (term, word)."""
    pairs = [
        f"named_struct('term', '{term}', 'word', '{word}')"
        for term, spellings in SYNONYMS.items()
        for word in spellings
    ]
    return F.expr(f"array({', '.join(pairs)})")


def variants(norm: Column) -> Column:
    """Distinct spellings of a normalised text: itself, and one synonym
    swapped in either direction wherever it occurs."""
    pairs = synonym_pairs()
    to_term = F.transform(
        F.filter(pairs, lambda p: F.contains(norm, p["word"])),
        lambda p: F.replace(norm, p["word"], p["term"]),
    )
    to_word = F.transform(
        F.filter(pairs, lambda p: F.contains(norm, p["term"])),
        lambda p: F.replace(norm, p["term"], p["word"]),
    )
    return F.array_distinct(F.concat(F.array(norm), to_term, to_word))


def normalize_code(code: Column) -> Column:
    """Codes as spreadsheets spell them: ``169.0`` and ``169`` are one code.

    Only plain decimal numbers are read as numbers: a JVM parse alone would
    also take a trailing type letter, turning ``169D`` into 169. Numbers too
    large for a 64-bit integer keep their text.
    """
    upper = F.upper(strip(code.cast("string")))
    text = F.regexp_replace(upper, r"\.0$", "")
    dotted = F.replace(text, F.lit(","), F.lit("."))
    number = F.when(dotted.rlike(_NUMBER), dotted.try_cast("double"))
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(9.2e18))
    return F.coalesce(F.when(whole, number.cast("bigint").cast("string")), text, F.lit(""))


def clean_text(value: Column) -> Column:
    return F.coalesce(blank_to_null(value.cast("string")), F.lit(EMPTY_MARK))


def describe_item(code: Column, brand: Column, energy: Column, type_name: Column,
                  model: Column, year: Column) -> Column:
    """Short label: the filled descriptors in order, or the code if none is."""

    def filled(value: Column) -> Column:
        return F.when(value != "", value)

    upper = F.upper(energy)
    family = F.lit(None).cast("string")
    for label, spellings in reversed(ENERGY_FAMILIES.items()):
        named = F.lit(False)
        for spelling in spellings:
            named = named | F.contains(upper, F.lit(spelling))
        family = F.when(named, F.lit(label)).otherwise(family)
    text = F.concat_ws(" ", filled(brand), family, filled(type_name), filled(model),
                       filled(year.cast("string")))
    return F.coalesce(filled(text), code, F.lit(""))


def plate_key(plate: Column) -> Column:
    return F.regexp_replace(F.upper(plate), "[ -]", "")


def sanitize_table_name(stem: str) -> str:
    """Table name for an export file stem (driver side: one name per file)."""
    name = stem.strip().replace("tbl ", "tbl_").replace(" ", "_")
    return name.translate(str.maketrans(_ACCENTS, _PLAIN))


def sanitized_name(stem: Column) -> Column:
    """Column form of :func:`sanitize_table_name`."""
    joined = F.replace(F.replace(strip(stem), F.lit("tbl "), F.lit("tbl_")), F.lit(" "), F.lit("_"))
    return F.translate(joined, _ACCENTS, _PLAIN)
