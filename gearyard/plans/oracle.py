"""Independent SQL text for every report, for any ANSI engine with list functions.

The texts name the generated tables directly and repeat the derivation rules
of the canonical tables as common table expressions.
"""

from __future__ import annotations

from gearyard.functions.text import ENERGY_FAMILIES, SYNONYMS
from gearyard.sources.sample import AS_OF, OFFER_DAY

# Fixed values, written out so that a wrong one in the library shows.
TARGET_MARGIN, URGENCY_BONUS, OVERSTOCK_MALUS = 0.35, 0.08, 0.05

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_OFFER_TAIL = """
    CASE WHEN event_id % 3 <> 0 THEN 'note ' || event_id END AS note,
    CASE WHEN event_id % 2 = 0 THEN 'R-' || event_id END AS registration,
    CASE WHEN event_id % 3 = 0 THEN 'VIN' || event_id END AS vin,
    CASE WHEN event_id % 4 = 0 THEN 'photos/engine-' || event_id || '.jpg' END AS photo_engine_path,
    CASE WHEN event_id % 5 = 0 THEN 'photos/plate-' || event_id || '.jpg' END AS photo_plate_path,
    CASE WHEN event_id % 7 = 0 THEN 'audio/' || event_id || '.m4a' END AS audio_path,
    ts AS created_at"""

_DESCRIPTORS = ("brand", "energy", "type_name", "type_model", "type_year")
_ITEM_COLUMNS = (
    "item_id, internal_no, receipt_id, serial_no, type_id, code, model_text, composition, state, "
    "housing_state, archived, exit_date, notes, purchase_price, reserved_at, reserved_by, dispatch_id"
)
_TYPE_COLUMNS = (
    "type_brand_id, type_name, type_model, type_energy_id, type_energy_note, type_year, "
    "type_particularity, type_equivalence, type_sale_price_with_box, type_sale_price_alone, "
    "type_hs_code, type_base_purchase_price, brand, energy"
)
_PLAIN_TYPE_COLUMNS = (
    "type_id, brand_id, type_name, model, energy_id, energy_note, year, particularity, equivalence, "
    "sale_price_with_box, sale_price_alone, hs_code, base_purchase_price"
)
_PRICE_COLUMNS = (
    "purchase_price", "type_sale_price_with_box", "type_sale_price_alone", "type_base_purchase_price",
    "last_sale_price", "sale_price", "asked_price", "sale_price_with_box", "sale_price_alone",
    "base_purchase_price",
)


def _back(months: int) -> str:
    return f"(TIMESTAMP '{AS_OF}' - INTERVAL {months} MONTH)"


def _sql_round(value: str, digits: int = 2) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"sign({value}) * floor(abs({value}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale}"


def _mean(price: str) -> str:
    return f"CAST(sum({price}) AS DOUBLE) / nullif(count({price}), 0)"


def _plain(columns: str) -> str:
    """Column list with prices as doubles and flags as integers."""
    out = []
    for name in (c.strip() for c in columns.split(",")):
        if name in _PRICE_COLUMNS:
            out.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif name in ("archived", "in_stock", "sold"):
            out.append(f"CAST({name} AS INTEGER) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


def _normalised(text: str) -> str:
    spaced = f"translate(regexp_replace(upper({text}), '^\\s+|\\s+$', '', 'g'), '-_.', '   ')"
    return f"coalesce(regexp_replace({spaced}, '\\s+', ' ', 'g'), '')"


def _pairs() -> str:
    rows = ", ".join(f"('{term}', '{word}')" for term, spellings in SYNONYMS.items() for word in spellings)
    return f"SELECT * FROM (VALUES {rows}) AS v(term, word)"


def _needs(limit: int | None, by_type: bool = False, view: str = "available") -> str:
    keys = "code, type_id" if by_type else "code"
    filled = "WHERE trim(i.code) <> ''" if by_type else ""
    prefix = "left(coalesce(s.type_name, ''), 3) AS type_prefix, " if by_type else ""
    average = ", ".join(
        f"{_sql_round(_mean(f'CASE WHEN purchased_at >= {_back(m)} THEN purchase_price END'))} AS avg_purchase_{m}m"
        for m in (3, 6, 12)
    )
    listed = ", ".join(f"coalesce(s.{c}, '') AS {c}" for c in _DESCRIPTORS)
    largest = ", ".join(f"max({c}) AS {c}" for c in _DESCRIPTORS)
    return f"""
    SELECT n.code, {prefix}{listed}, n.sold_3m, coalesce(s.stock, 0) AS stock,
           a.avg_purchase_3m, a.avg_purchase_6m, a.avg_purchase_12m,
           round_even(CAST(n.sold_3m AS DOUBLE) / (coalesce(s.stock, 0) + 1), 2) AS urgency
    FROM (
        SELECT {keys}, count(*) AS sold_3m
        FROM (SELECT upper(i.code) AS code, i.type_id FROM dispatches d JOIN items i ON i.item_id = d.item_id
              {filled} {'AND' if by_type else 'WHERE'} d.validated_at >= {_back(3)})
        GROUP BY {keys}
        ORDER BY sold_3m DESC, code ASC NULLS LAST{', type_id ASC NULLS LAST' if by_type else ''}
        {f'LIMIT {limit}' if limit else ''}
    ) n
    LEFT JOIN (
        SELECT upper(code) AS code, {average}
        FROM items JOIN receipts USING (receipt_id)
        WHERE purchase_price IS NOT NULL AND purchased_at IS NOT NULL
        GROUP BY upper(code)
    ) a ON a.code = n.code
    LEFT JOIN (
        SELECT upper(code) AS code, {largest}, count(*) AS stock
        FROM {view} WHERE is_available = 1 AND (archived IS NULL OR NOT archived)
        GROUP BY upper(code)
    ) s ON s.code = n.code"""


# name -> (tables it reads, text)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "items": ((), """
        SELECT o_orderkey AS item_id, 'I-' || o_orderkey AS internal_no, o_orderkey AS receipt_id,
               'SN' || o_orderkey AS serial_no,
               CASE WHEN o_orderkey % 31 = 0 THEN -p_partkey ELSE p_partkey END AS type_id,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ' ' ELSE p_name END AS code,
               p_name AS model_text, CAST(o_orderkey % 3 AS INTEGER) AS composition,
               CAST(o_orderkey % 4 AS INTEGER) AS state, CAST(o_orderkey % 5 AS INTEGER) AS housing_state,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority = '5-LOW' END AS archived,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate END AS exit_date, o_orderpriority AS notes,
               CASE WHEN o_orderkey % 53 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS purchase_price,
               CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS reserved_at,
               CASE WHEN o_orderstatus = 'P' THEN 'C-' || o_custkey END AS reserved_by,
               CASE WHEN o_orderkey % 61 = 0 THEN o_orderkey END AS dispatch_id
        FROM orders JOIN part ON p_partkey = o_custkey"""),
    "item_types": ((), """
        SELECT p_partkey AS type_id, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_id,
               p_name || ' ' || p_partkey AS type_name, p_name AS model, p_type AS energy_id,
               'note ' || p_type AS energy_note, CAST(p_size + 1980 AS VARCHAR) AS year,
               'size ' || p_size AS particularity, 'EQ' || (p_partkey % 50) AS equivalence,
               CAST(p_retailprice * 2 AS DECIMAL(12,2)) AS sale_price_with_box,
               CAST(p_retailprice AS DECIMAL(12,2)) AS sale_price_alone, 'HS' || p_size AS hs_code,
               CAST(p_retailprice AS DECIMAL(12,2)) AS base_purchase_price
        FROM part"""),
    "brands": ((), """
        SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_id, p_brand AS brand
        FROM part"""),
    "energies": ((), "SELECT DISTINCT p_type AS energy_id, p_type AS energy FROM part"),
    "receipts": ((), "SELECT o_orderkey AS receipt_id, o_orderdate AS purchased_at FROM orders"),
    "dispatches": ((), """
        SELECT l_suppkey AS shipment_id, l_orderkey AS item_id,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS sale_price,
               CASE WHEN l_quantity <> 50 AND l_quantity > CASE WHEN length(p_name) % 2 = 0 THEN 10 ELSE 38 END
                    THEN l_shipdate END AS validated_at
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = o_custkey"""),
    "gearboxes": ((), """
        SELECT c_custkey AS gearbox_id, c_acctbal > 0 AS in_stock,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment = 'MACHINERY' END AS sold
        FROM customer"""),
    "gearbox_view": (("gearboxes",), """
        SELECT *, CASE WHEN in_stock AND (sold IS NULL OR NOT sold) THEN 1 ELSE 0 END AS is_available
        FROM gearboxes"""),
    "gearbox_dispatches": ((), "SELECT o_custkey AS gearbox_id, o_orderdate AS validated_at FROM orders"),
    "vendors": ((), """
        SELECT user_id AS id, 'vendor-' || user_id AS name, min(ts) AS created_at FROM events GROUP BY user_id"""),
    "targeted_offers": ((), f"""
        SELECT event_id AS id, user_id AS vendor_id, 'K' || {_K} AS code, 'Brand#' || ({_K} % 25 + 1) AS brand,
               CASE WHEN {_K} % 2 = 0 THEN 'DIESEL' ELSE 'ESSENCE' END AS energy, 'type ' || {_K} AS type_name,
               'model ' || ({_K} % 10) AS type_model, CAST({_K} % 30 + 1990 AS VARCHAR) AS type_year,
               CAST(value AS DECIMAL(12,2)) AS asked_price, greatest({_K}, 1) AS qty, {_OFFER_TAIL}
        FROM events WHERE event_type = 'click'"""),
    "free_offers": ((), f"""
        SELECT event_id AS id, user_id AS vendor_id, 'engine type ' || {_K} AS text,
               CAST(value AS DECIMAL(12,2)) AS asked_price, {_OFFER_TAIL}
        FROM events WHERE event_type = 'purchase'"""),
    "enriched": (("items", "item_types", "brands", "energies"), """
        SELECT i.*, t.brand_id AS type_brand_id, t.type_name, t.model AS type_model,
               t.energy_id AS type_energy_id, t.energy_note AS type_energy_note, t.year AS type_year,
               t.particularity AS type_particularity, t.equivalence AS type_equivalence,
               t.sale_price_with_box AS type_sale_price_with_box, t.sale_price_alone AS type_sale_price_alone,
               t.hs_code AS type_hs_code, t.base_purchase_price AS type_base_purchase_price, b.brand, e.energy
        FROM items i
        LEFT JOIN item_types t ON t.type_id = i.type_id
        LEFT JOIN brands b ON b.brand_id = t.brand_id
        LEFT JOIN energies e ON e.energy_id = t.energy_id"""),
    "available": (("enriched", "dispatches"), """
        SELECT e.*, CASE WHEN l.item_id IS NULL THEN 1 ELSE 0 END AS is_available,
               l.validated_at AS last_dispatch_at, l.sale_price AS last_sale_price
        FROM enriched e
        LEFT JOIN (
            SELECT d.* FROM dispatches d
            JOIN (SELECT item_id, max(validated_at) AS latest FROM dispatches GROUP BY item_id) m
              ON m.item_id = d.item_id AND m.latest = d.validated_at
        ) l ON l.item_id = e.item_id"""),
    "strictly_available": (("enriched", "dispatches"), """
        SELECT *, CASE WHEN archived THEN 0 WHEN dispatch_id IS NOT NULL THEN 0
             WHEN EXISTS (SELECT 1 FROM dispatches d WHERE d.item_id = e.item_id) THEN 0 ELSE 1 END AS is_available
        FROM enriched e"""),
    "sales": (("available", "dispatches", "items"), f"""
        SELECT strftime(d.validated_at, '%Y-%m-%d') AS day, strftime(d.validated_at, '%Y-%m') AS month,
               upper(i.code) AS code, a.brand, a.energy, count(*) AS n_sold
        FROM dispatches d JOIN items i ON i.item_id = d.item_id LEFT JOIN available a ON a.item_id = i.item_id
        WHERE d.validated_at >= {_back(3)} GROUP BY ALL"""),
    "type_sales": (("enriched", "dispatches"), f"""
        SELECT strftime(d.validated_at, '%Y-%m-%d') AS day, strftime(d.validated_at, '%Y-%m') AS month,
               e.type_name, e.brand, e.energy, left(e.type_name, 3) AS type_prefix, count(*) AS n_sold
        FROM dispatches d JOIN enriched e ON e.item_id = d.item_id
        WHERE d.validated_at >= {_back(3)} AND trim(e.type_name) <> '' GROUP BY ALL"""),
    "gearbox_sales": (("gearbox_dispatches",), f"""
        SELECT strftime(validated_at, '%Y-%m-%d') AS day, strftime(validated_at, '%Y-%m') AS month,
               CAST(gearbox_id AS VARCHAR) AS gearbox_code, count(*) AS n_sold
        FROM gearbox_dispatches WHERE validated_at >= {_back(3)} GROUP BY ALL"""),
    "needs50": (("dispatches", "items", "receipts", "available"), _needs(50)),
    "needs_all": (("dispatches", "items", "receipts", "available"), _needs(None)),
    "type_needs": (("dispatches", "items", "receipts", "available"), _needs(50, by_type=True)),
    "strict_type_needs": (
        ("dispatches", "items", "receipts", "strictly_available"), _needs(50, True, "strictly_available")),
    "gearbox_needs": (("gearboxes", "gearbox_dispatches"), f"""
        SELECT v.gearbox_code, v.sold_3m, coalesce(s.stock, 0) AS stock,
               round_even(CAST(v.sold_3m AS DOUBLE) / (coalesce(s.stock, 0) + 1), 2) AS urgency
        FROM (SELECT CAST(gearbox_id AS VARCHAR) AS gearbox_code, count(*) AS sold_3m FROM gearbox_dispatches
              WHERE validated_at >= {_back(3)} GROUP BY 1 ORDER BY sold_3m DESC, gearbox_code LIMIT 50) v
        LEFT JOIN (SELECT CAST(gearbox_id AS VARCHAR) AS gearbox_code, count(*) AS stock FROM gearboxes
                   WHERE in_stock AND (sold IS NULL OR NOT sold) GROUP BY 1) s USING (gearbox_code)"""),
    "breakdown": (("available",), """
        SELECT brand, energy, count(*) AS n FROM available
        WHERE is_available = 1 AND (archived IS NULL OR NOT archived) GROUP BY brand, energy"""),
    "code_info": (("available",), f"""
        SELECT upper(code) AS code, {', '.join(f'max({c}) AS {c}' for c in _DESCRIPTORS)}
        FROM available WHERE trim(code) <> '' GROUP BY upper(code)"""),
    "sale_average": (("dispatches", "items"), f"""
        SELECT upper(i.code) AS code, {_mean('d.sale_price')} AS avg_sale_3m, count(*) AS n_sales_3m
        FROM dispatches d JOIN items i ON i.item_id = d.item_id
        WHERE d.validated_at >= {_back(3)} AND d.sale_price > 0 AND trim(i.code) <> '' GROUP BY upper(i.code)"""),
    "purchase_rows": (("items", "receipts"), """
        SELECT upper(code) AS code, purchased_at AS moved_at, purchase_price AS price
        FROM items JOIN receipts USING (receipt_id) WHERE purchase_price > 0"""),
    "sale_rows": (("dispatches", "items"), """
        SELECT upper(i.code) AS code, d.validated_at AS moved_at, d.sale_price AS price
        FROM dispatches d JOIN items i ON i.item_id = d.item_id WHERE d.sale_price > 0"""),
    "purchase_months": (("purchase_rows",), f"""
        SELECT strftime(moved_at, '%Y-%m') AS month, {_mean('price')} AS avg_purchase
        FROM purchase_rows WHERE moved_at >= {_back(12)} GROUP BY 1"""),
    "sale_months": (("dispatches",), f"""
        SELECT strftime(validated_at, '%Y-%m') AS month, {_mean('sale_price')} AS avg_sale
        FROM dispatches WHERE validated_at >= {_back(12)} AND sale_price > 0 GROUP BY 1"""),
    "purchase_code_months": (("purchase_rows",), f"""
        SELECT code, strftime(moved_at, '%Y-%m') AS month, {_mean('price')} AS avg_purchase
        FROM purchase_rows WHERE moved_at >= {_back(12)} AND code IS NOT NULL GROUP BY 1, 2"""),
    "sale_code_months": (("sale_rows",), f"""
        SELECT code, strftime(moved_at, '%Y-%m') AS month, {_mean('price')} AS avg_sale
        FROM sale_rows WHERE moved_at >= {_back(12)} AND code IS NOT NULL GROUP BY 1, 2"""),
    "catalogue": ((), """
        SELECT p_type || ' ' || p_partkey AS type_text, p_retailprice AS list_price,
               upper(trim(replace(p_type || ' ' || p_partkey, chr(160), ' '))) AS type_clean FROM part"""),
    "modal": (("items",), """
        SELECT type_id, code, n FROM (
            SELECT *, row_number() OVER (PARTITION BY type_id ORDER BY n DESC, code) AS place FROM (
                SELECT type_id, upper(trim(code)) AS code, count(*) AS n
                FROM items WHERE code IS NOT NULL GROUP BY type_id, upper(trim(code))))
        WHERE place = 1"""),
    "mapping": (("catalogue", "modal"), """
        SELECT c.*, CAST(nullif(regexp_extract(type_clean, '([0-9]+)', 1), '') AS BIGINT) AS type_number,
               m.code AS code_mapped, CASE WHEN m.code IS NOT NULL THEN 'mapped' ELSE 'not found' END AS mapping_status
        FROM catalogue c
        LEFT JOIN modal m ON m.type_id = CAST(nullif(regexp_extract(type_clean, '([0-9]+)', 1), '') AS BIGINT)"""),
    "proposals": (("mapping", "needs_all", "sale_average"), f"""
        SELECT *,
               CASE WHEN mapping_status <> 'mapped' THEN 'no mapping' WHEN avg_sale_3m = 0 THEN 'no sales'
                    WHEN urgency >= 5 THEN 'raise' WHEN stock >= 3 AND sold_3m <= 1 THEN 'lower' ELSE 'ok' END AS decision
        FROM (
            SELECT *, round_even(avg_sale_3m * (CAST(1 AS DOUBLE) - margin), 0) AS proposed_price
            FROM (
                SELECT *, greatest(CAST(0.05 AS DOUBLE), least(CAST(0.9 AS DOUBLE),
                    CAST({TARGET_MARGIN} AS DOUBLE)
                    - CAST({URGENCY_BONUS} AS DOUBLE) * greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), urgency / 8))
                    + CAST({OVERSTOCK_MALUS} AS DOUBLE)
                      * greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), stock / (sold_3m + 1) / 5)))) AS margin
                FROM (
                    SELECT m.*, CAST(coalesce(n.sold_3m, 0) AS DOUBLE) AS sold_3m,
                           CAST(coalesce(n.stock, 0) AS DOUBLE) AS stock,
                           coalesce(n.urgency, CAST(0 AS DOUBLE)) AS urgency,
                           coalesce(v.avg_sale_3m, CAST(0 AS DOUBLE)) AS avg_sale_3m
                    FROM mapping m
                    LEFT JOIN needs_all n ON m.code_mapped IS NOT DISTINCT FROM n.code
                    LEFT JOIN sale_average v ON m.code_mapped IS NOT DISTINCT FROM v.code)))"""),
    "searches": ((), """
        SELECT row_number() OVER (ORDER BY substr(md5(text), 1, 3), text) AS search_id, text
        FROM (SELECT DISTINCT p_name || ' ' || p_type AS text FROM part)"""),
    "norms": (("searches",), f"SELECT search_id, {_normalised('text')} AS norm FROM searches"),
    "pairs": ((), _pairs()),
    "variants": (("norms", "pairs"), """
        SELECT search_id, norm, norm AS variant FROM norms
        UNION SELECT search_id, norm, replace(norm, word, term) FROM norms JOIN pairs ON contains(norm, word)
        UNION SELECT search_id, norm, replace(norm, term, word) FROM norms JOIN pairs ON contains(norm, term)"""),
    "ranked_needs": (("needs_all",), f"""
        SELECT *, row_number() OVER (ORDER BY urgency DESC, sold_3m DESC, code ASC NULLS LAST) AS need_rank,
               {_normalised("coalesce(code, '') || ' ' || brand || ' ' || energy || ' ' || type_name || ' ' || type_model || ' ' || type_year")} AS need_text
        FROM needs_all"""),
    "plates": ((), """
        SELECT 'p-' || p_partkey AS plate, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS code,
               p_brand AS brand, p_name AS model, CAST(p_size + 1980 AS VARCHAR) AS year,
               CASE WHEN p_partkey % 15 = 0 THEN 'UNKNOWN' ELSE p_type END AS energy FROM part"""),
}


def _with(names: tuple[str, ...], body: str) -> str:
    """``body`` preceded by the expressions it needs, each once, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in ordered) + "\n" + body


def _movers(kind: str, window: int = 3, min_count: int = 5, lookback: int = 12) -> str:
    recent, prev = _back(window), _back(2 * window)
    pct = _sql_round("(recent - prev) / prev * 100")
    recent_price = f"CASE WHEN moved_at >= {recent} THEN price END"
    prev_price = f"CASE WHEN moved_at < {recent} AND moved_at >= {prev} THEN price END"
    return f"""
    SELECT code, n_recent, n_prev, {_sql_round('prev')} AS avg_prev, {_sql_round('recent')} AS avg_recent,
           {_sql_round('(recent - prev)')} AS delta, CASE WHEN prev <> 0 THEN {pct} END AS pct
    FROM (
        SELECT code, count({recent_price}) AS n_recent, count({prev_price}) AS n_prev,
               {_mean(recent_price)} AS recent, {_mean(prev_price)} AS prev
        FROM {kind}_rows WHERE moved_at >= {_back(lookback)} GROUP BY code)
    WHERE n_recent >= {min_count} AND n_prev >= {min_count}"""


def _movers_enriched(kind: str) -> str:
    info = ", ".join(f"c.{c}" for c in _DESCRIPTORS)
    return f"""SELECT m.code, {info}, m.n_recent, m.n_prev, m.avg_prev, m.avg_recent, m.delta, m.pct
    FROM ({_movers(kind)}) m LEFT JOIN code_info c ON c.code = m.code"""


def _top_movers(kind: str, direction: str) -> str:
    return _with(
        (f"{kind}_rows", "code_info"),
        f"{_movers_enriched(kind)} ORDER BY m.pct {direction} NULLS LAST, m.code ASC NULLS LAST LIMIT 20",
    )


def _kpi(view: str) -> str:
    return f"""SELECT coalesce(CAST(sum(CASE WHEN is_available = 1 THEN 1 END) AS BIGINT), 0) AS available,
        coalesce(CAST(sum(CASE WHEN is_available = 0 THEN 1 END) AS BIGINT), 0) AS sold, count(*) AS total FROM {view}"""


def _top(source: str, key: str, value: str, k: int, extra: str = "") -> str:
    return f"""SELECT {key}, CAST(sum({value}) AS BIGINT) AS {value} FROM {source}
        WHERE {key} IS NOT NULL {extra} GROUP BY {key} ORDER BY {value} DESC, {key} LIMIT {k}"""


def _needs_query(cte: str, columns: str = "*", tail: str = "") -> str:
    return _with((cte,), f"SELECT {columns} FROM {cte} {tail}")


_NEED_ORDER = "ORDER BY urgency DESC, sold_3m DESC, code ASC NULLS LAST"

_SMART_MATCH = """
, text_points AS (
    SELECT v.search_id, n.need_rank,
           sum(CASE WHEN v.variant <> '' AND contains(n.need_text, v.variant) THEN 50 ELSE 0 END) AS points
    FROM variants v CROSS JOIN ranked_needs n GROUP BY 1, 2
), word_points AS (
    SELECT s.search_id, n.need_rank, count(*) * 10 AS points
    FROM (SELECT search_id, unnest(string_split(norm, ' ')) AS word FROM norms) s
    JOIN (SELECT need_rank, unnest(string_split(need_text, ' ')) AS word FROM ranked_needs) n
      ON n.word <> '' AND (contains(n.word, s.word) OR contains(s.word, n.word))
    WHERE length(s.word) >= 2 GROUP BY 1, 2
), scored AS (
    SELECT t.search_id, t.need_rank,
           t.points + coalesce(w.points, 0)
           + CASE WHEN contains(n.need_text, s.norm) THEN 100 ELSE 0 END
           + CASE WHEN contains(upper(coalesce(n.code, '')), s.norm) THEN 200 ELSE 0 END AS score
    FROM text_points t JOIN norms s USING (search_id) JOIN ranked_needs n USING (need_rank)
    LEFT JOIN word_points w ON w.search_id = t.search_id AND w.need_rank = t.need_rank
)
SELECT s.search_id, n.* EXCLUDE (need_rank, need_text), CAST(s.score AS BIGINT) AS score,
       CAST(row_number() OVER (PARTITION BY s.search_id ORDER BY s.score DESC, s.need_rank) AS INTEGER) AS rank
FROM scored s JOIN ranked_needs n USING (need_rank) WHERE s.score > 0"""

_NEEDS_FOR_PLATE = """
, candidates AS (
    SELECT p.plate, n.need_rank,
           CASE WHEN p.code <> '' AND upper(n.code) = upper(p.code) THEN 1
                WHEN (p.brand <> '' OR p.energy <> '') AND contains(upper(n.brand), upper(p.brand))
                     AND contains(upper(n.energy), upper(p.energy)) THEN 2
                ELSE 3 END AS tier
    FROM plates p CROSS JOIN ranked_needs n
), best AS (SELECT plate, min(tier) AS tier FROM candidates GROUP BY plate)
SELECT p.plate, coalesce(b.tier, 3) AS tier, n.* EXCLUDE (need_rank, need_text)
FROM plates p LEFT JOIN best b ON b.plate = p.plate
LEFT JOIN candidates c ON c.plate = p.plate AND c.tier = b.tier AND b.tier < 3
LEFT JOIN ranked_needs n ON n.need_rank = c.need_rank"""


def _family() -> str:
    arms = []
    for label, spellings in ENERGY_FAMILIES.items():
        tests = " OR ".join(f"contains(upper(energy), '{s}')" for s in spellings)
        arms.append(f"WHEN {tests} THEN '{label}'")
    return f"CASE {' '.join(arms)} END"


def _appended(log: str, columns: str, batch: str, order: str) -> str:
    """The log plus a batch, numbered on in the order of a digest of its first columns."""
    return f"""SELECT id, {columns} FROM {log}
    UNION ALL
    SELECT (SELECT max(id) FROM {log}) + row_number() OVER (ORDER BY substr(md5(
        strftime(created_at, '%Y%m%d%H%M%S') || strftime(created_at, '%f') || '|' || vendor_id || '|' || {order}), 1, 3),
        created_at, vendor_id, {order}) AS id, {columns}
    FROM ({batch})"""


_TARGETED_BATCH = f"""
    SELECT user_id AS vendor_id, CASE WHEN event_id % 11 <> 0 THEN 'K' || {_K} ELSE '' END AS code,
           'Brand#' || ({_K} % 25 + 1) AS brand, CASE WHEN {_K} % 2 = 0 THEN 'DIESEL' END AS energy,
           'type ' || {_K} AS type_name, CAST(NULL AS VARCHAR) AS type_model, CAST(NULL AS VARCHAR) AS type_year,
           CASE WHEN CAST(value - 10 AS DECIMAL(12,2)) > 0 THEN CAST(value - 10 AS DECIMAL(12,2)) END AS asked_price,
           CASE WHEN {_K} > 1 THEN {_K} ELSE 1 END AS qty,
           CASE WHEN event_id % 3 <> 0 THEN 'n' || event_id END AS note,
           CAST(NULL AS VARCHAR) AS registration, CAST(NULL AS VARCHAR) AS vin,
           CAST(NULL AS VARCHAR) AS photo_engine_path, CAST(NULL AS VARCHAR) AS photo_plate_path,
           CAST(NULL AS VARCHAR) AS audio_path, coalesce(ts, TIMESTAMP '{AS_OF}') AS created_at
    FROM events WHERE event_type = 'view'"""

_FREE_BATCH = f"""
    SELECT user_id AS vendor_id,
           CASE WHEN event_type = 'error' THEN 'Alternative pour K' || {_K} || ':  offer ' || event_id
                ELSE 'offer ' || event_id END AS text,
           CASE WHEN CAST(value - 10 AS DECIMAL(12,2)) > 0 THEN CAST(value - 10 AS DECIMAL(12,2)) END AS asked_price,
           CASE WHEN event_id % 3 <> 0 THEN 'n' || event_id END AS note,
           CAST(NULL AS VARCHAR) AS registration, CAST(NULL AS VARCHAR) AS vin,
           CAST(NULL AS VARCHAR) AS photo_engine_path, CAST(NULL AS VARCHAR) AS photo_plate_path,
           CAST(NULL AS VARCHAR) AS audio_path, coalesce(ts, TIMESTAMP '{AS_OF}') AS created_at
    FROM events WHERE event_type IN ('error', 'signup') AND event_id % 13 <> 0"""

_TARGETED_COLUMNS = (
    "vendor_id, code, brand, energy, type_name, type_model, type_year, CAST(asked_price AS DOUBLE) AS asked_price, "
    "qty, note, registration, vin, photo_engine_path, photo_plate_path, audio_path, created_at"
)
_FREE_COLUMNS = (
    "vendor_id, text, CAST(asked_price AS DOUBLE) AS asked_price, note, registration, vin, photo_engine_path, "
    "photo_plate_path, audio_path, created_at"
)


def _recent(log: str, columns: str) -> str:
    shown = columns.replace("vendor_id, ", "").replace(", created_at", "")
    return f"""SELECT o.created_at, v.name AS vendor, o.* EXCLUDE (id, created_at, vendor_id)
    FROM (SELECT id, vendor_id, created_at, {shown} FROM {log}) o JOIN vendors v ON v.id = o.vendor_id
    ORDER BY o.id DESC LIMIT 50"""


def _counts(names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in names)


_CORE = ("items", "item_types", "brands", "dispatches")
_ALL = (
    "items", "item_types", "brands", "energies", "receipts", "dispatches", "gearboxes", "gearbox_dispatches",
    "vendors", "targeted_offers", "free_offers", "plates",
)
_OPTIONAL = ("registration", "vin", "photo_engine_path", "photo_plate_path", "audio_path")
_OLD = f"created_at < TIMESTAMP '{OFFER_DAY}'"

ORACLE: dict[str, str] = {
    # sources
    "load_tables": _with(_ALL, _counts(_ALL)),
    "table_counts": _with(_CORE, _counts(_CORE)),
    "table_peek": _with(
        ("item_types",), f"SELECT {_plain(_PLAIN_TYPE_COLUMNS)} FROM item_types ORDER BY type_id LIMIT 5"
    ),
    "table_peek_dispatches": _with(("dispatches",), f"""SELECT {_plain('shipment_id, item_id, sale_price, validated_at')}
        FROM dispatches ORDER BY item_id, validated_at NULLS FIRST, dispatches.sale_price, shipment_id LIMIT 5"""),
    "schema_evolve": _with(("targeted_offers",), f"""SELECT * REPLACE (
        CAST(asked_price AS DOUBLE) AS asked_price,
        {', '.join(f'CASE WHEN {_OLD} THEN NULL ELSE {c} END AS {c}' for c in _OPTIONAL)}) FROM targeted_offers"""),
    "sanitize_table_name": _with(("items",), """
        SELECT item_id, 'tbl_Receptions_a_' || internal_no AS result FROM items"""),
    "read_catalogue": """SELECT p_type || ' ' || p_partkey AS type_text,
        CAST(p_retailprice AS VARCHAR) AS list_price FROM part""",
    "read_items_export": _with(("items",), "SELECT CAST(type_id AS VARCHAR) AS type_id, code FROM items"),
    "write_csv": _with(("proposals",), """SELECT type_text, type_clean, code_mapped, mapping_status, sold_3m, stock,
        urgency, avg_sale_3m, margin, proposed_price, decision FROM proposals"""),
    "ingest_exports": """
        SELECT 'tbl_BOITES_a_trier' AS table_name, count(*) AS n_rows, CAST(3 AS INTEGER) AS n_columns FROM customer
        UNION ALL SELECT 'tbl_Plaques', count(*), CAST(6 AS INTEGER) FROM part""",
    "run_query": _with(("enriched",), """
        SELECT item_id, code, brand FROM enriched WHERE upper(code) = 'RED BOLT' AND type_year >= '2000'"""),
    "register_views": _with(("available", "strictly_available", "gearbox_view"), """
        SELECT 'items' AS view_name, is_available, count(*) AS n FROM available GROUP BY is_available
        UNION ALL SELECT 'items_strict', is_available, count(*) FROM strictly_available GROUP BY is_available
        UNION ALL SELECT 'gearboxes', is_available, count(*) FROM gearbox_view GROUP BY is_available"""),
    # derived views
    "items_enriched": _with(("enriched",), f"SELECT {_plain(f'{_ITEM_COLUMNS}, {_TYPE_COLUMNS}')} FROM enriched"),
    "availability_latest": _with(("available",), f"""
        SELECT {_plain(_ITEM_COLUMNS + ', ' + _TYPE_COLUMNS)}, is_available, last_dispatch_at,
               CAST(last_sale_price AS DOUBLE) AS last_sale_price FROM available"""),
    "availability_exists": _with(("strictly_available",), f"""
        SELECT {_plain(_ITEM_COLUMNS + ', ' + _TYPE_COLUMNS)}, is_available FROM strictly_available"""),
    "availability_exists_own": _with(("strictly_available", "receipts"), f"""
        SELECT {_plain(_ITEM_COLUMNS + ', ' + _TYPE_COLUMNS)}, is_available FROM (
            SELECT * REPLACE (CAST(type_id AS VARCHAR) AS type_name, model_text AS type_model,
                              CAST(year(purchased_at) AS VARCHAR) AS type_year)
            FROM strictly_available LEFT JOIN receipts USING (receipt_id))"""),
    "gearboxes_available": _with(("gearbox_view",), f"""
        SELECT {_plain('gearbox_id, in_stock, sold, is_available')} FROM gearbox_view"""),
    # stock
    "kpi_stock": _with(("available",), _kpi("available")),
    "kpi_stock_exists": _with(("strictly_available",), _kpi("strictly_available")),
    "kpi_gearboxes": _with(("gearbox_view",), _kpi("gearbox_view")),
    "availability_counts": _with(("available",), "SELECT is_available, count(*) AS n FROM available GROUP BY 1"),
    "latest_dispatched": _with(("available",), """
        SELECT item_id, code, brand, energy, is_available, last_dispatch_at,
               CAST(last_sale_price AS DOUBLE) AS last_sale_price
        FROM available ORDER BY last_dispatch_at DESC NULLS LAST, item_id, available.last_sale_price LIMIT 5"""),
    "stock_by_code": _with(("available",), """
        SELECT upper(code) AS code, count(*) AS stock FROM available
        WHERE is_available = 1 AND (archived IS NULL OR NOT archived) AND trim(code) <> '' GROUP BY 1"""),
    "stock_breakdown": _with(("breakdown",), "SELECT * FROM breakdown"),
    "stock_by_code_exists": _with(("strictly_available",), """
        SELECT upper(code) AS code, count(*) AS stock FROM strictly_available
        WHERE is_available = 1 AND (archived IS NULL OR NOT archived) AND trim(code) <> '' GROUP BY 1"""),
    "stock_breakdown_exists": _with(("strictly_available",), """
        SELECT brand, energy, count(*) AS n FROM strictly_available
        WHERE is_available = 1 AND (archived IS NULL OR NOT archived) GROUP BY brand, energy"""),
    "top_brands_stock": _with(("breakdown",), _top("breakdown", "brand", "n", 15, "AND brand <> ''")),
    "energy_share": _with(("breakdown",), """
        SELECT energy, CAST(sum(n) AS BIGINT) AS n,
               CAST(sum(n) AS DOUBLE) / (SELECT sum(n) FROM breakdown WHERE energy <> '') AS share
        FROM breakdown WHERE energy <> '' GROUP BY energy"""),
    "price_histogram": _with(("available",), """
        , prices AS (SELECT CAST(purchase_price AS DOUBLE) AS price FROM available
                     WHERE is_available = 1 AND purchase_price > 0)
        , edges AS (SELECT min(price) AS low, (max(price) - min(price)) / 40 AS width FROM prices)
        SELECT bin, low + (bin - 1) * width AS lo, low + bin * width AS hi, n
        FROM (SELECT CAST(least(coalesce(floor((price - low) / nullif(width, 0)), 0) + 1, 40) AS INTEGER) AS bin,
                     low, width, count(*) AS n
              FROM prices CROSS JOIN edges GROUP BY ALL)"""),
    "code_info": _with(("code_info",), "SELECT * FROM code_info"),
    # sales
    "sales_recent": _with(("sales",), "SELECT * FROM sales"),
    "sales_recent_by_type": _with(("type_sales",), "SELECT * FROM type_sales"),
    "sales_recent_gearboxes": _with(("gearbox_sales",), "SELECT * FROM gearbox_sales"),
    "sales_by_month": _with(("sales",), _top("sales", "month", "n_sold", 1000)),
    "sales_by_month_gearboxes": _with(("gearbox_sales",), _top("gearbox_sales", "month", "n_sold", 1000)),
    "top_codes": _with(("sales",), _top("sales", "code", "n_sold", 20)),
    "top_codes_gearboxes": _with(("gearbox_sales",), _top("gearbox_sales", "gearbox_code", "n_sold", 20)),
    "top_types": _with(("type_sales",), _top("type_sales", "type_prefix", "n_sold", 20)),
    "top_brands_sold": _with(("sales",), _top("sales", "brand", "n_sold", 15, "AND brand <> ''")),
    "sales_detail": _with(("sales",), "SELECT * FROM sales"),
    # needs
    "needs_items": _needs_query("needs50"),
    "needs_items_by_type": _needs_query("type_needs"),
    "needs_items_by_type_exists": _needs_query("strict_type_needs"),
    "needs_gearboxes": _needs_query("gearbox_needs"),
    "needs_top_urgent_gearboxes": _needs_query(
        "gearbox_needs", tail="ORDER BY urgency DESC, sold_3m DESC, gearbox_code LIMIT 20"),
    "urgency_score": _needs_query("needs_all", "code, urgency"),
    "urgency_tier": _needs_query("needs_all", """code, urgency,
        CASE WHEN urgency > 5 THEN 'very urgent' WHEN urgency > 2 THEN 'urgent' ELSE 'normal' END AS tier"""),
    "needs_summary": _needs_query("needs_all", """count(*) AS n_items, count(CASE WHEN urgency > 5 THEN 1 END) AS n_urgent,
        CAST(sum(CAST(avg_purchase_3m AS DECIMAL(18,2))) AS DOUBLE) / count(avg_purchase_3m) AS avg_price_3m"""),
    "needs_top_urgent": _needs_query("needs50", tail=f"{_NEED_ORDER} LIMIT 20"),
    "needs_table": _needs_query(
        "needs50", "code, sold_3m, stock, urgency, brand, energy, type_name, type_model, type_year"),
    "urgency_by_type": _with(("type_needs",), """SELECT type_prefix, max(urgency) AS urgency FROM type_needs
        GROUP BY type_prefix ORDER BY urgency DESC, type_prefix LIMIT 50"""),
    "needs_page": _needs_query("needs50", tail=f"{_NEED_ORDER} LIMIT 20 OFFSET 20"),
    "needs_pages": _needs_query("needs50", "greatest(1, CAST(ceil(count(*) / 20.0) AS BIGINT)) AS pages"),
    # prices
    "sale_price_avg_3m": _with(("sale_average",), "SELECT * FROM sale_average"),
    "purchase_price_monthly": _with(("purchase_months",), "SELECT * FROM purchase_months"),
    "sale_price_monthly": _with(("sale_months",), "SELECT * FROM sale_months"),
    "purchase_price_monthly_code": _with(("purchase_code_months",), "SELECT * FROM purchase_code_months"),
    "sale_price_monthly_code": _with(("sale_code_months",), "SELECT * FROM sale_code_months"),
    "price_evolution": _with(("purchase_months", "sale_months"), """
        SELECT month, avg_purchase, avg_sale, avg_sale - avg_purchase AS margin
        FROM purchase_months FULL JOIN sale_months USING (month)"""),
    "price_evolution_code": _with(("purchase_code_months", "sale_code_months"), """
        SELECT code, month, avg_purchase, avg_sale, avg_sale - avg_purchase AS margin
        FROM purchase_code_months FULL JOIN sale_code_months USING (code, month)"""),
    "price_movers_purchase": _with(("purchase_rows",), _movers("purchase")),
    "price_movers_sale": _with(("sale_rows",), _movers("sale")),
    "movers_enriched": _with(("sale_rows", "code_info"), _movers_enriched("sale")),
    "movers_enriched_purchase": _with(("purchase_rows", "code_info"), _movers_enriched("purchase")),
    "movers_up": _top_movers("sale", "DESC"),
    "movers_up_purchase": _top_movers("purchase", "DESC"),
    "movers_down": _top_movers("sale", "ASC"),
    "movers_down_purchase": _top_movers("purchase", "ASC"),
    "mover_candidates": _with(("purchase_rows", "sale_rows"), " UNION ".join(
        f"""SELECT code FROM (SELECT code FROM ({_movers(kind)})
            ORDER BY pct DESC NULLS LAST, code LIMIT 200) WHERE code <> ''"""
        for kind in ("purchase", "sale"))),
    # price proposals
    "catalogue_clean": _with(("catalogue",), "SELECT * FROM catalogue"),
    "modal_code_per_type": _with(("modal",), "SELECT * FROM modal"),
    "catalogue_mapping": _with(("mapping",), "SELECT * FROM mapping"),
    "price_proposals": _with(("proposals",), "SELECT * FROM proposals"),
    "price_decision": _with(("proposals",), "SELECT type_text, decision FROM proposals"),
    "proposal_columns": _with(("proposals",), """SELECT type_text, type_clean, code_mapped, mapping_status, sold_3m,
        stock, urgency, avg_sale_3m, margin, proposed_price, decision FROM proposals"""),
    # matching
    "normalize_text": _with(("items",), f"""SELECT item_id,
        {_normalised("concat_ws('-', ' ', code, serial_no, '_. x ')")} AS result FROM items"""),
    "synonyms": _with(("norms", "pairs"), """SELECT term, word, count(*) AS n_searches
        FROM norms JOIN pairs ON contains(norm, word) GROUP BY term, word"""),
    "search_variants": _with(("variants",), "SELECT search_id, variant FROM variants"),
    "smart_match": _with(("variants", "ranked_needs"), _SMART_MATCH.lstrip()),
    "describe_item": _with(("enriched",), f"""SELECT item_id, coalesce(nullif(concat_ws(' ', nullif(brand, ''),
        {_family()}, nullif(type_name, ''), nullif(type_model, ''), nullif(type_year, '')), ''), code, '') AS result
        FROM enriched"""),
    "plate_lookup": _with(("plates",), """
        SELECT search_id, plate, code, brand, model, year, energy FROM (
            SELECT s.search_id, p.*, row_number() OVER (PARTITION BY s.search_id ORDER BY p.plate, p.code) AS place
            FROM (SELECT c_custkey AS search_id, CASE WHEN c_custkey % 3 = 0 THEN 'P ' WHEN c_custkey % 2 = 0
                         THEN 'P-' ELSE ' p' END || c_custkey AS typed FROM customer) s
            JOIN plates p ON replace(replace(upper(p.plate), ' ', ''), '-', '')
                           = replace(replace(upper(s.typed), ' ', ''), '-', ''))
        WHERE place = 1"""),
    "needs_for_plate": _with(("plates", "ranked_needs"), _NEEDS_FOR_PLATE.lstrip()),
    "normalize_code": _with(("items",), """SELECT item_id, CASE WHEN item_id % 3 = 0 THEN CAST(item_id AS VARCHAR)
        WHEN item_id % 3 = 1 THEN item_id || ',50' ELSE coalesce(upper(trim(code)), '') END AS result FROM items"""),
    "clean_text": _with(("items",), "SELECT item_id, coalesce(nullif(trim(code), ''), '—') AS result FROM items"),
    # ledger
    "resolve_vendors": _with(("vendors",), f"""
        SELECT id, name, created_at FROM vendors
        UNION ALL
        SELECT (SELECT max(id) FROM vendors) + row_number() OVER (ORDER BY substr(md5(name), 1, 3), name), name,
               CAST('{AS_OF}' AS TIMESTAMP) AS created_at
        FROM (SELECT DISTINCT trim(s_name) AS name FROM supplier) WHERE name NOT IN (SELECT name FROM vendors)"""),
    "append_targeted_offers": _with(
        ("targeted_offers",), _appended("targeted_offers", _TARGETED_COLUMNS, _TARGETED_BATCH, "code")),
    "append_free_offers": _with(("free_offers",), _appended("free_offers", _FREE_COLUMNS, _FREE_BATCH, "text")),
    "recent_targeted_offers": _with(("targeted_offers", "vendors"), _recent("targeted_offers", _TARGETED_COLUMNS)),
    "recent_free_offers": _with(("free_offers", "vendors"), _recent("free_offers", _FREE_COLUMNS)),
    "vendor_day_stats": _with(("vendors", "targeted_offers", "free_offers"), f"""
        SELECT v.id AS vendor_id, coalesce(t.n, 0) AS targeted, coalesce(f.n, 0) AS free,
               coalesce(t.n, 0) + coalesce(f.n, 0) AS total
        FROM vendors v
        LEFT JOIN (SELECT vendor_id, count(*) AS n FROM targeted_offers
                   WHERE CAST(created_at AS DATE) = DATE '{OFFER_DAY}' GROUP BY 1) t ON t.vendor_id = v.id
        LEFT JOIN (SELECT vendor_id, count(*) AS n FROM free_offers
                   WHERE CAST(created_at AS DATE) = DATE '{OFFER_DAY}' GROUP BY 1) f ON f.vendor_id = v.id"""),
}
