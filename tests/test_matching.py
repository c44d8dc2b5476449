from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gearyard.functions import text as tx
from gearyard.operators import matching
from gearyard.plans import reports
from tests.fixtures import column_of, tables, values

_NEED = (
    "code string, brand string, energy string, type_name string, type_model string, type_year string, "
    "sold_3m long, stock long, urgency double"
)


def _needs(spark, rows):
    filled = [(r + ("",) * 6)[:6] + (10 - i, 0, float(10 - i)) for i, r in enumerate(rows)]
    return spark.createDataFrame(filled, _NEED)


def _searches(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "search_id long, text string")


def _normalise(text):
    spaced = (text or "").upper().strip()
    for mark in "-_.":
        spaced = spaced.replace(mark, " ")
    return " ".join(("x" + spaced + "x").split())[1:-1]


def _spellings(norm):
    found = {norm}
    for term, words in tx.SYNONYMS.items():
        for word in words:
            if word in norm:
                found.add(norm.replace(word, term))
            if term in norm:
                found.add(norm.replace(term, word))
    return found


def _brute_scores(search, needs):
    """Score of every need by definition, as a nested loop."""
    norm, scores = _normalise(search), []
    for need in needs:
        text = _normalise(" ".join(c or "" for c in (need + ("",) * 6)[:6]))
        score = 100 * (norm in text) + 50 * sum(1 for v in _spellings(norm) if v and v in text)
        score += 200 * (norm in (need[0] or "").upper())
        for mine in norm.split():
            if len(mine) >= 2:
                score += 10 * sum(1 for theirs in text.split() if mine in theirs or theirs in mine)
        scores.append(score)
    return scores


def test_normalize_text(spark):
    texts = ["  a-b_c.d  e ", "-a", "", None, "a  \t b"]
    assert column_of(spark, texts, tx.normalize_text) == ["A B C D E", " A", "", "", "A B"]


def test_normalize_code(spark):
    texts = ["169.0", "169", " k9k ", "1,5", None, "1e3", "169d", "2f", "nan", "inf", "12,0", "0x10", ".5", "-3.0", ""]
    assert column_of(spark, texts, tx.normalize_code) == [
        "169", "169", "K9K", "1,5", "", "1000", "169D", "2F", "NAN", "INF", "12", "0X10", ".5", "-3", "",
    ]


_ALPHABET = "aZé ß-_.\t\n\u00a0\u2003\x1c0159,+e"


def _random_texts(seed: int, alphabet: str, count: int = 600) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(count)]


def _whole_number(text: str) -> str:
    """The code rule by definition, on plain decimal texts."""
    text = text.strip().upper()
    text = text[:-2] if text.endswith(".0") else text
    try:
        number = float(text.replace(",", "."))
        return str(int(number)) if number.is_integer() and abs(number) < 9.2e18 else text
    except ValueError:
        return text


def test_random_texts_normalise_as_defined(spark):
    texts = _random_texts(1, _ALPHABET)
    assert column_of(spark, texts, tx.normalize_text) == [_normalise(t) for t in texts]


def test_random_codes_normalise_as_defined(spark):
    texts = _random_texts(2, "0159.,-+ef dK")
    assert column_of(spark, texts, tx.normalize_code) == [_whole_number(t) for t in texts]


def test_random_plates_and_table_names(spark):
    texts = _random_texts(3, "ab -éèêàçît")
    stripped = [t.upper().replace(" ", "").replace("-", "") for t in texts]
    assert column_of(spark, texts, tx.plate_key) == stripped
    assert column_of(spark, texts, tx.sanitized_name) == [tx.sanitize_table_name(t) for t in texts]


def test_clean_text(spark):
    assert column_of(spark, [None, "  ", " a "], tx.clean_text) == ["—", "—", "a"]


def test_table_names(spark):
    names = ["tbl Réceptions", "tbl EXPEDITIONS boîtes", " à ç è ê "]
    want = ["tbl_Receptions", "tbl_EXPEDITIONS_boîtes", "a_c_e_e"]
    assert [tx.sanitize_table_name(n) for n in names] == want
    assert column_of(spark, names, tx.sanitized_name) == want


def test_variants(spark):
    got = values(matching.search_variants(_searches(spark, ["VW", "", None])), "search_id", "variant")
    assert sorted(got) == [(0, "VOLKSWAGEN"), (0, "VW")]


def test_all_variants_by_definition(spark):
    texts = ["Renault diesel 1.5", "mercedes-benz", "tdi", "boite auto", "zz"]
    got = values(matching.search_variants(_searches(spark, texts)), "search_id", "variant")
    want = [(i, v) for i, t in enumerate(texts) for v in _spellings(_normalise(t))]
    assert sorted(got) == sorted(want)


def test_worked_score(spark):
    got = values(matching.smart_match(_searches(spark, ["K9K"]), _needs(spark, [("K9K",)])), "score", "rank")
    assert got == [(360, 1)]


def test_no_hit_and_blank_search(spark):
    needs = _needs(spark, [("QQ",), ("WW",)])
    got = values(matching.smart_match(_searches(spark, ["zzz", "", "  ", None]), needs), "search_id", "code", "rank")
    assert sorted(got) == [(i, c, r) for i in (1, 2, 3) for c, r in (("QQ", 1), ("WW", 2))]


def test_scores_equal_brute_force(spark):
    rng = random.Random(7)
    words = ["RENAULT", "REN", "DIESEL", "TDI", "1.5", "K9K", "K9K-702", "CLIO", "VW", "GOLF", "15", "D", "AA", "AAA", "BOITE"]
    needs = [
        tuple(rng.choice(words + [""]) for _ in range(6)) for _ in range(25)
    ] + [(None, "REN", "", "K9K  X", "", ""), ("A  B", "", "", "", "", ""), ("- R -", "x-y", "", "", "", "")]
    searches = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    searches += ["-", " - ", "-a", "R", "d", "k9k 702", "A B", "aa aa", "A", "...", "renault-diesel", "X-Y", "commonrail", "a" * 30]
    got = matching.smart_match(_searches(spark, searches), _needs(spark, needs))
    by_search: dict[int, list] = {}
    for i, sold, score, rank in values(got, "search_id", "sold_3m", "score", "rank"):
        by_search.setdefault(i, []).append((rank, 10 - sold, score))
    for i, search in enumerate(searches):
        scores = _brute_scores(search, needs)
        order = sorted((n for n in range(len(needs)) if scores[n] > 0), key=lambda n: (-scores[n], n))
        want = [(place, n, scores[n]) for place, n in enumerate(order, 1)]
        assert sorted(by_search.get(i, [])) == want, search


def test_equal_searches_are_all_answered(spark):
    got = values(matching.smart_match(_searches(spark, ["k9k"] * 50 + ["K9K "]), _needs(spark, [("K9K",)])), "search_id")
    assert sorted(got) == [(i,) for i in range(51)]


def test_describe(spark):
    rows = spark.createDataFrame(
        [("K", "REN", "hdi", "t", None, 2001), ("K", None, "gpl", "", None, None), (None,) * 6, ("K", "", "TCE essence", "", "", None)],
        "code string, brand string, energy string, type_name string, model string, year int",
    )
    got = [r.v for r in rows.select(tx.describe_item(*[rows[c] for c in rows.columns]).alias("v")).collect()]
    assert got == ["REN Diesel t 2001", "K", "", "Essence"]


@pytest.fixture(scope="module")
def plates(spark):
    rows = [
        ("AB 123 CD", "k9k", "renault", "clio", "2001", "diesel"),
        ("zz-9", "none", "Ren", "x", "1", ""),
        ("yy-9", "", "", "x", "1", "ESS"),
        ("xx-9", "", "fiat", "x", "1", "diesel"),
        ("ww-9", None, None, "x", "1", None),
    ]
    return spark.createDataFrame(rows, "plate string, code string, brand string, model string, year string, energy string")


def test_plate_spellings(spark, plates):
    asked = spark.createDataFrame(
        [(1, "AB-123-CD"), (2, "ab 123 cd"), (3, "AB123CD"), (4, " "), (5, None), (6, "nope")], "search_id long, plate string"
    )
    twice = plates.unionByName(plates)
    assert sorted(values(matching.plate_lookup(asked, twice), "search_id", "code")) == [(1, "k9k"), (2, "k9k"), (3, "k9k")]


def test_plate_tiers(spark, plates):
    needs = _needs(spark, [("K9K", "RENAULT", "DIESEL"), ("K9K", "DACIA", "DIESEL"), ("F4R", "RENAULT", "ESSENCE"), (None, "", "")])
    got: dict[str, list] = {}
    for plate, tier, sold in values(matching.needs_for_plate(plates, needs), "plate", "tier", "sold_3m"):
        got.setdefault(plate, []).append((tier, None if sold is None else 10 - sold))
    assert {p: sorted(v) for p, v in got.items()} == {
        "AB 123 CD": [(1, 0), (1, 1)],
        "zz-9": [(2, 0), (2, 2)],
        "yy-9": [(2, 2)],
        "xx-9": [(3, None)],
        "ww-9": [(3, None)],
    }


def test_plate_without_any_need(spark, plates):
    rows = matching.needs_for_plate(plates, _needs(spark, [])).collect()
    assert {(r.tier, r.sold_3m) for r in rows} == {(3, None)} and len(rows) == plates.count()


def test_reports_match_needs_of_any_rank(spark, monkeypatch):
    """A need far down the list is found, by text and by plate."""
    items = [{"item_id": k, "code": f"C{k:03d}X", "type_id": 1} for k in range(1, 252)]
    sold = [{"item_id": k, "validated_at": "2001-07-20"} for k in range(1, 252) for _ in range(1 if k == 251 else 2)]
    given = tables(spark, items=items, dispatches=sold)
    given["searches"] = _searches(spark, ["C251X", ""])
    given["plates"] = spark.createDataFrame(
        [("p", "C251X", "B", "", "", "")], "plate string, code string, brand string, model string, year string, energy string"
    )
    monkeypatch.setattr(reports, "sample_tables", lambda *_: given)
    found = reports.REPORTS["smart_match"](spark, "").collect()
    assert [(r.code, r["rank"]) for r in found if r.search_id == 0] == [("C251X", 1)]
    listed = sorted((r["rank"], r.code) for r in found if r.search_id == 1)
    assert listed == [(k, f"C{k:03d}X") for k in range(1, 252)]
    assert [(r.tier, r.code) for r in reports.REPORTS["needs_for_plate"](spark, "").collect()] == [(1, "C251X")]


def test_a_very_long_code_is_indexed_linearly(spark):
    code = "".join("ABCDEFGHJK"[(i * 7 + i // 10) % 10] for i in range(20_000))
    needs = [(code,), ("XK9K",)]
    n_grams = spark.range(1).select(F.size(matching.grams(F.lit(code)))).first()[0]
    assert n_grams <= 3 * len(code)
    searches = [code[5_000:5_040], "K9K", code[:2]]
    got = matching.smart_match(_searches(spark, searches), _needs(spark, needs))
    by_search: dict[int, list] = {}
    for i, sold, score, rank in values(got, "search_id", "sold_3m", "score", "rank"):
        by_search.setdefault(i, []).append((rank, 10 - sold, score))
    for i, search in enumerate(searches):
        scores = _brute_scores(search, needs)
        order = sorted((n for n in range(len(needs)) if scores[n] > 0), key=lambda n: (-scores[n], n))
        assert sorted(by_search.get(i, [])) == [(place, n, scores[n]) for place, n in enumerate(order, 1)]
