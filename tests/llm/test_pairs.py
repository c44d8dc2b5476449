"""Decontamination, near-duplicates and line dedup against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from gearyard.llm import decontam, line_dedup, near_dup
from gearyard.llm.components import components
from tests.llm.corpus import docs, empty, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _shingles(text, fold=False):
    w = WORD.findall((text or "").lower() if fold else (text or ""))
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w and not fold else [])


def test_containment_equals_plain_python(spark):
    part = prose(77, 40).split()
    half = part[:25] + [f"other{k}" for k in range(15)]
    most = part[:37] + ["x", "y", "z"]
    items = spark.createDataFrame(
        [(1, " ".join(part)), (2, " ".join(half)), (3, None), (4, "too short"), (5, " ".join(part).upper()), (6, " ".join(most)),
         (None, prose(101, 80)), (1, " ".join(part)), (9, ""), (10, "rain River"), (11, "THE"), (12, " ".join(part[3:7]))],
        "item_id bigint, text string",
    ).selectExpr("*", "'z' as shard", "1 as hash")
    source = docs(spark)
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in decontam.find_items(source, items).collect()}
    want = {}
    for r in source.collect():
        mine = set(_shingles(r.text, True))
        low = WORD.findall((r.text or "").lower())
        for item in items.collect():
            short = WORD.findall((item.text or "").lower())
            if 1 <= len(short) < 5:
                if any(low[i:i + len(short)] == short for i in range(len(low) - len(short) + 1)):
                    want[r.doc_id, item.item_id] = (1, 1)
                continue
            s = set(_shingles(item.text, True))
            if s and len(s & mine) >= 0.8 * len(s) - 1e-9 and item.item_id != 5:  # 5 is 1 in capitals
                want[r.doc_id, item.item_id] = (len(s & mine), len(s))
    assert got == want and len(want) >= 4
    assert {i for _, i in want} >= {10, 11, 12}  # items of fewer than five words are found
    clean = decontam.drop_contaminated(source, items)
    assert clean.schema == source.schema
    dirty = {d for d, _ in want}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in source.collect()} - dirty
    assert decontam.find_items(source, items.limit(0)).count() == 0
    assert decontam.find_items(empty(spark), items).count() == 0


def _weighted_jaccard(a, b):
    a, b = Counter(_shingles(a)), Counter(_shingles(b))
    both, either = sum((a & b).values()), sum((a | b).values())
    return both / either if either else 0.0


def _groups(rows):
    """Smallest doc_id of each connected group, by comparing all pairs."""
    distinct = sorted({t or "" for _, t in rows})
    root = {t: t for t in distinct}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if _weighted_jaccard(a, b) >= 0.8 - 1e-9:
                root[find(a)] = find(b)
    least = {}
    for doc_id, t in rows:
        r = find(t or "")
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return {(d, least.get(find(t or ""))) for d, t in rows}


def _edited(base, seed, n):
    w = base.split()
    rng = random.Random(seed)
    for k in rng.sample(range(len(w)), n):
        w[k] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def test_groups_equal_all_pairs(spark):
    base = prose(300, 150)
    # around the threshold, chains, and many that only a common original links
    given = texts() + [_edited(base, k, n) for k, n in enumerate([0, 1, 1, 2, 2, 3, 3, 4, 5, 8] * 4)]
    given += [_edited(_edited(base, k, 6), 50 + k, 1) for k in (1, 1, 2)]
    source = docs(spark, given)
    told = near_dup.classes(source)
    got = {(r.doc_id, r.class_id) for r in told.collect()}
    assert got == _groups([(r.doc_id, r.text) for r in source.collect()])
    assert told.count() == source.count()
    kept = near_dup.keep_one(source)
    assert kept.schema == source.schema
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({c for _, c in got})  # one of each group
    assert near_dup.classes(empty(spark)).count() == 0 and near_dup.keep_one(empty(spark)).count() == 0


def test_signatures_are_unbiased_and_agree_across_texts():
    rng = random.Random(3)
    for _ in range(5):
        a = [rng.choice("abcdefghij") for _ in range(80)]
        b = [rng.choice("abcdefghij") if rng.random() < 0.3 else c for c in a]
        x, y = (Counter(s) for s in (a, b))
        true = sum((x & y).values()) / sum((x | y).values())
        packed = [" ".join(s).encode() for s in (a, b)]
        both = near_dup.signatures(*near_dup._weighted(packed, 1), 2, 4096)
        alone = near_dup.signatures(*near_dup._weighted(packed[1:], 1), 1, 4096)
        assert abs((both[0] == both[1]).mean() - true) < 0.04
        assert np.array_equal(both[1], alone[0])


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_pairs_equal_all_pairs(spark, edits):
    rng = random.Random(edits)
    lines = []
    for k in range(30):
        line = prose(400 + k, 6)
        lines.append(line)
        for n in range(1, 5):
            chars = list(line)
            for _ in range(n):
                at = rng.randrange(len(chars))
                what = rng.choice("sdi")
                chars[at:at + 1] = {"s": "é", "d": "", "i": chars[at] + "q"}[what]
            lines.append("".join(chars))
    lines += ["short line", "short lime", "", "  "]
    rng.shuffle(lines)
    source = docs(spark, [*texts(), *["\n".join(lines[k:k + 10]) for k in range(0, len(lines), 10)]])
    rows = sorted(
        ((r.doc_id if r.doc_id is not None else 10**9, i, line) for r in source.dropDuplicates(["doc_id"]).collect()
         for i, line in enumerate((r.text or "").split("\n")) if WORD.search(line)), key=lambda x: x[:2],
    )
    first = {}
    for d, i, line in rows:
        first.setdefault(line, (d, i))
    links = {x: [y for y in first if y != x and min(len(x), len(y)) >= 24 and abs(len(x) - len(y)) <= edits
                 and _distance(x, y) <= edits] for x in first}
    want = {r.doc_id if r.doc_id is not None else 10**9: [0, 0, 0, 0] for r in source.collect()}
    for d, i, line in rows:
        got = want[d]
        got[0] += 1
        if (d, i) != first[line]:
            got[1] += 1
        else:
            got[2] += any(first[y] < (d, i) for y in links[line])
            got[3] += len(links[line])
    once = source.dropDuplicates(["doc_id"])
    found = {r.doc_id if r.doc_id is not None else 10**9: [r.n_lines, r.n_equal, r.n_near, r.n_links]
             for r in line_dedup.dedup_lines(once, edits).collect()}
    assert found == want and sum(x[2] for x in want.values()) > 5
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def _line_counts(given, edits=2):
    """[n_lines, n_equal, n_near, n_links] over all rows, by comparing all distinct lines in pairs; n_near where no chains are."""
    lines = [line for _, t in given for line in (t or "").split("\n") if WORD.search(line)]
    distinct = sorted(set(lines))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i]
             if min(len(a), len(b)) >= 24 and abs(len(a) - len(b)) <= edits and _distance(a, b) <= edits]
    assert len({x for pair in links for x in pair}) == 2 * len(links)  # pairs only: one of each goes, in any order
    return [len(lines), len(lines) - len(distinct), len(links), 2 * len(links)]


def test_line_dedup_without_unique_ids(spark):
    """NULL ids, repeated rows, and different texts under one id: a line leads once."""
    a, b, c, d = (prose(900 + k, 8) for k in range(4))
    near_a, near_c = a[:-1] + "!", c[:10] + "?" + c[10:]
    given = [
        (None, a), (None, a), (None, a + "\n" + b), (None, b), (None, near_a), (None, None), (None, ""),
        (7, c), (7, d), (7, near_c), (7, c), (7, c), (8, c + "\n\n" + c), (9, None), (9, ""), (9, d + "\n" + prose(950, 8)),
    ]
    source = spark.createDataFrame(given, "doc_id bigint, text string").repartition(5)
    got = line_dedup.dedup_lines(source).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 7, 8, 9]
    found = [sum(r[k] for r in got) for k in ("n_lines", "n_equal", "n_near", "n_links")]
    assert found == _line_counts(given)
    assert sum(r.n_kept for r in got) == found[0] - found[1] - found[2]
    lone = {r.doc_id: r for r in got}
    assert (lone[None].n_lines, lone[None].n_equal, lone[None].n_near, lone[None].n_links) == (6, 3, 1, 2)
    assert (lone[8].n_lines, lone[8].n_equal) == (2, 2)


def test_line_dedup_gives_texts_and_decisions(spark):
    a, b, c = (prose(960 + k, 8) for k in range(3))
    near_a = a[:-1] + "!"
    given = [
        (1, a + "\n\n" + b + "\n" + a), (2, "\n" + near_a + "\n" + c + "\n"), (2, c + "\nshort"), (3, b), (4, None), (5, " \n "),
        (None, "last\n" + c + "\nend"), (None, "last\n" + c + "\nend"), (None, "more"), (None, "more"),
    ]
    source = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    cleaned = line_dedup.clean_texts(source).collect()
    texts_of = lambda d: sorted(r.text for r in cleaned if r.doc_id == d)
    assert texts_of(1) == [a + "\n\n" + b] and texts_of(3) == texts_of(4) == texts_of(5) == [""]
    assert texts_of(2) in (["\n" + c + "\n", "short"], ["", c + "\nshort"])  # the hash of the texts says which is first
    assert texts_of(None) == ["", "", "last\nend", "more"]
    told = line_dedup.line_decisions(source).collect()
    assert {(r.doc_id, r.line_no, r.line): (r.decision, r.links) for r in told if r.doc_id == 1} == {
        (1, 0, a): ("keep", 1), (1, 1, ""): ("blank", 0), (1, 2, b): ("keep", 0), (1, 3, a): ("equal", 1),
    }
    assert [(r.decision, r.links) for r in told if r.line == near_a] == [("near", 1)]
    counts = {r.doc_id: r for r in line_dedup.dedup_lines(source).collect()}
    for d in (1, 2, 3, 4, 5, None):
        kept = [line for t in texts_of(d) for line in t.split("\n") if WORD.search(line)]
        assert len(kept) == counts[d].n_kept
        mine = [r for r in told if r.doc_id == d and r.decision != "blank"]
        assert sum(r.copies for r in mine) == counts[d].n_lines
        assert sum(r.copies - (r.decision != "equal") for r in mine) == counts[d].n_equal
        assert sum(r.decision == "near" for r in mine) == counts[d].n_near


def test_line_dedup_stores_no_row_for_pairs_that_are_apart(spark, monkeypatch):
    """Lines that differ in a word of the same letters: what is stored grows with the lines, not with their pairs."""
    rng = random.Random(11)
    words = sorted({"".join(rng.sample("thernosi", 8)) for _ in range(220)})
    lines = [f"the river runs by the old mill and {w} over stones to the quiet sea" for w in words]
    rows, stored = [], line_dedup.stored

    def counted(df, name, *more):
        kept = stored(df, name, *more)
        rows.append(kept.count())
        return kept

    monkeypatch.setattr(line_dedup, "stored", counted)
    source = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    found = sum(r.n_links for r in line_dedup.dedup_lines(source).collect())
    assert found == 2 * sum(_distance(a, b) <= 2 for i, a in enumerate(lines) for b in lines[:i])
    assert max(rows) <= 12 * len(lines)


@pytest.mark.parametrize("often", [1, 1_000_000])
def test_line_dedup_deals_texts_only_of_lines_that_meet(spark, monkeypatch, often):
    """Lines that share no key with another are shuffled as hashes; repeated lines are one, listed as frequent or not."""
    a, b = prose(970, 9), prose(971, 9)
    lines = [prose(1_000 + k, 9) for k in range(150)]
    lines += [a, a[:-1] + "!", b, b[:5] + "?" + b[5:]] + [a] * 40 + [lines[0]] * 30
    random.Random(4).shuffle(lines)
    texts_dealt, stored = [], line_dedup.stored

    def noted(df, name, *more):
        kept = stored(df, name, *more)
        if re.search(r"hashpartitioning\([^)]*\bline#", df._jdf.queryExecution().executedPlan().toString()):
            texts_dealt.append(kept.count())
        return kept

    monkeypatch.setattr(line_dedup, "stored", noted)
    monkeypatch.setattr(line_dedup, "OFTEN_ROWS", often, raising=False)  # 1: no line is frequent
    source = spark.createDataFrame([(k // 3, line) for k, line in enumerate(lines)], "doc_id bigint, text string")
    got = line_dedup.dedup_lines(source).collect()
    assert [sum(r[k] for r in got) for k in ("n_lines", "n_equal", "n_near", "n_links")] == _line_counts(list(enumerate(lines)))
    assert 0 < sum(texts_dealt) < len(set(lines)) // 2
