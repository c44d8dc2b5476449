"""Quality rules, sharding and mixing against plain Python."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gearyard.llm import mixing, quality_rules, sharding
from tests.llm.corpus import docs, empty, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_rules_equal_plain_python(spark):
    rows = quality_rules.apply_rules(docs(spark)).collect()
    assert len(rows) == len(texts()) + 2
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == _base(r.text), r.doc_id
        assert not (r.kept and r.base_failed)


def test_keep_good_returns_its_input_columns(spark):
    source = docs(spark)
    kept = quality_rules.keep_good(source)
    assert kept.schema == source.schema
    wanted = {r.doc_id for r in quality_rules.apply_rules(source).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted
    assert all(r.kept in ("y", None) for r in kept.collect())  # a column of that name is left alone
    assert quality_rules.keep_good(empty(spark)).count() == 0


def test_table_is_even_complete_and_stable():
    names = [f"n{i}" for i in range(20)]
    size = sharding.table_size(20)
    full, less = sharding.lookup_table(names, size), sharding.lookup_table(names[:-1], size)
    counts = Counter(full)
    assert set(counts) == set(range(20)) and max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(full, less) if a != 19)
    assert moved < 0.1 * size
    shuffled = sharding.lookup_table(names[::-1], size)
    assert [names[i] for i in full] == [names[::-1][i] for i in shuffled]
    with pytest.raises(ValueError):
        sharding.table_size(10_000)


def test_sharding_places_every_row_without_a_shuffle(spark, tmp_path):
    source = docs(spark)
    placed = sharding.place(source, 8)
    assert "Exchange hashpartitioning" not in placed._jdf.queryExecution().toString()
    rows = placed.collect()
    assert len(rows) == source.count() and all(0 <= r.shard < 8 for r in rows)
    assert {tuple(r) for r in rows} == {tuple(r) for r in sharding.place(source, 8).collect()}
    sharding.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert sharding.place(empty(spark)).count() == 0
    nameless = sharding.place(spark.range(1000).selectExpr("cast(null as bigint) doc_id", "cast(id as string) text"), 8)
    assert nameless.groupBy("shard").count().count() == 8  # rows without a key spread


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, target, free = Fraction(sum(sizes.values())), {}, set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            left -= target[s]
        free -= over
    return target


def test_targets_and_quotas(spark):
    source = docs(spark)
    rows = mixing.take(source).collect()
    assert len(rows) == source.count()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = _targets(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert mine[0].target == pytest.approx(float(want[s]))
        assert sum(r.taken for r in mine) == pytest.approx(float(want[s]), abs=0.02 * sum(sizes.values()))
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.take(source).collect()))
    assert mixing.take(empty(spark)).count() == 0


@pytest.mark.parametrize("votes,seats", [([53, 24, 23], 7), ([10, 10, 10, 10], 6), ([1000, 1, 1, 0], 11), ([7], 5), ([5, 3, 1] * 9, 100)])
def test_sainte_lague_equals_the_seat_by_seat_count(spark, votes, seats):
    from pyspark.sql import functions as F

    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * won[i] + 1), -i))
        won[best] += 1
    claims = spark.createDataFrame([(1, i, v) for i, v in enumerate(votes)], "g int, i int, v bigint")
    got = mixing.sainte_lague(claims, "v", F.lit(seats), ["g"], [F.asc("i")]).orderBy("i").collect()
    assert [r.seats for r in got] == won


def test_the_mix_holds_what_was_taken(spark):
    source = docs(spark)
    taken, mix = mixing.take(source), mixing.mixed(source)
    assert mix.schema == source.schema
    words = Counter()
    for r in mix.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    want = Counter()
    for r in taken.collect():
        want[r.doc_id] += r.taken
    assert +words == +want


def test_repeat_count_is_exact_on_a_long_text(spark):
    import random as _random

    rng = _random.Random(11)
    w = [f"w{rng.randrange(50_000)}" for _ in range(200_000)]
    w[150_000:150_030] = w[1_000:1_030]
    text = " ".join(w)
    row = quality_rules.apply_rules(docs(spark, [text, "x"])).filter("doc_id = 0").first()
    assert row.n_repeat_words == _base(text)[4]


def test_a_plain_filter_on_the_verdict_ends(spark):
    import time

    started = time.time()
    kept = quality_rules.apply_rules(docs(spark)).filter("kept").select("doc_id").collect()
    assert time.time() - started < 120
    assert {r.doc_id for r in kept} == {r.doc_id for r in quality_rules.apply_rules(docs(spark)).collect() if r.kept}


def test_the_mix_keeps_clashing_columns(spark):
    source = docs(spark).withColumn("size", F.lit(7)).withColumn("piece", F.lit("p"))
    mix = mixing.mixed(source)
    assert mix.schema == source.schema
    rows = mix.collect()
    assert rows and all(r.row_hash == 3 and r.size == 7 and r.piece == "p" for r in rows if r.doc_id is not None)


def test_small_sources_reach_their_targets(spark):
    rows = [(k, " ".join(f"b{k}x{i}" for i in range(1000)), "en", "big", 1) for k in range(300)]
    rows += [(1000 + k, " ".join(f"s{k}x{i}" for i in range(245)), "en", f"small{k}", 1) for k in range(6)]
    source = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.take(source).collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    for k in range(6):
        target = next(r.target for r in got if r.source == f"small{k}")
        assert target == pytest.approx(735.0)
        assert abs(taken[f"small{k}"] - target) <= 0.05 * target
    assert sorted(map(str, got)) == sorted(map(str, mixing.take(source).collect()))
