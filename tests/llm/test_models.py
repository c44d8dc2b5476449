"""Suffix dedup, both language models and language identification."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gearyard.llm import kneser_ney, lang_id, lm_score, suffix_dedup
from gearyard.llm.common import crc_remainder
from tests.llm.corpus import docs, empty, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _cleaned(rows, length):
    """Remaining bytes by looking at every string of every text in order."""
    seen, out = set(), {}
    for key, data in sorted(rows.items()):
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i:i + length] in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(data[i:i + length])
        out[key] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                    hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [8_000, 1])
def test_suffix_dedup_equals_plain_python(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)  # 1: all strings go the way of very frequent anchors
    passage = prose(900, 60)
    given = texts() + [prose(k, 30) + passage[k:400 - k] + prose(k + 1, 30) for k in range(20)] + ["ab" * 400, "abc" * 200]
    source = docs(spark, given).dropDuplicates(["doc_id"])
    rows = {(r.doc_id is None, r.doc_id or 0): (r.text or "").encode() for r in source.collect()}
    want = _cleaned(rows, 100)
    result = suffix_dedup.dedup(source, with_text=True).collect()
    got = {(r.doc_id is None, r.doc_id or 0): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result}
    assert got == want and sum(x[1] for x in want.values()) > 5_000
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in result)
    assert suffix_dedup.dedup(empty(spark)).count() == 0


def test_repeated_rows_count_as_one(spark):
    rows = suffix_dedup.dedup(docs(spark)).collect()
    twice = [r for r in rows if r.doc_id == len(texts()) - 2]
    assert len(twice) == 2 and len({r.kept_sha256 for r in twice}) == 1 and twice[0].n_removed == 0


def test_maximal_repeats_are_all_and_maximal():
    pieces = [b"xxabcdefghijyy", b"zzabcdefghijww", b"qqcdefghijqq", b"cdefghij"]
    array = suffix_dedup.SuffixArray(pieces, 6)
    found = {(n, frozenset((int(array.piece[k]), int(array.inside[k])) for k in range(low, high + 1)))
             for n, low, high in array.maximal_repeats(6)}
    assert found == {(10, frozenset({(0, 2), (1, 2)})), (8, frozenset({(0, 4), (1, 4), (2, 2), (3, 0)}))}


def _tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


@pytest.mark.parametrize("group,part,segment", [(256 << 20, 24 << 20, 16 << 20), (20_000, 10_000, 20_000)])
def test_language_model_base_and_score(spark, monkeypatch, group, part, segment):
    monkeypatch.setattr(lm_score, "BROADCAST_BYTES", group)
    monkeypatch.setattr(lm_score, "PART_BYTES", part)
    monkeypatch.setattr(lm_score, "SEGMENT_BYTES", segment)  # small: several segments, several passes
    source = docs(spark)
    rows = lm_score.score(source, crc_remainder(F.col("doc_id"), 7) != 2).collect()
    learn = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2
    given = [(r.doc_id, r.text) for r in source.collect()]
    counts, pairs = Counter(), Counter()
    for d, t in given:
        if learn(d):
            counts.update(_tokens(t))
            pairs.update(zip(["<"] + _tokens(t)[:-1], _tokens(t)))
    n, v, n_docs = sum(counts.values()), len(counts), sum(learn(d) for d, _ in given)
    want = Counter()
    for d, t in given:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in _tokens(t))
        want[d, len(_tokens(t)), sum(counts[w] > 0 for w in _tokens(t)), n, round(base, 6), learn(d)] += 1
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.learn) for r in rows)
    assert got == want

    def quantised(c):
        low = lm_score.level_bounds()
        return lm_score.level_values()[np.searchsorted(low, c, side="right")]

    off = 0
    for r in rows:
        text = next(t for d, t in given if d == r.doc_id)
        exact, before = 0.0, "<"
        for w in _tokens(text):
            head = n_docs if before == "<" else quantised(counts[before])
            p = (min(quantised(pairs[before, w]), head) + lm_score.MU * (quantised(counts[w]) + 1) / (n + v + 1)) / (head + lm_score.MU)
            exact, before = exact + math.log10(min(p, 1)), w
        assert math.isfinite(r.score) and r.score <= 0
        off += abs(r.score - exact) > 0.05 * abs(exact) + 0.5  # a false positive of the filter now and then
    assert off <= 2
    assert lm_score.score(empty(spark), F.lit(True)).count() == 0
    assert all(r.n_known == 0 for r in lm_score.score(source, F.lit(False)).collect())


def test_language_model_builds_a_segment_in_little_memory():
    """Counts of as much text as one segment stands for, in words of some four bytes, most of them different."""
    rng = np.random.default_rng(5)
    n = lm_score.SEGMENT_BYTES // 4
    keys = [rng.integers(0, 1 << 63, n // 4, dtype=np.uint64) for _ in range(8)]
    rows = list(lm_score._counted(iter([pa.RecordBatch.from_pydict({"text": ["a b a", None]})]), 1))
    counts = rows[0].schema.field("counts").type
    width = len(rows[0].column("counts")[0].as_py()) // (len(rows[0].column("keys")[0].as_py()) // 8)
    table = pa.table({
        "segment": pa.array([0] * 8, pa.int32()), "pair": [k % 2 == 1 for k in range(8)],
        "keys": pa.array([np.sort(k).tobytes() for k in keys], pa.binary()),
        "counts": pa.array([np.ones(len(k), f"u{width}").tobytes() for k in keys], counts),
    })
    tracemalloc.start()
    try:
        built = lm_score._segment(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert built.column("n_tokens")[0].as_py() == sum(len(k) for k in keys[::2])
    assert peak < 120 << 20


def test_language_model_filter_seldom_finds_what_is_not_there():
    keys = np.random.default_rng(6).integers(0, 1 << 63, 400_000, dtype=np.uint64)
    there, absent = np.sort(keys[:200_000]), keys[200_000:]
    table = pa.table({
        "segment": pa.array([0], pa.int32()), "pair": [True],
        "keys": pa.array([there.tobytes()], pa.binary()),
        "counts": pa.array([np.ones(len(there), np.uint32).tobytes()], pa.binary()),
    })
    rows = [SimpleNamespace(**r) for r in lm_score._segment(table).to_pylist()]
    model = lm_score._packed(rows, 1)
    assert (lm_score._levels(model, there) >= 1).all()
    assert (lm_score._levels(model, absent) >= 1).mean() < 0.015


def test_language_model_takes_no_more_passes_for_a_larger_model(spark, monkeypatch):
    """However many segments and parts there are, texts are stored once and n-grams looked up once."""
    source = docs(spark).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))  # ids of any type
    store, made = lm_score.stored, []
    monkeypatch.setattr(lm_score, "stored", lambda df, *a, **b: made.append(df.columns) or store(df, *a, **b))
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("binary")) % 5 != 2, F.lit(False))

    def base():
        made.clear()
        rows = lm_score.score(source, learn).collect()
        assert all(r.learn is not None and math.isfinite(r.score) for r in rows)
        return Counter((r.doc_id, r.learn, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), list(made)

    one, passes = base()
    for name, small in (("BROADCAST_BYTES", 20_000), ("PART_BYTES", 10_000), ("SEGMENT_BYTES", 5_000)):
        monkeypatch.setattr(lm_score, name, small)
    many, more = base()
    assert one == many and sum(one.values()) == source.count()
    assert len(more) == len(passes) and not any("text" in columns for columns in more)


def test_language_model_rows_arrive_as_they_were_sent():
    texts = ["a b a b c", None, "x", " ".join(f"w{k}" for k in range(3_000)), "be " * 70_000]
    rows = list(lm_score._counted(iter([pa.RecordBatch.from_pydict({"text": texts, "learn": [True, False, False, True, True]})]), 7))
    sent = pa.Table.from_batches(rows)
    got = lm_score._widened(pa.Table.from_batches(list(lm_score._narrowed(iter(rows)))))
    assert got.to_pylist() == sent.to_pylist() and set(sent.column("segment").to_pylist()) == set(range(7))
    edges = np.array([0, 1, 255, 256, (1 << 64) - 1], np.uint64)
    table = pa.table({
        "part": [1, 1, 2], "segment": pa.array([0, 0, 0], pa.int32()), "pair": [False, True, True],
        "keys": pa.array([edges.tobytes(), edges[2:3].tobytes(), edges[::4].tobytes()], pa.binary()),
        "counts": pa.array([np.array(c, np.uint32).tobytes() for c in ([0, 1, 255, 256, (1 << 32) - 1], [0], [3, 70_000])], pa.binary()),
    })
    narrow = [lm_score._narrowed(iter(table.slice(k, 1).to_batches())) for k in range(3)]  # each row of other widths
    assert lm_score._widened(pa.Table.from_batches([next(x) for x in narrow])).to_pylist() == table.to_pylist()


def test_language_model_answers_every_part_in_its_order():
    rows = list(lm_score._counted(iter([
        pa.RecordBatch.from_pydict({"text": ["a b a", "c d"], "learn": [True, False]}), pa.RecordBatch.from_pydict({"text": ["d a b"], "learn": [True]}),
    ]), 1))
    out = lm_score._answered(pa.Table.from_batches(list(lm_score._narrowed(iter(rows)))), 1).to_pylist()
    assert [r["n_words"] for r in out if r["n_words"]] == [4] and sum(r["n_tokens"] for r in out) == 8  # a, b, d and the end
    count = {w: n for w, n in zip([*lm_score.tokens([b"a b d c"])[0]], [3, 2, 1, 0, 2])}
    asked = [np.frombuffer(x, np.uint64) for r in rows for x, p in zip(r.column("keys").to_pylist(), r.column("pair").to_pylist()) if not p]
    given = [r for r in out if not r["pair"]]
    for keys, r in zip(asked, given):
        assert list(np.frombuffer(r["exact"], np.uint8)) == [count[k] for k in keys]
        assert all(level >= (count[k] > 0) for k, level in zip(keys, r["levels"]))


def test_kneser_ney_is_a_distribution(spark):
    train = spark.createDataFrame([(prose(k, 50),) for k in range(30)] + [(None,), ("",)], "text string")
    model, unknown = kneser_ney.train(train)
    parts = model.collect()
    keys = np.frombuffer(b"".join(bytes(r["keys"]) for r in parts), np.uint64)
    values = dict(zip(keys.tolist(), np.frombuffer(b"".join(bytes(r["values"]) for r in parts), np.float32).tolist()))
    vocabulary = sorted({w for k in range(30) for w in prose(k, 50).split()})
    token = {w: kneser_ney._windows([w.encode()])[2][:1] for w in vocabulary}
    token[None] = np.array([kneser_ney._END], np.uint64)
    look = lambda default, kind, *w: values.get(int(kneser_ney._keys(kind, *w)[0]), default)
    for a, b in [("the", "of"), ("rain", "rain"), ("the", "nowhere")]:
        a, b = (token.get(x, np.array([12345], np.uint64)) for x in (a, b))
        total = 0.0
        for w in [*token.values(), np.array([999], np.uint64)]:
            p = look(0.0, 1, w) or unknown
            p = look(0.0, 2, b, w) + look(1.0, 12, b) * p
            total += look(0.0, 3, a, b, w) + look(1.0, 13, a, b) * p
        assert total == pytest.approx(1.0, abs=1e-4)


def test_perplexity_keeps_prose_and_drops_noise(spark):
    good = [prose(k, 120) for k in range(120)]
    noise = [" ".join(f"{chr(97 + (k * 7 + j * 3) % 26)}{j * 31 % 97}zq" for j in range(80)) for k in range(20)]
    rows = [(k, t, ("en", None)[k % 2], k < 80) for k, t in enumerate(good)] + [(200 + k, t, "en", False) for k, t in enumerate(noise)]
    rows += [(300, None, "en", True), (301, "", "xx", False), (301, "", "xx", False)]
    source = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, trusted boolean").withColumn("last", F.lit(1))
    got = {r.doc_id: r for r in kneser_ney.perplexities(source, F.col("trusted")).collect()}
    assert sum(got[k].kept for k in range(120)) >= 115 and not any(got[200 + k].kept for k in range(20))
    assert not got[300].kept and not got[301].kept
    assert kneser_ney.perplexities(source.limit(0), F.col("trusted")).count() == 0
    assert kneser_ney.perplexities(source, F.lit(False)).filter("kept").count() == 140


def test_language_identification(spark):
    english = [prose(k, 30) for k in range(60)]
    other = ["der Regen und die Straße " * 3 + f"wörter{k} über große Gärten nicht {k}" for k in range(60)]
    rows = [(k, t, lang) for k, (t, lang) in enumerate([(t, "en") for t in english] + [(t, "de") for t in other])]
    rows += [(500, None, "en"), (501, "12 34 !?", "de"), (502, "", None), (503, english[0], None), (504, "hapax", None)]
    source = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("order", F.lit(1))
    model = lang_id.train(source, crc_remainder(F.col("doc_id"), 3) != 1, per_lang=30)
    got = {r.doc_id: r for r in lang_id.predict(source, model).collect()}
    assert sum(got[d].lang_pred == lang for d, _, lang in rows[:120]) >= 118
    assert all(got[d].lang_pred == "und" and got[d].score == 0 and not got[d].accepted for d in (500, 501, 502))
    assert got[503].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    again = lang_id.train(source, crc_remainder(F.col("doc_id"), 3) != 1, per_lang=30)
    assert np.array_equal(model.table, again.table)
    assert lang_id.predict(source.limit(0), model).count() == 0
    blank = lang_id.train(source, F.lit(False))
    assert all(r.lang_pred == "und" for r in lang_id.predict(source, blank).collect())
