"""The exact bottom-k sample by language, and every language learnt."""

from __future__ import annotations

from pyspark.sql import functions as F

from gearyard.llm import kneser_ney, lang_id
from gearyard.llm.common import bottom_k


def test_bottom_k_equals_sorting(spark):
    rows = [(None if i % 97 == 0 else ("hot" if i % 3 else f"g{i % 11}"), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "lang string, id long").withColumn("h", F.xxhash64("id"))
    got = {(r.lang, r.h) for r in bottom_k(df, "lang", "h", 40).collect()}
    by = {}
    for r in df.collect():
        by.setdefault(r.lang, []).append(r.h)
    want = {(g, h) for g, hs in by.items() for h in sorted(hs)[:40]}
    assert got == want


def _many_languages(spark, n_langs=25, per_lang=24):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(n_langs):
        letters = alphabet[k % 26] + alphabet[(7 * k + 3) % 26] + alphabet[(11 * k + 5) % 26]
        for j in range(per_lang):
            text = " ".join(letters[(i * (j + 1)) % 3] * (2 + (i + k + j) % 4) + letters[i % 3] for i in range(80))
            text += " " + letters * (1 + j)
            rows.append((len(rows), text, f"l{k:02d}", "s", len(text)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_every_language_has_training_text(spark):
    docs = _many_languages(spark)
    last = kneser_ney.trusted_texts(docs, F.lit(True), 3).collect()
    assert {r.lang for r in last} == {f"l{k:02d}" for k in range(25)}
    model = lang_id.train(docs, F.lit(True))
    assert set(model.langs) == {f"l{k:02d}" for k in range(25)}
