"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its byte n-grams (hashed into a
fixed number of buckets), followed by a linear softmax. Both layers are trained
together by stochastic gradient descent in numpy, on a bounded sample of
labelled texts. Averaging and the linear layer commute, so a trained model is
one table of a logit per bucket and language: of fixed size, and a text of any
length is scored by summing table rows. A temperature fitted on part of the
sample makes the score a probability, and a rejection threshold is set where
that part's right answers nearly all stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.llm.common import bottom_k
from gearyard.llm.hashing import blocks, utf8

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
# The sample: at most so many texts of each language, by the hash of their words.
SAMPLE_PER_LANG = 600
DIMENSIONS, EPOCHS, RATE = 16, 12, 0.5
CALIBRATION_SHARE = 0.2
REJECTED_RIGHT = 0.005
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def buckets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each n-gram size, the buckets of all places of the texts laid end to
    end. Texts are set apart by spaces, more of them than an n-gram has bytes."""
    data = np.frombuffer((b" " * max(SIZES)).join([b"", *texts, b""]).lower(), np.uint8).astype(np.uint32)
    for n in SIZES:
        total = np.full(len(data) - n + 1, n, np.uint32)
        for k in range(n):
            total = (total ^ data[k:len(data) - n + 1 + k]) * _FACTORS[k]
            total ^= total >> np.uint32(15)
        yield (total & np.uint32(BUCKETS - 1)).astype(np.int32)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bucket counts of a sampled text, as two arrays."""
    for batch in batches:
        used, counts = [], []
        for text in utf8(batch.column("text")):
            total = np.bincount(np.concatenate(list(buckets([text]))), minlength=BUCKETS)
            used.append(np.flatnonzero(total).astype(np.int32))
            counts.append(total[used[-1]].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("order"), pa.array(used, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
            names=["lang", "order", "buckets", "counts"],
        )


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    least: float  # scores below it are rejected


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 0) -> Model:
    """A model from (language, buckets, counts) of texts, in a fixed order."""
    langs = sorted({lang for lang, _, _ in samples})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    label = np.array([langs.index(lang) for lang, _, _ in samples])
    share = [counts / counts.sum() for _, _, counts in samples]
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weight, bias = np.zeros((DIMENSIONS, len(langs))), np.zeros(len(langs))
    order = rng.permutation(len(samples))
    n_held = int(len(samples) * CALIBRATION_SHARE) if len(samples) >= 10 else 0
    held, learn = order[:n_held], order[n_held:]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(learn):
            at, part = samples[i][1], share[i]
            average = part @ embedding[at]
            error = _softmax(average @ weight + bias)
            error[label[i]] -= 1
            back = weight @ error
            weight -= rate * np.outer(average, error)
            bias -= rate * 0.1 * error
            # the step for a rare bucket would vanish with its share of a long text
            embedding[at] -= rate * np.outer(np.sqrt(part), back)
    table = embedding @ weight
    logits = np.array([share[i] @ table[samples[i][1]] + bias for i in (held if n_held else order)])
    truth = label[held if n_held else order]
    # the temperature that makes the held texts' answers likeliest
    options = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in options]
    temperature = float(options[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    least = float(np.quantile(right, REJECTED_RIGHT)) if len(right) else 0.0
    return Model(langs, table.astype(np.float32), bias, temperature, least)


def train(docs: DataFrame, learn: Column, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on at most ``per_lang`` texts with a letter of each language.

    Every language is learnt. The sample is drawn
    by text hash, so reruns agree; only bucket counts come to the driver.
    """
    told = docs.select("text", "lang", F.coalesce(learn, F.lit(False)).alias("learn")).filter(
        "learn and lang is not null"
    ).filter(F.col("text").rlike(r"\p{L}")).withColumn("order", F.xxhash64("text"))
    # which texts: the smallest hashes of each language, without a window over a whole language
    chosen = bottom_k(told.select("lang", "order").distinct(), "lang", "order", per_lang)
    last = chosen.groupBy("lang").agg(F.max("order").alias("_last"))
    sampled = told.join(last, "lang").filter(F.col("order") <= F.col("_last")).dropDuplicates(["lang", "order"])
    # collected as Arrow, each text's histogram a view of one array: no Python number for each bucket
    table = sampled.select("lang", "order", "text").mapInArrow(
        _histograms, "lang string, order bigint, buckets array<int>, counts array<bigint>"
    ).toArrow().sort_by([("lang", "ascending"), ("order", "ascending")])
    if not table.num_rows:
        return fit([])
    langs = table.column("lang").to_pylist()
    found, counted = table.column("buckets").combine_chunks(), table.column("counts").combine_chunks()
    at, where = found.offsets.to_numpy(), found.values.to_numpy().astype(np.int64)
    ct, count = counted.offsets.to_numpy(), counted.values.to_numpy().astype(np.int64)
    del table, found, counted
    return fit([(lang, where[at[i]:at[i + 1]], count[ct[i]:ct[i + 1]]) for i, lang in enumerate(langs)])


def _labelled(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    table = np.ascontiguousarray(model.table)
    gap = max(SIZES)
    for batch in batches:
        texts, has_letter = utf8(batch.column("text")), batch.column("has_letter").to_numpy(zero_copy_only=False)
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for a, b in blocks(texts) if model.langs else ():
            length = np.array([len(t) for t in texts[a:b]])
            start = np.cumsum(np.r_[gap, length[:-1] + gap])
            logits, n_grams = np.zeros((b - a, len(model.langs))), np.zeros(b - a)
            for n, found in zip(SIZES, buckets(texts[a:b])):
                # from the space before a text to the one after it
                low, high = start - n + 1, start + length
                for k in range(len(model.langs)):
                    sums = np.r_[0.0, np.cumsum(table[found, k], dtype=np.float64)]
                    logits[:, k] += sums[high] - sums[low]
                n_grams += high - low
            p = _softmax((logits / n_grams[:, None] + model.bias) / model.temperature)
            for i, (best, value) in enumerate(zip(p.argmax(axis=1), p.max(axis=1))):
                if has_letter[a + i]:
                    lang[a + i], score[a + i] = model.langs[best], value
        known = pa.array([x != UNKNOWN for x in lang])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lang), pa.array(score), pa.array((score >= model.least) & known.to_numpy(zero_copy_only=False))],
            names=["doc_id", "lang_pred", "score", "accepted"],
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) for every document, from its whole text.

    ``accepted`` is false below the calibrated threshold. A text that is NULL
    or has no letter is ``und`` with score 0, as are all if nothing was learnt.
    """
    seen = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    return seen.mapInArrow(
        lambda it: _labelled(it, model), "doc_id bigint, lang_pred string, score double, accepted boolean"
    )
