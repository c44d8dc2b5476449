"""Anchors packed into buckets by their counted contexts."""

from __future__ import annotations

import random
from collections import Counter

from gearyard.llm import suffix_dedup


def test_buckets_hold_about_their_capacity(spark):
    rng = random.Random(4)
    sizes = [(a * 7919, 1 + (rng.randrange(900) if a % 50 else 5_000)) for a in range(3_000)]
    df = spark.createDataFrame(sizes, "a bigint, n bigint")
    got = {r.a: r.bucket for r in suffix_dedup._packed(df, 8_000).collect()}
    assert set(got) == {a for a, _ in sizes}
    load = Counter()
    for a, n in sizes:
        load[got[a]] += n
    assert max(load.values()) <= 8_000 + max(n for _, n in sizes)
    assert len(load) >= sum(n for _, n in sizes) // (8_000 + 5_001)
