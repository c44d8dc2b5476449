"""Periodic runs against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

from gearyard.llm import periodic_runs
from tests.llm.corpus import docs, empty, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(12, 2 * q) and not any(
                all(w[k] == w[k + d] for k in range(s, e - d)) for d in range(1, q)
            ):
                out.add((s, e - s, q))
            i = j
    return sorted(out)


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(0, 160)
        w = [str(rng.randrange(rng.randrange(1, 5))) for _ in range(n)]
        if rng.random() < 0.5 and n > 20:
            s, p = rng.randrange(n // 2), rng.randrange(1, 8)
            w = w[:s] + [w[s + (i - s) % p] for i in range(s, n)]
        assert periodic_runs.find_runs(w) == brute(w), w


def test_long_text_with_a_planted_tail():
    rng = random.Random(5)
    w = [f"w{rng.randrange(3000)}" for _ in range(20_000)]
    w = w[:15_000] + w[14_000:19_000]
    runs = periodic_runs.find_runs(w)
    assert (14_000, 2_000, 1_000) in runs
    assert periodic_runs.collapse(w, runs)[:15_000] == w[:15_000]


def _expected(doc_id, text):
    w = periodic_runs.tamper(WORD.findall(text or ""), None if doc_id is None else str(doc_id))
    runs = brute(w)
    dropped = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{ln},{q}\n" for s, ln, q in runs)
    return (
        len(runs), *((best[0], best[1], best[2], best[1] * 1000 // best[2]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_columns_on_spark(spark):
    short = [t if t is None or len(t) < 3000 else t[:3000] for t in texts()]
    given = [*short, "a b " * 30, "x y z " * 9 + "x y"]
    df = docs(spark, given)
    got = periodic_runs.digests(periodic_runs.detect(df, planted=True)).collect()
    assert len(got) == len(given) + 2
    ids = {}
    for r in got:
        ids.setdefault(r.doc_id, set()).add(tuple(r)[1:])
    for k, t in enumerate(given):
        assert ids[k] == {_expected(k, t)}, k
    assert ids[None] == {_expected(None, given[-1])}
    assert periodic_runs.detect(empty(spark)).count() == 0
