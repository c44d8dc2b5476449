"""The Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import functions as F

from gearyard.llm import merkle
from tests.llm.corpus import docs, empty


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v) -> str:
    if v is None:
        return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"


def _leaf(r, text) -> str:
    return H(*(_field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def _fold(nodes: list[str]) -> tuple[str, list[list[tuple[int, int]]]]:
    """Top and, for each level, the runs as (start, end) over the level's nodes."""
    levels = []
    while len(nodes) > 1:
        runs = [(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        levels.append((nodes, runs))
        nodes = [H(*nodes[a:b]) for a, b in runs]
    return nodes[0], levels


def _paths(levels, place):
    """(left, right) siblings of the node at ``place`` level by level."""
    out = []
    for nodes, _ in levels:
        start = place - place % 16
        end = min(start + 16, len(nodes))
        out.append(("".join(nodes[start:place]), "".join(nodes[place + 1:end])))
        place //= 16
    return out


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    sub, paths = {}, {}
    for s in order:
        group = sorted(by_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r, r["text"])))
        top, levels = _fold([_leaf(r, r["text"]) for r in group])
        sub[s] = top
        for place, r in enumerate(group):
            paths[id(r)] = _paths(levels, place)
    root, upper = _fold([sub[s] for s in order])
    upper_paths = {s: _paths(upper, k) for k, s in enumerate(order)}
    out = []
    for r in rows:
        path = paths[id(r)] + upper_paths[r["source"]]
        text = r["text"]
        if zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0 and text is not None:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        h = _leaf(r, text)
        for left, right in path:
            h = H(left, h, right)
        proof = H(*(left + right for left, right in path))
        out.append((r["doc_id"], _leaf(r, r["text"]), sub[r["source"]], root, proof, h, h == root))
    return sorted(out, key=repr)


def _got(df):
    told = merkle.manifest(df, merkle.tampered(F.col("doc_id")))
    rows = told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_manifest_equals_plain_python(spark):
    df = docs(spark)
    assert _got(df) == brute([r.asDict() for r in df.collect()])


def test_many_levels_and_a_hot_source(spark):
    rows = [(k, f"Text {k} Of A Row", "en", "hot" if k % 3 else f"s{k % 7}", k) for k in range(700)]
    rows += [(None, None, None, None, None), (5, "Text 5 Of A Row", "en", "hot", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = _got(df)
    assert got == brute([r.asDict() for r in df.collect()])
    assert {g[0] for g in got if not g[6]} <= {k for k in range(700) if zlib.crc32(str(k).encode()) % 5 == 0}


def test_lone_leaf_is_root_and_empty_table(spark):
    one = spark.createDataFrame([(7, "abc", None, "s", 3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    (row,) = _got(one)
    assert row[1] == row[2] == row[3] and row[4] == H()
    assert merkle.manifest(empty(spark)).count() == 0
