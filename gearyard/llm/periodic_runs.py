"""Periodic runs of words, found through a Re-Pair grammar of the text.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and length at least ``max(MIN_LENGTH, 2q)`` that no neighbouring
word extends with period q. Collapsing a run keeps its first q words.

Method, per document:

1. Words become ids; Re-Pair replaces frequent adjacent pairs by new symbols,
   round after round, until no pair repeats. A round takes the most frequent
   pairs whose left and right symbols are disjoint sets, so their occurrences
   cannot overlap (a pair of equal symbols takes every other of its
   occurrences). The result is a grammar and a short top sequence, over which
   a balanced tree of further nodes is laid.
2. Every run crosses the boundary between the two children of the lowest node
   that holds it. For each nonterminal, once, the runs that cross its boundary
   within its expansion are found: for every period q, longest common
   extensions to the right and left of the boundary (prefix hashes under two
   prime moduli, binary search over all periods at once) give the q-periodic
   stretch through the boundary; equal stretches keep the smallest period.
3. These runs are moved to every place the nonterminal occurs in the
   derivation; those that no neighbouring word extends in the whole text are
   the runs. Each is checked word by word before it is kept.

On Spark the documents are dealt in Arrow batches (``mapInPandas``); a
document's work is bounded by its own length times its grammar's depth.

Defined cases: NULL or empty text has no words and no runs; a NULL id is the
empty text for its crc32; other input columns are left out; repeated rows give
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 12  # at least 6: the search asks for three equal places in a row
MODULI = (1_000_000_007, 998_244_353)
BASES = (911_382_323, 972_663_749)
# Periods looked at together: bounds the arrays of one step of the search.
PAIRS_PER_STEP = 1 << 20


def tamper(words: list[str], doc_id) -> list[str]:
    """The planted repetition: with h the crc32 of the decimal id and g = h // 10,
    if h % 10 == 0 the words from a = g % n on repeat the first p of them."""
    n = len(words)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())  # the id as decimal text
    g = h // 10
    if h % 10 or n == 0:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def repair(seq: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair in rounds. Returns the top sequence, for symbols from ``first``
    on their left and right parts, and the length of every symbol's expansion."""
    lefts: list[np.ndarray] = []
    rights: list[np.ndarray] = []
    size = np.ones(first, dtype=np.int64)
    nxt = first
    while len(seq) >= 2:
        codes = seq[:-1] * (1 << 31) + seq[1:]
        uniq, inv, counts = np.unique(codes, return_inverse=True, return_counts=True)
        often = np.flatnonzero(counts >= 2)
        if not len(often):
            break
        often = often[np.argsort(-counts[often], kind="stable")]
        left_side, right_side, taken = set(), set(), []
        for u in often.tolist():
            a, b = divmod(int(uniq[u]), 1 << 31)
            if a in right_side or b in left_side:
                continue
            if a == b and (a in left_side or a in right_side):
                continue
            left_side.add(a)
            right_side.add(b)
            taken.append(u)
        taken = np.array(taken)
        new_id = np.full(len(uniq), -1, dtype=np.int64)
        new_id[taken] = np.arange(nxt, nxt + len(taken))
        lefts.append(uniq[taken] >> 31)
        rights.append(uniq[taken] & ((1 << 31) - 1))
        size = np.concatenate((size, size[lefts[-1]] + size[rights[-1]]))
        nxt += len(taken)
        mark = new_id[inv] >= 0
        # Runs of marked places only come from pairs of equal symbols: take every other.
        starts = mark & ~np.concatenate(([False], mark[:-1]))
        place = np.arange(len(mark))
        first_of_run = np.maximum.accumulate(np.where(starts, place, 0))
        take = mark & ((place - first_of_run) % 2 == 0)
        at = np.flatnonzero(take)
        out = seq.copy()
        out[at] = new_id[inv[at]]
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq = out[keep]
    if lefts:
        return seq, np.concatenate(lefts), np.concatenate(rights), size
    return seq, np.zeros(0, np.int64), np.zeros(0, np.int64), size


class _Hashes:
    """Prefix hashes of a sequence and of its mirror, under two moduli."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.ids = ids
        self._tables: tuple | None = None

    def _made(self) -> tuple:
        """The tables, made when first needed: most texts never need them."""
        if self._tables is None:
            ids = self.ids
            self._tables = (
                [self._prefix(ids, m, b) for m, b in zip(MODULI, BASES)],
                [self._prefix(ids[::-1], m, b) for m, b in zip(MODULI, BASES)],
            )
        return self._tables

    def same(self, j: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether words j and j + q are equal; False where either is outside."""
        last = self.n - 1
        inside = (j >= 0) & (j + q <= last)
        a = np.minimum(np.maximum(j, 0), last)
        b = np.minimum(j + q, last)
        return inside & (self.ids[a] == self.ids[b])

    def three(self, j: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether j lies in three consecutive places k with words k, k + q equal."""
        ok = self.same(j, q)
        j, q = j[ok], q[ok]
        m2, m1, p1, p2 = (self.same(j + d, q) for d in (-2, -1, 1, 2))
        ok[ok] = (p1 & p2) | (m1 & p1) | (m2 & m1)
        return ok

    @staticmethod
    def _prefix(ids: np.ndarray, m: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(ids)
        pw = np.ones(n + 1, dtype=np.int64)
        step, size = base % m, 1
        while size < n + 1:
            pw[size:2 * size] = pw[: min(size, n + 1 - size)] * step % m
            step, size = step * step % m, 2 * size
        x = (ids.astype(np.int64) + 1) % m
        terms = x * pw[:n] % m
        g = np.concatenate(([0], np.cumsum(terms) % m))
        return g, pw

    @staticmethod
    def _equal(tables, i, j, k) -> np.ndarray:
        ok = np.ones(len(i), dtype=bool)
        for (g, pw), m in zip(tables, MODULI):
            a = (g[i + k] - g[i]) % m * pw[j] % m
            b = (g[j + k] - g[j]) % m * pw[i] % m
            ok &= a == b
        return ok

    def extend(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, backward: bool = False) -> np.ndarray:
        """Largest k <= most with words i.. and j.. equal for k places (to the
        left of i and j if ``backward``)."""
        if not len(i):
            return np.zeros(0, np.int64)
        fwd, bwd = self._made()
        tables = bwd if backward else fwd
        if backward:
            i, j = self.n - i, self.n - j
        lo, hi = np.zeros(len(i), np.int64), most.astype(np.int64)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi + 1) // 2
            eq = self._equal(tables, i[open_], j[open_], mid[open_])
            lo[open_] = np.where(eq, mid[open_], lo[open_])
            hi[open_] = np.where(eq, hi[open_], mid[open_] - 1)


def _crossing(hashes: _Hashes, pos: np.ndarray, length: np.ndarray, cut: np.ndarray):
    """Runs through the boundary ``cut`` of windows [pos, pos + length):
    (window, start, end, period) with local maximality and smallest periods."""
    found = []
    half = length // 2
    order = np.argsort(-half, kind="stable")
    order = order[half[order] > 0]
    step = np.cumsum(half[order]) // PAIRS_PER_STEP  # windows of one step of the search
    starts = np.flatnonzero(np.diff(step, prepend=-1))
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        batch = order[lo:hi]
        counts = half[batch]
        w = np.repeat(batch, counts)
        q = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        p, ln, b = pos[w], length[w], cut[w]
        for side in (0, 1):
            if side == 0:
                # the stretch holds at least max(q, MIN_LENGTH - q) >= 6 places: three in a row around the first
                ok = q <= b
                ok[ok] = hashes.three((p + b - q)[ok], q[ok])
                ww, qq, pp, ll, bb = w[ok], q[ok], p[ok], ln[ok], b[ok]
                right = hashes.extend(pp + bb - qq, pp + bb, ll - bb)
                left = hashes.extend(pp + bb - qq, pp + bb, bb - qq, backward=True)
                good = (right >= 1) & (right + left >= qq)
                s, e = pp + bb - qq - left, pp + bb + right
            else:
                ok = (q < ln - b) & (b >= 1)
                at = p + b
                ok[ok] = hashes.same(at[ok] - 1, q[ok])
                ok[ok] = hashes.three(at[ok], q[ok])
                ww, qq, pp, ll, bb = w[ok], q[ok], p[ok], ln[ok], b[ok]
                right = hashes.extend(pp + bb, pp + bb + qq, ll - bb - qq)
                left = hashes.extend(pp + bb, pp + bb + qq, bb, backward=True)
                good = (right >= 1) & (left >= 1) & (right + left >= qq)
                s, e = pp + bb - left, pp + bb + qq + right
            good &= (e - s) >= np.maximum(MIN_LENGTH, 2 * qq)
            found.append(np.stack([ww[good], s[good], e[good], qq[good]], axis=1))
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.concatenate(found)
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = np.any(runs[1:, :3] != runs[:-1, :3], axis=1)
    return runs[first]


def find_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(words)
    if n < MIN_LENGTH:
        return []
    vocab = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(vocab.__getitem__, words), dtype=np.int64, count=n)
    v = len(vocab)
    top, lefts, rights, size = repair(ids, v)

    # Places of every nonterminal in the derivation.
    sym, at = top, np.concatenate(([0], np.cumsum(size[top])[:-1]))
    seen_sym, seen_at = [], []
    while len(sym):
        inner = sym >= v
        sym, at = sym[inner], at[inner]
        seen_sym.append(sym)
        seen_at.append(at)
        left = lefts[sym - v]
        sym = np.concatenate((left, rights[sym - v]))
        at = np.concatenate((at, at + size[left]))
    occ_sym = np.concatenate(seen_sym) if seen_sym else np.zeros(0, np.int64)
    occ_at = np.concatenate(seen_at) if seen_at else np.zeros(0, np.int64)
    rules, first = np.unique(occ_sym, return_index=True)

    # A balanced tree over the top sequence.
    t_pos, t_len = np.concatenate(([0], np.cumsum(size[top])[:-1])), size[top]
    tree_pos, tree_len, tree_cut = [], [], []
    while len(t_pos) > 1:
        pairs = len(t_pos) // 2
        lp, ll, rl = t_pos[0:2 * pairs:2], t_len[0:2 * pairs:2], t_len[1:2 * pairs:2]
        tree_pos.append(lp)
        tree_len.append(ll + rl)
        tree_cut.append(ll)
        t_pos = np.concatenate((lp, t_pos[2 * pairs:]))
        t_len = np.concatenate((ll + rl, t_len[2 * pairs:]))

    pos = np.concatenate([occ_at[first], *tree_pos])
    length = np.concatenate([size[rules], *tree_len])
    cut = np.concatenate([size[lefts[rules - v]], *tree_cut])
    hashes = _Hashes(ids)
    local = _crossing(hashes, pos, length, cut)

    # Move the runs of each nonterminal to all its places; tree nodes have one.
    n_rules = len(rules)
    runs = []
    of_rule = local[local[:, 0] < n_rules]
    if len(of_rule):
        rule_of_occ = np.searchsorted(rules, occ_sym)
        by_rule = np.argsort(rule_of_occ, kind="stable")
        starts = np.searchsorted(rule_of_occ[by_rule], np.arange(n_rules))
        ends = np.searchsorted(rule_of_occ[by_rule], np.arange(n_rules), side="right")
        many = ends[of_rule[:, 0]] - starts[of_rule[:, 0]]
        k = np.repeat(np.arange(len(of_rule)), many)
        offs = np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many)
        where = occ_at[by_rule[starts[of_rule[k, 0]] + offs]]
        shift = where - pos[of_rule[k, 0]]
        runs.append(np.stack([of_rule[k, 1] + shift, of_rule[k, 2] + shift, of_rule[k, 3]], axis=1))
    of_tree = local[local[:, 0] >= n_rules]
    runs.append(of_tree[:, 1:])
    runs = np.concatenate(runs)
    s, e, q = runs[:, 0], runs[:, 1], runs[:, 2]
    left_open = (s > 0) & (ids[np.maximum(s - 1, 0)] == ids[np.minimum(np.maximum(s - 1 + q, 0), n - 1)])
    right_open = (e < n) & (ids[np.minimum(e, n - 1)] == ids[np.maximum(e - q, 0)])
    runs = runs[~left_open & ~right_open]
    kept = set()
    for s, e, q in runs.tolist():
        if (s, e, q) not in kept and np.array_equal(ids[s:e - q], ids[s + q:e]):
            kept.add((s, e, q))
    return sorted((s, e - s, q) for s, e, q in kept)


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words without those that a run holds after its first ``period`` words."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop)[: len(words)] > 0
    return [w for w, g in zip(words, gone) if not g]


SCHEMA = "_id string, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def detect(docs: DataFrame, planted: bool = False, rows_per_batch: int = 256) -> DataFrame:
    """(``doc_id``, ``n_words``, ``runs`` by start then period, ``collapsed``: the
    kept words joined by one space) for every row. With ``planted``, each text's
    words are first given the repetition of ``tamper``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), rows_per_batch):
                part = batch.iloc[lo: lo + rows_per_batch]
                out = {"_id": [], "n_words": [], "runs": [], "collapsed": []}
                for doc_id, text in zip(part["_id"], part["text"]):
                    doc_id = doc_id if isinstance(doc_id, str) else None
                    words = WORD.findall(text) if isinstance(text, str) else []
                    if planted:
                        words = tamper(words, doc_id)
                    runs = find_runs(words)
                    out["_id"].append(doc_id)
                    out["n_words"].append(len(words))
                    out["runs"].append([{"start": s, "length": ln, "period": p} for s, ln, p in runs])
                    out["collapsed"].append(" ".join(collapse(words, runs)))
                yield pd.DataFrame(out)

    id_type = docs.schema["doc_id"].dataType
    found = docs.select(F.col("doc_id").cast("string").alias("_id"), "text").mapInPandas(run, SCHEMA)
    return found.select(F.col("_id").cast(id_type).alias("doc_id"), "n_words", "runs", "collapsed")


def digests(found: DataFrame) -> DataFrame:
    """The query's columns, computed by Spark from ``detect``: ``n_runs``; start,
    length, period and ``exponent_milli`` of the longest run (ties: smallest
    start, then period; none: NULL); lowercase-hex SHA-256 of the runs
    (``start,length,period`` and a line feed each) and of the collapsed text."""
    ranked = F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("neg"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")
    )))
    best = F.element_at(ranked, 1)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    has = F.size("runs") > 0
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.when(has, best["start"]).alias("start"),
        F.when(has, best["length"]).alias("length"),
        F.when(has, best["period"]).alias("period"),
        F.when(has, F.floor(best["length"] * 1000 / best["period"])).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )
