"""Near-duplicate documents by BagMinHash signatures and exact multiset overlap.

A text is the multiset of its five-word shingles. For every signature slot, a
shingle of weight w runs a Poisson process of rate w; the slot keeps the
earliest point of all shingles. Two texts agree in a slot with probability
equal to their weighted Jaccard similarity. The process of a shingle is the sum
of processes over weight strata [0,1), [1,2), [2,4), [4,8) ...: full strata are
run with their whole rate, the one that the weight cuts is thinned, so equal
weights share all points, unequal ones those below the smaller, and a heavy
shingle costs its points and not its weight. Points are drawn up to a horizon
that fills all slots.

Equal texts are one throughout. Texts that share a band meet in a bucket. There
each is compared with the bucket's first, not with all, and what that leaves
unconnected with a first of its own, a few times. Texts of buckets that
this leaves in several components are then compared across components, as far
as an exact prefix filter finds that two may be similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gearyard.llm.common import stored
from gearyard.llm.components import components
from gearyard.llm.decontam import text_key
from gearyard.llm.hashing import blocks, mixed, utf8, window_hashes, word_hashes

WIDTH = 5
SIMILARITY = 0.8
# 25 bands of 4: a pair at similarity 0.8 is missed with probability 2e-6.
BANDS, ROWS = 25, 4
# Further comparisons with a first member, among those that are not connected to the last one.
MORE_HEADS = 2
# Id lists up to this many rows (some 20 MB) are broadcast.
BROADCAST_ROWS = 500_000

_STEP, _SLOT, _LEVEL = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _weighted(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text, hash, count), in this order."""
    hashes, owner = window_hashes(*word_hashes(texts), width)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)])
    return owner[first], hashes[first], np.diff(np.r_[first, len(hashes)])


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, slots: int) -> np.ndarray:
    """An (n, slots) array: the earliest point of each slot, as 64 bits; inf for texts without shingles."""
    parts, low, rate = [], 0, 1
    while len(at := np.flatnonzero(weight > low)):
        key = mixed(shingle[at] + np.full(1, low, np.uint64) * _LEVEL)
        parts.append((owner[at], key, np.full(len(at), float(rate)), np.minimum(weight[at] - low, rate)))
        low, rate = low + rate, max(1, low + rate)
    best = np.full(n * slots, np.inf)
    if not parts:
        return best.reshape(n, slots).view(np.uint64)
    text, key, rate_of, cut = (np.concatenate(x) for x in zip(*parts))
    total = np.bincount(owner, weight, n)
    horizon = slots * (np.log(slots) + 4) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        at = np.flatnonzero(todo[text])
        t, k = np.zeros(len(at)), 0
        while len(at):
            # the next point of each unit, or the next few where few units are left
            few = 1 if len(at) > 4096 else 32
            steps = np.arange(k + 1, k + few + 1, dtype=np.uint64) * _STEP
            k += few
            draw = mixed(key[at][:, None] + steps)
            wait = -np.log1p(-(draw >> np.uint64(11)).astype(float) * 2.0**-53) / rate_of[at][:, None]
            wait[:, 0] += t
            times = np.cumsum(wait, axis=1)
            t, rate = times[:, -1], rate_of[at][:, None]
            level = (mixed(draw + _LEVEL) >> np.uint64(11)).astype(float) * 2.0**-53 * rate
            hit = (times <= horizon[text[at]][:, None]) & (level < cut[at][:, None])
            slot = (mixed(draw + _SLOT) % np.uint64(slots)).astype(int)
            np.minimum.at(best, (text[at][:, None] * slots + slot)[hit], times[hit])
            alive = t <= horizon[text[at]]
            at, t = at[alive], t[alive]
        todo &= np.isinf(best.reshape(n, slots)).any(axis=1)
        horizon = horizon * 2
    return best.reshape(n, slots).view(np.uint64)


def _band_hashes(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text"))
        out = []
        for start, end in blocks(texts):
            weighted = _weighted(texts[start:end], width)
            slots = signatures(*weighted, end - start, bands * rows).reshape(end - start, bands, rows)
            total = np.zeros((end - start, bands), np.uint64)
            for k in range(rows):
                total = mixed(total + slots[:, :, k] * _STEP)
            has = np.bincount(weighted[0], minlength=end - start) > 0
            out += [row.view(np.int64) if ok else None for row, ok in zip(total, has)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "_k1", "_k2")], pa.array(out, pa.list_(pa.int64()))],
            names=["doc_id", "_k1", "_k2", "bands"],
        )


def _units(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sorted hashes of a text's shingles, the k-th of equal ones told apart by k."""
    for batch in batches:
        texts, out = utf8(batch.column("text")), []
        for start, end in blocks(texts):
            owner, shingle, weight = _weighted(texts[start:end], width)
            nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            unit = mixed(np.repeat(shingle, weight) + nth.astype(np.uint64) * _LEVEL)
            cuts = np.searchsorted(np.repeat(owner, weight), np.arange(end - start + 1))
            out += [np.sort(unit[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(out, pa.binary())], names=["tid", "units"])


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tid, comp, packed in zip(*(batch.column(c).to_pylist() for c in ("tid", "comp", "units"))):
            unit = np.frombuffer(packed, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(unit), x, np.int64)) for x in (tid, comp, len(unit))] + [pa.array(unit)],
                names=["tid", "comp", "n", "unit"],
            )


def _similar(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("units_a").to_pylist(), batch.column("units_b").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def distinct_texts(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Stored (tid, _k1, _k2, doc_id, bands): each text once, numbered by its smallest doc_id (NULL last)."""
    keyed = docs.select("doc_id", "text", *text_key(F.col("text")))
    signed = keyed.mapInArrow(
        lambda it: _band_hashes(it, width, bands, rows), "doc_id bigint, _k1 bigint, _k2 int, bands array<bigint>"
    )
    texts = signed.groupBy("_k1", "_k2").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    ordered = texts.orderBy(F.asc_nulls_last("doc_id"), "_k1", "_k2")
    return stored(ordered.withColumn("tid", F.monotonically_increasing_id()), "texts")


def _verified(pairs: DataFrame, units: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""
    a = units.select(F.col("tid").alias("a"), F.col("units").alias("units_a"))
    b = units.select(F.col("tid").alias("b"), F.col("units").alias("units_b"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "units_a", "units_b").mapInArrow(
        lambda it: _similar(it, similarity), "a bigint, b bigint"
    )


def across_components(open_texts: DataFrame, units: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of texts in different components that may be similar, none left out.

    Prefix filter: with the shingles of every text in one order, rarest first,
    two texts that overlap enough share a shingle among the first of both, and
    the places of the first shared one leave room for the overlap. Texts that
    differ from a common original each in their own way share none there, so
    the pairs of a large group of such are never made.
    """
    share = similarity / (1 + similarity)  # of both sizes together that the overlap is at least
    listed = stored(open_texts.join(units, "tid").mapInArrow(
        _exploded, "tid bigint, comp bigint, n bigint, unit bigint"
    ), "shingles")
    common = listed.groupBy("unit").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    rarest = Window.partitionBy("tid").orderBy("df", "unit")
    known = F.count(F.lit(1)).over(Window.partitionBy("tid"))
    # shingles of no other text come first and need no row
    placed = listed.join(common, "unit").withColumn(
        "pos", F.col("n") - known + F.row_number().over(rarest) - 1
    ).filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-9))
    prefix = stored(placed.select("tid", "comp", "n", "unit", "pos"), "prefixes")
    small, large = ([F.col(c).alias(f"{c}_{side}") for c in ("tid", "comp", "n", "pos")] for side in "xy")
    # the smaller text of a pair can do with the shorter prefix
    x = prefix.filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * 2 * share - 1e-9)).select("unit", *small)
    need = F.ceil((F.col("n_x") + F.col("n_y")) * share - 1e-9)
    may = (
        (F.col("comp_x") != F.col("comp_y"))
        & ((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("tid_x") < F.col("tid_y"))))
        & (F.col("n_x") >= F.col("n_y") * similarity - 1e-9)
        & (F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")) >= need)
    )
    y = prefix.select(F.col("unit").alias("unit_y"), *large)
    return x.join(y, (F.col("unit") == F.col("unit_y")) & may).select(
        F.least("tid_x", "tid_y").alias("a"), F.greatest("tid_x", "tid_y").alias("b")
    ).distinct()


def links(docs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Stored (a, b): verified links that connect all texts which similar pairs of a bucket connect."""
    places = texts.filter("bands is not null").select("tid", F.posexplode("bands").alias("band", "h"))
    buckets = stored(
        places.groupBy("band", "h").agg(F.min("tid").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "buckets",
    )
    members = stored(places.join(buckets, ["band", "h"]), "members")
    pairs = stored(members.filter("tid <> first").select(F.col("first").alias("a"), F.col("tid").alias("b")).distinct(), "pairs")
    wanted = stored(members.select("tid").distinct().join(texts, "tid").select("tid", "_k1", "_k2"), "wanted")
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = docs.select("text", *text_key(F.col("text"))).join(F.broadcast(wanted) if small else wanted, ["_k1", "_k2"])
    # copies of a text give the same units
    units = stored(
        found.select("tid", "text").mapInArrow(lambda it: _units(it, width), "tid bigint, units binary")
        .groupBy("tid").agg(F.first("units").alias("units")), "units"
    )
    near, tested, at = stored(_verified(pairs, units, similarity), "near"), pairs, members
    for _ in range(MORE_HEADS):
        # what is not connected to a bucket's first gets a first of its own
        comp = at.join(components(near).withColumnRenamed("node", "tid"), "tid", "left").withColumn("comp", F.coalesce("comp", "tid"))
        heads = comp.filter("tid = first").select("band", "h", F.col("comp").alias("head"))
        rest = stored(comp.join(heads, ["band", "h"]).filter("comp <> head").select("band", "h", "tid"), "rest")
        at = rest.join(rest.groupBy("band", "h").agg(F.min("tid").alias("first")), ["band", "h"])
        more = at.filter("tid <> first").select(F.col("first").alias("a"), F.col("tid").alias("b")).distinct()
        more = stored(more.join(tested, ["a", "b"], "left_anti"), "pairs")
        near, tested = stored(near.unionByName(_verified(more, units, similarity)), "near"), tested.unionByName(more)
    comp = stored(
        members.join(components(near).withColumnRenamed("node", "tid"), "tid", "left")
        .select("band", "h", "tid", F.coalesce("comp", "tid").alias("comp")), "comp"
    )
    # Texts of buckets that are still in several components look across them.
    mixed_up = comp.groupBy("band", "h").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least <> most")
    open_texts = comp.join(mixed_up.select("band", "h"), ["band", "h"], "left_semi").select("tid", "comp").distinct()
    untold = across_components(open_texts, units, similarity).join(tested, ["a", "b"], "left_anti")
    return stored(near.unionByName(_verified(untold, units, similarity)), "linked")


def classes(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS,
            rows: int = ROWS) -> DataFrame:
    """The documents with ``class_id``: the smallest doc_id their group has.

    Groups are the components of links between texts of at least the given
    weighted Jaccard similarity; equal texts are in one group, also texts
    without words. A text of one to four words has one shingle, all its words.
    A NULL doc_id comes after all others; a group of only such has class_id
    NULL. Also ``text_id``, which numbers the distinct texts, and ``first_text``,
    whether the row's text is the one of its group that stays.
    """
    told, _ = _classes(docs, similarity, width, bands, rows)
    return told


def _classes(docs: DataFrame, similarity: float, width: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    texts = distinct_texts(docs, width, bands, rows)
    comp = components(links(docs, texts, width, similarity)).withColumnRenamed("node", "tid")
    heads = texts.select(F.col("tid").alias("comp"), F.col("doc_id").alias("class_id"))
    named = texts.join(comp, "tid", "left").withColumn("comp", F.coalesce("comp", "tid")).join(heads, "comp")
    known = stored(named.select("_k1", "_k2", "class_id", F.col("tid").alias("text_id"), (F.col("tid") == F.col("comp")).alias("first_text")), "classes")
    kept = [c for c in docs.columns if c not in ("class_id", "text_id", "first_text")]
    rows_in = docs.select(*kept, *text_key(F.col("text")))
    return rows_in.join(known, ["_k1", "_k2"]).select(*kept, "class_id", "text_id", "first_text"), known


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, with the columns it came with.

    It is the one of the smallest doc_id; of equal ones any.
    """
    settings = {"similarity": SIMILARITY, "width": WIDTH, "bands": BANDS, "rows": ROWS} | options
    keys = docs.select("doc_id", "text")
    _, known = _classes(keys, **settings)
    first = known.filter("first_text").select(F.col("_k1").alias("_f1"), F.col("_k2").alias("_f2"), F.col("class_id").alias("_first"))
    k1, k2 = text_key(docs["text"])
    stays = docs.join(first, (k1 == F.col("_f1")) & (k2 == F.col("_f2")) & docs["doc_id"].eqNullSafe(F.col("_first")))
    # rows of one id and text: a count per text tells whether there are any
    again = stored(
        keys.select("doc_id", *text_key(F.col("text"))).groupBy("doc_id", "_k1", "_k2").count().filter("count > 1"), "again"
    )
    if again.isEmpty():
        return stays.select(*docs.columns)
    return stays.dropDuplicates(["_f1", "_f2"]).select(*docs.columns)
