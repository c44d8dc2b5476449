"""Exact substring dedup: bytes covered by a string that also starts earlier go.

Every string of ``length`` bytes holds an anchor: a short byte window whose hash
is the least of all such windows in the string. Equal strings hold equal
anchors, so strings can only repeat around anchors that do. Anchors are
grouped by hash, with a hash of their context, which is all the bytes that
strings around the anchor can reach. Where equal contexts meet, all but the
first go as a whole. Where an anchor has different contexts, one of each goes
into an enhanced suffix array; a stack scan over its common-prefix intervals,
tested for diversity of the byte to the left, gives the maximal repeats with
all their occurrences, and all but the first occurrence go.

Equal texts are taken as one first. Anchors with very many different contexts
are not put into one array: their windows are grouped by content instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gearyard.llm.common import stored
from gearyard.llm.decontam import text_key
from gearyard.llm.hashing import mixed, rolling, slice_hash, utf8

LENGTH = 100
ANCHOR = 32
# Contexts that one suffix array takes (some MB), and one anchor's share that is too many for it.
ARRAY_CONTEXTS = 8_000
HOT_CONTEXTS = 8_000
# Tables of texts with a decision, up to this many rows (some dozen MB), are broadcast.
BROADCAST_ROWS = 300_000

_LEFT = np.uint64(0x9FB21C651E98DF25)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every full window, by doubling."""
    size, out = 1, x
    while size * 2 <= width:
        out, size = np.minimum(out[:-size], out[size:]), size * 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(hash, context hash, low, high) of each anchor.

    A string's anchor is the least of its byte windows by the upper half of the
    hash, the leftmost of equals. Strings that start next to each other mostly
    share theirs: text[low:high] is all that the strings of an anchor cover.
    """
    n = len(text)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = rolling(np.frombuffer(text, np.uint8))
    start = np.arange(n - anchor + 1)
    hashes = slice_hash(sums, start, start + anchor)
    upper, lower = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
    place = (_sliding_least((hashes & upper) | start.astype(np.uint64), length - anchor + 1) & lower).astype(np.int64)
    change = np.flatnonzero(place[1:] != place[:-1])
    low, high = np.r_[0, change + 1], np.r_[change, len(place) - 1] + length
    at = place[low]
    context = mixed(slice_hash(sums, low, high) + (at - low).astype(np.uint64) * _LEFT)
    return hashes[at], context, low, high


def _all_anchors(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    def batch_of(found: list) -> pa.RecordBatch:
        tid, a, ctx, low, high = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (tid, a.view(np.int64), ctx.view(np.int64), low, high)], names=["tid", "a", "ctx", "low", "high"]
        )

    for batch in batches:
        found, size = [], 0
        for tid, text in zip(batch.column("tid").to_pylist(), utf8(batch.column("text"))):
            found.append((None, *anchors(text, length, anchor)))
            size += len(found[-1][1])
            found[-1] = (np.full(len(found[-1][1]), tid, np.int64), *found[-1][1:])
            if size >= 200_000:
                yield batch_of(found)
                found, size = [], 0
        if found:
            yield batch_of(found)


def _context_bytes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted contexts: (bucket, tid, start, bytes); of hot anchors, each string by itself."""
    for batch in batches:
        rows: list[tuple] = []
        for tid, text, wanted in zip(batch.column("tid").to_pylist(), utf8(batch.column("text")), batch.column("wanted").to_pylist()):
            for w in wanted:
                low, high = w["low"], w["high"]
                if w["hot"]:
                    rows += [(None, tid, i, text[i:i + length]) for i in range(low, high - length + 1)]
                else:
                    rows.append((w["bucket"], tid, low, text[low:high]))
                if len(rows) >= 20_000:
                    yield _rows(rows)
                    rows = []
        if rows:
            yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["bucket", "tid", "start", "bytes"])


class SuffixArray:
    """Suffixes of some pieces with at least ``least`` bytes left in their piece,
    in order of their bytes, with the common prefix of neighbours.

    A suffix is compared eight bytes at a time, up to the longest piece's size.
    What follows a piece takes part in the order, but in no common prefix.
    """

    def __init__(self, pieces: list[bytes], least: int):
        size = np.array([len(p) for p in pieces])
        words = -(-int(size.max(initial=0)) // 8)
        data = np.frombuffer(b"".join(pieces) + bytes(8 * words + 8), np.uint8)
        first = np.cumsum(np.r_[0, size[:-1]])
        room = np.maximum(size - least + 1, 0)
        piece = np.repeat(np.arange(len(pieces)), room)
        inside = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        at = first[piece] + inside
        eight = np.zeros(len(data) - 7, np.uint64)
        for k in range(8):
            eight = eight << np.uint64(8) | data[k:len(data) - 7 + k].astype(np.uint64)
        by_word = [eight[at + 8 * k] for k in range(words)]
        order = np.lexsort(by_word[::-1]) if words else np.zeros(0, np.int64)
        self.piece, self.inside, at = piece[order], inside[order], at[order]
        left = size[self.piece] - self.inside
        common, going = np.zeros(max(len(order) - 1, 0), np.int64), np.ones(max(len(order) - 1, 0), bool)
        for word in by_word:
            word = word[order]
            differ = word[1:] ^ word[:-1]
            # equal leading bytes of the first word that differs
            part = sum((differ < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8)) + (differ == 0)
            common += np.where(going, part, 0)
            going &= differ == 0
        #: common[k]: prefix shared by suffixes k-1 and k
        self.common = np.r_[0, np.minimum(common, np.minimum(left[:-1], left[1:]))].astype(np.int64)
        before = np.where(self.inside > 0, data[np.maximum(at - 1, 0)].astype(np.int64), -1 - np.arange(len(at)))
        self.turns = np.cumsum(np.r_[0, before[1:] != before[:-1]].astype(np.int64)) if len(before) else before

    def maximal_repeats(self, least: int) -> Iterator[tuple[int, int, int]]:
        """(length, first, last): intervals of suffixes whose common prefix of
        ``least`` or more bytes can be extended to no side in all occurrences."""
        linked = np.flatnonzero(self.common >= least)
        if not len(linked):
            return
        cut = np.flatnonzero(np.diff(linked) > 1)
        starts, ends = linked[np.r_[0, cut + 1]] - 1, linked[np.r_[cut, len(linked) - 1]]
        diverse = self.turns[ends] > self.turns[starts]
        for low, high in zip(starts[diverse].tolist(), ends[diverse].tolist()):
            stack: list[tuple[int, int]] = []
            for k, common in enumerate([*self.common[low + 1:high + 1].tolist(), 0], low + 1):
                begin = k - 1
                while stack and stack[-1][0] > common:
                    length, begin = stack.pop()
                    if self.turns[k - 1] > self.turns[begin]:
                        yield length, begin, k - 1
                if common and (not stack or stack[-1][0] < common):
                    stack.append((common, begin))


def repeated_spans(tid: np.ndarray, start: np.ndarray, pieces: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """(tid, start, end) of all occurrences of maximal repeats that are not the first.

    Pieces may overlap: places of one text that are the same are one occurrence.
    """
    if not len(pieces):
        return []
    array = SuffixArray(pieces, least)
    where, place = tid[array.piece], start[array.piece] + array.inside
    order = np.lexsort((place, where))
    fresh = np.r_[True, (where[order][1:] != where[order][:-1]) | (place[order][1:] != place[order][:-1])][: len(order)]
    age = np.empty(len(order), np.int64)
    age[order] = np.cumsum(fresh)
    found = []
    for length, low, high in array.maximal_repeats(least):
        later = low + np.flatnonzero(age[low:high + 1] > age[low:high + 1].min())
        found.append(np.stack([where[later], place[later], place[later] + length]))
    if not found:
        return []
    spans = np.unique(np.concatenate(found, axis=1), axis=1)
    last = np.r_[(spans[0][1:] != spans[0][:-1]) | (spans[1][1:] != spans[1][:-1]), True]  # the longest from each place
    return list(map(tuple, spans[:, last].T.tolist()))


def _bucket_spans(table: pa.Table, length: int) -> pa.Table:
    tid, start = table.column("tid").to_numpy(), table.column("start").to_numpy()
    rows = repeated_spans(tid, start, table.column("bytes").to_pylist(), length)
    return pa.table({k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(("tid", "low", "high"))})


def _cleaned(batches: Iterator[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """What is left of each text, given the spans to cut, which may overlap."""
    for batch in batches:
        texts, out = utf8(batch.column("text")), []
        for text, copy, spans in zip(texts, batch.column("copy").to_pylist(), batch.column("spans").to_pylist()):
            merged: list[list[int]] = []
            if copy and len(text) >= length:
                merged = [[0, len(text)]]
            else:
                for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
            edges = [0, *[x for span in merged for x in span], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, k) for x, k in zip(zip(*out), kinds)]] if out else [batch.column("doc_id"), *[pa.array([], k) for k in kinds]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping spans of a text as one."""
    kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            merged: list[dict] = []
            for s in sorted(spans, key=lambda s: (s["low"], s["high"])):
                if merged and s["low"] <= merged[-1]["high"]:
                    merged[-1]["high"] = max(merged[-1]["high"], s["high"])
                else:
                    merged.append(dict(s))
            out.append(merged)
        yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(out, kind)], names=["tid", "spans"])


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _packed(sizes: DataFrame, capacity: int) -> DataFrame:
    """(a, bucket): anchors packed in order into buckets of about ``capacity``
    contexts, by the running sum of their counts ``n``.

    The anchors are sorted by ranges; each task sums its own, the tasks' totals
    (a row for each) give the offsets. A bucket holds at most ``capacity`` plus
    one anchor's contexts.
    """
    spark = sizes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = sizes.repartitionByRange(parts, "a").sortWithinPartitions("a").withColumn("_part", F.spark_partition_id())
    local = stored(local.mapInArrow(_running, "a bigint, n bigint, _part int, _before bigint"), "anchor-sums")
    totals = local.groupBy("_part").agg(F.sum("n").alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    return local.join(F.broadcast(offsets), "_part").select(
        "a", F.floor((F.col("_offset") + F.col("_before")) / capacity).cast("bigint").alias("bucket")
    )


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the anchors before each one in its task (rows come sorted)."""
    done = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        before = done + np.cumsum(n) - n
        done += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("n"), batch.column("_part"), pa.array(before, pa.int64())],
            names=["a", "n", "_part", "_before"],
        )


def repeated_parts(docs: DataFrame, length: int, anchor: int) -> tuple[DataFrame, DataFrame]:
    """Stored (tid, _k1, _k2, first, n): the distinct texts in document order with
    their first doc_id; and (tid, spans): the parts of them that also start earlier."""
    keyed = docs.select("doc_id", *text_key(F.col("text")))
    texts = stored(
        keyed.groupBy("_k1", "_k2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.asc_nulls_last("first"), "_k1", "_k2").withColumn("tid", F.monotonically_increasing_id()), "texts"
    )
    one = docs.select("doc_id", "text", *text_key(F.col("text"))).join(_bounded(texts), ["_k1", "_k2"]).filter(
        F.col("doc_id").eqNullSafe(F.col("first"))
    ).select("tid", "text")
    found = one.mapInArrow(lambda it: _all_anchors(it, length, anchor), "tid bigint, a bigint, ctx bigint, low bigint, high bigint")
    groups = found.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("least"), F.max("ctx").alias("most"))
    again = stored(groups.filter("n > 1").select("a", (F.col("least") != F.col("most")).alias("varied")), "anchors")
    repeats = stored(found.join(again, "a"), "repeats")
    contexts = stored(
        repeats.groupBy("a", "ctx", "varied").agg(F.min(F.struct("tid", "low", "high")).alias("head"))
        .select("a", "ctx", "varied", F.col("head.tid").alias("head_tid"), F.col("head.low").alias("head_low"), F.col("head.high").alias("head_high")),
        "contexts",
    )
    # all of an equal context but its first occurrence
    copied = repeats.drop("varied").join(contexts.select("a", "ctx", "head_tid", "head_low"), ["a", "ctx"]).filter(
        "tid <> head_tid or low <> head_low"
    ).select("tid", "low", "high")
    # different contexts of an anchor: the suffix arrays
    varied = contexts.filter("varied").select(
        "a", F.col("head_tid").alias("tid"), F.col("head_low").alias("low"), F.col("head_high").alias("high")
    )
    sizes = stored(varied.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "anchor-sizes")
    hot = sizes.filter(F.col("n") > HOT_CONTEXTS).select("a", F.lit(True).alias("hot"), F.lit(None).cast("bigint").alias("bucket"))
    packed = _packed(sizes.filter(F.col("n") <= HOT_CONTEXTS), ARRAY_CONTEXTS)
    wanted = varied.join(hot.unionByName(packed.select("a", F.lit(False).alias("hot"), "bucket")), "a").select(
        "tid", F.struct("low", "high", "bucket", "hot").alias("w")
    ).groupBy("tid").agg(F.collect_list("w").alias("wanted"))
    pieces = stored(one.join(wanted, "tid").mapInArrow(
        lambda it: _context_bytes(it, length), "bucket bigint, tid bigint, start bigint, bytes binary"
    ), "pieces")
    arrays = pieces.filter("bucket is not null").groupBy("bucket").applyInArrow(
        lambda table: _bucket_spans(table, length), "tid bigint, low bigint, high bigint"
    )
    # strings of hot anchors: grouped by content, with what can be combined combined first
    strings = pieces.filter("bucket is null").select("tid", "start", F.md5("bytes").alias("s")).distinct()
    heads = strings.groupBy("s").agg(F.min(F.struct("tid", "start")).alias("head"))
    spread = strings.join(heads, "s").filter("tid <> head.tid or start <> head.start").select(
        "tid", F.col("start").alias("low"), (F.col("start") + length).alias("high")
    )
    spans = copied.unionByName(arrays).unionByName(spread).groupBy("tid").agg(
        F.collect_list(F.struct("low", "high")).alias("spans")  # as many as the text has anchors, at most
    ).mapInArrow(_merged, "tid bigint, spans array<struct<low: bigint, high: bigint>>")
    return texts, stored(spans, "spans")


def dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every document.

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a document of smaller doc_id (NULL last, equal ids by content),
    or before in its own. All strings are judged on the input. NULL texts are
    empty. Rows of one id and text count as one document and get equal results.
    ``kept`` has the remaining bytes if asked for, else NULL; they need not be
    valid UTF-8.
    """
    texts, spans = repeated_parts(docs, length, anchor)
    known = stored(
        texts.join(spans, "tid", "left").filter("n > 1 or spans is not null").select("_k1", "_k2", "first", "spans"), "cuts"
    )
    rows = docs.select("doc_id", "text", *text_key(F.col("text"))).join(_bounded(known), ["_k1", "_k2"], "left")
    # a text that no decision is known of has no spans and no copies
    copy = F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first"))
    return rows.select("doc_id", "text", copy.alias("copy"), "spans").mapInArrow(
        lambda it: _cleaned(it, length, with_text),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary",
    )
