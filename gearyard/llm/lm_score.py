"""Language-model scores from a log-frequency Bloom filter.

All n-grams (words and pairs) of the training documents are counted. A count is
quantised to a level on a log scale, and the n-gram is put into a Bloom filter
once for each level up to its own. A scorer probes level after level until one
is missing; the last one present gives the count back. Word probabilities are
interpolated: p(w|v) = (c(vw) + mu * p(w)) / (c(v) + mu), with p(w) add-one.

The filter is built in segments by n-gram hash, as many as the corpus needs, and
looked up where it is built. Documents are stored once in parts, as numbers of
each part's distinct words. A part sends its distinct n-grams to their segments,
with their counts in the documents to learn from. A segment sums the counts,
builds its filter, looks all these n-grams up and answers with their levels, in
their order; a part's answers, end to end, are its scores' input. So every text
is read once and every n-gram sent once, whatever the size of the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.llm.common import stored
from gearyard.llm.hashing import blocks, mixed, utf8, word_hashes

SEGMENT_BYTES = 4 << 20  # text that one segment's n-grams stand for: its counts are held at once by one worker
BROADCAST_BYTES = 64 << 20  # no longer read (nothing is broadcast); kept for callers that set it
PART_BYTES = 16 << 20  # text of a part of the documents at most, but for one longer text
FLUSH_TOKENS = 1_500_000  # tokens of a part at which it ends
PART_ROWS = 8  # parts in a row group of the stored table
BATCH_KEYS = 1 << 22  # n-grams in an Arrow batch, about
KEYS_BLOCK = 1 << 18  # n-grams put into a filter at a time
BITS_PER_ITEM, PROBES = 10, 4  # some 1.2 % false positives at each level
LEVEL_BASE = 1.5
MU = 300.0

_END, _START, _PAIR, _LEVEL, _PROBE = (np.uint64(x) for x in (
    0xD6E8FEB86659FD93, 0xA3EC647659359ACD, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
))


def level_bounds() -> np.ndarray:
    """The smallest count of each level: 1, 2, 3, 4, 6, 8, 12 ..."""
    bounds, x = [], 1.0
    while x < 1e18:
        if not bounds or int(np.ceil(x)) > bounds[-1]:
            bounds.append(int(np.ceil(x)))
        x *= LEVEL_BASE
    return np.array(bounds, np.int64)


def level_values() -> np.ndarray:
    """What a level stands for: 0 for none, else the middle of its counts."""
    low = level_bounds()
    return np.r_[0.0, (low + np.r_[low[1:] - 1, low[-1]]) / 2]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words in lower case (A-Z) and of an end for each text, and each text's bounds."""
    words, bounds = word_hashes([t.lower() for t in texts])
    ends = bounds[1:] + np.arange(len(texts))
    single = np.empty(len(words) + len(texts), np.uint64)
    is_end = np.zeros(len(single), bool)
    is_end[ends] = True
    single[is_end], single[~is_end] = _END, words
    return single, np.r_[0, ends + 1]


def pairs_of(single: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hashes of the pairs that tokens end; a text's first pair begins with a start."""
    before = np.empty(len(single), np.uint64)
    before[1:] = single[:-1]
    before[bounds[:-1]] = _START
    before *= _PAIR
    before += single
    return mixed(before)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segments are ranges of hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _squeezed(values: np.ndarray) -> bytes:
    """Packed, all first bytes of the values together, then all second bytes and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unsqueezed(data: bytes, n: int, dtype: type) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * np.dtype(dtype).itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, n).T).view(dtype)[:, 0]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the documents, a row each: distinct words; the number of every token's word;
    the tokens of each text; and the other columns as lists."""
    task, made, held, size = TaskContext.get(), 0, [], [0, 0]

    def part() -> pa.RecordBatch:
        words, number, often = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True, return_counts=True)
        order = np.lexsort((words, -often))  # frequent words get small numbers, words of equal count ascend: both pack well
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        rest = pa.Table.from_batches([h[0] for h in held])
        learnt = pc.sum(rest.column("learn")).as_py() if "learn" in rest.column_names else rest.num_rows
        columns = {
            "part": pa.array([made + ((task.partitionId() if task else 0) << 32)], pa.int64()), "bytes": pa.array([size[0]], pa.int64()),
            "learnt": pa.array([learnt], pa.int64()), "words": pa.array([_squeezed(np.diff(words[order], prepend=np.uint64(0)))], pa.binary()),
            "n_words": pa.array([len(words)], pa.int64()), "numbers": pa.array([_squeezed(place[number])], pa.binary()),
            "lengths": pa.array([np.concatenate([np.diff(h[2]) for h in held]).astype(np.int64).tobytes()], pa.binary()),
        }
        for name in rest.column_names:
            values = pa.concat_arrays(rest.column(name).chunks)
            columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        texts, rest = utf8(batch.column("text")), batch.drop_columns(["text"])
        for a, b in blocks(texts):
            if held and size[0] + sum(map(len, texts[a:b])) > PART_BYTES:
                yield part()
                made, held, size = made + 1, [], [0, 0]
            held.append((rest.slice(a, b - a), *tokens(texts[a:b])))
            size = [size[0] + sum(map(len, texts[a:b])), size[1] + len(held[-1][1])]
            if size[1] >= FLUSH_TOKENS:
                yield part()
                made, held, size = made + 1, [], [0, 0]
    if held:
        yield part()


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A part's distinct words, ascending, the number of every token's word, and the texts' bounds."""
    bounds = np.r_[0, np.cumsum(np.frombuffer(row["lengths"], np.int64))]
    words = np.cumsum(_unsqueezed(row["words"], row["n_words"], np.uint64), dtype=np.uint64)
    order = np.argsort(words)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return words[order], place[_unsqueezed(row["numbers"], int(bounds[-1]), np.uint32)], bounds


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The ranges of values (rows of a table) between cuts as a binary column, without a Python object for each."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    offsets = ((cuts - cuts[0]) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values[cuts[0]:cuts[-1]])])


def _narrow(values: np.ndarray) -> np.ndarray:
    """Numbers as rows of as many bytes as the largest takes."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width])


def _wide(column: pa.ChunkedArray, n: np.ndarray) -> np.ndarray:
    """The numbers of a column of ``n`` narrow ones in each row, end to end."""
    data, out = _values(column, np.uint8), np.zeros((int(n.sum()), 8), np.uint8)
    size = pc.binary_length(column).to_numpy().astype(np.int64)
    each = size // np.maximum(n, 1)
    for width in np.unique(each[n > 0]):
        mine = each == width
        out[np.repeat(mine, n), :width] = data[np.repeat(mine, size)].reshape(-1, width)
    return out.view(np.uint64)[:, 0]


def _narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of n-grams as they are sent: the first key, and how far each is from the one before."""
    for batch in batches:
        cells = pa.Table.from_batches([batch])
        keys, counts = _values(cells.column("keys"), np.uint64), _values(cells.column("counts"), np.uint32)
        n = pc.binary_length(batch.column("keys")).to_numpy().astype(np.int64) >> 3
        cuts = np.r_[0, np.cumsum(n)]
        steps = np.diff(keys, prepend=np.uint64(0))
        steps[cuts[:-1]] = 0
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("part", "segment", "pair")), pa.array(n.astype(np.int32)), pa.array(keys[cuts[:-1]].view(np.int64)),
             _binary(_narrow(steps), cuts), _binary(_narrow(counts), cuts)],
            names=["part", "segment", "pair", "n", "first", "steps", "counts"],
        )


def _widened(table: pa.Table) -> pa.Table:
    """The rows that ``_narrowed`` sent as they were."""
    n = table.column("n").to_numpy().astype(np.int64)
    cuts, steps = np.r_[0, np.cumsum(n)], np.cumsum(_wide(table.column("steps"), n), dtype=np.uint64)
    keys = steps + np.repeat(table.column("first").to_numpy().view(np.uint64) - steps[cuts[:-1]], n)
    return table.select(["part", "segment", "pair"]).append_column("keys", _binary(keys, cuts)).append_column(
        "counts", _binary(_wide(table.column("counts"), n).astype(np.uint32), cuts)
    )


def _spans(cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring cells of some ``BATCH_KEYS`` values together."""
    edges = np.flatnonzero(np.r_[True, np.diff(cuts[:-1] // BATCH_KEYS) > 0, True])
    return zip(edges[:-1], edges[1:])


def _counted(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each part, ascending, with their counts in texts to learn from: a row
    for each segment, arrays packed as bytes. Texts that are not yet in parts are put into some;
    without a column ``learn`` all are learnt from."""
    def rows(part: int, pair: bool, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        segment, counts = segment_of(keys, segments), counts.astype(np.uint32)  # far fewer tokens than 2**32 are in a part
        cuts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
        for a, b in _spans(cuts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b - a, part)), pa.array(segment[cuts[a:b]].astype(np.int32)), pa.array([pair] * (b - a)),
                 _binary(keys, cuts[a:b + 1]), _binary(counts, cuts[a:b + 1])],
                names=["part", "segment", "pair", "keys", "counts"],
            )

    for batch in batches:
        for some in _numbered(iter([batch])) if "text" in batch.schema.names else [batch]:
            for k in range(some.num_rows):
                row = some.slice(k, 1).to_pylist()[0]
                words, number, bounds = _read(row)
                learn = np.repeat(np.array(row.get("learn", [True] * (len(bounds) - 1)), bool), np.diff(bounds))
                yield from rows(row["part"], False, words, np.bincount(number[learn], minlength=len(words)))
                pairs = pairs_of(words[number], bounds)
                keys, counts = np.unique(pairs[learn], return_counts=True)
                if not learn.all():
                    others = np.unique(pairs[~learn])
                    keys, counts = _summed(np.concatenate([keys, others]), np.r_[counts, np.zeros(len(others), np.int64)])
                del pairs
                yield from rows(row["part"], True, keys, counts)


def _values(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """The values of a binary column, end to end, as one array: read from the
    Arrow buffers, without a Python object for each row."""
    parts = []
    for chunk in column.chunks:
        if not len(chunk):
            continue
        width = 8 if pa.types.is_large_binary(chunk.type) else 4
        offsets = np.frombuffer(
            chunk.buffers()[1], np.int64 if width == 8 else np.int32, len(chunk) + 1, chunk.offset * width
        )
        start, end = int(offsets[0]), int(offsets[-1])
        parts.append(np.frombuffer(chunk.buffers()[2], np.uint8, end - start, start).view(dtype))
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their summed counts: one sort, no inverse."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts, dtype=np.int64)


def bit_places(keys: np.ndarray, level: np.ndarray | int, n_bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The probed bits of n-grams at a level."""
    step = mixed(keys + np.asarray(level).astype(np.uint64) * _LEVEL)
    stride = mixed(step + _PROBE) | np.uint64(1)
    for k in range(PROBES):
        yield (step + np.uint64(k) * stride) % np.asarray(n_bits).astype(np.uint64)


def _segment(table: pa.Table) -> pa.Table:
    """One segment's filter, its exact word counts, and their totals."""
    pair = table.column("pair")
    words, word_counts = _summed(*(_values(table.filter(pc.invert(pair)).column(c), t) for c, t in (("keys", np.uint64), ("counts", np.uint32))))
    pairs, pair_counts = _summed(*(_values(table.filter(pair).column(c), t) for c, t in (("keys", np.uint64), ("counts", np.uint32))))
    words, word_counts, pairs, pair_counts = words[word_counts > 0], word_counts[word_counts > 0], pairs[pair_counts > 0], pair_counts[pair_counts > 0]
    segment = table.column("segment")[0].as_py()
    del table, pair
    keys = np.concatenate([words, pairs])
    levels = np.concatenate([np.searchsorted(level_bounds(), c, side="right").astype(np.uint8) for c in (word_counts, pair_counts)])
    n_tokens = int(word_counts.sum())
    word_counts, words, n_words = word_counts.tobytes(), words.tobytes(), len(words)
    del pairs, pair_counts
    n_bits = max(64, -(-int(levels.sum(dtype=np.int64)) * BITS_PER_ITEM // 8) * 8)
    bits = np.zeros(n_bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for i in range(0, len(keys), KEYS_BLOCK):
            for place in bit_places(keys[i:i + KEYS_BLOCK], level, n_bits):
                bits[place.astype(np.int64)] = True
    return pa.table({
        "segment": pa.array([segment], pa.int32()),
        "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
        "words": pa.array([words], pa.binary()), "word_counts": pa.array([word_counts], pa.binary()),
        "n_words": pa.array([n_words], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64()),
    })


def _packed(rows: list, segments: int) -> dict:
    """Some neighbouring segments of the model in flat arrays."""
    rows = sorted(rows, key=lambda row: row.segment)
    size = np.array([len(row.bits) * 8 for row in rows])
    return {
        "segments": segments, "ids": np.array([row.segment for row in rows]),
        "n_bits": size, "offset": np.cumsum(size) - size,
        "bits": np.frombuffer(b"".join(bytes(row.bits) for row in rows), np.uint8),
        "words": np.frombuffer(b"".join(bytes(row.words) for row in rows), np.uint64),
        "counts": np.frombuffer(b"".join(bytes(row.word_counts) for row in rows), np.int64),
    }


def _levels(part: dict, keys: np.ndarray) -> np.ndarray:
    """The highest level up to which each n-gram is present."""
    found = np.zeros(len(keys), np.uint8)
    if not len(part["ids"]):
        return found
    segment = segment_of(keys, part["segments"])
    row = np.minimum(np.searchsorted(part["ids"], segment), len(part["ids"]) - 1)
    at, level = np.flatnonzero(part["ids"][row] == segment), 0
    n_bits, offset = part["n_bits"][row], part["offset"][row]
    while len(at) and level < 255:
        level += 1
        live = np.ones(len(at), bool)
        for place in bit_places(keys[at], level, n_bits[at]):
            spot = place.astype(np.int64) + offset[at]
            live &= (part["bits"][spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)
        at = at[live]
        found[at] = level
    return found


def _exact(part: dict, keys: np.ndarray) -> np.ndarray:
    """The counts of words, 0 where they are not in this part."""
    if not len(part["words"]):
        return np.zeros(len(keys), np.int64)
    place = np.minimum(np.searchsorted(part["words"], keys), len(part["words"]) - 1)
    return np.where(part["words"][place] == keys, part["counts"][place], 0)


def _answered(table: pa.Table, segments: int) -> pa.Table:
    """One segment's filter, looked up for all its n-grams of all parts: their levels and the exact
    counts of words, in the order of each part's n-grams. The first row has the segment's totals."""
    table = _widened(table)
    built = _segment(table).to_pylist()
    model, out = _packed([SimpleNamespace(**row) for row in built], segments), []
    for pair in (False, True):
        rows = table.filter(table.column("pair") if pair else pc.invert(table.column("pair")))
        distinct, place = np.unique(_values(rows.column("keys"), np.uint64), return_inverse=True)
        levels = _levels(model, distinct)[place]
        exact = np.zeros(0, np.int64) if pair else _exact(model, distinct)[place]
        cuts = np.r_[0, np.cumsum(pc.binary_length(rows.column("keys")).to_numpy() >> 3)].astype(np.int64)
        out.append(pa.table({
            "part": rows.column("part"), "segment": rows.column("segment"), "pair": rows.column("pair"), "levels": _binary(levels, cuts),
            "exact": _binary(_narrow(exact), np.zeros_like(cuts) if pair else cuts),
        }))
    out = pa.concat_tables(out)
    for name in ("n_words", "n_tokens"):
        out = out.append_column(name, pa.array(np.r_[built[0][name], np.zeros(out.num_rows - 1, np.int64)], pa.int64()))
    return out


def _scorer(kept: list[str], n_tokens: int, n_words: int, n_docs: int) -> Callable:
    """The scores of a part's documents from the answers of all segments; ``kept`` columns stay."""
    def run(parts: pa.Table, answers: pa.Table) -> pa.Table:
        row, values, spread = parts.drop_columns(kept).to_pylist()[0], level_values(), n_tokens + n_words + 1
        words, number, bounds = _read(row)
        answers = answers.sort_by("segment")  # segments are ranges of hashes: so come the keys, ascending
        asked = answers.filter(pc.invert(answers.column("pair")))
        levels = _values(asked.column("levels"), np.uint8)
        exact = _wide(asked.column("exact"), pc.binary_length(asked.column("levels")).to_numpy().astype(np.int64))
        distinct, place = np.unique(pairs_of(words[number], bounds), return_inverse=True)
        pair_levels = _values(answers.filter(answers.column("pair")).column("levels"), np.uint8)
        if len(levels) != len(words) or len(exact) != len(words) or len(pair_levels) != len(distinct):
            raise RuntimeError(f"part {row['part']}: not every n-gram was answered")
        count, owner = np.diff(bounds), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        known = np.bincount(owner, (exact > 0)[number], len(count)).astype(np.int64)
        base = np.bincount(owner, np.log10(exact + 1.0)[number], len(count)) - count * np.log10(spread)
        c, together = values[levels][number], values[pair_levels][place]
        del distinct, place
        head = np.r_[0.0, c[:-1]]
        head[bounds[:-1]] = n_docs
        # a pair is never seen more often than its first word, whatever the levels' middles say
        p = (np.minimum(together, head) + MU * (c + 1) / spread) / (head + MU)
        score = np.bincount(owner, np.log10(np.minimum(p, 1.0)), len(count))
        rest = {name: parts.column(name).combine_chunks().flatten() for name in kept}
        return pa.table(rest | {"n_tokens": count, "n_known": known, "base_score": base, "score": score})

    return run


def _runs(sized: list, most: int) -> list[list]:
    """Neighbouring segments in runs of so many bytes together."""
    runs, room = [], -1
    for row in sorted(sized, key=lambda row: row.segment):
        if row["size"] > room:
            runs.append([])
            room = most
        runs[-1].append(row)
        room -= row["size"]
    return runs


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score) for every document.

    The model learns from the rows for which ``learn`` holds (NULL: not).
    ``base_score`` is the exact add-one unigram score, ``score`` the model's
    log10 probability, both with one end token per text. A NULL text is an empty
    one: it has the end only. Repeated rows count and score as often as they
    come. If nothing is learnt from, all words are unknown.
    """
    rows = docs.select("doc_id", F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    key = rows.schema["doc_id"].dataType.simpleString()
    parts = stored(rows.mapInArrow(
        _numbered,
        f"part bigint, bytes bigint, learnt bigint, words binary, n_words bigint, numbers binary, lengths binary, doc_id array<{key}>, learn array<boolean>",
    ), "parts", group_rows=PART_ROWS)
    size, n_docs = (x or 0 for x in parts.agg(F.sum("bytes"), F.sum("learnt")).first())
    segments = max(1, -(-size // SEGMENT_BYTES))
    counts = parts.select("part", "words", "n_words", "numbers", "lengths", "learn").mapInArrow(
        lambda it: _narrowed(_counted(it, segments)),
        "part bigint, segment int, pair boolean, n int, first bigint, steps binary, counts binary",
    )
    answers = stored(counts.groupBy("segment").applyInArrow(
        lambda table: _answered(table, segments),
        "part bigint, segment int, pair boolean, levels binary, exact binary, n_words bigint, n_tokens bigint",
    ), "answers", "zstd")
    n_words, n_tokens = (x or 0 for x in answers.agg(F.sum("n_words"), F.sum("n_tokens")).first())
    scored = parts.select("part", "words", "n_words", "numbers", "lengths", "doc_id", "learn").groupBy("part").cogroup(
        answers.select("part", "segment", "pair", "levels", "exact").groupBy("part")
    ).applyInArrow(
        _scorer(["doc_id", "learn"], n_tokens, n_words, n_docs),
        f"doc_id {key}, learn boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.select(
        "doc_id", "learn", "n_tokens", "n_known", F.lit(n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
