"""SentencePiece encoding of merge-type (BPE) vocabularies by a score-ordered agenda.

A text is normalised as the model asks (here: a space mark in front and every
space written as the mark ``▁``), split into characters, and then the
adjacent pair whose joined piece is in the vocabulary with the highest score
is merged, again and again; among equal scores the leftmost pair goes first.
The agenda of a long chunk is a heap of candidate pairs; a pair whose sides
changed since it was pushed is skipped when it comes up. Short chunks (words,
mostly) are merged many at a time: those of equal length are one table, and each
round takes the first pair off every agenda. Characters left outside the vocabulary
become their UTF-8 bytes as byte pieces.

No vocabulary piece has the space mark after another character, so merges
never cross the start of a run of space marks that follows a character. Texts
are cut there into chunks, each chunk is merged alone and the ids of a chunk
are kept in a bounded cache: words repeat, so most chunks are looked up.
The agenda works on ids: every split of a piece into two symbols (pieces, or
single characters of pieces) is a pair in a table, with the joined piece's id
and score.

On Spark, ``encode`` runs in Arrow batches (``mapInArrow``); each batch is
also encoded by the sentencepiece library and ``agrees`` tells whether both
gave the same ids. ``decoded`` is the library's decoding of the ids.

Defined cases: a NULL text is encoded as the empty text (no pieces, only the
end id); any other columns of the input are left out; repeated rows are
encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import compress, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearyard.llm.hashing import blocks

MARK = "▁"
# Kinds of pieces in a model (sentencepiece's ModelProto): which can be merged.
NORMAL, USER_DEFINED = 1, 4
CACHE_ENTRIES = 1 << 18
PAIR_KEY = 1 << 32  # symbol ids are below this: a pair is one integer
SHORT = 32  # characters of chunks merged many at a time; a round reads all symbols of those still as long
TOGETHER = 1 << 16  # chunks looked up at a time
BLOCK_CHARS = 1 << 22  # of texts cut into chunks at a time; a longer text is cut alone
NO_PAIR = np.iinfo(np.int32).max


def _taken(ids: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some rows of ids that lie end to end, again end to end, and their sizes."""
    sizes = starts[at + 1] - starts[at]
    first = np.repeat(starts[at] - (np.cumsum(sizes) - sizes), sizes)
    return ids[first + np.arange(len(first))], sizes


class _Chunks:
    """Chunks numbered as they come, and their ids end to end in one array."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.starts, self.ids = array("q", [0]), array("i")

    def add(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Different new chunks."""
        self.starts.frombytes((len(self.ids) + np.cumsum(sizes)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.place.update(zip(chunks, count(len(self.place))))

    def at(self, chunks: list[str]) -> np.ndarray:
        """Places of chunks, -1 if not there."""
        return np.fromiter(map(self.place.get, chunks, repeat(-1)), np.int64, len(chunks))

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _taken(np.frombuffer(self.ids, np.int32), np.frombuffer(self.starts, np.int64), at)


class PieceModel:
    """The pieces, scores and special ids of a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        proto = model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != model_pb2.TrainerSpec.BPE:
            raise ValueError("only merge-type (BPE) models are encoded here")
        spec = proto.normalizer_spec
        if spec.name != "identity" or spec.remove_extra_whitespaces or spec.precompiled_charsmap:
            raise ValueError(f"normaliser {spec.name!r} is not supported; only the identity")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("space marks as suffixes are not supported")
        self.dummy_prefix = spec.add_dummy_prefix
        self.escape = spec.escape_whitespaces
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.unk_id = proto.trainer_spec.unk_id
        self.eos_id = proto.trainer_spec.eos_id
        self.vocab_size = len(proto.pieces)
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        for i, piece in enumerate(proto.pieces):
            if piece.type in (NORMAL, USER_DEFINED):
                self.ids[piece.piece] = i
                self.score[piece.piece] = piece.score
            elif piece.type == model_pb2.ModelProto.SentencePiece.BYTE:
                self.byte_ids[int(piece.piece[3:5], 16)] = i
        # Symbols are ids: pieces keep theirs, single characters of pieces that
        # are no piece get more; every split of a piece into two symbols is a pair.
        self.symbol = dict(self.ids)
        for piece in self.ids:
            for ch in piece:
                self.symbol.setdefault(ch, len(proto.pieces) + len(self.symbol))
        self.text_of = {i: p for p, i in self.symbol.items()}
        self.pairs: dict[int, tuple[float, int]] = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if a is not None and b is not None:
                    self.pairs[a * PAIR_KEY + b] = (-self.score[piece], i)
        # The same as arrays: a hash table of the pairs, with ranks by score (equal scores share one).
        ranks = np.unique(np.array([x[0] for x in self.pairs.values()]), return_inverse=True)[1]
        bits = max(4, (4 * len(self.pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.pair_keys = np.full((1 << bits) + len(self.pairs) + 1, -1, np.int64)  # -1: free; a probe never wraps
        self.pair_rank = np.full(len(self.pair_keys), NO_PAIR, np.int32)
        self.pair_joined = np.full(len(self.pair_keys), -1, np.int32)
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        for key, slot, rank, hit in zip(keys.tolist(), self._slots(keys).tolist(), ranks.tolist(), self.pairs.values()):
            while self.pair_keys[slot] >= 0:
                slot += 1
            self.pair_keys[slot], self.pair_rank[slot], self.pair_joined[slot] = key, rank, hit[1]
        self.symbol_of_char = -1 - np.arange(0x110000, dtype=np.int32)  # below 0: not in any piece
        for piece, i in self.symbol.items():
            if len(piece) == 1:
                self.symbol_of_char[ord(piece)] = i
        # Chunks may be merged alone only if no piece joins a character to a following mark.
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.chunks = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if not crossing else r"(?s).+")
        self.by_space = self.escape and self.dummy_prefix and not crossing
        self.lead = MARK if self.by_space else ""  # what every chunk begins with
        # Two halves: when the newer is full it becomes the older, and what is
        # looked up there moves back; chunks still in use stay, memory is bounded.
        self.cache, self.older = _Chunks(), _Chunks()
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        if self.escape:
            text = text.replace(" ", MARK)
        return MARK + text if self.dummy_prefix else text

    def plain(self, text: str) -> bool:
        """Whether the chunks of a text are its words, each after a mark."""
        return text != "" and text[0] != " " and "  " not in text and MARK not in text

    def cut(self, text: str) -> list[str]:
        """The chunks of a text."""
        if self.by_space and self.plain(text):
            return [MARK + word for word in text.split(" ")]  # every mark begins a chunk
        return self.chunks.findall(self.normalise(text))

    def merge(self, chunk: str) -> list[int]:
        """The symbols of a chunk by the agenda of adjacent pairs: the pair whose
        joined piece scores highest first, the leftmost among equals."""
        symbol, unknown = self.symbol, -1
        syms = [symbol.get(ch, unknown) for ch in chunk]
        n = len(syms)
        if n < 2:
            return syms
        prev = list(range(-1, n - 1))
        nxt = [*range(1, n), -1]
        pairs = self.pairs.get
        push, pop = heapq.heappush, heapq.heappop
        agenda = []
        for i in range(1, n):
            hit = pairs(syms[i - 1] * PAIR_KEY + syms[i])
            if hit is not None:
                agenda.append((hit[0], i - 1, i, syms[i - 1], syms[i], hit[1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, a, b, joined = pop(agenda)
            if syms[left] != a or syms[right] != b or nxt[left] != right:
                continue  # one side has changed since the pair was pushed
            syms[left], syms[right] = joined, None
            after = nxt[left] = nxt[right]
            if after >= 0:
                prev[after] = left
                hit = pairs(joined * PAIR_KEY + syms[after])
                if hit is not None:
                    push(agenda, (hit[0], left, after, joined, syms[after], hit[1]))
            before = prev[left]
            if before >= 0:
                hit = pairs(syms[before] * PAIR_KEY + joined)
                if hit is not None:
                    push(agenda, (hit[0], before, left, syms[before], joined, hit[1]))
        return [x for x in syms if x is not None]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _paired(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined piece of pairs of symbols, ``NO_PAIR`` where they don't join."""
        keys = left.astype(np.int64) * PAIR_KEY + right
        keys[(left < 0) | (right < 0)] = -1
        slots = self._slots(keys)
        found = self.pair_keys[slots]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] += 1
            found = self.pair_keys[slots[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return self.pair_rank[slots], self.pair_joined[slots]

    def merge_many(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of short chunks as ``merge`` gives them, end to end, and the chunk of each
        (a character in no piece is -1 less its code point here).

        Chunks of as many symbols are the columns of one table, the longest first. A round joins in
        each the pair that is first on its agenda, so all become one symbol shorter and meet the
        next shorter ones; a chunk with no pair left is done.
        """
        given = self.symbol_of_char[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        first, of_length = np.cumsum(lengths) - lengths, np.argsort(lengths, kind="stable")
        cuts = np.searchsorted(lengths[of_length], np.arange(lengths.max(initial=0) + 2))
        size, done = np.zeros(len(chunks), np.int64), []
        owner = np.zeros(0, np.int64)
        for n in range(len(cuts) - 2, 0, -1):
            new = of_length[cuts[n]:cuts[n + 1]]
            fresh = given[first[new] + np.arange(n)[:, None]]
            if not len(owner):  # what is left of longer chunks has n symbols now
                syms, rank, joined = (np.zeros((k, 0), np.int32) for k in (n, n - 1, n - 1))
            owner, syms = np.concatenate([owner, new]), np.hstack([syms, fresh])
            pairs = self._paired(fresh[:-1].ravel(), fresh[1:].ravel())
            rank, joined = (np.hstack([x, y.reshape(n - 1, len(new))]) for x, y in zip((rank, joined), pairs))
            best, at = np.full(len(owner), NO_PAIR, np.int32), np.zeros(len(owner), np.int32)
            for k, row in enumerate(rank):  # the leftmost of each chunk's best
                at = np.where(row < best, np.int32(k), at)
                best = np.minimum(best, row)
            if (best == NO_PAIR).any():
                over, left = np.flatnonzero(best == NO_PAIR), np.flatnonzero(best != NO_PAIR)
                size[owner[over]] = n
                done.append((owner[over], syms.take(over, 1)))
                owner, at = owner[left], at[left]
                syms, rank, joined = (x.take(left, 1) for x in (syms, rank, joined))
            if not len(owner):
                continue
            every = np.arange(len(owner))
            one = joined[at, every]
            place = np.arange(n - 1, dtype=np.int32)[:, None]
            syms = np.where(place <= at, syms[:-1], syms[1:])
            syms[at, every] = one
            rank, joined = (np.where(place[:-1] < at, x[:-1], x[1:]) for x in (rank, joined))
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)  # pairs with the joined symbol
            gap, column = np.r_[at[before] - 1, at[after]], np.r_[before, after]
            rank[gap, column], joined[gap, column] = self._paired(syms[gap, column], syms[gap + 1, column])
        ends = np.cumsum(size)
        out = np.empty(int(size.sum()), np.int32)
        for which, found in done:
            out[(ends - size)[which] + np.arange(len(found))[:, None]] = found
        return out, np.repeat(np.arange(len(chunks), dtype=np.int32), size)

    def _ids(self, chunk: str, merged: list[int]) -> list[int]:
        """The ids of a chunk's symbols; characters that are no piece in bytes."""
        ids = []
        for k, x in enumerate(merged):
            if 0 <= x < self.vocab_size:
                ids.append(x)
                continue
            # a character that is no piece: only unmerged symbols are such
            piece = self.text_of.get(x) if x >= 0 else None
            piece = piece if piece is not None else self._unknown_char(chunk, merged, k)
            if self.byte_fallback:
                ids.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
            else:
                ids.append(self.unk_id)
        return ids

    def _ids_many(self, syms: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for the symbols of ``merge_many``: ids end to end, and how many each of the n chunks has."""
        odd = (syms < 0) | (syms >= self.vocab_size)
        if odd.any():
            distinct, which = np.unique(syms[odd], return_inverse=True)
            chars = [self.text_of[x] if x >= 0 else chr(-1 - x) for x in distinct.tolist()]
            ids = [[self.byte_ids[b] for b in c.encode("utf-8")] if self.byte_fallback else [self.unk_id] for c in chars]
            times = np.ones(len(syms), np.int64)
            times[odd] = np.array([len(x) for x in ids])[which]
            syms, owner, odd = np.repeat(syms, times), np.repeat(owner, times), np.repeat(odd, times)
            syms[odd] = np.concatenate([ids[k] for k in which.tolist()])
        return syms, np.bincount(owner, minlength=n)

    def _look_up(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different chunks, end to end, and how many each has; kept in the cache's newer
        half. A key is a chunk without ``lead``, which all of them begin with."""
        if len(self.cache.place) >= CACHE_ENTRIES:
            self.older, self.cache = self.cache, _Chunks()
        at = self.cache.at(keys)
        missing = at < 0
        if missing.any():
            new = list(compress(keys, missing.tolist()))
            at[missing] = len(self.cache.place) + np.arange(len(new))
            old = self.older.at(new)
            short = np.fromiter(map(len, new), np.int64, len(new)) <= SHORT - len(self.lead)
            known, many, long = (np.flatnonzero(x) for x in (old >= 0, (old < 0) & short, (old < 0) & ~short))
            ids, sizes = ([x] for x in self.older.get(old[known]))  # still in use
            if len(many):
                chunks = [self.lead + new[k] for k in many.tolist()]
                merged = self._ids_many(*self.merge_many(chunks), len(chunks))
                ids, sizes = [*ids, merged[0]], [*sizes, merged[1]]
            for k in long.tolist():
                chunk = self.lead + new[k]
                ids.append(np.array(self._ids(chunk, self.merge(chunk)), np.int32))
                sizes.append(np.array([len(ids[-1])]))
            order = np.argsort(np.concatenate([known, many, long]))
            self.cache.add(new, *_taken(np.concatenate(ids), np.r_[0, np.cumsum(np.concatenate(sizes))], order))
        return self.cache.get(at)

    def _unknown_char(self, chunk: str, merged: list[int], k: int) -> str:
        """The character of the k-th symbol when it is unknown: symbols before
        it stand for so many characters."""
        at = sum(len(self.text_of[x]) if x >= 0 else 1 for x in merged[:k])
        return chunk[at]

    def _keys(self, texts: list[str]) -> pa.ListArray:
        """The chunks of texts without ``lead``."""
        if not self.lead:
            return pa.array([self.cut(text) for text in texts], pa.list_(pa.string()))
        spaced = [
            None if not text else text if self.plain(text) else " ".join([c[1:] for c in self.cut(text)]) for text in texts
        ]
        return pc.split_pattern(pa.array(spaced, pa.string()), " ")  # no chunk holds a space

    def encode_many(self, texts: list[str | None], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (NULL as empty), end to end, each with the end id last if ``end``; and their bounds."""
        found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        texts = [text or "" for text in texts]
        for a, b in blocks(texts, BLOCK_CHARS):
            keys = self._keys(texts[a:b])
            coded = keys.flatten().dictionary_encode()
            different = coded.dictionary
            if self.lead and len(different):  # one string, cut again: faster than a string each
                different = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(different)], pa.int32()), different), " ")[0].as_py().split(" ")
            else:
                different = different.to_pylist()
            parts = [self._look_up(different[k:k + TOGETHER]) for k in range(0, len(different), TOGETHER)]
            which = coded.indices.to_numpy()
            if parts:
                ids, each = (np.concatenate(x) for x in zip(*parts))
                ids, each = _taken(ids, np.r_[0, np.cumsum(each)], which)
                found.append(ids)
            else:
                each = np.zeros(0, np.int64)
            total = np.r_[0, np.cumsum(each)]
            ends = np.cumsum(pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False))
            sizes.append(np.diff(total[np.r_[0, ends]]))
        ids, bounds = np.concatenate(found), np.r_[0, np.cumsum(np.concatenate(sizes))]
        if end:
            ids, bounds = np.insert(ids, bounds[1:], self.eos_id), bounds + np.arange(len(bounds))
        return ids, bounds

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        """Ids of one text."""
        return self.encode_many([text], end)[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model per Python worker and path."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, rows_per_batch: int = 1024) -> DataFrame:
    """(``doc_id``, ``ids`` array<int> with the end id, ``decoded`` string,
    ``agrees`` boolean: the library gave the same ids) for each row of ``docs``.

    Ids keep their type; the results leave in parts of ``rows_per_batch`` rows
    and ``BLOCK_CHARS`` characters (a longer text alone) at most, which bounds a
    worker's memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for rows in (batch.slice(lo, rows_per_batch) for batch in batches for lo in range(0, len(batch), rows_per_batch)):
            read = [t or "" for t in rows.column("text").to_pylist()]
            for lo, hi in blocks(read, BLOCK_CHARS):
                part, texts = rows.slice(lo, hi - lo), read[lo:hi]
                ids, bounds = m.encode_many(texts)
                own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                library = m.library.encode(texts, num_threads=1, return_type="numpy")
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(m.library.decode(own, num_threads=1), pa.string()),
                    pa.array([np.array_equal(a[:-1], b) for a, b in zip(own, library)], pa.bool_()),
                ], names=["doc_id", "ids", "decoded", "agrees"])

    doc_id = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_id}, ids array<int>, decoded string, agrees boolean"
    )


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens`` and lowercase-hex SHA-256 of the ids (decimal, one space
    between) and of the decoded text, computed by Spark from ``encode``."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.coalesce("decoded", F.lit("")), 256).alias("decoded_sha256"),
        "agrees",
    )


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
