"""SentencePiece encoding against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import sentencepiece

from gearyard.llm import piece_codec
from tests.llm.corpus import docs, empty, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a ", "A  b\t\tc  ", "x\x00y", "日本語 テキスト", "😀😀 a  ", "▁ ▁▁x", "  lead", "trail  ", "<s> </s> <unk>", "a" * 5000]


def test_agenda_equals_library_in_python():
    m = piece_codec.model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in [*(x for x in texts() if x is not None), *ODD]:
        assert m.encode(t) == library.encode(t) + [2], repr(t[:40])


def _lists(ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_short_chunks_are_merged_together(monkeypatch):
    """Thousands of different words take a few rounds for all, not a heap each; equal to the heap and the library."""
    m = piece_codec.PieceModel(PATH)
    rng = random.Random(3)
    letters = "etaoinshrdlu" * 6 + "cmfwypvbgkjqxz" + "éß日😀1.,'-\t\n"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 15))) for _ in range(5_000)] + ["a" * 31, "ab" * 40]
    heaps, merge = [], m.merge
    monkeypatch.setattr(m, "merge", lambda chunk: heaps.append(chunk) or merge(chunk))
    given = [" ".join(words[k::7]) for k in range(7)]
    got = _lists(*m.encode_many(given))
    assert heaps == [chunk for chunk in heaps if len(chunk) > piece_codec.SHORT] and len(heaps) == 1
    assert got == [ids + [2] for ids in m.library.encode(given)]
    chunks = sorted(chunk for chunk in m.cache.place if len(chunk) <= piece_codec.SHORT)
    syms, owner = m.merge_many(chunks)
    assert [syms[owner == k].clip(-1).tolist() for k in range(0, len(chunks), 9)] == [merge(chunk) for chunk in chunks[::9]]


def test_lookups_in_small_parts_and_full_caches(monkeypatch):
    monkeypatch.setattr(piece_codec, "TOGETHER", 5)
    monkeypatch.setattr(piece_codec, "CACHE_ENTRIES", 8)
    m = piece_codec.PieceModel(PATH)
    given = [*(x for x in texts() if x is not None and len(x) < 5_000), *ODD, ""]
    assert _lists(*m.encode_many(given, end=False)) == m.library.encode(given)
    assert _lists(*m.encode_many([*given, None, ""])) == [x + [2] for x in m.library.encode([*given, "", ""])]
    for t in [*given, "a b", "a b ", "a ", "x  y z", "a▁b c"]:
        assert m.cut(t) == m.chunks.findall(m.normalise(t))
    assert len(m.cache.place) < 8 + 10 and len(m.older.place) < 8 + 10
    assert _lists(*m.encode_many([])) == [] and m.encode(None) == [2] and m.encode("", end=False) == []


def test_a_block_looks_each_different_chunk_up_once(monkeypatch):
    """Words repeat over the texts of a block: they are counted as one lookup, odd spaces or not."""
    m = piece_codec.PieceModel(PATH)
    asked, at = [], piece_codec._Chunks.at
    monkeypatch.setattr(piece_codec._Chunks, "at", lambda self, chunks: asked.extend(chunks) or at(self, chunks))
    given = [" ".join(f"word{(k * j) % 50}{' ' * (j % 9 == k)}" for j in range(200)) for k in range(100)] + [None, "", " word1"]
    assert _lists(*m.encode_many(given, end=False)) == m.library.encode([t or "" for t in given])
    # each is asked for once in either half of the cache, not 20,000 times
    assert len(asked) <= 2 * len(set(asked)) < 200


def test_encode_on_spark_with_digests(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    given = [*texts(), *ODD]
    got = piece_codec.digests(piece_codec.encode(docs(spark, given), PATH)).collect()
    assert len(got) == len(given) + 2
    by_id = {r.doc_id: r for r in got}
    for k, t in enumerate(given):
        ids = library.encode(t or "") + [2]
        r = by_id[k]
        assert r.agrees and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert by_id[0].n_tokens == 1  # NULL: only the end id
    assert piece_codec.encode(empty(spark), PATH).count() == 0
