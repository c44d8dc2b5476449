"""Vectorised 64-bit hashes of the words and windows of many texts at once.

Numpy helpers used inside Spark tasks. Texts are handled in blocks of a few
hundred kB (a longer text is a block of its own), so memory follows the
longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20_240_101).integers(0, 1 << 64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, direction: str) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**64."""
    if len(_powers[direction]) < n:
        steps = np.full(1 << n.bit_length(), _BASE if direction == "up" else _BACK, np.uint64)
        steps[0] = 1
        _powers[direction] = np.cumprod(steps, dtype=np.uint64)
    return _powers[direction][:n]


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte codes times base powers; see ``slice_hash``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data), "up"), out=sums[1:])
    return sums


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]: equal bytes give equal hashes, wherever they lie."""
    return mixed((sums[end] - sums[start]) * powers(len(sums), "down")[start] + (end - start).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and each text's bounds in them."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    bounds = np.searchsorted(starts, np.cumsum([1, *[len(t) + 1 for t in texts]]))
    return slice_hash(rolling(data), starts, ends), bounds


def window_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows inside each text, and the text of each.

    A text of fewer than n words, but one at least, is one window.
    """
    count = np.diff(bounds)
    text = np.repeat(np.arange(len(count)), count)
    if len(words) >= n:
        total = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            total = mixed(total + words[k:len(words) - n + 1 + k] * _BASE)
        inside = text[: len(total)] == text[n - 1:]
        hashes, owner = total[inside], text[: len(total)][inside]
    else:
        hashes, owner = np.zeros(0, np.uint64), np.zeros(0, int)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = []
        for i in short:
            total = np.array([count[i]], np.uint64)
            for k in range(bounds[i], bounds[i + 1]):
                total = mixed(total + words[k:k + 1] * _BASE)
            whole.append(total[0])
        hashes, owner = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner


def blocks(texts: list[bytes] | list[str], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes (characters of strings) together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
