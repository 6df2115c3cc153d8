"""Vectorised 64-bit hashes of words and word windows, straight from Arrow string buffers.

A word's hash is a polynomial over its bytes modulo 2^64 with random byte values, taken
from prefix sums, so that a batch costs a handful of numpy passes; it does not depend on
where the word stands. Windows of words are hashed the same way over word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20                    # bytes hashed at once; longer texts are cut at white space

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            grown = []
            for b in (self.base, self.inverse):
                f = np.full(size, b, dtype=np.uint64)
                f[0] = 1
                grown.append(np.multiply.accumulate(f))
            self.up, self.down = grown
        return self.up[:n], self.down[:n]


_BYTES = _Powers(0x9E3779B97F4A7C15)
_WORDS = {0: _Powers(0xC2B2AE3D27D4EB4F), 1: _Powers(0xD6E8FEB86659FD93)}


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bit mixer (the finaliser of splitmix64)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its texts (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def _hash_chunk(data: np.ndarray, off: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts data[off[i]:off[i+1]] and how many words each has."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(off) - 1, np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _BYTES(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(np.uint64)), np.diff(np.searchsorted(starts, off))


def _pieces(data: np.ndarray):
    """A long text cut at white space into pieces of about CHUNK bytes."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + CHUNK)
        while end < n:
            gaps = np.flatnonzero(_SPACE[data[end:end + CHUNK]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(n, end + CHUNK)
        yield data[at:end]
        at = end


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch of texts, and the offsets of each text's words."""
    data, off = buffers(texts)
    values = _VALUES[_LOWER] if lower else _VALUES
    hashes, counts, i, n = [], [], 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + CHUNK, side="right")) - 1
        if j <= i:     # one long text
            got = [_hash_chunk(p, np.array([0, len(p)]), values)[0] for p in _pieces(data[off[i]:off[i + 1]])]
            hashes += got
            counts.append(np.array([sum(map(len, got))]))
            i += 1
        else:
            h, c = _hash_chunk(data[off[i]:off[j]], off[i:j + 1] - off[i], values)
            hashes.append(h)
            counts.append(c)
            i = j
    ends = np.cumsum(np.concatenate([[0], *counts]).astype(np.int64))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), ends


def window_hashes(words: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """Hash of every window of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORDS[family](len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mixed((total[width:] - total[:n]) * down[:n], family)
