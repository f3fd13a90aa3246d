"""The k-shingles of many texts at once as machine words in numpy, each in its canonical form.

A shingle is never a row of its own: its words are read from the text's bytes, or the reverse's, as they lie.
"""

from __future__ import annotations

import numpy as np

_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[list(b"ACGT")] = list(b"TGCA")
_BASE = np.zeros(256, bool)
_BASE[list(b"ACGT")] = True
#: Window starts taken at once: few enough for a processor's cache, enough to outweigh numpy's calls.
CHUNK = 1 << 15


class Chunk:
    """Bytes with their characters' starts; ``dna``: the other strand instead of the reverse. ``by_bytes``: every byte is a character."""

    def __init__(self, data: np.ndarray, by_bytes: bool, dna: bool):
        self.data, self.dna, n = data, dna, len(data)
        first = None if by_bytes else (data & 0xC0) != 0x80
        self.plain = by_bytes or bool(first.all())
        if self.plain:
            self.at = np.arange(n + 1)
            self.back = data[::-1]
        else:
            self.at = np.append(np.flatnonzero(first), n)
            character = np.cumsum(first) - 1
            self.back = np.empty_like(data)
            self.back[n - self.at[character + 1] + np.arange(n) - self.at[character]] = data
        if dna:
            self.back = _COMPLEMENT[self.back]
            self.other = np.append(0, np.cumsum(~_BASE[data]))

    def whole(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which shingles have no letters that are left out."""
        return self.other[end] == self.other[start] if self.dna else np.ones(len(start), bool)


class _Words:
    """Little-endian words at any byte of some data. Bytes beyond a shingle's length are cleared, and ``end`` stands after its last one."""

    def __init__(self, data: np.ndarray, dtype, end: int):
        self.size = np.dtype(dtype).itemsize
        self.at = np.ndarray((len(data) - self.size + 1,), np.dtype(dtype).newbyteorder("<"), data, strides=(1,)).astype(dtype)
        self.masks = np.array([0, *((1 << 8 * v) - 1 for v in range(self.size)), (1 << 8 * self.size) - 1], dtype)
        self.ends = np.array([0, *(end << 8 * v for v in range(self.size)), 0], dtype)

    def read(self, places: np.ndarray, rest, least: int) -> np.ndarray:
        """The words at ``places``, of shingles that have ``rest`` bytes more, ``least`` or more."""
        word = self.at[places]
        if least < self.size:
            over = np.minimum(np.maximum(rest, -1), self.size) + 1
            word &= self.masks[over]
            word |= self.ends[over]
        return word


def canonical(chunk: Chunk, k: int, which: np.ndarray | None, dtype, end: int = 0) -> list[np.ndarray]:
    """The words of the smaller of each shingle and its reverse (or other strand); of the shingles ``which``, or of all where None (plain chunks)."""
    n, size = len(chunk.data), np.dtype(dtype).itemsize
    if which is None:
        forth, lengths, lo, hi = np.arange(len(chunk.at) - k), k, k, k
        last = forth + k
    else:
        forth, last = chunk.at[which], chunk.at[which + k]
        lengths = last - forth
        lo, hi = int(lengths.min()), int(lengths.max())
    gap = np.zeros(hi + 2 * size, np.uint8)
    words = _Words(np.concatenate([chunk.data, gap, chunk.back, gap]), dtype, end)
    back = (2 * n + len(gap)) - last
    a, b = words.read(forth, lengths, lo).byteswap(), words.read(back, lengths, lo).byteswap()
    swap, same = b < a, np.flatnonzero(a == b)
    for at in range(size, hi, size):
        if not len(same):
            break
        rest = lengths - at if which is None else lengths[same] - at
        a, b = words.read(forth[same] + at, rest, lo - at).byteswap(), words.read(back[same] + at, rest, lo - at).byteswap()
        swap[same] = b < a
        same = same[a == b]
    places, found = np.where(swap, back, forth), []
    for at in range(0, hi + 1 if end else hi, size):
        found.append(words.read(places, lengths - at, lo - at))
        places += size
    return found


def cuts(data: np.ndarray, overlap: int, by_bytes: bool):
    """(first byte, end of the starts, end of the bytes) of the chunks of ``data``, cut between characters."""

    def whole(p: int) -> int:
        while not by_bytes and 0 < p < len(data) and data[p] & 0xC0 == 0x80:
            p -= 1
        return p

    at = 0
    while at < len(data):
        stop = min(len(data), at + CHUNK)
        stop = whole(stop) if whole(stop) > at else len(data)
        yield at, stop, whole(min(len(data), stop + overlap))
        at = stop
