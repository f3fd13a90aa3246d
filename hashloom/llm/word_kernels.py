"""Vectorised word kernels over the UTF-8 bytes of many texts at once.

Words are runs of bytes other than ASCII white space (0x20, 0x09 to 0x0D).
Every function takes a byte array and the texts' starts in it with the end
appended, so no string object is made per word.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
GRAM_CODES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | U(1)
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose prefix sums are in memory at once.
BLOCK = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((BASE, BASE_INVERSE)):
            a = np.full(size, base, U)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a text's start ends a run."""
    cuts = starts[:-1]
    cuts = cuts[cuts < len(inside)]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def owner(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text that each byte position lies in."""
    return np.searchsorted(starts[:-1], at, "right") - 1


def span_hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [s, e), both ascending; equal bytes give equal hashes wherever they lie.

    Sums over prefixes are taken a block of bytes at a time, so a very long text needs eight bytes a span, not a byte.
    """
    p, inverse = powers(BLOCK)
    at_s, at_e = np.empty(len(s), U), np.empty(len(e), U)
    carry, scale = U(0), U(1)
    with np.errstate(over="ignore"):
        for x in range(0, max(len(b), 1), BLOCK):
            y = min(len(b), x + BLOCK)
            total = np.empty(y - x + 1, U)
            total[0] = 0
            np.cumsum(BYTE_CODES[b[x:y]] * p[: y - x], out=total[1:])
            total = total * scale + carry
            for at, out in ((s, at_s), (e, at_e)):
                i, j = np.searchsorted(at, x, "left"), np.searchsorted(at, y, "left" if y < len(b) else "right")
                out[i:j] = total[at[i:j] - x]
            carry, scale = total[-1], scale * p[-1] * BASE
        blocks = np.multiply.accumulate(np.concatenate([[U(1)], np.full(len(b) // BLOCK + 1, inverse[-1] * BASE_INVERSE, U)]))
        return mix((at_e - at_s) * inverse[s % BLOCK] * blocks[s // BLOCK])


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n values in a row, wherever texts end."""
    if len(h) < n:
        return np.zeros(0, U)
    out = np.zeros(len(h) - n + 1, U)
    for j in range(n):
        out += h[j : len(h) - n + 1 + j] * GRAM_CODES[j]
    return mix(out)


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return np.where((b >= 0x41) & (b <= 0x5A), b | 0x20, b)
