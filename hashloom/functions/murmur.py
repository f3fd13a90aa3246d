"""MurmurHash3 x64 128 in numpy: the low 64 bits for equal-length keys, many at a time.

The algorithm is public domain; vectors are in the tests.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
C1, C2 = U(0x87C37B91114253D5), U(0x4CF5AD432745937F)


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def _fmix(k: np.ndarray) -> np.ndarray:
    k = (k ^ (k >> U(33))) * U(0xFF51AFD7ED558CCD)
    k = (k ^ (k >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return k ^ (k >> U(33))


def murmur3_words(words: list[np.ndarray], length: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Both halves for keys of ``length`` bytes given as columns of little-endian 64-bit words, zeros after the last byte."""
    n, blocks, rest = len(words[0]) if words else 0, length // 16, length % 16
    h1, h2 = np.full(n, seed, U), np.full(n, seed, U)
    for i in range(blocks):
        h1 ^= _rotl(words[2 * i] * C1, 31) * C2
        h1 = (_rotl(h1, 27) + h2) * U(5) + U(0x52DCE729)
        h2 ^= _rotl(words[2 * i + 1] * C2, 33) * C1
        h2 = (_rotl(h2, 31) + h1) * U(5) + U(0x38495AB5)
    if rest > 8:
        h2 ^= _rotl(words[2 * blocks + 1] * C2, 33) * C1
    if rest:
        h1 ^= _rotl(words[2 * blocks] * C1, 31) * C2
    h1 ^= U(length)
    h2 ^= U(length)
    h1 = h1 + h2
    h2 = h2 + h1
    h1, h2 = _fmix(h1), _fmix(h2)
    h1 = h1 + h2
    return h1, h2 + h1


def murmur3_128(keys: np.ndarray, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Both halves for each row of an (n, length) uint8 array."""
    n, length = keys.shape
    padded = np.zeros((n, -(-length // 8) * 8 or 8), np.uint8)
    padded[:, :length] = keys
    words = padded.view("<u8").astype(U)
    return murmur3_words([np.ascontiguousarray(words[:, i]) for i in range(words.shape[1])], length, seed)
