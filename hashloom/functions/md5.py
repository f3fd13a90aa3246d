"""MD5 (RFC 1321) in numpy: the leading 60 bits of many digests at once, of messages that are given word by word."""

from __future__ import annotations

import math

import numpy as np

U = np.uint32
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
SINES = [int(abs(math.sin(i + 1)) * (1 << 32)) for i in range(64)]
SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
PLACES = ((1, 0), (5, 1), (3, 5), (7, 0))


def _block(state: list[np.ndarray], words: list) -> list[np.ndarray]:
    """The state after 16 words, each an array or one number for all messages."""
    a, b, c, d = (x.copy() for x in state)
    f = np.empty_like(a)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif turn == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        step, first = PLACES[turn]
        word = words[(step * i + first) % 16]
        if isinstance(word, np.ndarray):
            f += word
            f += U(SINES[i])
        else:
            f += U((SINES[i] + word) & 0xFFFFFFFF)
        n = SHIFTS[turn][i % 4]
        np.right_shift(f, U(32 - n), out=a)
        f <<= U(n)
        f |= a
        f += b
        a, b, c, d, f = d, f, b, c, a
    return [x + y for x, y in zip(state, (a, b, c, d), strict=True)]


def below(words: list, n: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(which, values) of ``n`` messages whose first 15 hexadecimal digits are a number under ``limit``.

    ``words``: the padded messages' 32-bit words, a multiple of 16, each an array or one number for all.
    """
    state = [np.full(n, x, U) for x in START]
    for at in range(0, len(words), 16):
        state = _block(state, words[at : at + 16])
    high = state[0].byteswap()
    which = np.flatnonzero(high <= U((limit - 1) >> 28))
    values = (high[which].astype(np.uint64) << np.uint64(28)) | (state[1][which].byteswap() >> U(4)).astype(np.uint64)
    kept = values < np.uint64(limit)
    return which[kept], values[kept]
