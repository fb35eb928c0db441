"""SHA-256 over arrays of messages whose state can be kept, copied and stored at block borders.

A library hash object cannot leave its process; here a state is eight 32-bit
words, so a table can hold it.  All arrays are (words, messages) of uint32, and
one call advances every message by one 64-byte block.  A digest written as 64
hex digits fills exactly one block.
"""

from __future__ import annotations

import math

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(n: int) -> int:
    """Floor of the cube root of ``n``."""
    low, high = 0, 1 << -(-n.bit_length() // 3)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


MASK = 0xFFFFFFFF
#: First 32 fraction bits of the square roots of the first 8 primes and of the cube roots of the first 64.
START = np.array([math.isqrt(p << 64) & MASK for p in _primes(8)], np.uint32)
ROUND = [np.uint32(_cube_root(p << 96) & MASK) for p in _primes(64)]

_NIBBLES = np.frombuffer(b"0123456789abcdef", np.uint8).astype(np.uint32)
_HALVES = np.arange(1 << 16, dtype=np.uint32)
#: The four hex digits of a 16-bit number as one word.
HEX = _NIBBLES[_HALVES >> 12] << 24 | _NIBBLES[_HALVES >> 8 & 15] << 16 | _NIBBLES[_HALVES >> 4 & 15] << 8 | _NIBBLES[_HALVES & 15]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x >> np.uint32(n) | x << np.uint32(32 - n)


def start(n: int) -> np.ndarray:
    """The state before the first block of ``n`` messages."""
    return np.repeat(START[:, None], n, axis=1)


def advance(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block (16 words a message)."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + w[i - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ x >> np.uint32(3)) + (_turn(y, 17) ^ _turn(y, 19) ^ y >> np.uint32(10)))
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ e & (f ^ g)) + ROUND[i] + w[i]
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + (a & b | c & (a | b))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def digits(digest: np.ndarray) -> np.ndarray:
    """The block that holds a digest as 64 lower-case hex digits."""
    return np.stack([HEX[half] for word in digest for half in (word >> np.uint32(16), word & np.uint32(0xFFFF))])


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages of so many whole blocks."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    last[0] = 0x80000000
    bits = blocks.astype(np.uint64) << np.uint64(9)
    last[14], last[15] = (bits >> np.uint64(32)).astype(np.uint32), (bits & np.uint64(MASK)).astype(np.uint32)
    return advance(state, last)


def to_words(digests: list[bytes]) -> np.ndarray:
    """(8, n) words of ``n`` digests or states of 32 bytes."""
    return np.ascontiguousarray(np.frombuffer(b"".join(digests), ">u4").reshape(-1, 8).T.astype(np.uint32))


def to_bytes(words: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(words.T).astype(">u4").tobytes()
    size = 4 * words.shape[0]
    return [raw[i : i + size] for i in range(0, len(raw), size)]
