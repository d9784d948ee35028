"""SHA-256 of many messages at once, with states that can be kept and resumed.

A state is eight 32-bit words after a whole number of 64-byte blocks.  A digest in
hexadecimal fills exactly one block, so the state before each child of a tree node
is a state before a block.  ``hashlib`` can copy a running hash but not store it.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_WORD = 0xFFFFFFFF


def _primes(n: int) -> list[int]:
    out: list[int] = []
    k = 2
    while len(out) < n:
        if all(k % p for p in out):
            out.append(k)
        k += 1
    return out


def _cube_root(x: int) -> int:
    low, high = 0, x
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= x else (low, mid - 1)
    return low


# The constants are the leading 32 bits of the fractions of roots of primes.
_K = np.array([_cube_root(p << 96) & _WORD for p in _primes(64)], np.uint32)
START = np.array([isqrt(p << 64) & _WORD for p in _primes(8)], np.uint32)
_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) of big-endian words each."""
    w = [np.ascontiguousarray(block[:, i]) for i in range(16)]
    a, b, c, d, e, f, g, h = before = [np.ascontiguousarray(state[:, i]) for i in range(8)]
    for t in range(64):
        if t >= 16:
            x, y = w[t % 16 - 15], w[t % 16 - 2]
            w[t % 16] = (w[t % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[t % 16 - 7]
                         + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _K[t] + w[t % 16]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return np.stack([x + y for x, y in zip(before, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of messages that end after so many whole blocks."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0] = 0x80000000
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(_WORD)
    return to_bytes(compress(state, last))


def to_bytes(state: np.ndarray) -> np.ndarray:
    """States (n, 8) as bytes (n, 32)."""
    return np.ascontiguousarray(state.astype(">u4")).view(np.uint8).reshape(len(state), 32)


def to_state(data: np.ndarray) -> np.ndarray:
    """Bytes (n, 32) as states (n, 8)."""
    return np.ascontiguousarray(data).view(">u4").astype(np.uint32).reshape(len(data), 8)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as the block (n, 16) that their hexadecimal text fills."""
    return np.ascontiguousarray(_HEX[digests]).reshape(len(digests), 64).view(">u4").astype(np.uint32)
