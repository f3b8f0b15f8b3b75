"""SHA-256 with states that can be kept, for many messages of whole 64-byte blocks at a time.

A digest as lowercase hex is exactly one block, so a node's hash after some
children is a state of 32 bytes with nothing buffered: it can be stored and
hashing taken up again from there.
"""

from __future__ import annotations

from math import isqrt

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found if p * p <= k):
            found.append(k)
        k += 1
    return found


def _cube_root(n: int) -> int:
    x = 1 << -(-n.bit_length() // 3)
    while True:
        y = (2 * x + n // (x * x)) // 3
        if y >= x:
            return x
        x = y


#: the first 32 bits of the fractional parts of the primes' cube and square roots
_K = [_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)]
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_HEX = np.array([[ord(c) for c in f"{b:02x}"] for b in range(256)], np.uint8)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """n x 32 bytes -> n x 64 bytes of lowercase hex."""
    return _HEX[digests].reshape(len(digests), 64)


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n x 8 words) after one more block each (n x 64 bytes, or 1 x 64 for all)."""
    first = np.ascontiguousarray(np.ascontiguousarray(blocks).view(">u4").astype(np.uint32).T)
    w = list(first)
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(x) for x in states.T)
    start = (a, b, c, d, e, f, g, h)
    for t in range(64):
        if t >= 16:
            x, y = w[t - 15], w[t - 2]
            w.append(w[t - 16] + w[t - 7] + (_rotated(x, 7) ^ _rotated(x, 18) ^ (x >> np.uint32(3)))
                     + (_rotated(y, 17) ^ _rotated(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + (g ^ (e & (f ^ g))) + np.uint32(_K[t]) + w[t]
        two = (_rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return np.stack([x + y for x, y in zip(start, (a, b, c, d, e, f, g, h))], axis=1)


def finished(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests (n x 32 bytes) of messages of ``blocks`` (n, or 1 for all) whole blocks, from their states after them."""
    pad = np.zeros((len(blocks), 64), np.uint8)
    pad[:, 0] = 0x80
    pad[:, 56:] = (blocks.astype(np.uint64) * np.uint64(512)).astype(">u8").view(np.uint8).reshape(len(blocks), 8)
    return to_bytes(absorb(states, pad))


def to_bytes(states: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(states.astype(">u4")).view(np.uint8).reshape(len(states), 32)


def from_bytes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw).view(">u4").astype(np.uint32).reshape(len(raw), 8)
