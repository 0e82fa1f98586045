"""SHA-256 over many lanes at once in numpy, with its chaining states as plain data.

A hex digest is 64 bytes, one block of SHA-256. So the state of a parent's hash before one of its
children is eight words that nothing is buffered beside: it can be stored, copied and resumed anywhere.
"""

from __future__ import annotations

import math

import numpy as np

LANES = 4096  # lanes that are worked on together, so that a round's arrays stay in the cache


def _root(value: int, power: int) -> int:
    guess = 1 << -(-value.bit_length() // power)
    while True:
        closer = ((power - 1) * guess + value // guess ** (power - 1)) // power
        if closer >= guess:
            return guess
        guess = closer


_PRIMES = [p for p in range(2, 312) if all(p % d for d in range(2, math.isqrt(p) + 1))]
#: The first 32 bits behind the point of the square and cube roots of the first primes, as the standard has them.
START = np.array([_root(p << 64, 2) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)
_ROUNDS = [np.uint32(_root(p << 96, 3) & 0xFFFFFFFF) for p in _PRIMES]
_HEX = np.array([[ord(c) for c in f"{i:02x}"] for i in range(256)], np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _rounds(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = [np.ascontiguousarray(x) for x in block.T]
    a, b, c, d, e, f, g, h = start = [np.ascontiguousarray(x) for x in state.T]
    for t in range(64):
        if t >= 16:
            x, y = w[(t - 15) % 16], w[(t - 2) % 16]
            w[t % 16] = w[t % 16] + w[(t - 7) % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + (
                _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
            )
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUNDS[t] + w[t % 16]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return np.stack([x + y for x, y in zip(start, (a, b, c, d, e, f, g, h))], axis=1)


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States ``(n, 8)`` after one block of 16 words each, ``(n, 16)``."""
    out = np.empty_like(states)
    for at in range(0, len(states), LANES):
        out[at : at + LANES] = _rounds(states[at : at + LANES], blocks[at : at + LANES])
    return out


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests ``(n, 32)`` of states that took whole ``blocks`` so far, one number for each lane."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = (bits >> np.uint64(32)).astype(np.uint32), (bits & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return to_bytes(absorb(states, last))


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The block ``(n, 16)`` that the hex texts of digests ``(n, 32)`` make."""
    return np.ascontiguousarray(_HEX[digests]).reshape(len(digests), 64).view(">u4").astype(np.uint32)


def to_bytes(states: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(states.astype(">u4")).view(np.uint8).reshape(len(states), 32)


def to_states(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data).view(">u4").astype(np.uint32)
