"""CRC-32 of many overlapping spans of a text at once, by table look-ups.

Without its constant start and end value, CRC-32 is linear: the CRC of a span is the XOR of what
each byte contributes at its distance from the span's end, and of a constant for the span's
length. A table holds the contribution of every byte at every distance.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

#: Distances in the table; longer spans are folded in blocks of this length.
REACH = 256


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Contributions by distance and byte, constants by length, and the four tables that move a
    CRC state by ``REACH`` zero bytes."""
    constants = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], dtype=np.uint32)
    at = np.empty((REACH, 256), dtype=np.uint32)
    # At the end of a span, a byte's contribution is its difference to a zero byte.
    at[0] = [zlib.crc32(bytes([b])) ^ int(constants[1]) for b in range(256)]
    for d in range(1, REACH):  # one more zero byte behind it
        at[d] = (at[d - 1] >> np.uint32(8)) ^ at[0][at[d - 1] & np.uint32(255)]

    def moved(state: int) -> int:
        for _ in range(REACH):
            state = (state >> 8) ^ int(at[0][state & 255])
        return state

    bits = [moved(1 << k) for k in range(32)]
    shift = [[0] * 256 for _ in range(4)]
    for lane in range(4):
        for b in range(1, 256):
            low = b & -b
            shift[lane][b] = shift[lane][b ^ low] ^ bits[8 * lane + low.bit_length() - 1]
    return at.ravel(), constants, shift


def _moved(state: int, shift: list[list[int]]) -> int:
    return (shift[0][state & 255] ^ shift[1][state >> 8 & 255]
            ^ shift[2][state >> 16 & 255] ^ shift[3][state >> 24])


@cache
def _zeros(length: int) -> int:
    return zlib.crc32(bytes(length))


def _long_span(data: np.ndarray) -> int:
    """CRC-32 of one span of more than ``REACH`` bytes: XOR within blocks counted from the end,
    then one move per block."""
    at, _, shift = _tables()
    first = len(data) % REACH or REACH
    behind = np.arange(len(data) - 1, -1, -1) % REACH
    starts = np.concatenate(([0], np.arange(first, len(data), REACH)))
    state = 0
    for block in np.bitwise_xor.reduceat(at[behind << 8 | data], starts).tolist():
        state = _moved(state, shift) ^ block
    return state ^ _zeros(len(data))


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of ``data[starts[i]:ends[i]]`` for all i; spans aren't empty and may overlap."""
    at, constants, _ = _tables()
    lengths = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    short = lengths <= REACH
    some = lengths[short]
    if len(some):
        upto = np.cumsum(some)
        step = np.int32 if max(int(upto[-1]), len(data)) < 1 << 31 else np.int64
        where = np.arange(upto[-1], dtype=step)
        behind = np.repeat((upto - 1).astype(step), some)
        behind -= where
        behind <<= 8
        where += np.repeat((starts[short] - upto + some).astype(step), some)
        behind |= data.take(where)
        out[short] = np.bitwise_xor.reduceat(at.take(behind), upto - some) ^ constants[some]
    for i in np.flatnonzero(~short):
        out[i] = _long_span(data[starts[i]:ends[i]])
    return out
