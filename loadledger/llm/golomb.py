"""Golomb codes of sorted distinct integers.

The gaps between neighbours are cut at a power of two: the remainders are
stored with a fixed number of bits, the quotients in unary, each kind in a
stream of its own, so that both directions run over whole arrays.
"""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<IBI")  # numbers, bits of a remainder, bytes of the quotients


def remainder_bits(gaps: np.ndarray) -> int:
    """Bits of the remainder for which gaps of this mean take the least room."""
    return round(math.log2(max(1.0, float(gaps.mean()) * math.log(2))))


def encode(values: np.ndarray) -> bytes:
    """Sorted distinct numbers from 0 below 2**63; none give an empty list's code."""
    if not len(values):
        return _HEAD.pack(0, 0, 0)
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    bits = remainder_bits(gaps)
    ends = np.cumsum((gaps >> bits) + 1) - 1  # a one ends each run of zeros
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = ((gaps[:, None] >> np.arange(bits)) & 1).astype(np.uint8)
    quotients = np.packbits(unary).tobytes()
    return _HEAD.pack(len(values), bits, len(quotients)) + quotients + np.packbits(rest).tobytes()


def decode(code: bytes) -> np.ndarray:
    """The numbers again, as 64-bit integers."""
    n, bits, size = _HEAD.unpack_from(code)
    if not n:
        return np.empty(0, np.int64)
    raw = np.frombuffer(code, np.uint8, offset=_HEAD.size)
    ends = np.flatnonzero(np.unpackbits(raw[:size]))[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    gaps = quotients << bits
    if bits:
        rest = np.unpackbits(raw[size:], count=n * bits).reshape(n, bits)
        gaps = gaps + (rest.astype(np.int64) << np.arange(bits)).sum(axis=1)
    return np.cumsum(gaps + 1) - 1
