"""Compressed sets of document positions 0 to 65,535 inside a chunk.

Fewer than 4,096 members are kept as sorted unsigned 16-bit numbers, more as a bit per
position (8,192 bytes); the length tells the two apart.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

POSITIONS = 1 << 16
_DENSE = POSITIONS // 8


def pack(members: np.ndarray) -> bytes:
    """The set of sorted, distinct positions."""
    if 2 * len(members) < _DENSE:
        return members.astype("<u2").tobytes()
    bits = np.zeros(POSITIONS, np.uint8)
    bits[members] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def members(data: bytes) -> np.ndarray:
    if len(data) < _DENSE:
        return np.frombuffer(data, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def count(data: bytes) -> int:
    if len(data) < _DENSE:
        return len(data) // 2
    return int(np.bitwise_count(np.frombuffer(data, np.uint8)).sum())


def union(sets: Sequence[bytes]) -> bytes:
    if len(sets) == 1:
        return sets[0]
    if sum(map(len, sets)) < _DENSE:
        return pack(np.unique(np.concatenate([members(s) for s in sets])))
    bits = np.zeros(POSITIONS, np.uint8)
    for s in sets:
        bits[members(s)] = 1
    return pack(np.flatnonzero(bits))
