"""Patched frame-of-reference blocks: a compact form of a long row of unsigned 32-bit ids.

A block holds ``BLOCK`` ids. Its minimum is subtracted from each; the block's width is the
number of bits that the ``PERCENTILE`` of its differences needs. The low bits of all
differences are packed at that width, 32 differences to ``width`` 32-bit words. A difference
that needs more bits is an exception: its place in the block and its high bits follow in a
list of their own. The last block is filled up with its last id; the number of ids says where
it ends.

    block      u32 minimum, u8 width, u8 0, u16 exceptions, u32 words [4 * width],
               u8 places [exceptions], u32 high bits [exceptions]

All numbers are little-endian. Where blocks start is not part of them; a file keeps a list.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
PERCENTILE = 90
_HEAD = 8
_LANES = BLOCK // 32
_RANK = -(-PERCENTILE * BLOCK // 100) - 1  # the place of the percentile among sorted widths


def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _packed(low: np.ndarray, width: int) -> np.ndarray:
    """Words of blocks of one width: [blocks, BLOCK] to [blocks, 4 * width]."""
    lanes = np.ascontiguousarray(low.reshape(-1, 32).T)
    words = np.zeros((width, lanes.shape[1]), np.uint32)
    for j in range(32):
        word, shift = divmod(j * width, 32)
        words[word] |= lanes[j] << np.uint32(shift)
        if shift + width > 32:
            words[word + 1] |= lanes[j] >> np.uint32(32 - shift)
    return np.ascontiguousarray(words.T).reshape(len(low), _LANES * width)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.reshape(-1, width).T)
    mask = np.uint32((1 << width) - 1)
    lanes = np.empty((32, columns.shape[1]), np.uint32)
    for j in range(32):
        word, shift = divmod(j * width, 32)
        value = columns[word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | (columns[word + 1] << np.uint32(32 - shift))
        lanes[j] = value & mask
    return np.ascontiguousarray(lanes.T).reshape(-1, BLOCK)


def _place(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Writes rows of equal length, as bytes, to where ``at`` says."""
    size = rows.nbytes // max(len(rows), 1)
    flat = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), size)
    out[at[:, None] + np.arange(size)] = flat


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each run of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def encode(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of ``ids`` and where each starts. Without ids there is no block."""
    if not len(ids):
        return b"", np.empty(0, np.int64)
    blocks = -(-len(ids) // BLOCK)
    values = np.full(blocks * BLOCK, ids[-1], np.uint32)
    values[:len(ids)] = ids
    values = values.reshape(blocks, BLOCK)
    least = values.min(axis=1)
    values = values - least[:, None]
    widths = np.partition(_bits(values), _RANK, axis=1)[:, _RANK].astype(np.uint32)
    high = np.where(widths[:, None] < 32, values >> np.minimum(widths, 31)[:, None], 0)
    odd_block, odd_place = np.nonzero(high)
    exceptions = np.bincount(odd_block, minlength=blocks)

    sizes = _HEAD + 4 * _LANES * widths.astype(np.int64) + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    head = np.zeros(blocks, [("least", "<u4"), ("width", "u1"), ("", "u1"), ("odd", "<u2")])
    head["least"], head["width"], head["odd"] = least, widths, exceptions
    _place(out, starts, head)
    for width in np.unique(widths):
        if width:
            own = np.flatnonzero(widths == width)
            low = values[own] & np.uint32((1 << int(width)) - 1)
            _place(out, starts[own] + _HEAD, _packed(low, int(width)))
    lists = starts + _HEAD + 4 * _LANES * widths.astype(np.int64)
    rank = _within(exceptions)
    out[lists[odd_block] + rank] = odd_place
    _place(out, (lists + exceptions)[odd_block] + 4 * rank,
           high[odd_block, odd_place].astype("<u4"))
    return out.tobytes(), starts


def decode(data: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of blocks that start at ``starts`` in ``data``."""
    raw, blocks = np.frombuffer(data, np.uint8), len(starts)
    if not blocks:
        return np.empty(0, np.uint32)
    head = raw[starts[:, None] + np.arange(_HEAD)].reshape(-1).view(
        [("least", "<u4"), ("width", "u1"), ("", "u1"), ("odd", "<u2")])
    widths, exceptions = head["width"], head["odd"].astype(np.int64)
    values = np.zeros((blocks, BLOCK), np.uint32)
    for width in np.unique(widths):
        if width:
            own = np.flatnonzero(widths == width)
            size = 4 * _LANES * int(width)
            words = raw[(starts[own] + _HEAD)[:, None] + np.arange(size)]
            values[own] = _unpacked(words.reshape(-1).view("<u4"), int(width))
    odd = np.repeat(np.arange(blocks), exceptions)
    rank = _within(exceptions)
    lists = starts + _HEAD + 4 * _LANES * widths.astype(np.int64)
    places = raw[lists[odd] + rank]
    high = raw[((lists + exceptions)[odd] + 4 * rank)[:, None] + np.arange(4)]
    high = high.reshape(-1).view("<u4").astype(np.uint32)
    values[odd, places] |= high << widths[odd].astype(np.uint32)
    values += head["least"].astype(np.uint32)[:, None]
    return values.reshape(-1)[:n]
