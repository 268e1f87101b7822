"""Patched frame-of-reference coding of unsigned integers, in numpy.

Values are cut into blocks of ``BLOCK``. A block stores its minimum and the differences from it, packed at the smallest
width that holds a given percentile of them; what is wider goes to the block's exception list as position and value.
The start of every block is indexed, so any block is decoded without those before it.

A body, little endian:

    u32 values | u32 blocks | u32 start of each block, and of the end, from the end of this index
    per block: u32 minimum | u8 width | u8 exceptions | u32 x 4 x width packed | u8 position, ... | u32 difference, ...

Value 4 r + c of a block is the r-th of lane c; a lane's values follow each other bit by bit through its words, and word
w of the four lanes stand together.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
LANES = 4
ROWS = BLOCK // LANES
_HEAD = 6


def _bits(values: np.ndarray) -> np.ndarray:
    """Number of binary digits; 0 for 0."""
    return np.frexp(values.astype(np.float64))[1]


def pack(values: np.ndarray, percentile: float = 90.0) -> bytes:
    """The body for ``values`` (below 2**32); ``percentile`` is the share of differences that the packed width holds."""
    values = np.ascontiguousarray(values, np.uint32)
    count, blocks = len(values), -(-len(values) // BLOCK)
    if not count:
        return np.zeros(3, "<u4").tobytes()
    padded = np.concatenate([values, np.full(blocks * BLOCK - count, values[-1], np.uint32)]).reshape(blocks, BLOCK)
    low = padded.min(1)
    apart = padded - low[:, None]
    place = min(BLOCK - 1, max(0, int(np.ceil(BLOCK * percentile / 100.0)) - 1))
    width = _bits(np.partition(apart, place, axis=1)[:, place])
    wide = _bits(apart.max(1)) > width
    outlier = np.zeros(apart.shape, bool)
    outlier[wide] = apart[wide] >> width[wide, None].astype(np.uint32) != 0
    outliers = outlier.sum(1)
    sizes = _HEAD + 4 * LANES * width + 5 * outliers
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), np.uint8)

    def put(at: np.ndarray, rows: np.ndarray) -> None:
        out[at[:, None] + np.arange(rows.shape[1])] = rows

    head = np.empty((blocks, _HEAD), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    head[:, 4], head[:, 5] = width, outliers
    put(starts[:-1], head)
    lanes = np.where(outlier, 0, apart).astype(np.uint32).reshape(blocks, ROWS, LANES)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        words = np.zeros((len(own), w, LANES), "<u4")
        for r in range(ROWS):
            word, shift = divmod(r * w, 32)
            words[:, word] |= lanes[own, r] << np.uint32(shift)
            if shift + w > 32:
                words[:, word + 1] |= lanes[own, r] >> np.uint32(32 - shift)
        put(starts[own] + _HEAD, words.reshape(len(own), -1).view(np.uint8))
    block, position = np.nonzero(outlier)
    if len(block):
        nth = np.arange(len(block)) - np.concatenate([[0], np.cumsum(outliers)])[block]
        at = starts[block] + _HEAD + 4 * LANES * width[block]
        out[at + nth] = position
        put(at + outliers[block] + 4 * nth, apart[block, position].astype("<u4").view(np.uint8).reshape(-1, 4))
    index = np.concatenate([[count, blocks], starts]).astype("<u4")
    return index.tobytes() + out.tobytes()


def unpack(body: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Values ``first`` to ``last`` (exclusive; default all) of a body; only the blocks that hold them are read."""
    count, blocks = np.frombuffer(body, "<u4", 2).tolist()
    last = count if last is None else min(last, count)
    if first >= last:
        return np.zeros(0, np.uint32)
    a, b = first // BLOCK, -(-last // BLOCK)
    starts = np.frombuffer(body, "<u4", blocks + 1, 8).astype(np.int64)[a : b + 1]
    data = np.frombuffer(body, np.uint8, offset=4 * (blocks + 3))

    def get(at: np.ndarray, length: int) -> np.ndarray:
        return data[at[:, None] + np.arange(length)]

    head = get(starts[:-1], _HEAD)
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    width, outliers = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    apart = np.zeros((b - a, ROWS, LANES), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        words = get(starts[own] + _HEAD, 4 * LANES * w).view("<u4").reshape(len(own), w, LANES)
        part = np.empty((len(own), ROWS, LANES), np.uint32)
        for r in range(ROWS):
            word, shift = divmod(r * w, 32)
            part[:, r] = words[:, word] >> np.uint32(shift)
            if shift + w > 32:
                part[:, r] |= words[:, word + 1] << np.uint32(32 - shift)
        apart[own] = part & np.uint32((1 << w) - 1)
    apart = apart.reshape(b - a, BLOCK)
    block = np.repeat(np.arange(b - a), outliers)
    if len(block):
        nth = np.arange(len(block)) - np.concatenate([[0], np.cumsum(outliers)])[block]
        at = starts[block] + _HEAD + 4 * LANES * width[block]
        apart[block, data[at + nth]] = get(at + outliers[block] + 4 * nth, 4).view("<u4").ravel()
    return (apart + low[:, None]).ravel()[first - a * BLOCK : last - a * BLOCK]
