"""Simple-8b: integers packed into 64-bit words, four bits of which select how many of how many bits follow.

A stream is cut into blocks of ``BLOCK`` integers, each beginning a new word, and ``offsets`` holds the first word
of every block.  So blocks are packed side by side, and any block can be decoded on its own or all of them at once,
one gather for each selector.  Integers of 60 bits and more are escaped: packed as 0, and listed by position.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 1024
#: Selector: (integers in a word, bits of each).  Fixed by the scheme; 0 and 1 are runs of zeros.
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
_COUNTS = np.array([n for n, _ in SELECTORS])
_LIMIT = 1 << 60


class Packed(NamedTuple):
    count: int
    words: np.ndarray  # uint64
    offsets: np.ndarray  # int64: first word of each block, and their number
    escaped_at: np.ndarray  # int64
    escaped: np.ndarray  # uint64


_BITS_BELOW = 1 << 16
_FEW_BITS = np.array([x.bit_length() for x in range(_BITS_BELOW)], dtype=np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths, as bytes."""
    if not len(values) or values.max() < _BITS_BELOW:
        return _FEW_BITS[values]
    out = np.zeros(len(values), dtype=np.uint8)
    for shift in (32, 16, 8, 4, 2, 1):
        high = values >= np.uint64(1) << np.uint64(shift)
        out += high * np.uint8(shift)
        values = np.where(high, values >> np.uint64(shift), values)
    return out + values.astype(np.uint8)


def _widest(bits: np.ndarray) -> dict[int, np.ndarray]:
    """For every count of a selector, the bits that the integers from each position on need together."""
    known, out = {1: bits}, {}
    for count in sorted({n for n, _ in SELECTORS}):
        half = max(x for x in known if x <= count)
        while half < count:  # two overlapping runs cover a longer one
            step = min(half, count - half)
            run = known[half]
            joined = run.copy()
            np.maximum(run[:-step], run[step:], out=joined[:-step])
            half += step
            known[half] = joined
        out[count] = known[count]
    return out


def pack(values: np.ndarray, block: int = BLOCK) -> Packed:
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    escaped_at = np.flatnonzero(values >= _LIMIT)
    escaped = values[escaped_at]
    if len(escaped_at):
        values = values.copy()
        values[escaped_at] = 0
    if not n:
        return Packed(0, np.empty(0, np.uint64), np.zeros(1, np.int64), escaped_at, escaped)
    left = np.tile(np.arange(block, 0, -1, dtype=np.uint16), -(-n // block))[:n]
    left[n - 1 - (n - 1) % block :] -= np.uint16(left[n - 1] - 1)  # a word never reaches into the next block
    selector = np.full(n, 15, dtype=np.uint8)
    widest = _widest(_bits(values))
    for s in range(14, -1, -1):
        count, bits = SELECTORS[s]
        np.copyto(selector, np.uint8(s), where=(widest[count] <= bits) & (left >= count))
    # Words follow one another within a block; all blocks are walked in step.
    lanes = np.arange(0, n, block)
    ends = np.minimum(lanes + block, n)
    lane, here = np.arange(len(lanes)), lanes.copy()
    starts, owners = [], []
    while len(here):
        starts.append(here)
        owners.append(lane)
        here = here + _COUNTS[selector[here]]
        going = here < ends[lane]
        here, lane = here[going], lane[going]
    first = np.sort(np.concatenate(starts))
    per_block = np.bincount(np.concatenate(owners), minlength=len(lanes))
    offsets = np.concatenate([[0], np.cumsum(per_block)])
    chosen = selector[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(SELECTORS):
        which = np.flatnonzero(chosen == s)
        if bits and len(which):
            places = first[which]
            packed = values[places]
            for j in range(1, count):
                packed |= values[places + j] << np.uint64(j * bits)
            words[which] |= packed
    return Packed(n, words, offsets, escaped_at, escaped)


def _spread(words: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(_COUNTS[selector])])
    out = np.zeros(begin[-1], dtype=np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        which = np.flatnonzero(selector == s)
        if bits and len(which):
            mask = np.uint64((1 << bits) - 1)
            found, places = words[which], begin[which]
            for j in range(count):
                out[places + j] = (found >> np.uint64(j * bits)) & mask
    return out


def unpack(packed: Packed) -> np.ndarray:
    out = _spread(packed.words)
    out[packed.escaped_at] = packed.escaped
    return out


def unpack_block(packed: Packed, number: int, block: int = BLOCK) -> np.ndarray:
    """One block, without reading the others."""
    out = _spread(packed.words[packed.offsets[number] : packed.offsets[number + 1]])
    lo, hi = np.searchsorted(packed.escaped_at, [number * block, (number + 1) * block])
    out[packed.escaped_at[lo:hi] - number * block] = packed.escaped[lo:hi]
    return out
