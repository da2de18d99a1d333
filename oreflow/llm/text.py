"""Text in Arrow batches as flat NumPy arrays: byte views, words, hashes of words and shingles.

A word is a run of ASCII letters and digits and of any non-ASCII characters, with A-Z in lower case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return data, at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text; a longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def per_slice(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text"
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``work`` on pieces of bounded size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column):
                yield work(piece)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Spans:
    """Hashes of any byte spans of one buffer: a running polynomial sum, differences taken at the ends."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, max(len(data) - 1, 0))[: len(data)], out=self.sums[1:])
        self.back = powers(_INVERSE, len(data))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of some texts: byte spans over one lower-cased buffer, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _LOWER[data]
        inside = _WORD[self.data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return Spans(self.data).hashes(self.starts, self.ends)

    def strings(self, text: int) -> list[str]:
        lo, hi = self.first[text], self.first[text + 1]
        data = self.data.tobytes() if lo < hi else b""
        return [data[a:b].decode() for a, b in zip(self.starts[lo:hi], self.ends[lo:hi], strict=True)]


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's runs of ``size`` words and where each text's begin; fewer words make one run."""
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], n)
    last = np.repeat(first[1:], n)
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        out *= _BASE
        out += np.where(at + i < last, padded[at + i], np.uint64(0))
    return mix(out), begin
