"""Arrow batches of sorted rows as whole groups, and binary columns as flat arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of sorted rows that hold every group whole, with where its groups begin, and the end."""

    def begins(table: pa.Table) -> np.ndarray:
        change = np.zeros(len(table), dtype=bool)
        change[:1] = True
        for key in keys:
            values = table.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(change)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            first = begins(table)
            if len(first) > 1:
                yield table.slice(0, first[-1]), first
                held = table.slice(first[-1]).to_batches()
    if held and sum(map(len, held)):
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(begins(table), len(table))


def binary_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]
