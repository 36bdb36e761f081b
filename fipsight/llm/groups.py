"""Sorted rows in Arrow batches: whole groups at a time, and the best rows of each group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], key: int = 0, cells: int = 200_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Yield (rows, group starts) such that no group of equal keys (column ``key``) is cut; the rows
    arrive sorted by key. A yield holds about ``cells`` rows or one larger group."""
    held: list[pa.RecordBatch] = []
    size = 0

    def give(final: bool):
        nonlocal held, size
        table = pa.Table.from_batches(held).combine_chunks()
        k = table.column(key).to_numpy()
        start = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
        end = len(k) if final else int(start[-1])
        held, size = ([] if final else table.slice(end).to_batches()), len(k) - end
        if end:
            yield table.slice(0, end), (start if final else start[:-1])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
            if size >= cells:
                yield from give(False)
    if held:
        yield from give(True)


def first_of_groups(start: np.ndarray, n: int, most: int) -> np.ndarray:
    """True for the first ``most`` rows of each group."""
    size = np.diff(np.append(start, n))
    return np.arange(n) - np.repeat(start, size) < most
