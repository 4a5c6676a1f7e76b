"""Whole groups of sorted rows from Arrow batches, and unions within them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, least: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups of rows that agree in the first ``keys`` columns; rows come by them."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < least:
            continue
        whole = pa.concat_batches(held)
        same = np.ones(rows, bool)
        for c in range(keys):
            same &= np.asarray(whole.column(c)) == b.column(c)[b.num_rows - 1].as_py()
        cut = int(np.argmax(same))
        if cut:
            yield whole.slice(0, cut)
        held, rows = [whole.slice(cut)], rows - cut
    if rows:
        yield pa.concat_batches(held)


def group_starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in range(keys):
        values = np.asarray(batch.column(c))
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def roots(joined: np.ndarray) -> np.ndarray:
    """Each position's root; ``joined`` points at smaller positions and is shortened."""
    while True:
        up = joined[joined]
        if (up == joined).all():
            return joined
        joined[:] = up


def unite(joined: np.ndarray, r: np.ndarray, c: np.ndarray) -> None:
    """Put the ends of each link under one root."""
    while len(r):
        top = roots(joined)
        a, b = top[r], top[c]
        apart = a != b
        r, c = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
        if len(r):
            np.minimum.at(joined, r, c)
