"""Vectorised tokenising and hashing of Arrow string columns, whole texts, without a loop over rows.

A column is handled in slices of about a megabyte so that the work arrays stay small; a
longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_Q = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_Q_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: Words of the license and decontamination operators: digits, letters and all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = ALNUM[ord("a") : ord("z") + 1] = ALNUM[ord("A") : ord("Z") + 1] = ALNUM[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` whose ``column`` holds about ``limit`` bytes each."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.cumsum(np.asarray(sizes, dtype=np.int64))
    at = 0
    while at < n:
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) UTF-8 bytes of a string column end to end, and n+1 offsets; null counts as empty."""
    if array.null_count:
        array = pc.fill_null(array, "")
    wide = pa.types.is_large_string(array.type)
    n = len(array)
    _, offsets, data = array.buffers()
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, kind, count=n + 1, offset=array.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]]
    return LOWER[raw], offs - offs[0]


def word_bounds(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray = ALNUM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and n+1 positions of each text's first word in them."""
    inside = is_word[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offs[:-1] < offs[1:]
    first[offs[:-1][full]] = inside[offs[:-1][full]]
    last[offs[1:][full] - 1] = inside[offs[1:][full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_Q, _Q_INV):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        if size > 4 * SLICE_BYTES:  # made for one very long text: not kept
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


class SpanHasher:
    """Hashes of byte spans of one buffer, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, buf: np.ndarray):
        up, self._down = _power_tables(len(buf) + 1)
        self._sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within one text, and the index of each run's first word."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words[: n - k + 1].copy()
    for i in range(1, k):
        h = mix(h * np.uint64(0x100000001B3) + words[i : n - k + 1 + i])
    whole = np.ones(n - k + 1, bool)
    for i in range(1, k):  # a run must not reach into the next text
        cut = firsts[1:-1] - i
        whole[cut[(cut >= 0) & (cut < len(whole))]] = False
    at = np.flatnonzero(whole)
    return h[at], at


def words_of(text: str) -> list[str]:
    """The same words of one text as a plain list, for templates and tests."""
    buf, offs = column_bytes(pa.array([text or ""], pa.string()))
    starts, ends, _ = word_bounds(buf, offs)
    raw = buf.tobytes()
    return [raw[a:b].decode() for a, b in zip(starts, ends)]


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes equal to those of the same words inside a text."""
    if not words:
        return np.zeros(0, np.uint64)
    buf, offs = column_bytes(pa.array(words, pa.string()))
    return SpanHasher(buf)(offs[:-1], offs[1:])
