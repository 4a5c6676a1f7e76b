"""Elias-Fano coding of non-decreasing integers, with sampled select."""

from __future__ import annotations

import struct

import numpy as np

#: Every how many ones the position in the high bits is kept.
SAMPLE = 512
_HEAD = struct.Struct("<QQBQQ")


def encode(values: np.ndarray) -> bytes:
    """A self-contained block: header, select samples, high bits in unary, packed low bits."""
    v = np.asarray(values, dtype=np.uint64)
    m = len(v)
    if not m:
        return _HEAD.pack(0, 0, 0, 0, 0)
    if m > 1 and (v[1:] < v[:-1]).any():
        raise ValueError("values must not decrease")
    top = int(v[-1]) + 1
    low = max(0, (top // m).bit_length() - 1)
    high = (v >> np.uint64(low)).astype(np.int64)
    ones = high + np.arange(m)
    bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    bits[ones] = 1
    high_bytes = np.packbits(bits, bitorder="little").tobytes()
    low_bytes = b""
    if low:
        digits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low_bytes = np.packbits(digits.ravel(), bitorder="little").tobytes()
    samples = ones[::SAMPLE].astype("<u4").tobytes()
    return _HEAD.pack(m, top, low, len(high_bytes), len(low_bytes)) + samples + high_bytes + low_bytes


class EliasFano:
    """Random access to an encoded block without unpacking it."""

    def __init__(self, data: bytes, at: int = 0):
        self.count, self.universe, self.low, n_high, n_low = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        n_samples = -(-self.count // SAMPLE)
        self._samples = np.frombuffer(data, "<u4", n_samples, at)
        at += 4 * n_samples
        self._high = np.frombuffer(data, np.uint8, n_high, at)
        at += n_high
        self._low = np.frombuffer(data, np.uint8, n_low, at)
        self.end = at + n_low

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        start, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte = start >> 3
        here = np.unpackbits(self._high[byte : byte + 1], bitorder="little")
        here[: start & 7] = 0
        while (ones := int(here.sum())) <= left:
            left -= ones
            byte += 1
            here = np.unpackbits(self._high[byte : byte + 1], bitorder="little")
        position = byte * 8 + int(np.flatnonzero(here)[left])
        value = (position - i) << self.low
        if self.low:
            first = i * self.low
            part = int.from_bytes(self._low[first >> 3 : (first + self.low + 7) >> 3].tobytes(), "little")
            value |= (part >> (first & 7)) & ((1 << self.low) - 1)
        return value

    def to_array(self) -> np.ndarray:
        if not self.count:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.count]
        out = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            digits = np.unpackbits(self._low, bitorder="little")[: self.count * self.low].reshape(self.count, self.low).astype(np.uint64)
            out |= (digits << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out
