"""Words of whole texts as arrays: spans and 64-bit hashes for a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n, modulo 2^64."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (BASE, INVERSE):
            p = np.full(size + 1, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[size] = tuple(out)
    return _POWERS[size]


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s with s[i] over the first i bytes; bytes i to j hash to (s[j] - s[i]) * inverse[i]."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


class Table(NamedTuple):
    """Bytes as words have them, A-Z lower-cased, and which of them separate words."""

    lower: np.ndarray
    separates: np.ndarray


def lower_table(separators: bytes) -> Table:
    table, separates = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
    table[65:91] += 32
    separates[list(separators)] = True
    return Table(table, separates)


SPACES = lower_table(b"\x20\t\n\x0b\x0c\r")
PLAIN = lower_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each value starts; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(starts: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes, so that the arrays of a step stay small; a longer text is a range of its own."""
    begin, n = 0, len(starts) - 1
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + most, "right")) - 1)
        yield begin, end
        begin = end


class Words:
    """Words of some texts in order: `row` and `start`, `end` (bytes within the joined texts) and `hash`."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, table: Table):
        n, self.text_start = len(starts) - 1, starts
        inside = ~table.separates[data]
        first = np.zeros(len(data) + 1, bool)  # a word never crosses texts
        first[starts[:-1]] = True
        before = np.r_[False, inside[:-1]] if len(data) else inside
        begins = inside & (~before | first[:-1])
        after = np.r_[inside[1:], False] if len(data) else inside
        ends = inside & (~after | first[1:])
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(starts, self.start, "right") - 1
        sums, down = prefix_hashes(table.lower[data])
        self.hash = mixed((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        self.counts = np.bincount(self.row, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; only valid where the row has that many."""
        out = np.full(max(0, len(self.hash) - n + 1), 0x51_7C_C1_B7_27_22_0A_95, np.uint64)
        for i in range(n):
            out = mixed(out * BASE + self.hash[i : i + len(out)])
        return out

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each word on lie in one row."""
        last = len(self.hash) - n + 1
        return self.row[:last] == self.row[n - 1 :] if last > 0 else np.zeros(0, bool)
