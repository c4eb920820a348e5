"""Words of whole texts as numpy arrays, for use inside tasks.

Texts arrive as Arrow string columns. Their UTF-8 bytes are looked at in place, one block of rows
at a time, so memory follows the block and the longest single text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text looked at together. A longer text makes a block of its own.
BLOCK = 1 << 21
#: Bytes hashed together, small enough for a processor's cache.
SLICE = 1 << 17

_CODES = np.arange(256)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
#: Bytes of a word: digits, letters of either case, everything beyond ASCII.
LETTERS = (_CODES >= 128) | ((_CODES >= 48) & (_CODES <= 57)) | ((LOWER >= 97) & (LOWER <= 122))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = seeded(1, 256)
_tables = [powers(_BASE, SLICE + 1), powers(_INVERSE, SLICE + 1)]


def _powers(n: int) -> list[np.ndarray]:
    if n <= len(_tables[0]):
        return _tables
    return [powers(_BASE, n), powers(_INVERSE, n)]


@dataclass
class Words:
    """Words of a block of texts: byte ranges, and the number of the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, fold: np.ndarray = LOWER) -> np.ndarray:
        """A 64-bit hash of each word, with A-Z as a-z unless another table of bytes is given."""
        n = len(self.starts)
        out = np.empty(n, dtype=np.uint64)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + SLICE, "right")))
            a, z = int(self.starts[i]), int(self.ends[j - 1])
            power, inverse = _powers(z - a + 1)
            sums = np.zeros(z - a + 1, dtype=np.uint64)
            np.cumsum(_BYTE[fold[self.data[a:z]]] * power[: z - a], out=sums[1:])
            s, e = self.starts[i:j] - a, self.ends[i:j] - a
            out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
            i = j
        return out


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def split(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = LETTERS) -> Words:
    """Longest runs of word bytes; none crosses the border of two texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    inside = letters[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive entries; runs over the border of texts are included."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i, factor in enumerate(seeded(2, size) | np.uint64(1)):
        out += hashes[i : i + n] * factor
    return mix(out)


def sequence_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of the whole word sequence of each text (0 for a text without words)."""
    counts = np.diff(first)
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        place = np.arange(len(hashes)) - np.repeat(first[:-1], counts)
        terms = hashes * mix(place.astype(np.uint64) * np.uint64(_BASE) + np.uint64(7)) if len(hashes) else hashes
        out[full] = mix(np.add.reduceat(mix(terms), first[:-1][full]) + counts[full].astype(np.uint64))
    return out


def concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
