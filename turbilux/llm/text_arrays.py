"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# bytes of text handled at once inside a task; a longer text forms a block of its own
BLOCK_BYTES = 4 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of the 256 byte values, true inside the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# separators: space and the ASCII controls tab to carriage return
WHITE_SPACE = byte_table((0x09, 0x0D), (0x20, 0x20))


def blocks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK_BYTES of text each."""
    sizes = np.diff(_offsets(batch.column(text)))
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > BLOCK_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins (one more entry at the end); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets = _offsets(column)
    data = column.buffers()[2] if len(column) else None
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _MULTIPLIER, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of a block: ``start`` and ``size`` in bytes, ``first[i]`` the number of words before text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE_SPACE):
        inside = ~separators[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        begins[heads] = inside[heads]
        self.data = data
        self.start = np.flatnonzero(begins)
        self.first = np.searchsorted(self.start, offsets)
        if len(self.start):
            self.size = np.add.reduceat(inside.astype(np.int32), self.start)
        else:
            self.size = np.zeros(0, np.int32)
        self._inside = inside

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first ``prefix`` bytes."""
        if not hasattr(self, "_terms"):
            self._terms, self._place = _terms(self.data, self.start, self._inside)
        if prefix is None or not len(self):
            return _summed(self._terms, self.start, self.size)
        terms = np.where(self._place < prefix, self._terms, np.uint64(0))
        return _summed(terms, self.start, np.minimum(self.size, prefix))


def _terms(data: np.ndarray, start: np.ndarray, inside: np.ndarray | None = None):
    """Each byte's term of its span's polynomial hash, and its place in the span."""
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(start, len(data)))
    place = np.arange(len(data))
    place[start[0] :] -= np.repeat(start, lengths)
    terms = data.astype(np.uint64) + np.uint64(1)
    if inside is not None:
        place[~inside] = 0
        terms[~inside] = 0
    terms *= _powers(int(place.max()) + 1)[place]
    return terms, place


def _summed(terms: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    return mix(np.add.reduceat(terms, start) ^ (size.astype(np.uint64) << np.uint64(40)))


def span_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of the adjoining spans that begin at ``start``; the last ends with the data."""
    return _summed(_terms(data, start)[0], start, np.diff(np.append(start, len(data))))


def spans_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each i, empty spans included."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def text_of(first: np.ndarray) -> np.ndarray:
    """Number of the text each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
