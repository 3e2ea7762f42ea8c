"""Vectorised words of whole texts, for use inside Arrow tasks.

A word is a maximal run of bytes other than the six ASCII white-space bytes, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+``. Texts of a batch lie in one byte buffer, so splitting and hashing are a few numpy passes
over it. Word hashes are multilinear with random 64-bit multipliers, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
BLOCK_BYTES = 4_000_000

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_multipliers = np.zeros(0, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (two multiply-and-shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def multipliers(n: int) -> np.ndarray:
    """The first ``n`` of a fixed endless row of random odd 64-bit numbers."""
    global _multipliers
    if len(_multipliers) < n:
        size = max(1024, 2 * n)
        _multipliers = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    return _multipliers[:n]


def lookup(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``table[data]`` for bytes, in blocks, as numpy widens an index to eight bytes."""
    found = np.empty(len(data), dtype=table.dtype)
    for low in range(0, len(data), BLOCK_BYTES):
        found[low : low + BLOCK_BYTES] = table[data[low : low + BLOCK_BYTES]]
    return found


@dataclass
class Words:
    """Words of a batch of texts: byte positions in ``data``, and ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` folds A-Z first. Words are taken in blocks of bytes, a word never parted."""
        found = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(found):
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + BLOCK_BYTES, side="right")))
            found[at:to] = self._hashes(at, to, lower)
            at = to
        return found

    def _hashes(self, at: int, to: int, lower: bool) -> np.ndarray:
        start, end = self.start[at:to], self.end[at:to]
        length = end - start
        low, high = int(start[0]), int(end[-1])
        data = self.data[low:high]
        values = (_LOWER[data] if lower else data).astype(np.uint64)
        values += np.uint64(1)
        begin = start - low
        span = np.diff(begin, append=high - low)
        place = np.arange(high - low, dtype=np.int64)
        place -= np.repeat(begin, span)
        values *= multipliers(int(span.max()) + 1)[place]
        values[place >= np.repeat(length, span)] = 0
        return mix(np.add.reduceat(values, begin) + length.astype(np.uint64))


def as_texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one string array without nulls (null counts as empty) and without an offset."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    return pa.concat_arrays([column]) if column.offset == 0 else pa.array(column.to_pylist(), pa.large_string())


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more at the end)."""
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[: len(texts) + 1] if places else np.zeros(1, np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, np.uint8)
    return data[: int(offsets[-1])], offsets


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text, so that temporary arrays stay small."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    run = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cut = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [batch.num_rows]])
    for low, high in zip(cut[:-1], cut[1:]):
        yield batch.slice(int(low), int(high - low))


def split_words(texts: pa.Array) -> Words:
    """Words of every text of ``as_texts``'s result."""
    data, offsets = buffers(texts)
    inside = ~lookup(_IS_SPACE, data)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # a text's first byte begins a word, and the byte before it ends one, if they are inside words
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    last = edges[1:] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, doc, first)
