"""Fixed-size counters filled by all tasks: a sketch of a table whose size does not follow the table's.

Each task counts into ``cells`` counters and emits them packed; they are summed in two levels, so that no task reads more
than about the square root of their number, and the driver gets one array.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhawk.session import cut_lineage


def _row(counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([packed(counts)], pa.binary())], ["counts"])


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.tobytes(), 1)


def merged(parts: DataFrame, cells: int) -> np.ndarray:
    """Sum of the packed counters in ``parts`` (counts), a stored table with one row per task."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for part in batch.column(0):
                counts += np.frombuffer(zlib.decompress(part.as_py()), dtype=np.int64)
        if counts.any():
            yield _row(counts)

    few = max(1, math.isqrt(parts.count()))
    total = parts.repartition(few).mapInArrow(merge, "counts binary").coalesce(1).mapInArrow(merge, "counts binary").first()
    return np.frombuffer(zlib.decompress(total[0]), dtype=np.int64) if total else np.zeros(cells, dtype=np.int64)


def cell_counts(df: DataFrame, cells: int, to_cells: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """How often each cell number below ``cells`` comes out of ``to_cells`` over all batches of ``df``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for found in to_cells(batch):
                counts += np.bincount(found, minlength=cells)
        if counts.any():
            yield _row(counts)

    return merged(cut_lineage(df.mapInArrow(count, "counts binary")), cells)
