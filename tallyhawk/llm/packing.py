"""Concatenate-and-cut packing of token streams into fixed windows.

First pass: every task tokenises its documents and stores them with their place in the task's own stream. Second pass:
the tasks' totals are summed up to global offsets (one row per task, 16 bytes each, which is what is broadcast), and each
document is cut where a window ends. A document over a window's edge leaves a record on either side. Only the last
sequence can be short.

Null texts count as empty: their only id is the end id. Repeated rows are packed as often as they occur. An empty
table gives no pieces. Extra columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyhawk.llm.words import as_texts, slices
from tallyhawk.session import cut_lineage

WINDOW = 1024
END_ID = 0
KEPT_WORDS = 200_000
SPECIAL = "<|endoftext|>"

_UNSAFE = re.compile(r" (?:\s|$)")
_loaded: dict[tuple, ByteTokens] = {}


class ByteTokens(dict):
    """Ids, as little-endian 16-bit bytes, of " " + piece for pieces without a space.

    A space before anything but white space always begins a pre-token, so a text falls apart there, and a piece that
    was met before costs one lookup. The memory is emptied when ``KEPT_WORDS`` pieces are in it.
    """

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        super().__init__()
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.special = len(table)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[piece] = ids = self.whole(" " + piece)
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u2").tobytes()

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            mark = np.array([self.special], dtype="<u2").tobytes()
            return mark.join(self.ids(part) for part in text.split(SPECIAL))
        if _UNSAFE.search(text):
            return self.whole(text)
        pieces = text.split(" ")
        return self.whole(pieces[0]) + b"".join(map(self.__getitem__, pieces[1:]))


def byte_tokens(ranks: str, pattern: str) -> ByteTokens:
    """One per worker process."""
    if (ranks, pattern) not in _loaded:
        _loaded[ranks, pattern] = ByteTokens(ranks, pattern)
    return _loaded[ranks, pattern]


def tokenise(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored stream: ``part`` (task), ``local_start`` (ids before it in the task), the id, ``n`` and ``ids`` (16-bit)."""
    end = np.array([END_ID], dtype="<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, tokens = TaskContext.get().partitionId(), 0, byte_tokens(ranks, pattern)
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            ids = [tokens.ids(t) + end for t in as_texts(batch.column(1)).to_pylist()]
            n = np.array([len(x) // 2 for x in ids], dtype=np.int64)
            starts = seen + np.cumsum(n) - n
            seen += int(n.sum())
            columns = [pa.array(np.full(len(n), part)), pa.array(starts), batch.column(0), pa.array(n), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "local_start", "doc_id", "n", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut_lineage(rows.mapInArrow(run, "part long, local_start long, doc_id long, n long, ids binary"))


def cut(stream: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of a stored stream: id, start, length, ids_crc32, doc_tokens, sequence_id and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for at, doc, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                wide = np.frombuffer(ids, dtype="<u2").astype("<u4")
                edges = [0, *range(window - at % window, n, window), n]
                for low, high in zip(edges[:-1], edges[1:]):
                    values = (doc, low, high - low, zlib.crc32(wide[low:high]), n, (at + low) // window, (at + low) % window)
                    for column, value in zip(out, values):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], PIECE)

    totals = stream.groupBy("part").agg(F.max(F.col("local_start") + F.col("n")).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # one row per task of the first pass
    placed = stream.join(F.broadcast(offsets), "part")
    rows = placed.select((F.col("before") + F.col("local_start")).alias("at"), "doc_id", "n", "ids")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in PIECE))


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, ranks: str, pattern: str, window: int = WINDOW) -> DataFrame:
    return cut(tokenise(docs, ranks, pattern), window)
