"""Product codes of vectors in whole numbers: every vector is cut into parts, and each part is named by the nearest of 256 entries.

Distances are compared after an integer Walsh-Hadamard transform of the zero-padded parts and entries. The transform
multiplies every squared distance by the padded length P, so sums of squared differences of its coefficients are exact
multiples and no floating point is needed. Coefficients are taken in sequency order (slow changes first). After each step
the entry that leads is measured to the end, which bounds the distance from above; entries whose sum so far is greater
are out. A sum only grows, so the nearest entry is never lost; one equal to the bound stays, so ties go to the lower index.

Codebooks are learned over all rows: each round every task assigns its rows and adds up the parts of each entry, and what
reaches the driver is one row per entry (parts x entries) whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhawk.llm.heavy import attach
from tallyhawk.session import cut_lineage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
STEP = 4
ROWS_AT_ONCE = 2048


def walsh(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of zero-padded integer rows, coefficients by the number of sign changes of their functions."""
    n, width = rows.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((n, size), dtype=np.int64)
    out[:, :width] = rows
    half = 1
    while half < size:
        pair = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency(size)]


def sequency(size: int) -> np.ndarray:
    """Row k of the naturally ordered matrix has s sign changes, where k reversed in its bits is the Gray code of s."""
    s = np.arange(size)
    gray = s ^ (s >> 1)
    bits = size.bit_length() - 1
    found = np.zeros(size, dtype=np.int64)
    for bit in range(bits):
        found |= ((gray >> bit) & 1) << (bits - 1 - bit)
    return found


def greatest_component(width: int) -> int:
    """Up to this size of components no sum of squared differences leaves 64 bits."""
    size = 1 << max(0, width - 1).bit_length()
    return int((2.0**61 / (4 * size * size)) ** 0.5)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of every row; of equally near ones the lowest index."""
    index, distance = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
    places = walsh(entries)
    for low in range(0, len(rows), ROWS_AT_ONCE):
        high = min(len(rows), low + ROWS_AT_ONCE)
        index[low:high], distance[low:high] = _nearest(walsh(rows[low:high]), places)
    return index, distance // places.shape[1]


def _nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, size = rows.shape
    bound = np.full(n, np.iinfo(np.int64).max)
    every = np.arange(n)
    sums = np.zeros((n, len(entries)), dtype=np.int64)
    done = 0
    # while most entries are in, whole tables; then a list of (row, entry) pairs
    while done < size:
        upto = min(size, done + STEP)
        for c in range(done, upto):
            difference = rows[:, c, None] - entries[None, :, c]
            sums += difference * difference
        done = upto
        lead = sums.argmin(axis=1)
        rest = rows[:, done:] - entries[lead, done:]
        bound = np.minimum(bound, sums[every, lead] + (rest * rest).sum(axis=1))
        alive = sums <= bound[:, None]
        if np.count_nonzero(alive) * 4 < alive.size:
            break
    if done == size:
        lead = sums.argmin(axis=1)
        return lead, sums[every, lead]
    row, entry = np.nonzero(alive)
    total = sums[row, entry]
    while done < size:
        upto = min(size, done + STEP)
        difference = rows[row, done:upto] - entries[entry, done:upto]
        total = total + (difference * difference).sum(axis=1)
        done = upto
        keep = total <= bound[row]
        row, entry, total = row[keep], entry[keep], total[keep]
    order = np.lexsort((entry, total, row))
    row, entry, total = row[order], entry[order], total[order]
    first = np.searchsorted(row, every)
    return entry[first], total[first]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, with zeros behind up to a multiple of the number of parts."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
    limit = greatest_component(-(-width // PARTS))
    if flat.size and max(int(flat.max()), -int(flat.min())) > limit:
        raise ValueError(f"a component times {SCALE} exceeds {limit}: distances would not fit into 64 bits")
    return np.pad(flat, ((0, 0), (0, -width % PARTS)))


def _sum_parts(vectors: DataFrame, codebooks: list[np.ndarray], width: int) -> DataFrame:
    """(part, entry, n, sums) over all rows; a task emits a row per entry at most."""
    part_width = codebooks[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(book.shape, dtype=np.int64) for book in codebooks]
        counts = [np.zeros(len(book), dtype=np.int64) for book in codebooks]
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            for k, book in enumerate(codebooks):
                part = rows[:, k * part_width : (k + 1) * part_width]
                index, _ = nearest(part, book)
                np.add.at(sums[k], index, part)
                counts[k] += np.bincount(index, minlength=len(book))
        out = [(k, e, int(counts[k][e]), sums[k][e].tolist()) for k in range(PARTS) for e in np.flatnonzero(counts[k]).tolist()]
        if out:
            part, entry, n, total = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
                ["part", "entry", "n", "sums"],
            )

    found = vectors.select("q").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = F.array(*[F.sum(F.col("sums")[i]) for i in range(part_width)])
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("sums"))


def learn(vectors: DataFrame, first: np.ndarray, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks, one per part, that start as the parts of the rows ``first`` and follow the means, rounded down, of the parts they get."""
    codebooks = [book.copy() for book in np.split(first, PARTS, axis=1)]
    for _ in range(rounds):
        for part, entry, n, sums in _sum_parts(vectors, codebooks, width).collect():
            codebooks[part][entry] = [total // n for total in sums]
    return codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def _assign(vectors: DataFrame, codebooks: list[np.ndarray], width: int, kinds: str) -> DataFrame:
    part_width = codebooks[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(2), width)
            code, error = np.empty((len(rows), PARTS), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
            for k, book in enumerate(codebooks):
                code[:, k], distance = nearest(rows[:, k * part_width : (k + 1) * part_width], book)
                error += distance
            text = ["".join(f"{x:02x}" for x in c) for c in code.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)], ["id", "label", "code", "error"]
            )

    return vectors.select("id", "label", "q").mapInArrow(run, kinds + ", code string, error long")


def vector_codes(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """Per usable row of ``df``: id, code (an index of two hex digits for each of 4 parts), error (squared distances summed over the
    parts), label_error (error summed over the rows with that label, nulls together) and a digest of the codebooks.

    Rows whose vector is null, empty, or holds null or non-finite components go. Components become floor(1024 * x). The
    length of the usable vector with the smallest id sets the length; vectors of another length go, too. A length that 4 does not
    divide is filled with zeros. The first entries are the 256 smallest ids (null ids last; equal ids by their
    components), or as many as there are. Repeated rows each count and are each returned. Other columns are not
    read. An empty table, or one without a usable row, gives no rows. Components so large that a sum of squares would
    leave 64 bits raise an error instead of giving a wrong number.
    """
    spark = df.sparkSession
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(usable)
    vectors = cut_lineage(rows.select("id", "label", F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE)))).alias("q")))
    by_id = [F.col("id").asc_nulls_last(), "q"]
    least = vectors.orderBy(*by_id).select("q").first()
    id_kind, label_kind = (df.schema[c].dataType.simpleString() for c in (vec_id, label))
    if least is None:
        nothing = f"`{vec_id}` {id_kind}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], nothing)
    width = len(least.q)
    vectors = vectors.filter(F.size("q") == width)
    first = [r.q for r in vectors.orderBy(*by_id).select("q").limit(ENTRIES).collect()]
    first = np.pad(np.array(first, dtype=np.int64), ((0, 0), (0, -width % PARTS)))
    codebooks = learn(vectors, first, width, rounds)
    coded = cut_lineage(_assign(vectors, codebooks, width, f"id {id_kind}, label {label_kind}"))
    # a key that is never null, so that rows without a label meet
    keyed = coded.withColumn("key", F.struct(F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("name")))
    per_label = keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    coded = attach(keyed, per_label, ["key"], "n", coded.count())
    return coded.select(
        F.col("id").alias(vec_id), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
