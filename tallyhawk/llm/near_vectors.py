"""Near duplicates among vectors of one label, by cosine, as a subspace pigeonhole join.

Unit vectors with a cosine of c or more are at a squared distance of 2 - 2c or less. A fixed random rotation spreads that distance over
all coordinates; the rotated vectors are split into blocks of a few dimensions, and each block gets a share of the
budget by its number of dimensions. In at least one block a near pair stays within the share, so a range join in each block
misses none. The pairs that a block brings are verified by the cosine of the whole vectors there and then, and a pair that several
blocks bring counts in the first of them only, so no table of pairs is ever written.

The range join of a block puts each vector into every grid cell that a ball of half the radius around it touches. The middle of a near pair
lies within that of both, so they meet in its cell, and count there only. How many dimensions the grid has follows
from the label's number of vectors. A crowded cell is cut into chunks of bounded size by hash, and each two chunks meet
in a task of their own.

Equal vectors are one vector with a number of copies before all this.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallyhawk.llm.components import components
from tallyhawk.llm.heavy import attach
from tallyhawk.session import cut_lineage

BLOCK = 8
CHUNK = 2048
TILE = 512
# rotated coordinates are kept in single precision; what that can add to a squared distance of unit vectors
ROUNDING = 1e-6


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(20_011).standard_normal((dims, dims)))[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; by their greatest component first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def budgets(dims: int, cosine: float, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First coordinate of each block, and its share of the squared distance."""
    starts = np.arange(0, dims, block)
    widths = np.diff(np.append(starts, dims))
    return starts, max(0.0, 2 - 2 * cosine) * widths / dims + ROUNDING


def cells(points: np.ndarray, radius: float, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for every cell of width 2 * radius that the ball of half the radius around a row's point touches; ``grid`` says in how
    many of its first dimensions a row's cells are bounded."""
    width, reach = 2 * radius, (radius / 2) ** 2 * (1 + 1e-9) + 1e-12
    base = 2 * int(np.ceil(1 / width)) + 5
    row, cell, used = np.arange(len(points)), np.zeros(len(points), dtype=np.int64), np.zeros(len(points))
    for dim in range(min(points.shape[1], grid_limit(radius))):
        x = points[row, dim] / width
        at = np.floor(x)
        # only the nearer face can be within half a radius, a quarter of the width
        up = x - at > 0.5
        gap = np.where(up, at + 1 - x, x - at) * width
        more = used + gap * gap
        inside = grid[row] > dim
        other = inside & (more <= reach)
        scale = np.int64(base) ** dim
        own = cell + np.where(inside, at.astype(np.int64) + base // 2, 0) * scale
        beside = (cell + (at.astype(np.int64) + np.where(up, 1, -1) + base // 2) * scale)[other]
        row, cell, used = np.append(row, row[other]), np.append(own, beside), np.append(used, more[other])
    return row, cell


def cell_of(points: np.ndarray, radius: float, grid: int) -> np.ndarray:
    width = 2 * radius
    base = 2 * int(np.ceil(1 / width)) + 5
    cell = np.zeros(len(points), dtype=np.int64)
    for dim in range(min(points.shape[1], grid, grid_limit(radius))):
        cell += (np.floor(points[:, dim] / width).astype(np.int64) + base // 2) * np.int64(base) ** dim
    return cell


def grid_limit(radius: float) -> int:
    """So many dimensions' cell numbers fit into 62 bits."""
    return int(62 / np.log2(2 * np.ceil(1 / (2 * radius)) + 5))


def _vectors(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _rotated(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(len(column), -1).astype(np.float64)


def _by_dims(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch's rows by the length of their vectors."""
    lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield batch.filter(pa.array(lengths == n))


def _rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _by_dims(whole, "v"):
            vectors = unit(_vectors(batch.column("v"), batch.num_rows))
            turned = (vectors @ rotation(vectors.shape[1])).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in turned], pa.binary())], [*batch.schema.names, "rot"])


def _place(cosine: float, block: int, with_vectors: bool):
    """Rows to their blocks and cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_dims(whole, "v"):
                points = _rotated(batch.column("rot"))
                grid = batch.column("grid").to_numpy(zero_copy_only=False)
                starts, budget = budgets(points.shape[1], cosine, block)
                for k, start in enumerate(starts):
                    row, cell = cells(points[:, start : start + block], float(np.sqrt(budget[k])), grid)
                    taken = batch.take(pa.array(row)) if with_vectors else batch.select(["g", "dims"]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.array(np.full(len(row), k, dtype=np.int32)), pa.array(cell)],
                        [*taken.schema.names, "block", "cell"],
                    )

    return run


def _merge(root: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Roots after joining the trees of each pair; a root is the least row of its tree."""
    while True:
        a, b = root[first], root[second]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _link(cosine: float, block: int):
    """The links inside one cell, or between two chunks of it: per vector the copies linked, and a vector of its tree."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        number = table.column("n").to_numpy()
        copies = table.column("copies").to_numpy()
        vectors = unit(_vectors(table.column("v").combine_chunks(), len(number)))
        points = _rotated(table.column("rot").combine_chunks())
        key = {c: table.column(c)[0].as_py() for c in ("block", "cell", "a", "b", "grid")}
        chunk = table.column("chunk").to_numpy()
        starts, budget = budgets(points.shape[1], cosine, block)
        own = points[:, starts[key["block"]] : starts[key["block"]] + block]
        radius = float(np.sqrt(budget[key["block"]]))
        square = (own * own).sum(axis=1)
        left, right = np.flatnonzero(chunk == key["a"]), np.flatnonzero(chunk == key["b"])
        linked, root = np.zeros(len(number), dtype=np.int64), np.arange(len(number))
        for low in range(0, len(left), TILE):
            rows = left[low : low + TILE]
            near = square[rows][:, None] + square[right][None, :] - 2 * (own[rows] @ own[right].T) <= budget[key["block"]] + ROUNDING
            if key["a"] == key["b"]:
                near &= number[rows][:, None] < number[right][None, :]
            i, j = np.nonzero(near)
            if not len(i):
                continue
            if len(i) > 20_000:
                close = (vectors[rows] @ vectors[right].T)[i, j] >= cosine
                i, j = rows[i[close]], right[j[close]]
            else:
                i, j = rows[i], right[j]
                close = (vectors[i] * vectors[j]).sum(axis=1) >= cosine
                i, j = i[close], j[close]
            for at in range(0, len(i), 16_384):
                x, y = i[at : at + 16_384], j[at : at + 16_384]
                difference = points[x] - points[y]
                by_block = np.add.reduceat(difference * difference, starts, axis=1)
                counts = (by_block <= budget).argmax(axis=1) == key["block"]
                counts &= cell_of((own[x] + own[y]) / 2, radius, key["grid"]) == key["cell"]
                x, y = x[counts], y[counts]
                np.add.at(linked, x, copies[y])
                np.add.at(linked, y, copies[x])
                root = _merge(root, x, y)
        has = linked > 0
        return pa.table({"n": number[has], "links": linked[has], "mate": number[root[has]]})

    return run


def near_vectors(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    cosine: float = 0.98, block: int = BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """Per row of ``df``: id, n_links (other rows of its label with a cosine of ``cosine`` or more), component_id (smallest id reachable by
    links, its own included) and kept (its id is the component's).

    Rows without a label, and vectors that are null, empty, all zero or hold null or non-finite components, link with nothing, nor do vectors of
    different lengths. Repeated rows are rows of their own that link with each other. A null id is never the smallest; a component
    of null ids only has a null component_id, and its rows are kept. Other columns are not read, so names can't clash. An
    empty table gives an empty one. ``cosine`` must be over 0: below, the distance no longer decides.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be over 0 and at most 1")
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).cast(kind).alias("v"), F.col(label).alias("g"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("g").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))

    vectors = rows.filter(usable).groupBy("g", "v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    vectors = vectors.withColumn("dims", F.size("v")).withColumn("n", F.monotonically_increasing_id())
    label_kind = df.schema[label].dataType.simpleString()
    columns = f"g {label_kind}, v {kind}, least {df.schema[vec_id].dataType.simpleString()}, copies long, dims int, n long"
    vectors = cut_lineage(vectors.mapInArrow(_rotate, columns + ", rot binary"))
    total = vectors.count()

    # a bounded dimension leaves about 0.4 of the rows in a cell
    crowds = vectors.groupBy("g", "dims").agg(F.count("*").alias("crowd"))
    sized = attach(vectors, crowds, ["g", "dims"], "crowd", total)
    grid = F.greatest(F.lit(0), F.ceil(F.log(F.col("crowd") / chunk) / float(-np.log(0.4)))).cast("int")
    sized = sized.select("n", "g", "dims", "v", "rot", "copies", grid.alias("grid"))
    carried = f"n long, g {label_kind}, dims int, v {kind}, rot binary, copies long, grid int, block int, cell long"
    key = ["g", "dims", "block", "cell"]
    slim = sized.mapInArrow(_place(cosine, block, False), f"g {label_kind}, dims int, block int, cell long")
    crowded = slim.groupBy(*key).agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks")).filter("chunks > 1")
    placed = sized.mapInArrow(_place(cosine, block, True), carried).join(crowded, key, "left")
    placed = placed.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("n"), "chunks").cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.withColumns({"a": F.least("chunk", "other"), "b": F.greatest("chunk", "other")}).drop("chunks", "other")
    found = met.groupBy(*key, "a", "b").applyInArrow(_link(cosine, block), "n long, links long, mate long")
    found = cut_lineage(found)

    links = found.groupBy("n").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("n").alias("x"), F.col("mate").alias("y"))).withColumnsRenamed({"doc": "n", "comp": "root"})
    state = vectors.select("n", "g", "v", "least", "copies").join(links, "n", "left").join(roots, "n", "left")
    state = cut_lineage(state.withColumn("root", F.coalesce("root", "n")))
    least = state.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("members"))
    state = attach(state, least, ["root"], "members", total).select(
        "g", "v", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component")
    )
    linked = attach(rows.filter(usable), state, ["g", "v"], "copies", rows.count()).select("id", "n_links", "component")
    alone = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(vec_id), "n_links", F.col("component").alias("component_id"), F.expr("id <=> component").alias("kept")
    )
