"""Near-duplicate join: Jaccard similarity of word n-grams by adaptive multi-match prefixes.

A document is the set of its distinct ``width``-word shingles (as 64-bit hashes). All sets are sorted by one global order,
rare before frequent, that comes from a fixed-size frequency sketch. A pair as similar as asked for shares at least

    need = ceil(pct * (n_x + n_y) / (100 + pct)) - max(suffix_x, suffix_y)

shingles of the two prefixes, ``suffix`` being what a prefix leaves out. The shortest prefix leaves ceil(pct / 100 * n) - 1 out.
A document whose prefix meets frequent shingles gets the length of least estimated cost (list entries read plus expected
candidates times the cost of a check): a longer one asks correspondingly more shared prefix shingles of a candidate.
Candidates that pass are verified on whole sets, so the result is exact.

Copies cost nothing extra: documents with equal sets form one class with one representative. Large groups of near copies
don't emit their pairs. First every representative is checked against one pivot per prefix shingle, the member with the
smallest share of unshared prefix shingles; links found make components. The pivot that a document of a crowded shingle
shares most with is its home. Two documents of one home that both link with it are in one component already. Any other pair of
one home shares more than half of what a member differs from home by, so it is found by a prefix join over these differences, where
the common shingles of the group don't occur. Pairs of different homes are found by their prefix shingles; of a
shingle's most frequent home no two rows meet. Pairs within a component and pairs of which one has fewer shared prefix
shingles in all than needed are left out. No candidate is capped or dropped. Components are what is asked for, and links
inside a component don't change them.

Texts without words (null, empty, blank) have an empty set and link with nothing. Texts with fewer words than ``width`` have
their whole word sequence as one shingle. Rows that repeat an id must repeat its text. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.llm.cells import cell_counts, merged, packed
from tallyhawk.llm.components import components
from tallyhawk.llm.words import as_texts, mix, multipliers, slices, split_words
from tallyhawk.session import cut_lineage

SKETCH_BITS = 20
FILTER_BITS = 22
CROWD = 8  # documents of a shingle from which on its members get a home; decides costs only
LENGTHEN = (0.0, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)  # of the set's size, beyond the shortest prefix


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes."""
    words = split_words(texts)
    hashes = words.hashes(lower=True)
    factors = multipliers(width + 8)[8:]
    shingles = np.zeros(max(len(hashes) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        shingles += hashes[k : len(hashes) - width + 1 + k] * factors[k]
    shingles = mix(shingles)
    sets = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= width:
            sets.append(np.unique(shingles[low : high - width + 1]))
        elif high > low:
            total = (hashes[low:high] * factors[: high - low]).sum(dtype=np.uint64)
            sets.append(mix(np.array([total + np.uint64(high - low)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def frequency_levels(counts: np.ndarray) -> np.ndarray:
    """0 for cells that chance explains, else twice the logarithm of what is beyond the average cell."""
    mean = counts.mean()
    beyond = counts > mean + 6 * np.sqrt(mean) + 4
    return np.where(beyond, np.clip(2 * np.log2(np.maximum(counts - mean, 1)), 1, 250), 0).astype(np.uint8)


def prefix(shingles: np.ndarray, levels: np.ndarray, pct: int) -> np.ndarray:
    """The first shingles in the global order, as many as cost least."""
    n = len(shingles)
    if not n:
        return shingles
    level = levels[_cell(shingles)]
    order = np.lexsort((shingles, level))
    shortest = n - -(-pct * n // 100) + 1
    if level[order[shortest - 1]] == 0:
        return shingles[order[:shortest]]
    frequency = np.where(level[order] > 0, 2.0 ** (level[order] / 2), 0.0)
    hot, entries = np.cumsum(frequency > 0), np.cumsum(frequency)
    alike = -(-2 * pct * n // (100 + pct))
    best = None
    for part in LENGTHEN:
        size = min(n, shortest + int(part * n))
        need = max(1, alike - (n - size))
        expected = entries[size - 1] / need if hot[size - 1] >= need else 0.0
        cost = size + entries[size - 1] + expected * n
        if best is None or cost < best[0]:
            best = cost, size
    return shingles[order[: best[1]]]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in chain.from_iterable(slices(b, "text") for b in batches):
        yield batch, shingle_sets(as_texts(batch.column(1)), width)


def _keys(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """(doc, n, key): size of the set and a 128-bit digest of it; key is null for the empty set. With the sketch, of the same pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = np.uint64(0x5851F42D4C957F2D)
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch, sets in _sets(batches, width):
            keys = [s.sum(dtype=np.uint64).tobytes() + mix(s ^ other).sum(dtype=np.uint64).tobytes() if len(s) else None for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            counts += np.bincount(_cell(np.concatenate(sets)), minlength=1 << SKETCH_BITS) if sets else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(keys, pa.binary()), pa.nulls(len(keys), pa.binary())], names)
        if counts.any():
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([packed(counts)], pa.binary())], names)

    names = ["doc", "n", "key", "counts"]
    stored = cut_lineage(docs.mapInArrow(run, "doc long, n long, key binary, counts binary"))
    # a document's row has its size, a task's row its counters
    sketch = merged(stored.filter("n IS NULL").select("counts"), 1 << SKETCH_BITS)
    return stored.filter("n IS NOT NULL").select("doc", "n", "key"), sketch


def _prefixes(docs: DataFrame, width: int, levels: np.ndarray, pct: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2^20 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, width):
            found = [prefix(s, shared.value, pct) for s in sets]
            left = pa.array([len(s) - len(p) for s, p in zip(sets, found)], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            tokens = pa.array([_signed(p) for p in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, left, tokens], ["doc", "n", "suffix", "tokens"])

    return docs.mapInArrow(run, "doc long, n long, suffix long, tokens array<long>")


def _need(x: dict[str, Column], y: dict[str, Column], pct: int) -> Column:
    alike = F.ceil(pct * (x["n"] + y["n"]) / (100 + pct) - F.lit(1e-9))
    return F.greatest(F.lit(1).cast("long"), alike - F.greatest(x["suffix"], y["suffix"]))


def _sizes_fit(x: dict[str, Column], y: dict[str, Column], pct: int) -> Column:
    return 100 * F.least(x["n"], y["n"]) >= pct * F.greatest(x["n"], y["n"])


def _side(at: str, names: tuple[str, ...] = ("doc", "n", "suffix", "shared", "comp", "home")) -> dict[str, Column]:
    return {c: F.col(f"{at}.{c}") for c in names}


def star_pairs(rows: DataFrame, pct: int) -> DataFrame:
    """(x, y, home): rows against their shingles' pivots ``y``, if the shingles shared that way already suffice or if ``y`` is x's home.

    A document with a shingle that many share has a home, the pivot it shares most with. A home of others has none.
    """
    best = F.min(F.struct("unshared", "doc", "n", "suffix"))
    pivots = rows.groupBy("token").agg(best.alias("p"), F.count("*").alias("df"))
    met = rows.join(pivots, "token").select(F.struct("doc", "n", "suffix").alias("x"), F.struct("p.doc", "p.n", "p.suffix").alias("y"), "df")
    names = ("doc", "n", "suffix")
    x, y = _side("x", names), _side("y", names)
    counted = met.filter((x["doc"] != y["doc"]) & _sizes_fit(x, y, pct)).groupBy("x", "y").agg(F.count("*").alias("common"), F.max("df").alias("df"))
    enough = (F.col("common") >= _need(x, y, pct)).alias("enough")
    counted = cut_lineage(counted.select(x["doc"].alias("x"), y["doc"].alias("y"), "common", "df", enough))
    nearest = F.max_by("y", F.struct("common", -F.col("y")))
    homes = cut_lineage(counted.filter(F.col("df") >= CROWD).groupBy("x").agg(nearest.alias("y")))
    guests = homes.join(homes.select(F.col("y").alias("x")).distinct(), "x", "left_anti")
    passed = counted.filter("enough").select("x", "y", F.lit(False).alias("home"))
    return passed.unionByName(guests.withColumn("home", F.lit(True))).groupBy("x", "y").agg(F.max("home").alias("home"))


def cross_candidates(rows: DataFrame, pct: int) -> DataFrame:
    """(x, y): every pair of different components and homes with enough shared prefix shingles.

    The rows of a shingle's most frequent home are never held against one another.
    """
    x, y = _side("x"), _side("y")
    once = F.col("y.main") | (x["doc"] < y["doc"])
    apart = once & (x["home"] != y["home"]) & (x["comp"] != y["comp"]) & _sizes_fit(x, y, pct)
    hope = _need(x, y, pct) <= F.least(x["shared"], y["shared"])
    met = rows.filter("NOT main").alias("x").join(rows.alias("y"), (F.col("x.token") == F.col("y.token")) & apart & hope)
    # which side a pair's row came from differs from shingle to shingle
    pair = F.least(x["doc"], y["doc"]).alias("x"), F.greatest(x["doc"], y["doc"]).alias("y")
    counted = met.groupBy(*pair, _need(x, y, pct).alias("need")).agg(F.count("*").alias("common"))
    return counted.filter("common >= need").select("x", "y")


def home_candidates(rows: DataFrame, pct: int) -> DataFrame:
    """(x, y): every pair of one home but different components, x far from home, with enough shared differences.

    ``rows``: (home, token, doc, n, d, near, deep, far_suffix, suffix, comp), see ``differences``.
    """
    names = ("doc", "n", "d", "suffix", "far_suffix", "comp")
    x, y = _side("x", names), _side("y", names)
    alike = F.ceil((x["d"] + y["d"] - (100 - pct) * (x["n"] + y["n"]) / (100 + pct)) / 2 - F.lit(1e-9))
    fit = (x["comp"] != y["comp"]) & _sizes_fit(x, y, pct) & (alike <= F.least(x["d"], y["d"]))
    same = (F.col("x.home") == F.col("y.home")) & (F.col("x.token") == F.col("y.token")) & fit

    def counted(left: DataFrame, right: DataFrame, on: Column, suffix: Column) -> DataFrame:
        need = F.greatest(F.lit(1).cast("long"), alike - suffix).alias("need")
        met = left.alias("x").join(right.alias("y"), on).groupBy(x["doc"].alias("x"), y["doc"].alias("y"), need)
        return met.agg(F.count("*").alias("common")).filter("common >= need").select("x", "y")

    far, near = rows.filter("NOT near"), rows.filter("near")
    mixed = counted(far, near, same, F.greatest(x["far_suffix"], y["suffix"]))
    flat = far.filter("NOT deep")
    return mixed.unionByName(counted(flat, flat, same & (x["doc"] < y["doc"]), F.greatest(x["suffix"], y["suffix"])))


def _described(shared: DataFrame, sizes: DataFrame, comps: DataFrame, homes: DataFrame) -> DataFrame:
    """Rows (token, doc) of shingles that still join different components and homes, with what is known of their documents.

    ``main`` says whether a row's home is its shingle's most frequent one.
    """
    own = {"comp": F.coalesce("comp", "doc"), "home": F.coalesce("home", "doc")}
    rows = shared.join(comps, "doc", "left").join(homes, "doc", "left").withColumns(own)
    per_home = rows.groupBy("token", "home").agg(F.count("*").alias("df"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    per_token = per_home.groupBy("token").agg(
        F.max_by("home", F.struct("df", "home")).alias("largest"), F.count("*").alias("n_homes"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    mixed = per_token.filter("low <> high AND n_homes > 1").select("token", "largest")
    alive = cut_lineage(rows.join(mixed, "token").withColumn("main", F.col("home") == F.col("largest")).drop("largest"))
    counts = alive.groupBy("doc").agg(F.count("*").alias("shared"))
    known = counts.join(sizes, "doc").withColumn("unshared", (F.col("n") - F.col("suffix") - F.col("shared")) / F.col("n"))
    return cut_lineage(alive.join(known, "doc"))


def _filter_cells(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(doc, shingles as bytes) of at least the documents in ``wanted``.

    A bit table of fixed size, 2^22, tells most others apart before their sets are built, without moving any text.
    """
    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _filter_cells(batch.column(0).to_numpy(zero_copy_only=False))

    bits = docs.sparkSession.sparkContext.broadcast(cell_counts(wanted.select("doc"), 1 << FILTER_BITS, cells) > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = bits.value[_filter_cells(batch.column(0).to_numpy(zero_copy_only=False))]
            for part, sets in _sets([batch.filter(pa.array(hit))], width):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc", "shingles"])

    return cut_lineage(docs.filter("doc IS NOT NULL").mapInArrow(run, "doc long, shingles binary").join(wanted, "doc", "left_semi"))


def _paired(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``pairs`` (x, y, ...), a stored table, with the sets of both as bytes ``a`` and ``b``."""
    both = pairs.select(F.col("x").alias("doc")).unionByName(pairs.select(F.col("y").alias("doc")))
    sets = _sets_of(docs, cut_lineage(both.distinct()), width)
    first = pairs.join(sets.select(F.col("doc").alias("x"), F.col("shingles").alias("a")), "x")
    return first.join(sets.select(F.col("doc").alias("y"), F.col("shingles").alias("b")), "y")


def _two_sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for left, right in zip(batch.column(2), batch.column(3)):
        yield tuple(np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (left, right))


def _linked(a: np.ndarray, b: np.ndarray, pct: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= pct * (len(a) + len(b) - both)


def verified(pairs: DataFrame, docs: DataFrame, width: int, pct: int) -> DataFrame:
    """Those of ``pairs`` (x, y), a stored table, whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [_linked(a, b, pct) for a, b in _two_sets(batch)]
            yield batch.select(["x", "y"]).filter(pa.array(hit, pa.bool_()))

    return _paired(pairs, docs, width).select("x", "y", "a", "b").mapInArrow(run, "x long, y long")


def difference_prefix(own: np.ndarray, home: np.ndarray, near: bool, levels: np.ndarray, pct: int) -> tuple[np.ndarray, int, int, int]:
    """First differences from home, how many may serve any partner, and what the two prefixes leave out.

    Differences are what one of the sets has and the other lacks, in a common order: what home lacks first, then rare before
    frequent. With ``d`` their number, a partner of a document far from home shares more than
    (d + (100 - pct) / (100 + pct) * (n_home - n)) / 2 of them; a partner of any kind at least d - (100 - pct) / pct * n.
    """
    differ = np.setxor1d(own, home, assume_unique=True)
    d, n = len(differ), len(own)
    order = np.lexsort((differ, levels[_cell(differ)], np.isin(differ, home, assume_unique=True)))
    least = (d * (100 + pct) + (100 - pct) * (len(home) - n)) // (2 * (100 + pct)) + 1
    flat = max(0, d - least + 1)
    far_least = max(1, d - (100 - pct) * n // pct)
    size = flat if near else max(flat, d - far_least + 1)
    return differ[order[:size]], flat, d - flat, d - size


def differences(pairs: DataFrame, docs: DataFrame, width: int, pct: int, levels: np.ndarray) -> DataFrame:
    """Per pair (x, y, home), a stored table: whether it is ``near`` enough to link, and for homes the differences x is found by."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2^20 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for (a, b), home in zip(_two_sets(batch), batch.column(4).to_pylist()):
                near = _linked(a, b, pct)
                if home:
                    tokens, flat, suffix, far_suffix = difference_prefix(a, b, near, shared.value, pct)
                    differ = flat + suffix
                else:
                    tokens, flat, suffix, far_suffix, differ = np.zeros(0, dtype=np.uint64), 0, 0, 0, 0
                rows.append((near, len(a), differ, flat, suffix, far_suffix, _signed(tokens)))
            near, *numbers, tokens = zip(*rows) if rows else [()] * 7
            columns = [batch.column(0), batch.column(1), batch.column(4), pa.array(near, pa.bool_())]
            columns += [pa.array(x, pa.int64()) for x in numbers] + [pa.array(tokens, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["x", "y", "home", "near", "n", "d", "flat", "suffix", "far_suffix", "tokens"])

    schema = "x long, y long, home boolean, near boolean, n long, d long, flat long, suffix long, far_suffix long, tokens array<long>"
    return _paired(pairs, docs, width).select("x", "y", "a", "b", "home").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, pct: int = 80) -> DataFrame:
    """Per row: the id, ``n_shingles``, ``class_id`` (smallest id with an equal set) and ``component_id``."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    keys, sketch = _keys(texts, width)
    classes = keys.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc").alias("rep"))

    levels = frequency_levels(sketch)
    reps = classes.select(F.col("rep").alias("doc"))
    prefixes = cut_lineage(_prefixes(texts, width, levels, pct).join(reps, "doc", "left_semi").dropDuplicates(["doc"]))
    sizes = prefixes.select("doc", "n", "suffix")
    tokens = prefixes.select(F.explode("tokens").alias("token"), "doc")
    frequent = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").select("token")
    shared = cut_lineage(tokens.join(frequent, "token"))

    alone = sizes.select("doc", F.col("doc").alias("comp"))
    at_home = alone.select("doc", F.col("doc").alias("home"))
    star = cut_lineage(star_pairs(_described(shared, sizes, alone, at_home), pct))
    checked = cut_lineage(differences(star, texts, width, pct, levels))
    links = checked.filter("near").select("x", "y")
    comps = components(links)

    guests = checked.filter("home")
    homes = cut_lineage(guests.select(F.col("x").alias("doc"), F.col("y").alias("home")))
    placed = guests.withColumnsRenamed({"x": "doc", "y": "at"}).drop("home").withColumnRenamed("at", "home")
    placed = placed.join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    kept = ("home", "doc", "n", "d", "near", "flat", "suffix", "far_suffix", "comp")
    differ = placed.select(*kept, F.posexplode("tokens").alias("at", "token")).withColumn("deep", F.col("at") >= F.col("flat"))
    within = home_candidates(cut_lineage(differ), pct)
    across = cross_candidates(_described(shared, sizes, comps, homes), pct)
    rest = cut_lineage(within.unionByName(across))
    links = cut_lineage(links.unionByName(verified(rest, texts, width, pct)))
    comps = components(links)

    placed = keys.join(classes, "key", "left").join(comps, F.col("rep") == comps["doc"], "left").select(
        keys["doc"].alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.coalesce("rep", keys["doc"]).alias("class_id"),
        F.coalesce("comp", "rep", keys["doc"]).alias("component_id"),
    )
    return placed
