"""Quality classifier by Bradley-Terry ranking.

Each labelled good text is preferred to labelled bad ones. Logistic loss on the feature differences of such pairs gives one
weight per feature, and a text's strength is its weighted feature sum. The cut lies at a quantile of the strengths of
the labelled texts, the one that their share of bad texts names, and is shown as score ``cut_score``.

Features describe the text only: characters of several kinds, word lengths, and repetition of words and lines. Null and
empty texts have all-zero features and so a defined score. Labels are used on a sample of ``most_rows`` at most.
Repeated rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from tallyhawk.llm.repetition import duplicate_lines, per_doc
from tallyhawk.llm.words import as_texts, mix, slices, split_words
from tallyhawk.operators.quantiles import exact_quantiles
from tallyhawk.session import cut_lineage

FEATURES = (
    "upper", "lower", "digits", "full_stops", "shouts", "bars", "symbols", "beyond_ascii", "white",
    "word_length", "distinct_words", "top_word", "same_as_previous", "odd_endings", "duplicate_lines", "log_words",
)
ROUNDING = 9  # places of a score, so that sums in another order give the same result


def _kind(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_KINDS = {
    "upper": _kind(bytes(range(65, 91))),
    "lower": _kind(bytes(range(97, 123))),
    "digits": _kind(b"0123456789"),
    "full_stops": _kind(b".,;:?"),
    "shouts": _kind(b"!"),
    "bars": _kind(b"|"),
    "symbols": _kind(b"#*$%&<>@^~=+_\\/{}[]"),
    "beyond_ascii": _kind(bytes(range(128, 256))),
    "white": _kind(b" \t\n\r\x0b\x0c"),
}
_PLAIN_END = _kind(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;:?" + bytes(range(128, 256)))


def features(texts: pa.Array) -> np.ndarray:
    """A row per text, columns as in ``FEATURES``."""
    words = split_words(texts)
    n = np.diff(words.first)
    size = np.maximum(np.diff(words.offsets), 1)
    at_least = np.maximum(n, 1)
    columns = [np.diff(np.concatenate([[0], np.cumsum(kind[words.data])])[words.offsets]) / size for kind in _KINDS.values()]
    hashes = words.hashes(lower=True)
    previous = np.zeros(len(hashes), dtype=bool)
    previous[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    own = mix(hashes + mix(words.doc.astype(np.uint64) + np.uint64(7)))
    _, where, counts = np.unique(own, return_index=True, return_counts=True)
    distinct = np.bincount(words.doc[where], minlength=len(n))
    top = np.zeros(len(n), dtype=np.int64)
    np.maximum.at(top, words.doc[where], counts)
    odd = ~_PLAIN_END[words.data[words.end - 1]] if len(words.end) else np.zeros(0, dtype=bool)
    columns += [
        per_doc(words, words.end - words.start) / at_least / 10,
        distinct / at_least,
        top / at_least,
        per_doc(words, previous) / at_least,
        per_doc(words, odd) / at_least,
        np.array([duplicate_lines(t) / (1 + t.count("\n")) if t else 0.0 for t in texts.to_pylist()]),
        np.log1p(n) / 10,
    ]
    return np.column_stack(columns) * (np.diff(words.offsets) > 0)[:, None]


@dataclass
class Ranking:
    weights: np.ndarray
    cut: float
    cut_score: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        level = rows @ self.weights - self.cut + math.log(self.cut_score / (1 - self.cut_score))
        return np.round(1 / (1 + np.exp(-np.clip(level, -30, 30))), ROUNDING)


def _featured(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            rows = pa.array(list(features(as_texts(batch.column(len(keep))))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], rows], [*keep, "features"])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, F.col(text).alias("text")).mapInArrow(run, ", ".join([*kinds, "features array<double>"]))


def train(
    docs: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    most_rows: int = 20_000, rivals: int = 4, cut_score: float = 0.3,
) -> Ranking:
    """Fit on rows with label 1 (good) or 0 (bad): weights on about ``most_rows`` of them at most, drawn by hash of the id, the cut and the share
    of bad texts that names it on all of them.

    A good text meets ``rivals`` bad ones. With labels of one kind only, every weight is 0.
    """
    return train_featured(_featured(docs.filter(F.col(label).isin(0, 1)), [doc_id, label], text), label, doc_id, most_rows, rivals, cut_score)


def featured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``features``) per row, stored: labels are then joined to a few numbers and not to texts, and one pass over the texts serves
    fitting and scoring."""
    return cut_lineage(_featured(docs, [doc_id], text))


def train_featured(
    rows: DataFrame, label: str = "quality", doc_id: str = "doc_id", most_rows: int = 20_000, rivals: int = 4, cut_score: float = 0.3
) -> Ranking:
    """The same from rows with an id, a label and ``features``."""
    every = cut_lineage(rows.filter(F.col(label).isin(0, 1)).select(doc_id, label, "features"))
    total, sample = every.count(), every
    if total > most_rows:
        sample = every.filter(F.pmod(F.xxhash64(F.col(doc_id), F.lit("quality")), F.lit(1 << 30)) < int(most_rows / total * (1 << 30)))
    counts = {r[label]: r["n"] for r in sample.groupBy(label).agg(F.count("*").alias("n")).collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    if not good or not bad:
        return Ranking(np.zeros(len(FEATURES)), 0.0, cut_score)
    by_hash = Window.partitionBy(label).orderBy(F.xxhash64(F.col(doc_id), F.lit("rank")), doc_id)  # most_rows bounds it
    ranked = sample.withColumn("_rank", F.row_number().over(by_hash) - 1)
    winners = ranked.filter(F.col(label) == 1).withColumn("_try", F.explode(F.sequence(F.lit(0), F.lit(rivals - 1))))
    winners = winners.select("_rank", F.col("features").alias("win"), ((F.col("_rank") * rivals + F.col("_try")) % bad).alias("_rival"))
    losers = ranked.filter(F.col(label) == 0).select(F.col("_rank").alias("_rival"), F.col("features").alias("lose"))
    # a pair is told either way round, by turns, so that both classes occur
    turn = (F.col("_rank") % 2).cast("int")
    difference = F.zip_with("win", "lose", lambda w, v: (w - v) * (2 * turn - 1))
    pairs = winners.join(losers, "_rival").select(turn.cast("double").alias("label"), array_to_vector(difference).alias("features"))
    stored = cut_lineage(pairs)
    model = LogisticRegression(fitIntercept=False, regParam=1e-3, maxIter=60).fit(stored)
    weights = model.coefficients.toArray()
    strength = F.aggregate(
        F.zip_with("features", F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x
    )
    # the middle between the neighbours of the quantile that the share of bad texts names
    share = every.filter(F.col(label) == 0).count() / total
    scored = cut_lineage(every.select(strength.alias("s")))
    found = [r["q"] for r in exact_quantiles(scored, ["s"], sorted({max(0.0, share - 0.5 / total), share})).orderBy("p").collect()]
    return Ranking(weights, (found[0] + found[-1]) / 2, cut_score)


def score(docs: DataFrame, ranking: Ranking, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``score`` and ``predicted`` (1 from ``cut_score`` on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            scores = ranking.scores(features(as_texts(batch.column(1))))
            predicted = pa.array((scores >= ranking.cut_score).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), predicted], [doc_id, "score", "predicted"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{doc_id}` {kind}, score double, predicted int")


def score_featured(rows: DataFrame, ranking: Ranking, doc_id: str = "doc_id") -> DataFrame:
    """The same as ``score`` from ``featured`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = ranking.scores(values)
            predicted = pa.array((scores >= ranking.cut_score).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), predicted], [doc_id, "score", "predicted"])

    kind = rows.schema[doc_id].dataType.simpleString()
    return rows.select(doc_id, "features").mapInArrow(run, f"`{doc_id}` {kind}, score double, predicted int")
