"""Language spans of mixed text: script ranges, letter trigrams, and Viterbi with a switching penalty.

Words are runs of letters and the marks on them. Training counts their trigrams (with a boundary on either side, A-Z folded) per language,
and which scripts a language is written in. In prediction a word's script narrows its candidates, trigram log-probabilities score them,
and the best path over a text's words pays ``penalty`` for every change of language. The text's language has the most
letters on that path; the score is its share of them.

Null texts and texts without a letter are ``und`` with score 0. Of languages with equally many letters the first by name is given; of equal
paths the one that stays, then the first by name. With no training rows every text is ``und``. Repeated
rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.llm.words import as_texts, slices

TRIGRAMS = 1 << 16
SLICE_BYTES = 500_000  # a byte of text takes some dozens of bytes of temporary arrays
SMOOTH = 0.5
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"

# Code point ranges of scripts; every other letter is Latin or has a script that narrows nothing.
SCRIPT_RANGES = {
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "odia": [(0xB00, 0xB7F)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "mongolian": [(0x1800, 0x18AF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3041, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
SCRIPTS = len(SCRIPT_RANGES) + 1


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the letter with A-Z folded, or 0 for what is neither a letter nor a mark on one; and the script."""
    fold = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    fold[[unicodedata.category(chr(c))[0] not in "LM" for c in range(sys.maxunicode + 1)]] = 0
    fold[65:91] += 32
    script = np.zeros(sys.maxunicode + 1, dtype=np.int64)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), start=1):
        for low, high in ranges:
            script[low : high + 1] = number
    return fold, script


@dataclass
class Letters:
    """Runs of letters of a batch: trigram code per byte, and for each run its bytes, script and text."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def letters_of(texts: pa.Array) -> Letters:
    fold, scripts = tables()
    plain = texts.to_pylist()
    # a boundary character is put between texts so that no run leaves its text
    points = np.frombuffer("\0".join(["", *plain, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    wide = fold[points]
    inside = wide > 0
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    codes = np.zeros(len(wide), dtype=np.uint32)
    codes[1:-1] = (wide[:-2] * np.uint32(0x10001) + wide[1:-1] * np.uint32(0x9E3779B1) + wide[2:] * np.uint32(0x85EBCA77))
    codes = (codes ^ (codes >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    codes = (codes >> np.uint32(16)).astype(np.int64)
    borders = np.concatenate([[0], np.cumsum([len(t) + 1 for t in plain], dtype=np.int64)])
    first = np.searchsorted(start, borders)
    doc = np.repeat(np.arange(len(plain)), np.diff(first))
    return Letters(codes, start, end, scripts[points[start]], end - start, doc, first)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # trigram, language
    allowed: np.ndarray  # script, language: 0 or a large negative number


def is_held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, label: str = "lang", text: str = "text", doc_id: str = "doc_id", most_rows: int = 20_000) -> Model:
    """Fit on the rows of ``docs`` with a label. Each language has an equal part of ``most_rows``: all its rows if it has no more, else about that
    many drawn by hash of the id, so that a rare language is learned from a large table as from a small one."""
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    per_language = rows.groupBy(F.col(label).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
    each = max(1, most_rows // max(1, len(per_language)))
    place = F.pmod(F.xxhash64(F.col(doc_id), F.lit("language")), F.lit(1 << 30))
    large = [(r["lang"], int(each / r["n"] * (1 << 30))) for r in per_language if r["n"] > each]
    if large:
        bounds = F.create_map(*[F.lit(x) for pair in large for x in pair])
        rows = rows.filter(place < F.coalesce(bounds[F.col(label)], F.lit(1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in chain.from_iterable(slices(b, "text", SLICE_BYTES) for b in batches):
            found = letters_of(as_texts(batch.column(1)))
            labels = batch.column(0).to_pylist()
            inside = np.zeros(len(found.codes) + 1, dtype=np.int64)
            inside[found.start] += 1
            inside[found.end] -= 1
            inside = np.cumsum(inside)[:-1] > 0
            run_of = np.repeat(np.arange(len(found.start)), found.end - found.start)
            languages = sorted(set(labels))
            number = np.array([languages.index(x) for x in labels])
            of = number[found.doc]
            for k, language in enumerate(languages):
                table = counts.setdefault(language, np.zeros(TRIGRAMS + SCRIPTS, dtype=np.int64))
                table[:TRIGRAMS] += np.bincount(found.codes[inside][of[run_of] == k], minlength=TRIGRAMS)
                table[TRIGRAMS:] += np.bincount(found.script[of == k], minlength=SCRIPTS)
        for language, table in counts.items():
            cells = np.flatnonzero(table)
            columns = [pa.array([language] * len(cells), pa.string()), pa.array(cells, pa.int64()), pa.array(table[cells])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "cell", "n"])

    counted = rows.select(F.col(label).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, cell long, n long")
    # languages x 65,544 cells at most, whatever the input
    cells = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow().combine_chunks()
    named = pc.dictionary_encode(cells["lang"]).combine_chunks()
    named = named if isinstance(named, pa.DictionaryArray) else named.chunk(0) if named.num_chunks else pa.array([], pa.string()).dictionary_encode()
    met = named.dictionary.to_pylist()
    languages = sorted(met)
    table = np.zeros((TRIGRAMS + SCRIPTS, len(languages)))
    column = np.array([languages.index(x) for x in met], dtype=np.int64)
    if languages:
        table[cells["cell"].to_numpy(), column[named.indices.to_numpy()]] = cells["n"].to_numpy()
    grams, scripts = table[:TRIGRAMS], table[TRIGRAMS:]
    scores = np.log((grams + SMOOTH) / (grams.sum(0) + SMOOTH * TRIGRAMS)) if languages else grams
    allowed = np.where(scripts >= 0.001 * scripts.sum(0), 0.0, -1e4)
    allowed[(allowed < 0).all(1)] = 0.0  # a script that no language is written in excludes none
    return Model(languages, scores.astype(np.float32), allowed.astype(np.float32))


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best state per word for all texts at once: step ``t`` handles word ``t`` of every text that has one."""
    size = np.diff(first)
    by_size = np.argsort(-size, kind="stable")
    begin, size = first[:-1][by_size], size[by_size]
    steps = int(size[0]) if len(size) else 0
    states = scores.shape[1]
    if states > np.iinfo(np.int16).max:
        raise ValueError("more languages than back pointers can name")
    path = np.zeros(len(scores), dtype=np.int64)
    if not steps:
        return path
    alive = np.searchsorted(-size, -np.arange(steps), side="left")  # how many texts have more than t words
    came = np.zeros(scores.shape, dtype=np.int16)
    own = np.arange(states, dtype=np.int16)
    value = scores[begin[: alive[0]]].copy()
    last = np.zeros(len(begin), dtype=np.int64)
    for t in range(1, steps):
        k = alive[t]
        if k < len(value):
            last[k : len(value)] = value[k:].argmax(1)
            value = value[:k]
        at = begin[:k] + t
        top = value.argmax(1)
        switch = value[np.arange(k), top][:, None] - penalty
        stay = value >= switch
        came[at] = np.where(stay, own, top[:, None])
        value = np.where(stay, value, switch) + scores[at]
    last[: len(value)] = value.argmax(1)
    state = last
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        path[at] = state[:k]
        state[:k] = came[at, state[:k]] if t else state[:k]
    return path


def predict_batch(texts: pa.Array, model: Model, penalty: float) -> tuple[list[str], np.ndarray]:
    found = letters_of(texts)
    states = len(model.languages)
    share = np.zeros((len(texts), max(states, 1)))
    if states and len(found.start):
        sums = np.zeros((len(found.codes) + 1, states), dtype=np.float32)
        inside = model.scores[found.codes]
        edges = np.empty(2 * len(found.start), dtype=np.int64)
        edges[0::2], edges[1::2] = found.start, found.end
        sums = np.add.reduceat(inside, edges, axis=0)[0::2] + model.allowed[found.script]
        path = best_path(sums, found.first, penalty)
        np.add.at(share, (found.doc, path), found.letters)
    total = share.sum(1)
    best = share.argmax(1)
    plain = texts.to_pylist()
    known = [bool(states) and total[i] > 0 and bool(LETTER.search(plain[i])) for i in range(len(plain))]
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
    score = np.where(known, share[np.arange(len(best)), best] / np.maximum(total, 1), 0.0)
    return names, score


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", penalty: float = 12.0) -> DataFrame:
    """Per row: the id, ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 65,536 x languages x 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text", SLICE_BYTES) for b in batches):
            names, score = predict_batch(as_texts(batch.column(1)), shared.value, penalty)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], [doc_id, "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{doc_id}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.35, text: str = "text", penalty: float = 12.0) -> DataFrame:
    """Rows of ``docs``, all columns, whose text has a language with at least ``least`` of its letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, text, SLICE_BYTES) for b in batches):
            names, score = predict_batch(as_texts(batch.column(at)), shared.value, penalty)
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, score)]))

    return docs.mapInArrow(run, docs.schema)
