"""Maximal periodic runs of words (repeated phrases, stuck generators) by internal pattern matching.

A run with smallest period q that is at least four periods long holds, within its first period, a block of 2^k <= q words that
begins at a multiple of 2^k, and the same block once more q words later. So the text is cut into such dyadic blocks for every k, and each
asks where it occurs among the 2^k places that begin 2^k to 2^(k + 1) words after it. The blocks equal to one another are an interval
of the suffix array, and the smallest place above a bound in an interval is a range successor query, answered by a wavelet
matrix over the array. Occurrences so close together form an arithmetic progression: one or two are tried as periods; of
three or more, whose step is the block's own period, only the one can be a smallest period that puts the ends of the
two stretches having that step on top of each other. What is tried is extended word by word to both sides, so every run
returned is exact and none is lost.

Most texts repeat nothing at such close range. In a run every three words in a row occur three times or more, so words outside
such places are taken out before the suffix array is built; no run can reach into them.

Words are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhawk.llm.words import as_texts, mix, slices, split_words

FEWEST_WORDS = 6
FEWEST_PERIODS = 4


class WaveletMatrix:
    """Range successor queries over an array of small non-negative integers, one bit of rank data and a half per entry and level."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.words, self.before, self.zeros = [], [], []
        n = len(values)
        for level in range(self.bits - 1, -1, -1):
            ones = ((values >> level) & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, dtype=np.uint8)
            part = np.packbits(ones, bitorder="little")
            packed[: len(part)] = part
            words = packed.view("<u8")
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(n - int(ones.sum()))
            values = np.concatenate([values[~ones], values[ones]])

    def _ones(self, level: int, place: np.ndarray) -> np.ndarray:
        """How many ones lie before each place."""
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        under = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(under).astype(np.int64)

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest value >= bound among entries [low, high) of each query, or -1."""
        order = self._below(low, high, bound)
        found = order < high - low
        result = np.full(len(low), -1, dtype=np.int64)
        result[found] = self._smallest(low[found], high[found], order[found])
        return result

    def _below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values under bound the entries [low, high) have."""
        total = np.where(bound >> self.bits > 0, high - low, 0)
        inside = bound >> self.bits == 0
        for level in range(self.bits):
            one_low, one_high = self._ones(level, low), self._ones(level, high)
            is_one = (bound >> (self.bits - 1 - level)) & 1 == 1
            zero_low, zero_high = low - one_low, high - one_high
            total += np.where(is_one & inside, zero_high - zero_low, 0)
            low = np.where(is_one, self.zeros[level] + one_low, zero_low)
            high = np.where(is_one, self.zeros[level] + one_high, zero_high)
        return total

    def _smallest(self, low: np.ndarray, high: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The value that has ``order`` smaller ones before it among entries [low, high)."""
        value = np.zeros(len(low), dtype=np.int64)
        for level in range(self.bits):
            one_low, one_high = self._ones(level, low), self._ones(level, high)
            zero_low, zero_high = low - one_low, high - one_high
            is_one = order >= zero_high - zero_low
            order = np.where(is_one, order - (zero_high - zero_low), order)
            value |= is_one.astype(np.int64) << (self.bits - 1 - level)
            low = np.where(is_one, self.zeros[level] + one_low, zero_low)
            high = np.where(is_one, self.zeros[level] + one_high, zero_high)
        return value


def dyadic_intervals(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array by prefix doubling, sorted by as many words as ``longest`` asks for, and for each block length 2^k
    (length, places, low, high): the repeated blocks and their intervals of the array."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    length, found = 1, []
    while True:
        sorted_rank = rank[order]
        blocks = np.arange(0, n, length)
        low = np.searchsorted(sorted_rank, rank[blocks], "left")
        high = np.searchsorted(sorted_rank, rank[blocks], "right")
        again = high - low > 1
        if not again.any():
            break
        found.append((length, blocks[again], low[again], high[again]))
        if 2 * length > longest:
            break
        follow = np.zeros(n, dtype=np.int64)
        follow[:-length] = rank[length:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = steps
        length *= 2
    return order, found


def stretches(symbols: np.ndarray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query the longest stretch [start, end) around ``place`` in which words ``period`` apart are equal, given that they are
    at ``place``. Queries in a stretch already measured cost nothing."""
    start, end = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    known_period, known_end, known_start = -1, -1, -1
    for k in np.lexsort((place, period)):
        p, q = int(place[k]), int(period[k])
        if q != known_period or p + q >= known_end:
            known_period = q
            known_end = p + q + _alike(symbols, p, p + q, 1)
            known_start = p - _alike(symbols, p - 1, p + q - 1, -1)
        start[k], end[k] = known_start, known_end
    return start, end


def _alike(symbols: np.ndarray, first: int, second: int, step: int) -> int:
    """How many words from ``first`` on equal those from ``second`` on, going by ``step``; second > first."""
    n, total, chunk = len(symbols), 0, 64
    while True:
        size = min(chunk, n - second if step > 0 else first + 1)
        if size <= 0:
            return total
        if step > 0:
            differ = symbols[first : first + size] != symbols[second : second + size]
        else:
            differ = (symbols[first - size + 1 : first + 1] != symbols[second - size + 1 : second + 1])[::-1]
        if differ.any():
            return total + int(differ.argmax())
        total, first, second, chunk = total + size, first + step * size, second + step * size, min(4 * chunk, 1 << 20)


def find_runs(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs, by start, of which none is longer than ``longest`` words."""
    none = np.zeros(0, dtype=np.int64)
    if len(symbols) < FEWEST_WORDS:
        return none, none, none
    array, found = dyadic_intervals(symbols, longest // FEWEST_PERIODS)
    if not found:
        return none, none, none
    length = np.concatenate([np.full(len(x[1]), x[0], dtype=np.int64) for x in found])
    block, low, high = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in (1, 2, 3))
    tree = WaveletMatrix(array.astype(np.int64))
    limit = block + 2 * length

    def next_from(which: np.ndarray, bound: np.ndarray) -> np.ndarray:
        place = tree.successor(low[which], high[which], bound)
        return np.where(place < limit[which], place, -1)

    every = np.arange(len(block))
    first = next_from(every, block + length)
    met = every[first >= 0]
    first = first[met]
    second = next_from(met, first + 1)
    third = np.full(len(met), -1, dtype=np.int64)
    two = second >= 0
    third[two] = next_from(met[two], second[two] + 1)
    many = third >= 0
    places = [block[met[~many]], block[met[two & ~many]]]
    periods = [first[~many] - places[0], second[two & ~many] - places[1]]
    if many.any():
        step = second[many] - first[many]
        # the stretch having that step around the block itself is known only if the step is a period of the block, which it is
        _, end_here = stretches(symbols, block[met[many]], step)
        _, end_there = stretches(symbols, first[many], step)
        places.append(block[met[many]])
        periods.append(end_there - end_here)
    place, period = np.concatenate(places), np.concatenate(periods)
    real = (period > 0) & (place + period < len(symbols))
    place, period = place[real], period[real]
    real = symbols[place] == symbols[place + period]
    place, period = place[real], period[real]
    start, end = stretches(symbols, place, period)
    enough = end - start >= np.maximum(FEWEST_WORDS, FEWEST_PERIODS * period)
    start, end, period = start[enough], end[enough], period[enough]
    # multiples of the smallest period give the same stretch
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    return start[new], end[new], period[new]


def _close_repeats(symbols: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that may be in a run: where four or more places in a row begin three words that their text has three times or more.
    Gives their places, and the number of the stretch that each is in."""
    n = len(symbols)
    if n < FEWEST_WORDS:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    salted = mix(symbols + mix(doc.astype(np.uint64) + np.uint64(11)))
    three = mix(mix(salted[:-2] + np.uint64(1)) + salted[1:-1] * np.uint64(3)) + salted[2:]
    _, inverse, counts = np.unique(three, return_inverse=True, return_counts=True)
    often = np.zeros(n, dtype=bool)
    often[:-2] = (counts[inverse] >= 3) & (doc[:-2] == doc[2:])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= FEWEST_WORDS - 2
    begin, end = begin[long], end[long] + 2
    size = end - begin
    offset = np.cumsum(size) - size
    place = np.repeat(begin - offset, size) + np.arange(int(size.sum()))
    return place, np.repeat(np.arange(len(begin)), size)


def runs_by_doc(symbols: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, start, length, period) of all runs, by doc, start and period; start counts the words of the doc from 0."""
    place, part = _close_repeats(symbols, doc)
    none = np.zeros(0, dtype=np.int64)
    if not len(place):
        return none, none, none, none
    # a word found nowhere else stands between two stretches, so that no run crosses
    wide = place + 0
    row = np.arange(len(place)) + part
    codes = np.unique(symbols[place], return_inverse=True)[1].astype(np.int64)
    filled = np.empty(int(row[-1]) + 1, dtype=np.int64)
    gaps = np.ones(len(filled), dtype=bool)
    gaps[row] = False
    filled[row] = codes
    filled[gaps] = len(codes) + np.arange(int(gaps.sum()))
    back = np.full(len(filled), -1, dtype=np.int64)
    back[row] = wide
    start, end, period = find_runs(filled, int(np.bincount(part).max()))
    at = back[start]
    of = doc[at]
    order = np.lexsort((period, at))
    of, at, length, period = of[order], at[order], (end - start)[order], period[order]
    return of, at - first[of], length, period


def planted(ids: list, counts: np.ndarray) -> list[tuple[int, int] | None]:
    """By id, where (a) and with which step (p) a text's words are made periodic: word i >= a becomes word a + (i - a) % p."""
    made = []
    for doc_id, n in zip(ids, counts):
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        n = int(n)
        if h is None or h % 10 or not n:
            made.append(None)
        else:
            g = h // 10
            a = g % n
            made.append((a, 1 + (n - a) // (3 + g % 8)))
    return made


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def measure(ids: pa.Array, texts: pa.Array, plant: bool) -> dict[str, list]:
    words = split_words(texts)
    counts = np.diff(words.first)
    changes = planted(ids.to_pylist(), counts) if plant else [None] * len(counts)
    source = np.arange(len(words.doc))
    for d, change in enumerate(changes):
        if change:
            a, p = change
            low, high = int(words.first[d]) + a, int(words.first[d + 1])
            source[low:high] = low + np.arange(high - low) % p
    symbols = words.hashes()[source]
    of, start, length, period = runs_by_doc(symbols, words.doc, words.first)
    cut = np.searchsorted(of, np.arange(len(counts) + 1))
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
    out: dict[str, list] = {k: [] for k in names}
    data = words.data.tobytes()
    for d, change in enumerate(changes):
        own = [(int(start[k]), int(length[k]), int(period[k])) for k in range(cut[d], cut[d + 1])]
        own.sort(key=lambda r: (r[0], r[2]))
        text = data[int(words.offsets[d]) : int(words.offsets[d + 1])].split()
        if change:
            a, p = change
            text = text[:a] + [text[a + (i - a) % p] for i in range(a, len(text))]
        best = None
        for run in own:
            # length / period as fractions, without rounding
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        if own:
            marks = np.zeros(len(text) + 1, dtype=np.int64)
            for s, n, q in own:
                marks[s + q] += 1
                marks[s + n] -= 1
            gone = np.cumsum(marks)[:-1] > 0
            text = [w for w, x in zip(text, gone.tolist()) if not x]
        joined = b" ".join(text)
        out["n_runs"].append(len(own))
        for k, name in enumerate(["start", "length", "period"]):
            out[name].append(best[k] if best else None)
        out["exponent_milli"].append(1000 * best[1] // best[2] if best else None)
        out["runs_sha256"].append(_sha("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()))
        out["collapsed_sha256"].append(_sha(joined))
        out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in own])
        out["collapsed"].append(joined.decode())
    return out


DIGEST_TYPES = {
    "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(),
    "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
}
FULL_TYPES = {
    "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
    "collapsed": pa.large_string(),
}


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False, full: bool = True) -> DataFrame:
    """Per row of ``docs``: the id, how many runs its text has, the one with the greatest length / period (ties: smallest start,
    then period; four nulls without a run), digests of all runs and of the text without what repeats, and with ``full`` the runs and
    that text themselves. ``plant`` first makes the texts of some ids periodic (``planted``).

    A null text counts as empty and has no words; a null id is kept and never planted. Repeated rows and ids each give their own
    row; other columns are not read, so their names can't clash. An empty table gives an empty one. A text's whole
    words are read in one task, with up to some 600 bytes of memory a word in the parts that repeat closely and 200 elsewhere.
    """
    types = DIGEST_TYPES | (FULL_TYPES if full else {})
    kinds = {"n_runs": "long", "start": "long", "length": "long", "period": "long", "exponent_milli": "long",
             "runs_sha256": "string", "collapsed_sha256": "string",
             "runs": "array<struct<start: long, length: long, period: long>>", "collapsed": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            found = measure(batch.column(0), as_texts(batch.column(1)), plant)
            arrays = [pa.array(found[k], kind) for k, kind in types.items()]
            arrays = [x.cast(pa.string()) if pa.types.is_large_string(x.type) else x for x in arrays]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [doc_id, *types])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{doc_id}` {kind}, " + ", ".join(f"{k} {kinds[k]}" for k in types))
