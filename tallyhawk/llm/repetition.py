"""Quality rules over repeated substrings of words, from suffix arrays.

The words of a batch of texts form one sequence whose symbols carry their text, so that no match leaves a text. Prefix
doubling sorts the suffixes, going on only with those not yet told apart. It notes in one byte per sorted place at which level
its group parted from the one before, which is all that the longest common prefixes of neighbours need: the groups of a level are
the running count of places parted by then. Memory is so many bytes per word, however much repeats. Runs of neighbours with a common prefix of ``m`` words or more are the intervals of the maximal
repeated substrings of that length; the spans they cover are united.

A text fails the base rules with fewer than 20 words or more than 30% of words in repeated windows of 8 words. Otherwise it
is kept unless maximal repeats of ``min_words`` or more cover more than ``covered_pct`` percent, or the longest repeat has
more than ``longest_words`` words and more than ``longest_pct`` percent of the text's words.
Null, empty and blank texts have no words and fail. Repeated rows give repeated results; extra columns are not read, so their names
may clash. Null and repeated ids are returned as they are. An empty table gives an empty one. A text is never cut: a very long one
is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhawk.llm.words import Words, as_texts, lookup, mix, slices, split_words

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEWEST_WORDS = 20
REPEAT_PCT = 30
_BLANK = " \t\n\x0b\x0c\r"
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_LATER_BYTE = (np.arange(256) & 0xC0) == 0x80


def repeat_lengths(symbols: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest substring from there that also begins at another place."""
    n = len(symbols)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    kind = np.int32 if n < 1 << 30 else np.int64
    order = np.argsort(symbols, kind="stable").astype(kind)
    symbols = symbols[order]
    new = np.concatenate([[True], symbols[1:] != symbols[:-1]])
    del symbols
    # the level, or -1, at which a sorted place became the first of its group: groups of level k share 2^k symbols
    born = np.where(new, 0, -1).astype(np.int8)
    # a rank is the first place of its group in the sorted order; -1 lies after the end
    rank = np.empty(n + 1, dtype=kind)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=kind), 0))
    rank[n] = -1
    level = 0
    while True:
        unsure = born < 0
        unsure[:-1] |= unsure[1:].copy()
        at = np.flatnonzero(unsure).astype(kind)
        if not len(at):
            break
        active = order[at]
        key = rank[active].astype(np.int64)
        key *= n + 2
        key += rank[np.minimum(active + (1 << level), n)]
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        del by
        order[at] = active
        first = np.concatenate([[True], key[1:] != key[:-1]])
        del key
        level += 1
        starts = at[first]
        born[starts[born[starts] < 0]] = level
        rank[active] = at[np.maximum.accumulate(np.where(first, np.arange(len(at), dtype=kind), 0))]
    pairs = np.flatnonzero(born[1:])
    left, right = order[pairs], order[pairs + 1]
    del order, pairs
    a, b = left.copy(), right.copy()
    common = np.zeros(len(left), dtype=kind)
    for k in range(level - 1, -1, -1):
        group = np.cumsum(born <= k, dtype=kind)[rank[:n]]
        same = (a < n) & (b < n)
        same &= group[np.minimum(a, n - 1)] == group[np.minimum(b, n - 1)]
        gain = same.astype(kind) << k
        common += gain
        a, b = np.minimum(a + gain, n), np.minimum(b + gain, n)
    longest = np.zeros(n, dtype=kind)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which places lie in the union of the repeats of ``least`` words or more."""
    change = np.zeros(len(lengths) + 1, dtype=np.int64)
    begin = np.flatnonzero(lengths >= least)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + lengths[begin], -1)
    return np.cumsum(change)[:-1] > 0


def per_doc(words: Words, values: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[words.first])


def marked_bytes(words: Words, marked: np.ndarray) -> np.ndarray:
    """Per text how many of its bytes are of the ``marked`` kinds."""
    hit = lookup(marked, words.data)
    bounds = words.offsets.tolist()
    return np.array([np.count_nonzero(hit[low:high]) for low, high in zip(bounds[:-1], bounds[1:])], dtype=np.int64)


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines))


def measure(texts: pa.Array, min_words: int) -> dict[str, np.ndarray]:
    words = split_words(texts)
    of_text = mix(np.arange(len(texts), dtype=np.uint64) + np.uint64(7))
    lengths = repeat_lengths(mix(words.hashes() + of_text[words.doc]))
    longest = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(longest, words.doc, lengths)
    return {
        "n_words": np.diff(words.first).astype(np.int64),
        # only the first byte of a code point counts; the others are never blanks, so they lie in words
        "word_chars": per_doc(words, words.end - words.start) - marked_bytes(words, _LATER_BYTE),
        "n_symbols": marked_bytes(words, _IS_SYMBOL),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts.to_pylist()], dtype=np.int64),
        "n_repeat_words": per_doc(words, covered(lengths, WINDOW)),
        "covered_words": per_doc(words, covered(lengths, min_words)),
        "longest_repeat": longest,
    }


def repetition_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_words: int = 6, covered_pct: int = 30, longest_words: int = 50, longest_pct: int = 15,
) -> DataFrame:
    """Per row: the id, the measures, ``base_failed`` and ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            found = measure(as_texts(batch.column(1)), min_words)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.values())], [doc_id, *found])

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"))
    measured = rows.mapInArrow(run, f"`{doc_id}` {kind}, " + ", ".join(f"{c} long" for c in names))
    n = F.col("n_words")
    failed = (n < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PCT * n)
    much = 100 * F.col("covered_words") > covered_pct * n
    long = (F.col("longest_repeat") > longest_words) & (100 * F.col("longest_repeat") > longest_pct * n)
    return measured.withColumns({"base_failed": failed, "kept": ~(failed | much | long)})
