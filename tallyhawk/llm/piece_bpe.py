"""Encoding and decoding for BPE models of the sentencepiece kind, by backtracking.

A text falls apart before every word mark that follows something else, since no piece has a mark inside, and between letters and
other characters if no piece joins them. Within such a chunk an Aho-Corasick automaton over reversed pieces finds the longest piece that starts at each
place. Pieces are taken greedily; a neighbour is compatible if merging the two from single characters again gives just these two,
which their last merges decide; a place from which nothing worked is marked in a bit field and not tried again. Chunks met before
cost one lookup; of two generations of remembered chunks the older goes when the younger is full, so what recurs stays.

Pieces of equal score (runs of the word mark) leave the pair rule undecided, so a chunk with two marks in a row is merged
directly. Characters without a piece become byte pieces. Null texts count as empty; an empty text has the end id only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain, groupby, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhawk.llm.words import as_texts, slices

MARK = "▁"
KEPT_CHUNKS = 300_000
KEPT_PAIRS = 500_000
LONG_RUN = 256
NEVER = float("-inf")
_loaded: dict[str, PieceBpe] = {}


class PieceBpe(dict):
    """Maps a chunk to (its ids as text, how many, its decoded form)."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.ends = str(model.eos_id())
        everything = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(i) for i in everything]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in everything if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        plain = [i for i in everything if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.control = {i for i in everything if model.is_control(i)}
        self.id_of = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("pieces with a word mark inside are not supported")
        self.known = {c for p in self.id_of for c in p}
        self.reversed = ahocorasick.Automaton()
        for piece in self.id_of:
            self.reversed.add_word(piece[::-1], piece)
        self.reversed.make_automaton()
        self.special = self.control | self.byte_of.keys()
        self.shorter = {p: self.next_shorter(p) for p in self.id_of}
        self.fits: dict[tuple[str, str], bool] = {}
        self.older: dict[str, tuple[str, int, str]] = {}
        # letters, and all else; numerals that are no digits (superscripts and the like) are no letters
        numerals = "".join(re.escape(c) for c in sorted(self.known) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
        by_kind = re.compile(f"{MARK}*(?:[^\\W\\d_{numerals}]+|(?:[^\\w{MARK}]|[\\d_{numerals}])+)|{MARK}+")
        self.by_kind = by_kind if all(by_kind.fullmatch(p) for p in self.id_of) else None
        # the order in which merges are made, and the two pieces that the last merge of each joins
        self.rank = {p: i for i, p in enumerate(sorted(self.id_of, key=self.score.get, reverse=True))}
        self.halves = {p: found for p in self.id_of if len(p) > 1 and (found := self.last_merge(p))}

    def next_shorter(self, piece: str) -> str:
        """The longest piece that ``piece`` goes on from; empty if there is none."""
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id_of), "")

    def merge(self, text: str) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, from single characters on."""
        if len(text) > LONG_RUN:
            return self.merge_long(text)
        parts, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in pairwise(parts)]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NEVER)
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NEVER)
        return parts

    def merge_long(self, text: str) -> list[str]:
        """The same with a heap of pairs and a linked list of parts, for runs where a scan for each merge would be too much."""
        size = len(text)
        parts, before, after = list(text), list(range(-1, size - 1)), [*range(1, size), -1]
        pairs: list[tuple[float, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                both = parts[left] + parts[right]
                if both in self.score:
                    heappush(pairs, (-self.score[both], left, both))

        for at in range(size - 1):
            offer(at, at + 1)
        while pairs:
            _, left, both = heappop(pairs)
            right = after[left]
            if right < 0 or not parts[left] or parts[left] + parts[right] != both:
                continue  # one of the two is part of something else by now
            parts[left], parts[right] = both, ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that ``piece`` is made of last when its characters are merged; None if they don't come to it."""
        whole = self.score[piece]
        for n in range(1, len(piece)):
            left, right = piece[:n], piece[n:]
            if left in self.score and right in self.score and self.merge_below(piece, whole) == [left, right]:
                return left, right
        return None

    def merge_below(self, text: str, end: float) -> list[str]:
        """The parts of ``text`` when only two are left, or nothing merges any more."""
        parts, score = list(text), self.score.get
        while len(parts) > 2:
            scores = [score(a + b, NEVER) for a, b in pairwise(parts)]
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            self.fits[left, right] = found = self.stay_apart(left, right)
        return found

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` from characters on gives just these two.

        Merges are taken back from the later to the earlier, of the left piece at its right edge and of the right piece at its left edge. Two
        parts that meet at the border are there together until the merge taken back last; they would have become one if theirs comes before.
        Of equal merges the left one is made first.
        """
        rank, halves = self.rank, self.halves
        if (len(left) > 1 and left not in halves) or (len(right) > 1 and right not in halves):
            return False
        limit = len(rank)
        while True:
            if rank.get(left + right, limit) < limit:
                return False
            a = rank[left] if len(left) > 1 else -1
            b = rank[right] if len(right) > 1 else -1
            if a > b:
                limit, left = a, halves[left][1]
            elif b >= 0:
                limit, right = b + 1, halves[right][0]
            else:
                return True

    def split(self, text: str) -> list[str]:
        """Pieces of a run of known characters."""
        size = len(text)
        # the automaton names the longest match at a place first, so that it is the last one to be put in the dictionary
        longest = dict(reversed(list(self.reversed.iter(text[::-1]))))
        shorter, fits = self.shorter, self.fits
        taken: list[str] = []
        dead = None  # a bit for each place from which nothing worked
        at, piece = 0, longest.get(size - 1, "")
        while at < size:
            while piece:
                to = at + len(piece)
                if not (dead and dead[to >> 3] >> (to & 7) & 1):
                    if not taken:
                        break
                    fit = fits.get((taken[-1], piece))
                    if self.compatible(taken[-1], piece) if fit is None else fit:
                        break
                piece = shorter[piece]
            if piece:
                taken.append(piece)
                at += len(piece)
                piece = longest.get(size - 1 - at, "")
            elif taken:
                dead = dead or bytearray((size >> 3) + 1)
                dead[at >> 3] |= 1 << (at & 7)
                last = taken.pop()
                at -= len(last)
                piece = shorter[last]
            else:
                return self.merge(text)  # only for a model whose pieces cannot all be reached by merges
        return taken

    def pieces_of(self, run: str) -> list[str]:
        """Pieces of a run of known characters, also of one where scores are equal."""
        return self.merge(run) if MARK * 2 in run else self.split(run)

    def chunk_ids(self, chunk: str) -> list[int]:
        if self.known.issuperset(chunk):
            runs = [(True, chunk)]
        else:
            runs = [(known, "".join(run)) for known, run in groupby(chunk, self.known.__contains__)]
        ids: list[int] = []
        for known, run in runs:
            if known:
                for piece in self.pieces_of(run):
                    ids += [self.id_of[piece]] if piece in self.id_of else self.fallback(piece)
            else:
                ids += self.fallback(run)
        return ids

    def fallback(self, run: str) -> list[int]:
        return [self.bytes[b] for b in run.encode()]

    def surface(self, ids: list[int]) -> str:
        """The text of ids, with word marks as spaces."""
        if self.special.isdisjoint(ids):
            return "".join([self.pieces[i] for i in ids]).replace(MARK, " ")
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.control:
                out.append(self.pieces[i])
        return "".join([*out, raw.decode("utf-8", "replace")]).replace(MARK, " ")

    def __missing__(self, chunk: str) -> tuple[str, int, str]:
        found = self.older.get(chunk)
        if found is None:
            ids = self.chunk_ids(chunk)
            # pieces of known characters spell the chunk
            spelt = chunk.replace(MARK, " ") if self.special.isdisjoint(ids) else self.surface(ids)
            found = " ".join(map(str, ids)), len(ids), spelt
        if len(chunk) < 64:
            if len(self) >= KEPT_CHUNKS:
                self.older = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def chunks(self, text: str) -> list[str]:
        """``text`` with marks for spaces and one more in front, cut before each mark that follows something else and, if pieces allow it,
        where letters and other characters meet."""
        if not text:
            return []
        text = text.replace(" ", MARK)
        if self.by_kind:
            return self.by_kind.findall(MARK + text)
        out, marks = [], 1
        for piece in text.split(MARK):
            if piece:
                out.append(MARK * marks + piece)
                marks = 1
            else:
                marks += 1
        return out if marks == 1 else [*out, MARK * (marks - 1)]

    def encode(self, text: str) -> list[int]:
        """Ids without the end id."""
        return [int(i) for c in self.chunks(text) for i in self[c][0].split()]

    def decode(self, ids: list[int]) -> str:
        return self.surface(ids).removeprefix(" ")


def piece_bpe(model_file: str) -> PieceBpe:
    """One per worker process."""
    if model_file not in _loaded:
        _loaded[model_file] = PieceBpe(model_file)
    return _loaded[model_file]


def encode_texts(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``ids`` (decimal, one space between, end id last), ``n_tokens`` and ``decoded``."""
    return _mapped(docs, model_file, doc_id, text, False)


def encoding_digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_texts`` with SHA-256 digests in place of ids and text: ``ids_sha256``, ``decoded_sha256``."""
    return _mapped(docs, model_file, doc_id, text, True)


def _mapped(docs: DataFrame, model_file: str, doc_id: str, text: str, digests: bool) -> DataFrame:
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
    shown = (lambda s: hashlib.sha256(s.encode()).hexdigest()) if digests else (lambda s: s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(model_file)
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            counts, ids, decoded = [], [], []
            for t in as_texts(batch.column(1)).to_pylist():
                known, n, spelt = zip(*map(bpe.__getitem__, bpe.chunks(t))) if t else ((), (), ())
                counts.append(sum(n) + 1)
                ids.append(shown(" ".join([*known, bpe.ends])))
                decoded.append(shown("".join(spelt).removeprefix(" ")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)], [doc_id, *names])

    rows = docs.select(F.col(doc_id), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"`{doc_id}` {kind}, n_tokens long, {names[1]} string, {names[2]} string")
