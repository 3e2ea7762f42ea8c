"""Vector near duplicates, vector codes and periodic runs against brute force, with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallyhawk.llm import near_vectors, periodic_runs, vector_codes
from tallyhawk.llm.words import as_texts

VECTORS = "vec_id long, embedding array<double>, label int, code string, n_links string, g string, id string, cell string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def vector_table(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(*r, "c", "l", "g", "i", "e") for r in rows], schema)


def sample_vectors(seed, n=220, dims=20):
    """Around a few directions at cosines on both sides of 0.98, with copies, scaled copies and unusable rows."""
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, dims))
    rows = []
    for k in range(n):
        v = centres[k % 6] / np.linalg.norm(centres[k % 6]) + draw.standard_normal(dims) * draw.choice([0.005, 0.03, 0.3]) / math.sqrt(dims) * 4
        rows.append((k, (v * draw.choice([1.0, 7.5])).tolist(), int(k % 2)))
    rows += [(1000 + k, rows[0][1], 0) for k in range(40)] + [(2000, rows[0][1], 1), (2001, [x * 3 for x in rows[0][1]], 0)]
    rows += [(3000, None, 0), (3001, [0.0] * dims, 0), (3002, [math.nan] + [1.0] * (dims - 1), 0), (3003, [None] + [1.0] * (dims - 1), 0)]
    rows += [(3004, [math.inf] + [1.0] * (dims - 1), 0), (3005, rows[0][1], None), (3006, rows[0][1][:5], 0), (3007, [], 0), (5, rows[5][1], 1)]
    rows += [(None, rows[0][1], 0), (3008, [1e200] * dims, 0), (3009, [1e200] * dims, 0), (3010, [1e-200] * dims, 0)]
    return rows


def brute_links(rows, cosine):
    ok = [v is not None and len(v) > 0 and g is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, g in rows]
    units = [np.array(v) / max(map(abs, v)) if o else None for (_, v, _), o in zip(rows, ok)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
             and float(units[i] @ units[j]) >= cosine] for i in range(len(rows))]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        comp[i] = min(ids) if ids else None
    return sorted(((rows[i][0], len(near[i]), comp[i], rows[i][0] == comp[i]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("block,chunk", [(8, 2048), (4, 8), (3, 30)])
def test_near_vectors_equal_brute_force(spark, block, chunk):
    rows = sample_vectors(block)
    got = near_vectors.near_vectors(vector_table(spark, rows), block=block, chunk=chunk).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_links(rows, 0.98)


def test_near_vectors_at_other_thresholds_and_empty(spark):
    rows = sample_vectors(9, 90)
    for cosine in (0.6, 1.0):
        got = near_vectors.near_vectors(vector_table(spark, rows), cosine=cosine, chunk=16).collect()
        # at 1.0 rounding decides whether a scaled copy is still equal, so only the lower bound is compared there
        if cosine < 1:
            assert sorted((tuple(r) for r in got), key=repr) == brute_links(rows, cosine)
        else:
            assert len(got) == len(rows)
    nothing = near_vectors.near_vectors(vector_table(spark, []))
    assert nothing.count() == 0 and nothing.columns == ["vec_id", "n_links", "component_id", "kept"]
    with pytest.raises(ValueError):
        near_vectors.near_vectors(vector_table(spark, []), cosine=0)


def test_cells_hold_the_middle_of_every_near_pair():
    draw = np.random.default_rng(3)
    points = draw.uniform(-0.5, 0.5, (400, 4))
    others = points + draw.standard_normal((400, 4)) * 0.02
    radius = 0.07
    close = np.linalg.norm(points - others, axis=1) <= radius
    grid = np.full(400, 3)
    one, two = (set(zip(*(x.tolist() for x in near_vectors.cells(p, radius, grid)))) for p in (points, others))
    middle = near_vectors.cell_of((points + others) / 2, radius, 3)
    assert close.sum() > 50
    for k in np.flatnonzero(close):
        assert (k, middle[k]) in one and (k, middle[k]) in two


def brute_codes(rows, rounds=4):
    kept = [(i, g, [math.floor(1024 * x) for x in v]) for i, v, g in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = -(-len(kept[0][2]) // 4)
    parts = [[(v + [0] * 4)[k * width : (k + 1) * width] for _, _, v in kept] for k in range(4)]
    books = [p[:256] for p in parts]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)) for x in p] for p, book in zip(parts, books)]

    for _ in range(rounds):
        for k, near in enumerate(assign()):
            for e in range(len(books[k])):
                own = [x for x, (_, best) in zip(parts[k], near) if best == e]
                if own:
                    books[k] = [*books[k][:e], [sum(c) // len(own) for c in zip(*own)], *books[k][e + 1 :]]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(found[k][r][0] for k in range(4)) for r in range(len(kept))]
    by_label = {}
    for (_, g, _), error in zip(kept, errors):
        by_label[g] = by_label.get(g, 0) + error
    return sorted(((kept[r][0], "".join(f"{found[k][r][1]:02x}" for k in range(4)), errors[r], by_label[kept[r][1]], sha) for r in range(len(kept))), key=repr)


@pytest.mark.parametrize("dims,n", [(8, 300), (10, 40), (3, 60)])
def test_vector_codes_equal_brute_force(spark, dims, n):
    draw = random.Random(dims)
    rows = [(k, [draw.choice([-0.0007, 0.25, draw.uniform(-1, 1)]) for _ in range(dims)], draw.choice([None, 1, 2])) for k in range(n)]
    rows += [(5, rows[6][1], 1), (5, rows[5][1], 1), (None, rows[7][1], None), (900, None, 1), (901, [None] * dims, 1), (902, [math.inf] * dims, 1), (903, [1.0], 2)]
    rows += [(904, [], 1), (905, [math.nan] * dims, 1)]
    got = vector_codes.vector_codes(vector_table(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_codes(rows)


def test_vector_codes_without_rows_and_too_large(spark):
    for rows in ([], [(1, None, 1)]):
        assert vector_codes.vector_codes(vector_table(spark, rows)).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.vector_codes(vector_table(spark, [(1, [1e12] * 4, 1)])).collect()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 20), st.integers(1, 60), st.integers(1, 2000), st.integers(0, 10**6))
def test_nearest_is_exact_and_takes_the_lowest_index(width, entries, spread, seed):
    draw = np.random.default_rng(seed)
    rows, book = draw.integers(-spread, spread + 1, (50, width)), draw.integers(-spread, spread + 1, (entries, width))
    distances = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
    index, distance = vector_codes.nearest(rows, book)
    assert (index == distances.argmin(axis=1)).all() and (distance == distances.min(axis=1)).all()


def test_sequency_order_counts_sign_changes():
    matrix = vector_codes.walsh(np.eye(32, dtype=np.int64)).T
    assert (np.diff(matrix, axis=1) != 0).sum(axis=1).tolist() == list(range(32))


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(6, 4 * q) and end > at:
                found.setdefault((at, end + q), q)
            at = max(end, at) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 5)), max_size=6))
def test_runs_of_small_alphabets_equal_brute_force(pieces):
    words = [w for unit, times, extra in pieces for w in (unit * times + unit[:extra])]
    found = periodic_runs.measure(pa.array([1, 2]), as_texts(pa.array([" ".join(words), " ".join(words[::-1])])), False)
    for k, own in enumerate((words, words[::-1])):
        assert [(r["start"], r["length"], r["period"]) for r in found["runs"][k]] == brute_runs(own)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=90), st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90), st.integers(0, 70)), min_size=1, max_size=20))
def test_range_successor(values, queries):
    tree = periodic_runs.WaveletMatrix(np.array(values))
    low, high, bound = (np.array(x) for x in zip(*((min(a, b, len(values)), min(max(a, b), len(values)), c) for a, b, c in queries)))
    want = [min((v for v in values[a:b] if v >= c), default=-1) for a, b, c in zip(low, high, bound)]
    assert tree.successor(low, high, bound).tolist() == want


def test_periodic_runs_equal_brute_force_with_planted_tails(spark):
    draw = random.Random(4)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "x \x85 \x85 \x85 \x85 \x85 \x85 é", "A a A a A a A a", "ha " * 3000 + "b"]
    texts += [" ".join(draw.choice(["so it is", "no", "yes", "and then"]) for _ in range(draw.randrange(120))) for _ in range(60)]
    texts += [" ".join([draw.choice("abcdefgh") for _ in range(draw.randrange(1, 60))] * draw.randrange(1, 9)) for _ in range(60)]
    rows = [(i, t, "r", "e", "s") for i, t in enumerate(texts)] + [(8, texts[8], "r", "e", "s"), (None, "b " * 9, "r", "e", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_runs string, start string")
    got = periodic_runs.periodic_runs(docs, plant=True)
    want = [brute_row(i, t) for i, t, *_ in rows]
    assert sorted((tuple(r)[:8] for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and w[1] for i, w in enumerate(want))
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_periodic_runs_give_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "start " + "so it goes " * 5 + "end")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)] and row.collapsed == "start so it goes end" and row.exponent_milli == 5000
