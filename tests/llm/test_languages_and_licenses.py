"""Language ID against a plain version of the whole prediction, many languages, rare ones; licences under other line wrapping."""

from __future__ import annotations

import random
import re
import textwrap
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import language_id, licenses
from tallyhawk.llm.words import as_texts


def test_back_pointers_name_three_hundred_languages():
    draw = np.random.default_rng(2)
    scores = draw.normal(size=(40, 300)).astype(np.float32) * 4
    path = language_id.best_path(scores, np.array([0, 40]), 3.0)
    best = scores[0].astype(np.float64)
    came = []
    for row in scores[1:]:
        top = best.argmax()
        came.append(np.where(best >= best[top] - 3.0, np.arange(300), top))
        best = np.maximum(best, best[top] - 3.0) + row
    state = [int(best.argmax())]
    for back in reversed(came):
        state.append(int(back[state[-1]]))
    assert path.tolist() == state[::-1] and path.min() >= 0 and path.max() > 128


def test_words_are_letters_and_scripts_go_by_code_point():
    text = "«привет» — мир 😀 ok naïve 漢字かな ไทย हिन्दी x1y"
    found = language_id.letters_of(as_texts(pa.array([text, None, "B"])))
    flat = "\0" + text + "\0\0B\0"
    words = [flat[a:b] for a, b in zip(found.start, found.end)]
    assert words == ["привет", "мир", "ok", "naïve", "漢字かな", "ไทย", "हिन्दी", "x", "y", "B"]
    names = ["latin", *language_id.SCRIPT_RANGES]
    assert [names[s] for s in found.script] == ["cyrillic", "cyrillic", "latin", "latin", "han", "thai", "devanagari", "latin", "latin", "latin"]
    assert found.letters.tolist() == [len(w) for w in words] and found.doc.tolist() == [0] * 9 + [2]


def plain_prediction(text, model, penalty):
    """The whole prediction word by word, with Python loops."""
    fold, scripts = language_id.tables()
    folded = [0] + [int(fold[ord(c)]) for c in text] + [0]
    words, at = [], 1
    while at <= len(text):
        end = at
        while folded[end]:
            end += 1
        if end > at:
            words.append((at, end))
        at = end + 1
    if not words:
        return "und", 0.0
    rows = []
    for low, high in words:
        total = np.zeros(len(model.languages))
        for i in range(low, high):
            code = (folded[i - 1] * 0x10001 + folded[i] * 0x9E3779B1 + folded[i + 1] * 0x85EBCA77) % 2**32
            code = ((code ^ (code >> 15)) * 0x2C1B3C6D % 2**32) >> 16
            total += model.scores[code]
        rows.append(total + model.allowed[scripts[ord(text[low - 1])]])
    best, paths = rows[0], [[k] for k in range(len(model.languages))]
    for row in rows[1:]:
        top = int(best.argmax())
        keep = best >= best[top] - penalty
        paths = [[*(paths[k] if keep[k] else paths[top]), k] for k in range(len(best))]
        best = np.where(keep, best, best[top] - penalty) + row
    path = paths[int(best.argmax())]
    share = np.zeros(len(model.languages))
    for (low, high), k in zip(words, path):
        share[k] += high - low
    return model.languages[int(share.argmax())], share.max() / share.sum()


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    sounds = {"aa": "ba be bi", "bb": "dú fó gé", "cc": "па бо ки", "dd": "mo na ru"}
    made = {k: [a + b for a in v.split() for b in v.split()] for k, v in sounds.items()}
    return [(i, " ".join(draw.choice(made[lang]) for _ in range(draw.randrange(1, 30))), lang)
            for i, lang in enumerate(draw.choice(list(made)) for _ in range(400))], made


def test_prediction_equals_a_plain_version(spark, rows):
    table, made = rows
    model = language_id.train(spark.createDataFrame(table, "doc_id long, text string, lang string"))
    draw = random.Random(7)
    texts = ["", "1 2 !", "x", "ba", "ÀÉ па"] + [
        " ".join(draw.choice(made[lang]).upper() if draw.random() < 0.1 else draw.choice(made[lang]) for lang in draw.choices(list(made), k=3) for _ in range(draw.randrange(9)))
        for _ in range(80)
    ]
    names, score = language_id.predict_batch(as_texts(pa.array([*texts, None])), model, 12.0)
    want = [plain_prediction(t, model, 12.0) for t in [*texts, ""]]
    assert names == [n for n, _ in want]
    assert score.tolist() == pytest.approx([s for _, s in want])


def test_a_rare_language_is_learned_among_many_rows(spark, rows):
    table, made = rows
    common = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit(" ".join(made["aa"])).alias("text"), F.lit("aa").alias("lang"))
    rare = spark.createDataFrame([(10**6 + i, " ".join(made["cc"]), "cc") for i in range(3)], common.schema)
    model = language_id.train(common.unionByName(rare), most_rows=200)
    assert model.languages == ["aa", "cc"]
    assert language_id.predict_batch(as_texts(pa.array([" ".join(made["cc"])])), model, 12.0)[0] == ["cc"]


def test_equal_languages_go_to_the_first_by_name(spark):
    df = spark.createDataFrame([(1, "same words", "bb"), (2, "same words", "aa"), (2, "same words", "aa"), (1, "same words", "bb")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id.predict(df, language_id.train(df)).collect()} == {"aa"}


# texts whose paragraphs don't join a copyright line with something else when they are refilled
REFILLED = ["0BSD", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Zlib", "Unlicense"]


def refilled(text, width):
    return "\n\n".join(textwrap.fill(re.sub(r"\s+", " ", p), width) for p in re.split(r"\n\s*\n", text.strip()))


def test_licenses_are_found_under_any_wrapping(spark):
    rows = [(f"{name}@{width}", refilled("Copyright (c) 2021 A. Holder\n\n" + licenses.KNOWN[name], width)) for name in REFILLED for width in range(60, 101)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string"), licenses.known_licenses(spark)).collect()
    assert [r.doc_id for r in got if r.license_id != r.doc_id.split("@")[0]] == [] and len(got) == len(rows)


def test_spellings_side_by_side_and_copyright_in_a_sentence(spark):
    rows = [(1, "licence licence licence"), (2, "license License, license"), (3, "the above\ncopyright notice"), (4, "the above copyright notice"),
            (5, "(c) You must retain"), (6, "You must retain"), (7, "© 2020 X\ntext"), (8, "text"), (9, "noncommercial licence"), (10, "non-commercial license")]
    got = {r.doc_id: r.canonical_sha256 for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string"), licenses.known_licenses(spark)).collect()}
    assert got[1] == got[2] and got[3] == got[4] and got[5] != got[6] and got[7] == got[8] and got[9] == got[10]


def test_an_empty_registry_and_null_ids(spark):
    docs = spark.createDataFrame([(1, licenses.KNOWN["MIT"]), (None, licenses.KNOWN["MIT"])], "doc_id int, text string")
    nothing = spark.createDataFrame([], "license_id string, text string")
    assert {r.license_id for r in licenses.scan_licenses(docs, nothing).collect()} == {None}
    known = spark.createDataFrame([(None, licenses.KNOWN["MIT"]), ("m", licenses.KNOWN["MIT"]), ("n", None)], "license_id string, text string")
    assert [r.license_id for r in licenses.scan_licenses(docs, known).collect()] == ["m", "m"]
    assert unicodedata.category("ि") == "Mc"


def test_temporary_arrays_of_the_language_scan_stay_small():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tallyhawk.llm import language_id
    from tallyhawk.llm.words import as_texts, slices

    batch = pa.RecordBatch.from_pydict({"text": ["some words of a plain text " * 40] * 4000})
    model = language_id.Model(["a", "b", "c"], np.zeros((language_id.TRIGRAMS, 3), np.float32), np.zeros((language_id.SCRIPTS, 3), np.float32))
    language_id.tables()
    tracemalloc.start()
    rows = 0
    for part in slices(batch, "text", language_id.SLICE_BYTES):
        rows += len(language_id.predict_batch(as_texts(part.column(0)), model, 12.0)[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4000 and peak < 60e6
