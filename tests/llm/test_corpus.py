"""Registered corpus queries on a small table, and the pipeline against a brute-force version."""

from __future__ import annotations

import corpus_pipeline
from compare import differences, duck
from llm.test_operators import SECRET, byte_ids, check_packing, edited, jaccard_components, prose
from tallyhawk.llm import language_id, secrets
from tallyhawk.llm.queries import ORACLES, QUERIES

import pytest


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, small, name):
    assert differences(QUERIES[name](spark, small), duck(small), ORACLES[name]) is None


def test_held_out_accuracy(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    named = QUERIES["op10_language_id"](spark, small).filter("held_out").join(docs, "doc_id")
    assert named.filter("lang_pred = lang").count() >= 0.9 * named.count()
    ranked = QUERIES["op8_quality_ranking"](spark, small).join(labels, "doc_id")
    assert ranked.filter("predicted = quality").count() >= 0.95 * ranked.count()


def test_pipeline_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    model = language_id.train(docs.filter(~language_id.is_held_out("doc_id")))
    score = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    texts = {i: t for i, t in texts.items() if score[i].lang_pred != "und" and score[i].score >= corpus_pipeline.LEAST_LANGUAGE_SHARE}
    last = {t: i for i, t in sorted(texts.items())}
    texts = {i: t for t, i in last.items()}
    texts = {i: texts[i] for i, (_, comp) in jaccard_components(texts).items() if comp == i}
    clean = {}
    for i, text in texts.items():
        out, at = "", 0
        for start, end, kind in secrets.find_spans(text):
            if start >= at:
                out += text[at:start] + f"[{kind}]"
            at = max(at, end)
        clean[i] = out + text[at:]
    check_packing(corpus_pipeline.run(spark, small).collect(), byte_ids(clean), 1024)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), small).columns == columns
        assert stage(spark, docs.limit(0), small).count() == 0


def test_near_copies_go_by_row_where_ids_repeat(spark):
    long, other = prose(3, 400), prose(4, 300)
    near = edited(long, 1, 4)
    rows = [(5, long, "a"), (5, other, "b"), (None, near, "c"), (2, "", "d"), (None, None, "e"), (9, prose(5, 50), "f"), (9, "one", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.n_shingles for r in kept.collect()) == ["a", "b", "d", "e", "f", "g"]
    # without them the smallest id stays
    docs = docs.filter("n_shingles IN ('a', 'f')").union(spark.createDataFrame([(3, near, "h")], docs.schema))
    assert sorted(r.n_shingles for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == ["f", "h"]


def test_stages_handle_null_and_repeated_ids_and_extra_columns(spark, small):
    texts = [None, "", "  ", prose(1, 60), prose(1, 60), prose(2, 5000), SECRET, SECRET, "漢字 😀", "x" * 100000]
    rows = [(None if i % 4 == 0 else i // 2, t, "en", "s", len(t or ""), "mine", 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, blob string, score int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert all(r.blob == "mine" and r.score == 7 for r in out.collect())
    cleaned = corpus_pipeline.redact_secrets(spark, docs, small).collect()
    assert len(cleaned) == len(texts) and sum("[access]" in (r.text or "") for r in cleaned) == 2
    assert corpus_pipeline.drop_copies(spark, docs, small).count() == len(set(t or "" for t in texts))
