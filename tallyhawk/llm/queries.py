"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhawk.llm import (
    exact_dedup, language_id, licenses, near_duplicates, near_vectors, packing, periodic_runs, piece_bpe, quality_ranking, repetition, secrets,
    sharding, vector_codes,
)
from tallyhawk.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op1_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    WINDOW same AS (PARTITION BY text_sha256)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(documents(spark, sf_dir))


@query(
    "op2_ngram_jaccard_join",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    shingles AS (
        SELECT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' ')))) END) AS s
        FROM words
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, p.n, q.n
        HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
    ),
    reach AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION
        SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other
    )
    SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query("op3_piece_encoding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encoding_digests(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.tiktoken"), pattern())


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op5_repetition_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(documents(spark, sf_dir))


def _licenses_sql() -> str:
    """The canonical form once more, for the documents and the registry alike."""
    form = "lower(coalesce(text, ''))"
    form = f"regexp_replace({form}, '{licenses.COPYRIGHT_LINE}', ' ', 'g')"
    form = f"'  ' || regexp_replace({form}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || '  '"
    for other, usual in licenses.EQUIVALENT:
        form = f"replace({form}, ' {other} ', ' {usual.replace(' ', '  ')} ')"
    form = f"nullif(trim(regexp_replace({form}, ' +', ' ', 'g')), '')"
    known = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(licenses.KNOWN.items()))
    return f"""
    WITH known AS (
        SELECT sha256({form}) AS digest, min(license_id) AS license_id FROM (VALUES {known}) AS t(license_id, text) GROUP BY 1
    ),
    canonical AS (SELECT doc_id, sha256({form}) AS canonical_sha256 FROM documents)
    SELECT doc_id, canonical_sha256, license_id FROM canonical LEFT JOIN known ON digest = canonical_sha256
    """


@query("op6_license_lookup", _licenses_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir), licenses.known_licenses(spark))


@query("op7_balanced_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.balanced_shards(documents(spark, sf_dir))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op8_quality_ranking")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ranking.featured(documents(spark, sf_dir))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    labelled = rows.join(labels.filter(~language_id.is_held_out("doc_id")), "doc_id")
    scored = quality_ranking.score_featured(rows, quality_ranking.train_featured(labelled))
    return scored.select("doc_id", language_id.is_held_out("doc_id").alias("held_out"), "score", "predicted")


def _secrets_sql() -> str:
    kinds = {
        "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""",
        "access": "AKIA[A-Z0-9]{16,}",
        "hex": "[0-9a-f]{24,}",
        "github": "gh[pousr]_[A-Za-z0-9]{36,}",
        "pem": "-----BEGIN [A-Z ]*PRIVATE KEY-----",
    }
    value = r"""(?i)^(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
    keep = {
        "assign": f"length(regexp_replace(m, '{value}', '')) >= 6", "access": "true", "hex": "true",
        "github": "true", "pem": "true",
    }
    # a mark around each match cuts the text into what lies between and the matches by turns
    parts = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS kind, {i} AS rank, string_split(regexp_replace(t, '({p})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS parts"
        " FROM texts" for i, (k, p) in enumerate(kinds.items())
    )
    cases = " ".join(f"WHEN '{k}' THEN {c}" for k, c in keep.items())
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    cut AS ({parts}),
    pieces AS (
        SELECT doc_id, kind, rank, unnest(parts) AS m, unnest(range(len(parts))) AS i,
               unnest(list_transform(range(len(parts)), lambda i: coalesce(list_sum(list_transform(parts[1:i], lambda p: length(p))), 0))) AS place
        FROM cut WHERE len(parts) > 1
    ),
    found AS (
        SELECT doc_id, kind, rank, place, kind || ':' || place::BIGINT || ':' || (place + length(m))::BIGINT AS span
        FROM pieces WHERE i % 2 = 1 AND CASE kind {cases} END
    ),
    per_doc AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(span, ',' ORDER BY place, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY place, rank) AS spans
        FROM found GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN per_doc USING (doc_id)
    """


@query("op9_secret_scan", _secrets_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir), scratch_path(spark, "ledger"), appends=2)
    return found.select(
        "doc_id",
        *[secrets.count_kind("spans", k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(secrets.span_text("spans", True), 256).alias("base_sha256"),
        secrets.span_text("spans", False).alias("spans"),
    )


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.filter(~language_id.is_held_out("doc_id")))
    predicted = language_id.predict(docs, model)
    return predicted.select("doc_id", language_id.is_held_out("doc_id").alias("held_out"), "lang_pred", "score")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@query(
    "op11_embedding_near_dedup",
    """
    WITH RECURSIVE vectors AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
    ),
    reach AS (
        SELECT vec_id, vec_id AS other FROM embeddings
        UNION
        SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.other
    ),
    least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
    counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN counted ON x = vec_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(embeddings(spark, sf_dir))


def _codes_sql(parts: int = vector_codes.PARTS, rounds: int = vector_codes.ROUNDS) -> str:
    """Each round as a pair of views: the nearest entry of every part, then the means rounded down. Dot products of these whole numbers are
    exact in double precision."""
    steps = [
        f"""
    kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    parts AS MATERIALIZED (
        SELECT vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i
        FROM kept, range({parts}) t(p)
    ),
    book0 AS MATERIALIZED (SELECT p, i AS e, v AS c FROM parts WHERE i < {vector_codes.ENTRIES})"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""
    near{k} AS MATERIALIZED (
        SELECT vec_id, p, any_value(v) AS v, min(struct_pack(d := d, e := e)) AS best FROM (
            SELECT vec_id, parts.p, v, e, (list_dot_product(v, v) + list_dot_product(c, c) - 2 * list_dot_product(v, c))::BIGINT AS d
            FROM parts JOIN book{k} USING (p)
        ) GROUP BY vec_id, p
    )""")
        if k < rounds:
            steps.append(f"""
    mean{k} AS MATERIALIZED (
        SELECT p, e, list(m ORDER BY j) AS c FROM (
            SELECT p, best.e AS e, j, floor(sum(v[j]) / count(*)) AS m FROM near{k}, range(1, 10000) t(j) WHERE j <= len(v) GROUP BY p, best.e, j
        ) GROUP BY p, e
    ),
    book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e))""")
    return "WITH " + ",".join(steps) + f""",
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id)
    """


@query("op12_vector_codes", _codes_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(embeddings(spark, sf_dir))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(documents(spark, sf_dir), plant=True, full=False)
