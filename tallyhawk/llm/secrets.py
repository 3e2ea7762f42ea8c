"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its content. Only blobs that the ledger has not seen under this version of the
rules are scanned, each once however many paths hold it; findings are added to the ledger and joined back to all paths.
The ledger is a Parquet table in shared storage; a path not yet written is an empty ledger. A run that dies before its
append leaves the ledger as it was, so the next one scans these blobs again.

A blob that very many paths hold is joined to them by copies of its findings, so no task has all of its paths.

Null texts count as empty and have no findings. Repeated rows get a result each, also with equal or null ids. Extra columns are
not read by ``scan``; ``redact`` carries them, under any names but those that begin with an underscore. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from tallyhawk.llm.exact_dedup import digest, mark_copies
from tallyhawk.llm.heavy import attach_spread
from tallyhawk.llm.words import as_texts, slices
from tallyhawk.session import cut_lineage, scratch_path

# Kinds in the order of listing, the last two being this operator's own.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "pem")
RULES = "1"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_WORDS = ("passw", "secret", "token", "api")


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every finding, by start, then kind as listed; offsets in code points."""
    found = [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    lowered = text.lower() if text.isascii() else text.translate(_LOWER)
    if any(w in lowered for w in _WORDS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    if "gh" in text:
        found += [(m.start(), m.end(), 3) for m in _GITHUB.finditer(text)]
    if "-----BEGIN" in text:
        found += [(m.start(), m.end(), 4) for m in _PEM.finditer(text)]
    return [(start, end, KINDS[kind]) for start, end, kind in sorted(found, key=lambda f: (f[0], f[2]))]


_LOWER = {c: c + 32 for c in range(65, 91)}
SPANS = "array<struct<start: int, end: int, kind: string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            spans = [[{"start": s, "end": e, "kind": k} for s, e, k in find_spans(t)] for t in as_texts(part.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPAN)], ["blob", "spans"])


def read_ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(f"blob string, rules string, spans {SPANS}").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"blob string, rules string, spans {SPANS}")


def append(versions: DataFrame, ledger: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan the blobs that ``ledger`` has not seen and add them to it; per row the id, ``blob``, ``kept`` and ``group_size``."""
    spark = versions.sparkSession
    paths = cut_lineage(mark_copies(versions, doc_id, text).withColumnRenamed("text_sha256", "blob"))
    seen = read_ledger(spark, ledger).filter(F.col("rules") == RULES).select("blob")
    unseen = paths.filter("kept").select(F.col(doc_id).alias("id"), "blob").join(seen, "blob", "left_anti")
    # one version stands for each blob; equal ids with other texts are told apart by the blob
    texts = versions.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.lower(F.hex(digest(text))).alias("blob"))
    first = texts.join(unseen, (texts["blob"] == unseen["blob"]) & texts["id"].eqNullSafe(unseen["id"]), "left_semi")
    scanned = first.select("blob", "text").mapInArrow(_scan_batches, f"blob string, spans {SPANS}")
    scanned.withColumn("rules", F.lit(RULES)).write.mode("append").parquet(ledger)
    return paths.select(doc_id, "blob", "kept", "group_size")


def scan(versions: DataFrame, ledger: str, doc_id: str = "doc_id", text: str = "text", appends: int = 1) -> DataFrame:
    """Scan unseen blobs into ``ledger``; one row per row of ``versions``: the id, ``blob`` and ``spans``.

    With several ``appends`` the versions arrive in so many parts by the hash of their ids, each meeting the ledger of those before.
    """
    part = F.pmod(F.xxhash64(doc_id), F.lit(appends))
    paths = append(versions.filter(part == 0) if appends > 1 else versions, ledger, doc_id, text)
    for k in range(1, appends):
        paths = paths.unionByName(append(versions.filter(part == k), ledger, doc_id, text))
    findings = read_ledger(versions.sparkSession, ledger).filter((F.col("rules") == RULES) & (F.size("spans") > 0))
    copied = paths.filter("kept AND group_size > 1").groupBy("blob").agg(F.sum("group_size").alias("paths"))
    findings = findings.dropDuplicates(["blob"]).select("blob", "spans").join(copied, "blob", "left").fillna(1, ["paths"])
    joined = attach_spread(paths.select(doc_id, "blob"), findings, ["blob"], "paths", paths.count(), doc_id)
    return joined.select(doc_id, "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def span_text(spans: str, base_only: bool) -> F.Column:
    kept = F.col(spans)
    if base_only:
        kept = F.filter(kept, lambda s: s["kind"].isin(*BASE_KINDS))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


# a key whose end line is missing: its headers, lines of base64 and a short last line; line ends may be escaped
_KEY_LINES = (
    r"^(?:\s*+(?:Proc-Type|DEK-Info):[^\n]*+)*+(?:(?:\s|\\[rn])*+[A-Za-z0-9+/]{16,}+={0,2}+)*+"
    r"(?:(?:\s|\\[rn])*+[A-Za-z0-9+/]{1,15}+={1,2}+|\r?\n[A-Za-z0-9+/]{1,15}+(?=\s*+$))?+"
)


def _whole_keys(spans: str, text: str) -> F.Column:
    """``spans`` with those of kind pem, which are of the header only, up to the end line or the last line of base64."""

    def key(s):
        rest = F.substring(F.col(text), s["end"] + 1, F.length(text))
        last, other = F.locate("-----END ", rest), F.locate("-----BEGIN", rest)
        line = F.regexp_extract(F.substring(rest, last, F.lit(200)), r"^-----END [A-Z ]*PRIVATE KEY-----", 0)
        ended = (last > 0) & ((other == 0) | (last < other)) & (F.length(line) > 0)
        more = F.when(ended, last - 1 + F.length(line)).otherwise(F.length(F.regexp_extract(rest, _KEY_LINES, 0)))
        return F.when(
            s["kind"] == "pem", F.struct(s["start"].alias("start"), (s["end"] + more).alias("end"), s["kind"].alias("kind"))
        ).otherwise(s)

    return F.transform(spans, key)


def redact(docs: DataFrame, ledger: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each finding's text replaced by ``[kind]`` (overlapping findings by the first's), n_chars kept true.

    A private key goes whole, not its header only.
    """
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    found = scan(docs, ledger, doc_id, text).filter(F.size("spans") > 0)
    found = found.groupBy(F.col("blob").alias("_blob")).agg(F.first("spans").alias("_spans"), F.count("*").alias("_paths"))
    # findings are joined by content, to rows that have any only
    tagged = docs.withColumn("_blob", F.lower(F.hex(digest(text))))
    tagged = attach_spread(tagged, found, ["_blob"], "_paths", docs.count(), doc_id).withColumn("_spans", _whole_keys("_spans", text))
    last = lambda done: done["at"]
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda done, s: F.when(
        s["start"] >= last(done),
        F.struct(
            F.concat(done["out"], F.substring(F.col(text), last(done) + 1, s["start"] - last(done)), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            s["end"].alias("at"),
        ),
    ).otherwise(F.struct(done["out"].alias("out"), F.greatest(last(done), s["end"]).alias("at")))
    clean = F.aggregate("_spans", start, step, lambda done: F.concat(done["out"], F.substring(F.col(text), last(done) + 1, F.length(text))))
    cleaned = tagged.withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(clean))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")))
    return cleaned.select(*docs.columns)
