"""From raw documents to packed sequences in five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a frame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``. An empty table goes through every stage. Null and empty texts are
rejected with the language stage. Ids may be null or repeat with other texts: no stage takes two texts for one. Extra columns
are carried under any names but those that begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhawk.llm import exact_dedup, language_id, near_duplicates, packing, queries, secrets
from tallyhawk.session import cut_lineage

LEAST_LANGUAGE_SHARE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language has a good third of the letters, go. Learns from rows that aren't held out."""
    model = language_id.train(docs.filter(~language_id.is_held_out("doc_id")))
    return language_id.keep_identified(docs, model, LEAST_LANGUAGE_SHARE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays; documents without words all stay.

    Where ids are null or repeat, rows are numbered by id (null last), then text, and written before.
    """
    if docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty():
        numbered = docs.withColumn("_row", F.col("doc_id").cast("long"))
    else:
        ordered = docs.orderBy(F.asc_nulls_last("doc_id"), exact_dedup.digest("text"))
        numbered = cut_lineage(ordered.withColumn("_row", F.monotonically_increasing_id()))
    found = near_duplicates.near_duplicates(numbered, "_row")
    dropped = found.filter(F.col("_row") != F.col("component_id")).select("_row")
    return numbered.join(dropped, "_row", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; what the scan finds is replaced by its kind in brackets."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens, as op4 returns them."""
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.tiktoken"), queries.pattern())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_duplicates", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# tokenising and learned language models have no SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
