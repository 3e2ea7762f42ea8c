"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries propose frequent digests; an exact count verifies them and finds their winners. The verified
winners, ``counters`` rows of under 100 bytes at most, are broadcast, so that rows of hot groups are decided on the map
side and never shuffled. All other digests have at most 2 / counters of the rows each and go through one ordinary shuffle.

Equal means: the same text, null counting as empty. Of equal texts the row with the largest id stays (null ids lose);
of rows that repeat the id too, exactly one stays. An empty table gives an empty result. Other columns are ignored by
``mark_copies`` and carried by ``keep_one``, under any names but those that begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.llm import heavy
from tallyhawk.session import cut_lineage


def digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _winners(digests: DataFrame, counters: int) -> DataFrame:
    """Verified frequent digests with their winner and size: ``counters`` rows at most."""
    found = heavy.candidates(digests, "_digest", digests.count(), counters)
    exact = digests.join(F.broadcast(found), "_digest").groupBy("_digest")
    winners = exact.agg(F.max("_order").alias("_best"), F.count("*").alias("group_size"))
    return cut_lineage(winners.filter("group_size > 1"))


def mark_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = heavy.COUNTERS) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    digests = docs.select(F.col(doc_id).alias("_id"), digest(text).alias("_digest"))
    # a row's number is fixed by being written; ties of the id fall to the smallest
    numbered = digests.withColumn("_row", F.monotonically_increasing_id())
    stored = cut_lineage(numbered).withColumn("_order", F.struct("_id", -F.col("_row")))
    winners = F.broadcast(_winners(stored, counters))
    group = Window.partitionBy("_digest")
    light = stored.join(winners, "_digest", "left_anti").withColumns(
        {"_best": F.max("_order").over(group), "group_size": F.count("*").over(group)}
    )
    marked = stored.join(winners, "_digest").unionByName(light)
    return marked.select(
        F.col("_id").alias(doc_id),
        F.col("_best._id").alias("keep_id"),
        "group_size",
        (F.col("_order") == F.col("_best")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = heavy.COUNTERS) -> DataFrame:
    """``docs`` without copies, all columns kept. Losers of hot groups are removed before the shuffle."""
    digests = docs.select(F.struct(doc_id).alias("_order"), digest(text).alias("_digest"))
    winners = F.broadcast(_winners(cut_lineage(digests), counters).drop("group_size"))
    tagged = docs.withColumn("_digest", digest(text)).join(winners, "_digest", "left")
    maybe = tagged.filter(F.col("_best").isNull() | F.col(doc_id).eqNullSafe(F.col("_best").getField(doc_id)))
    maybe = maybe.drop("_best")
    best = Window.partitionBy("_digest").orderBy(F.desc_nulls_last(doc_id), F.xxhash64(*[F.col(c) for c in docs.columns]))
    return maybe.withColumn("_place", F.row_number().over(best)).filter("_place = 1").select(*docs.columns)
