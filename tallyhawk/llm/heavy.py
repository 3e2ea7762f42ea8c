"""Frequent keys of a table by mergeable Misra-Gries summaries.

Every task keeps at most ``counters`` counters, so what it emits is bounded whatever it reads. Summed over tasks a
key's counter is short of its true count by at most rows / (counters + 1), and counters above that bound belong to
at most ``counters`` keys: each key with more than twice the bound is among them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

COUNTERS = 1024


def summarise(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    kept: dict = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for pair in batch.column(0).value_counts().to_pylist():
            if pair["values"] is not None:
                kept[pair["values"]] = kept.get(pair["values"], 0) + pair["counts"]
        if len(kept) > counters:
            # taking the next largest count off every counter is many decrement steps of Misra-Gries at once
            least = sorted(kept.values(), reverse=True)[counters]
            kept = {k: n - least for k, n in kept.items() if n > least}
    if kept:
        keys = pa.array(list(kept), schema.field(0).type)
        yield pa.RecordBatch.from_arrays([keys, pa.array(list(kept.values()), pa.int64())], ["key", "counted"])


def candidates(df: DataFrame, key: str, rows: int, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values of ``key``, among them all that more than 2 * rows / (counters + 1) rows have."""
    kind = df.schema[key].dataType.simpleString()
    parts = df.select(F.col(key).alias("key")).mapInArrow(
        lambda batches: summarise(batches, counters), f"key {kind}, counted long"
    )
    summed = parts.groupBy("key").agg(F.sum("counted").alias("counted"))
    least = max(1, rows // (counters + 1))
    return summed.filter(F.col("counted") > least).select(F.col("key").alias(key))


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], counted: str, total: int, counters: int = COUNTERS) -> DataFrame:
    """Left join of ``facts``, which has one row per key and in ``counted`` how many of the ``total`` rows have it at most.

    More than total / counters rows can belong to fewer than ``counters`` keys only; their facts are broadcast, so that their
    rows stay where they are. The others are joined by shuffle, where no key has more than that share.
    """
    frequent = F.col(counted) > total // counters
    hot = facts.filter(frequent).withColumn("_frequent", F.lit(True))
    marked = rows.join(F.broadcast(hot), keys, "left")
    there = marked.filter("_frequent").drop("_frequent")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(facts.filter(~frequent), keys, "left")
    return there.unionByName(rest)


def attach_spread(
    rows: DataFrame, facts: DataFrame, keys: list[str], counted: str, total: int, by: str, how: str = "left", counters: int = COUNTERS
) -> DataFrame:
    """Join of ``facts`` as in ``attach``, of any size each: of frequent keys only the keys are broadcast.

    The rows of a frequent key are dealt by the hash of ``by`` over copies of its facts, one copy per total / counters rows, so
    that all copies beyond the first are ``counters`` rows at most. Rows of one key that are equal in ``by`` too stay together.
    """
    most = max(1, total // counters)
    copies = F.greatest(F.lit(1), F.ceil(F.col(counted) / most)).cast("int")
    hot = facts.filter(F.col(counted) > most).select(*keys, copies.alias("_copies"))
    copy = F.pmod(F.xxhash64(by), F.coalesce("_copies", F.lit(1))).cast("int")
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("_copy", copy).drop("_copies")
    spread = facts.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.join(spread, [*keys, "_copy"], how).drop("_copy")
