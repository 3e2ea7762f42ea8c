"""Turn one wide aggregate row into a long, readable table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def melt(df: DataFrame, records: list[dict[str, Column]], keep: list[str] | None = None) -> DataFrame:
    """One output row per record and input row; all records share field names and types."""
    structs = [F.struct(*[value.alias(name) for name, value in record.items()]) for record in records]
    return df.select(*(keep or []), F.explode(F.array(*structs)).alias("_r")).select(*(keep or []), "_r.*")
