"""Run registered queries next to their SQL in DuckDB and compare every value.

python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


# Types that agree across the two engines.
SAME_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
}


def differences(frame, con, sql: str) -> str | None:
    """None if the Spark frame and the SQL agree on columns, types and all values, else what differs."""
    relation = con.sql(sql)
    names = relation.columns
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    types = dict(zip(names, [str(t) for t in relation.types]))
    off = [(c, t, types[c]) for c, t in frame.dtypes if SAME_TYPES.get(t, t) != types[c]]
    spark_rows = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    sql_rows = rows_of(names, relation.fetchall())
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if bad:
        return f"{len(bad)} of {len(spark_rows)} rows differ, first {bad[0]}"
    return f"types {off}" if off else None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            if name in oracles:
                problem = differences(frame, con, oracles[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                rows = frame.collect()
                state = f"rows {len(rows)} {rows[:2]}"
        except Exception as error:  # noqa: BLE001
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += state.startswith(("DIFF", "ERROR"))
        print(f"{name:38s} {time.time() - start:6.2f}s {state[:900]}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
