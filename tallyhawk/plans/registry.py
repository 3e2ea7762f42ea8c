"""Registry of runnable queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhawk.functions.hashing import HASH_DIGITS, hash_bound

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it has no relational equivalent and is covered by tests."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all double columns, for comparison across engines."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# SQL building blocks. Table expressions mirror plans/entities.py.

KINDS = ("click", "error", "purchase", "signup", "view")

ENTITIES = (
    "entities AS (SELECT user_id*100000 + datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS entity_id, user_id, CAST(ts AS DATE) AS day, "
    + "".join(f"CAST(SUM(CASE WHEN event_type='{k}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}, " for k in KINDS)
    + "COUNT(*) AS total_events, ROUND(SUM(value), 2) AS sum_value, "
    "CAST(MAX(CASE WHEN value >= 200 THEN 1 ELSE 0 END) AS INT) AS label "
    "FROM events GROUP BY user_id, day(ts), CAST(ts AS DATE))"
)

SCORED = (
    ENTITIES + ", scored AS (SELECT *, CAST(CASE WHEN score > 0 THEN 1 ELSE 0 END AS INT) AS prediction FROM ("
    "SELECT 'a' AS model, entity_id, label, ROUND(0.01*sum_value + 0.1*n_error - 2.75, 6) AS score FROM entities "
    "UNION ALL "
    "SELECT 'b', entity_id, label, ROUND(0.01*sum_value - 0.25*total_events - 1.5, 6) FROM entities))"
)

CELLS = (
    SCORED + ", cells AS (SELECT model, "
    "SUM(CASE WHEN label=1 AND prediction=1 THEN 1 ELSE 0 END)::BIGINT AS tp, "
    "SUM(CASE WHEN label=0 AND prediction=1 THEN 1 ELSE 0 END)::BIGINT AS fp, "
    "SUM(CASE WHEN label=1 AND prediction=0 THEN 1 ELSE 0 END)::BIGINT AS fn, "
    "SUM(CASE WHEN label=0 AND prediction=0 THEN 1 ELSE 0 END)::BIGINT AS tn FROM scored GROUP BY model)"
)

CURVE = (
    SCORED + ", groups AS (SELECT model, score, SUM(label)::BIGINT AS pos, SUM(1-label)::BIGINT AS neg "
    "FROM scored GROUP BY model, score), "
    "curve AS (SELECT model, score, pos, neg, "
    "SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, row_number() OVER w AS place, "
    "SUM(pos) OVER (PARTITION BY model) AS positives, SUM(neg) OVER (PARTITION BY model) AS negatives, "
    "COUNT(*) OVER (PARTITION BY model) AS places FROM groups "
    "WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
)

GAPPY = (
    "gappy AS (SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN NULL "
    "WHEN l_linenumber = 5 THEN 'NaN'::DOUBLE ELSE l_extendedprice END AS l_extendedprice) FROM lineitem)"
)


def hash_sql(key: str, salt: str = "") -> str:
    salted = f"CAST({key} AS VARCHAR)" + (f"||'-{salt}'" if salt else "")
    return f"('0x'||substr(md5({salted}),1,{HASH_DIGITS}))::BIGINT"


def below_sql(key: str, salt: str, fraction: float) -> str:
    """Whether the salted hash of ``key`` is among the lowest ``fraction``."""
    return f"{hash_sql(key, salt)} < {hash_bound(fraction)}"


def bucket_sql(key: str, buckets: int, salt: str = "") -> str:
    return f"({hash_sql(key, salt)} % {buckets})"


# Class-weighted metrics over the cells, as used by several oracles.
F1_SQL = (
    "((tp+fn)*(CASE WHEN 2*tp+fp+fn=0 THEN 0 ELSE 2.0*tp/(2*tp+fp+fn) END)"
    " + (tn+fp)*(CASE WHEN 2*tn+fp+fn=0 THEN 0 ELSE 2.0*tn/(2*tn+fp+fn) END))/(tp+fp+fn+tn)"
)
ACCURACY_SQL = "(tp+tn)/(tp+fp+fn+tn)::DOUBLE"
PRECISION_SQL = "((tp+fn)*(tp/(tp+fp)::DOUBLE) + (tn+fp)*(tn/(tn+fn)::DOUBLE))/(tp+fp+fn+tn)"
