"""Placement-independent pseudo-random numbers derived from row keys.

``rand(seed)`` depends on where a row happens to sit; a hash of the row's key does not, survives
repartitioning and task retries, and can be recomputed by any engine that has MD5.
"""

from __future__ import annotations

from math import exp, factorial, lgamma, log

from pyspark.sql import Column, functions as F

HASH_BITS = 60
HASH_SPACE = 2**HASH_BITS
HASH_DIGITS = HASH_BITS // 4


def key_hash(key: Column | str, salt: Column | str | int | None = None) -> Column:
    """Uniform integer in [0, 2^60): the first 60 bits of ``md5(key)`` or ``md5(key-salt)``.

    Choices that must not depend on one another (a split, a sample of a split, folds) need different salts.
    """
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    if salt is not None:
        salt = salt if isinstance(salt, Column) else F.lit(str(salt))
        text = F.concat_ws("-", text, salt.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def salt_for(purpose: str, seed: int | None = None) -> str:
    return purpose if seed is None else f"{purpose}{seed}"


def hash_bound(fraction: float) -> int:
    """Keys whose hash is below this number are ``fraction`` of all."""
    return round(fraction * HASH_SPACE)


def key_bucket(key: Column | str, buckets: int, salt: Column | str | int | None = None) -> Column:
    return F.pmod(key_hash(key, salt), F.lit(buckets)).cast("bigint")


def unit_hash(key: Column | str, salt: Column | str | int | None = None) -> Column:
    """Uniform double in [0, 1)."""
    return key_hash(key, salt) / F.lit(float(HASH_SPACE))


def poisson_cdf(mean: int) -> list[float]:
    """Cumulative probabilities of the Poisson distribution, until less than 2^-32 is left."""
    bounds, below, events = [], 0.0, 0
    while 1.0 - below >= 2.0**-32 or events < mean:
        below += exp(events * log(mean) - mean - lgamma(events + 1))
        bounds.append(below)
        events += 1
    return bounds


def poisson_one_cdf() -> list[float]:
    """The same for mean 1."""
    bounds, below, events = [], 0.0, 0
    while 1.0 - below >= 2.0**-32:
        below += exp(-1.0) / factorial(events)
        bounds.append(below)
        events += 1
    return bounds


def poisson_one(uniform: Column) -> Column:
    """Poisson(1) count by inversion of a uniform number; what lies beyond the table has a chance below 2^-32."""
    bounds = poisson_one_cdf()
    count = F.lit(len(bounds))
    for events, bound in reversed(list(enumerate(bounds))):
        count = F.when(uniform < bound, F.lit(events)).otherwise(count)
    return count
