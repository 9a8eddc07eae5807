"""Small column helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round6(c: Column) -> Column:
    """Round a double to 6 places, half-up, after dropping float noise.

    Going through ``decimal(38,12)`` first makes an average that is a
    half-way value up to the last bit (0.52193749999999995) round the same
    way in every engine that reads the result.
    """
    return F.round(c.cast("decimal(38,12)"), 6).cast("double")


def session_cached(fn):
    """Memoise a builder of Column expressions per SparkContext.

    Column expressions are immutable and name-based, so a list built once can
    be reused by every DataFrame of the session; this saves thousands of
    driver-to-JVM calls per query plan. Arguments must be hashable.
    """
    import functools

    from pyspark import SparkContext
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (sc.applicationId if sc else None, args)
        hit = cache.get(key)
        if hit is None:
            hit = cache[key] = fn(*args)
        return hit
    return wrapper
