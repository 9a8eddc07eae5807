"""Event-time window metrics (A1-A5), one function for batch and stream.

Every aggregate is algebraic (count, sum, avg, min, max, count_if), so Spark
runs a partial aggregate before the shuffle and only one row per
(window, key) per task crosses the network; hot keys (a platform holding a
third of all rows) are absorbed map-side.

Distinct counts: batch uses exact ``countDistinct``. Spark refuses it on a
stream, so ``distinct="set"`` counts ``size(collect_set)`` (exact, but keeps
every distinct value of an open window in state) and ``distinct="approx"``
uses HyperLogLog++ (fixed-size state per window, ~5% error by default) for
large windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.common import round6

from cadenza.functions.derive_simple import event_time
from cadenza.schemas import EVENT_TYPES_A, PLATFORMS_A

METRICS_WINDOW = "1 minute"
KEYED_WINDOW = "5 minutes"


# HyperLogLog++ relative error for ``distinct="approx"``. State per sketch grows
# as 1/rsd^2: 0.05 keeps ~0.4 KB per open window and key, 0.01 ~12 KB.
APPROX_RSD = 0.05


def distinct_count(col: str, mode: str = "exact", rsd: float = APPROX_RSD) -> Column:
    if mode == "exact":
        return F.countDistinct(col)
    if mode == "set":
        return F.size(F.collect_set(col))
    if mode == "approx":
        return F.approx_count_distinct(col, rsd)
    raise ValueError(f"unknown distinct mode {mode!r}")


def distribution_json(col: str, values: list[str]) -> Column:
    """A2: ``{"value": count, ...}`` over a closed value set, zero counts left out.

    One ``count_if`` per value keeps the aggregate algebraic (it works in a
    stream and combines map-side); keys follow the order of ``values``.
    """
    m = F.create_map(*[x for v in values for x in (F.lit(v), F.count_if(F.col(col) == v))])
    return F.to_json(F.map_filter(m, lambda k, v: v > 0))


def window_metrics(raw: DataFrame, duration: str = METRICS_WINDOW, distinct: str = "exact",
                   time_col: str = "timestamp") -> DataFrame:
    """A1 + A2: one row per fixed window of shape A raw rows.

    ``window_start``/``window_end`` are the true window bounds;
    ``first_event_ts``/``last_event_ts`` are min and max event time inside it.
    """
    w = F.window(time_col, duration)
    return (raw.groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("total_events"),
                 distinct_count("user_id", distinct).alias("unique_users"),
                 distinct_count("track_id", distinct).alias("unique_tracks"),
                 distribution_json("platform", PLATFORMS_A).alias("platform_distribution"),
                 distribution_json("event_type", EVENT_TYPES_A).alias("event_type_distribution"),
                 F.coalesce(round6(F.avg("engagement_score")), F.lit(0.0)).alias("average_engagement_score"),
                 F.min(time_col).alias("first_event_ts"),
                 F.max(time_col).alias("last_event_ts"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "total_events", "unique_users", "unique_tracks", "platform_distribution",
                    "event_type_distribution", "average_engagement_score",
                    "first_event_ts", "last_event_ts"))


def with_event_time(processed: DataFrame) -> DataFrame:
    """Parse the ISO text timestamp of processed shape B rows into ``event_ts``."""
    return processed.withColumn("event_ts", event_time(F.col("timestamp")))


def engagement_metrics(processed: DataFrame, duration: str = KEYED_WINDOW) -> DataFrame:
    """A3: per window and event type: count and mean engagement score."""
    return (processed.groupBy(F.window("event_ts", duration).alias("w"),
                              F.coalesce(F.col("event_type"), F.lit("unknown")).alias("event_type"))
            .agg(F.count(F.lit(1)).alias("count"),
                 round6(F.avg("engagement_score")).alias("avg_engagement"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "count", "avg_engagement"))


def genre_metrics(processed: DataFrame, duration: str = KEYED_WINDOW) -> DataFrame:
    """A4: per window and genre (null genre is ``unknown``): count, mean popularity."""
    return (processed.groupBy(F.window("event_ts", duration).alias("w"),
                              F.coalesce(F.col("genre"), F.lit("unknown")).alias("genre"))
            .agg(F.count(F.lit(1)).alias("count"),
                 round6(F.avg("genre_popularity")).alias("avg_popularity"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "genre", "count", "avg_popularity"))


def platform_metrics(processed: DataFrame, duration: str = KEYED_WINDOW) -> DataFrame:
    """A5: per window and platform: count and share of premium-platform events."""
    return (processed.groupBy(F.window("event_ts", duration).alias("w"),
                              F.coalesce(F.col("platform"), F.lit("unknown")).alias("platform"))
            .agg(F.count(F.lit(1)).alias("count"),
                 round6(F.avg(F.col("is_premium_platform").cast("double"))).alias("premium_ratio"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "platform", "count", "premium_ratio"))
