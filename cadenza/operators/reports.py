"""Warehouse views and daily reports over the raw (flat, derived) table.

Date windows take an explicit ``as_of`` date instead of ``CURRENT_DATE`` so
results are reproducible. Filters use the ``event_date`` partition column
when it exists (partition pruning on a stored table) and otherwise
``to_date(timestamp)``; callers reading the driver tables push the same range
into the scan with ``adapter.read_events(since=...)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.common import round6

DEFAULT_AS_OF = dt.date(2024, 1, 31)


def _date(df: DataFrame) -> Column:
    return F.col("event_date") if "event_date" in df.columns else F.to_date("timestamp")


def since(df: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """rows on or after ``as_of - days`` (``DATE_SUB(as_of, days)``)."""
    return df.filter(_date(df) >= F.date_sub(F.lit(as_of), days))


r6 = round6


def daily_events_summary(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    """One row per day of the last ``days`` days, newest first."""
    et = F.col("event_type")
    return (since(raw, as_of, days)
            .groupBy(_date(raw).alias("event_date"))
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.countDistinct("user_id").alias("unique_users"),
                 F.countDistinct("track_id").alias("unique_tracks"),
                 F.countDistinct("artist_id").alias("unique_artists"),
                 r6(F.avg("engagement_score")).alias("avg_engagement"),
                 F.sum(F.when(et == "play", 1).otherwise(0)).cast("long").alias("total_plays"),
                 F.sum(F.when(et == "skip", 1).otherwise(0)).cast("long").alias("total_skips"),
                 F.sum(F.when(et == "like", 1).otherwise(0)).cast("long").alias("total_likes"))
            .orderBy(F.col("event_date").desc()))


def top_tracks_weekly(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF, days: int = 7,
                      min_plays: int = 10, top: int = 100) -> DataFrame:
    """A8 + T1: plays of the last week per track, at least ``min_plays``, top ``top``.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each partition
    keeps its own top ``top`` and only those reach the final task. Ties break
    on ``track_id`` so the cut is deterministic.
    """
    return (since(raw, as_of, days)
            .filter(F.col("event_type") == "play")
            .groupBy("track_id", "track_name", "artist_name")
            .agg(F.count(F.lit(1)).alias("play_count"),
                 F.countDistinct("user_id").alias("unique_listeners"),
                 r6(F.avg("engagement_score")).alias("avg_engagement"),
                 r6(F.avg("play_completion_ratio")).alias("avg_completion"))
            .filter(F.col("play_count") >= min_plays)
            .orderBy(F.col("play_count").desc(), F.col("avg_engagement").desc(), F.col("track_id"))
            .limit(top))


def platform_performance(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF, days: int = 7) -> DataFrame:
    """Per platform over the last week; hours streamed and completion rate."""
    return (since(raw, as_of, days)
            .groupBy("platform")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.countDistinct("user_id").alias("unique_users"),
                 r6(F.avg("engagement_score")).alias("avg_engagement"),
                 r6(F.sum("played_duration_ms") / 1000 / 3600).alias("total_hours_streamed"),
                 r6(F.count(F.when(F.col("is_full_play"), 1)) / F.count(F.lit(1))).alias("completion_rate"))
            .orderBy(F.col("total_events").desc()))


# --- most frequent value per group ---------------------------------------------

def closed_mode(name: str) -> Column:
    """Most frequent value of a column with a small closed domain (hour, platform,
    device), ties to the smallest. It joins the group's other aggregates: its
    buffer has one entry per value of the domain, so no row is stacked for it."""
    return F.mode(name, True)


def modes(df: DataFrame, keys: list[str], attrs: dict[str, Column], explode: dict[str, Column] | None = None,
          distributions: dict[str, Column] | None = None, distinct: dict[str, Column] | None = None) -> DataFrame:
    """Most frequent value of each attribute per ``keys`` group; ties go to the
    smallest value.

    All attributes are stacked into one long (key, attr, value) relation, so
    the whole job is two aggregations: a count per (key, attr, value) that
    combines map-side (a hot key is folded inside each task before the
    shuffle), then one ``min(struct(-count, value))`` per key and attribute,
    also algebraic. Nothing collects a group's rows. ``explode`` attributes
    are arrays whose every element counts once. ``distributions`` attributes
    come back as a JSON object of count per value (keys sorted), built from
    the same counts: the list gathered per group holds one entry per
    distinct value, never the group's rows. ``distinct`` attributes come back
    as exact distinct counts (the counted relation has one row per distinct
    non-null value), which spares the caller a ``countDistinct`` rewrite.
    """
    explode = explode or {}
    distributions = distributions or {}
    distinct = distinct or {}
    names = list(attrs) + list(explode)
    attrs = {**attrs, **distributions, **{n: c.cast("string") for n, c in distinct.items()}}
    integral = _integral_attrs(df, attrs)  # one analysis for all attribute types
    items = [F.array(F.struct(F.lit(n).alias("attr"), c.cast("string").alias("vs"),
                              (c.cast("long") if n in integral else F.lit(None).cast("long")).alias("vn")))
             for n, c in attrs.items()]
    # A null array adds no value, but must not take the event's other values with it.
    none = F.array().cast("array<struct<attr:string,vs:string,vn:bigint>>")
    items += [F.coalesce(F.transform(arr, _tag(n)), none) for n, arr in explode.items()]
    stacked = df.select(*keys, F.explode(F.concat(*items)).alias("s")).select(*keys, "s.*")
    counted = (stacked.filter(F.col("vs").isNotNull())
               .groupBy(*keys, "attr", "vs", "vn").agg(F.count(F.lit(1)).alias("n")))
    best = counted.groupBy(*keys).agg(*[
        F.min(F.when(F.col("attr") == n, F.struct((-F.col("n")).alias("neg"), "vn", "vs"))).alias(n)
        for n in names], *[
        _json_counts(F.collect_list(F.when(F.col("attr") == n, F.struct("vs", "n")))).alias(n)
        for n in distributions], *[F.count_if(F.col("attr") == n).alias(n) for n in distinct])
    return best.select(*keys, *[(F.col(f"{n}.vn") if n in integral else F.col(f"{n}.vs")).alias(n)
                                for n in names], *distributions, *distinct)


def _tag(name: str):
    # one-argument lambda: Spark treats a two-argument one as (element, index)
    def fn(g: Column) -> Column:
        return F.struct(F.lit(name).alias("attr"), g.cast("string").alias("vs"), F.lit(None).cast("long").alias("vn"))
    return fn


def _integral_attrs(df: DataFrame, attrs: dict[str, Column]) -> set[str]:
    integral = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
    schema = df.select(*[c.alias(n) for n, c in attrs.items()]).schema
    return {f.name for f in schema.fields if isinstance(f.dataType, integral)}


def _rate(num: Column, den: Column) -> Column:
    return round6(num / F.nullif(den, F.lit(0)))


def _type_count(t: str) -> Column:
    return F.count_if(F.col("event_type") == t)


def user_daily_analytics(raw: DataFrame) -> DataFrame:
    """A10: per user and day."""
    keys = ["user_id", "analysis_date"]
    df = raw.withColumn("analysis_date", _date(raw))
    main = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.sum("played_duration_ms"), F.lit(0)).cast("long").alias("total_play_time_ms"),
        round6(F.avg("engagement_score")).alias("average_engagement_score"),
        _rate(_type_count("skip"), F.count(F.lit(1))).alias("skip_rate"),
        _rate(F.count_if(F.col("is_full_play")), _type_count("play")).alias("completion_rate"),
        closed_mode("platform").alias("favorite_platform"), closed_mode("device_type").alias("preferred_device"),
        closed_mode("hour_of_day").cast("long").alias("most_active_hour"))
    top = modes(df, keys, {}, explode={"top_genre": F.col("track_genres")},
                distinct={"unique_tracks": F.col("track_id"), "unique_artists": F.col("artist_id"),
                          "listening_sessions": F.col("session_id")})
    return main.join(top, keys, "left").select(
        "user_id", "analysis_date", "total_events", "total_play_time_ms", "unique_tracks", "unique_artists",
        "top_genre", "favorite_platform", "average_engagement_score", "listening_sessions",
        "preferred_device", "most_active_hour", "skip_rate", "completion_rate")


def _json_counts(entries: Column) -> Column:
    """(value, count) entries to a JSON object with sorted keys; null when empty."""
    return F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(F.sort_array(entries))))


def track_daily_analytics(raw: DataFrame, trend_days: int = 7) -> DataFrame:
    """Per track, artist and day, with a trending score.

    ``trending_score`` = plays that day / (1 + mean plays over the previous
    ``trend_days`` calendar days, missing days counted as 0). The window runs
    over daily aggregates (one row per track and day), not over events.
    """
    from cadenza.operators.metrics import distribution_json
    from cadenza.schemas import PLATFORMS_A
    keys = ["track_id", "artist_id", "analysis_date"]
    df = raw.withColumn("analysis_date", _date(raw))
    n = F.count(F.lit(1))
    main = df.groupBy(*keys).agg(
        _type_count("play").alias("total_plays"),
        F.coalesce(F.sum("played_duration_ms"), F.lit(0)).cast("long").alias("total_play_time_ms"),
        round6(F.avg("play_completion_ratio")).alias("average_completion_ratio"),
        _rate(_type_count("skip"), n).alias("skip_rate"),
        _rate(_type_count("like"), n).alias("like_rate"),
        _rate(_type_count("share"), n).alias("share_rate"),
        _type_count("playlist_add").alias("playlist_adds"),
        distribution_json("platform", PLATFORMS_A).alias("platform_distribution"),
        closed_mode("hour_of_day").cast("long").alias("peak_listening_hour"))
    peak = modes(df, keys, {}, distributions={"geographic_distribution": F.col("user_location")},
                 distinct={"unique_listeners": F.when(F.col("event_type") == "play", F.col("user_id"))})
    day = F.datediff(F.col("analysis_date"), F.lit("1970-01-01"))
    w = Window.partitionBy("track_id", "artist_id").orderBy(day).rangeBetween(-trend_days, -1)
    prev = F.coalesce(F.sum("total_plays").over(w), F.lit(0)) / trend_days
    return (main.join(peak, keys, "left")
            .withColumn("trending_score", round6(F.col("total_plays") / (1 + prev)))
            .select("track_id", "artist_id", "analysis_date", "total_plays", "unique_listeners",
                    "total_play_time_ms", "average_completion_ratio", "skip_rate", "like_rate", "share_rate",
                    "playlist_adds", "platform_distribution", "geographic_distribution",
                    "peak_listening_hour", "trending_score"))


def platform_daily_analytics(raw: DataFrame) -> DataFrame:
    """Per platform and day; session duration from per-session spans."""
    keys = ["platform", "analysis_date"]
    df = raw.withColumn("analysis_date", _date(raw))
    main = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.sum("played_duration_ms"), F.lit(0)).cast("long").alias("total_streaming_time_ms"),
        round6(F.avg("engagement_score")).alias("average_engagement_score"),
        _rate(F.count_if(F.col("device_type") == "mobile"), F.count(F.lit(1))).alias("mobile_usage_ratio"),
        closed_mode("hour_of_day").cast("long").alias("peak_usage_hour"))
    span = (df.groupBy(*keys, "session_id")
            .agg(((F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / 1000).alias("ms"))
            .groupBy(*keys).agg(F.floor(F.avg("ms")).cast("long").alias("average_session_duration_ms")))
    top = modes(df, keys, {"most_popular_artist": F.col("artist_name"), "most_popular_track": F.col("track_name")},
                explode={"top_genre": F.col("track_genres")},
                distinct={"unique_users": F.col("user_id"),
                          "_premium_users": F.when(F.col("subscription_type") == "premium", F.col("user_id"))})
    top = top.withColumn("premium_user_ratio", _rate(F.col("_premium_users"), F.col("unique_users")))
    return (main.join(span, keys, "left").join(top, keys, "left")
            .select("platform", "analysis_date", "total_events", "unique_users", "total_streaming_time_ms",
                    "average_session_duration_ms", "top_genre", "most_popular_artist", "most_popular_track",
                    "average_engagement_score", "premium_user_ratio", "mobile_usage_ratio", "peak_usage_hour"))
