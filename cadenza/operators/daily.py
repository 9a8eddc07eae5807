"""The daily user, track and platform tables (A10-A12) from one scan of the raw rows.

Every event opens one entry per level (user; track and artist; platform) and
attribute. Entries are counted per (level, keys, day, attribute, value) with a
map-side combine, so a hot key is folded inside each task; the counts give
modes, exact distinct counts, distributions and session spans of all three
levels in a second algebraic aggregation. The hour entry, of which an event
has exactly one a level, also carries the event's measures.

The per-day rows of all levels are written once, a folder a level, under the
shared checkpoint folder; each table reads its own. The tables equal those of
``reports.user_daily_analytics``, ``track_daily_analytics`` and
``platform_daily_analytics``, which read the raw rows once or twice each.

Null keys and null days form groups of their own; a null attribute value is
no mode and adds nothing to a distinct count; events without a session share
one span. Without rows the tables are empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.common import round6
from cadenza.operators.reports import _date, _json_counts
from cadenza.schemas import PLATFORMS_A
from cadenza.session import checkpoint_path
from cadenza.sources.tables import TASK_ROWS

KEYS = ["level", "k1", "k2", "analysis_date"]
COUNTED = {"plays": "play", "skips": "skip", "likes": "like", "shares": "share", "adds": "playlist_add"}
CARRIER = "hour"


def _entries() -> Column:
    """All (level, keys, attribute, value) entries of one event."""
    def of(level: str, k1: str, k2: Column, values: dict[str, Column], lists: dict[str, str]) -> list[Column]:
        def item(name: str, value: Column) -> Column:
            number = value.cast("long") if name == CARRIER else F.lit(None).cast("long")
            return F.struct(F.lit(level).alias("level"), F.col(k1).alias("k1"), k2.alias("k2"), F.lit(name).alias("attr"),
                            value.cast("string").alias("vs"), number.alias("vn"))
        def items(name: str):
            return lambda x: item(name, x)
        single = [F.array(*[item(n, c) for n, c in values.items()])]
        return single + [F.coalesce(F.transform(c, items(n)), F.array().cast(_ENTRY)) for n, c in lists.items()]
    hour, none = F.col("hour_of_day"), F.lit(None).cast("string")
    premium = F.when(F.col("subscription_type") == "premium", F.col("user_id"))
    listener = F.when(F.col("event_type") == "play", F.col("user_id"))
    return F.concat(
        *of("user", "user_id", none, {CARRIER: hour, "platform": F.col("platform"), "device": F.col("device_type"), "track": F.col("track_id"),
                                      "artist": F.col("artist_id"), "session": F.col("session_id")}, {"genre": "track_genres"}),
        *of("track", "track_id", F.col("artist_id"), {CARRIER: hour, "platform": F.col("platform"), "location": F.col("user_location"), "listener": listener}, {}),
        *of("platform", "platform", none, {CARRIER: hour, "artist": F.col("artist_name"), "track": F.col("track_name"), "user": F.col("user_id"),
                                           "premium": premium, "session": F.col("session_id")}, {"genre": "track_genres"}))


_ENTRY = "array<struct<level:string,k1:string,k2:string,attr:string,vs:string,vn:bigint>>"


def _counts(raw: DataFrame) -> DataFrame:
    """One row per (level, keys, day, attribute, value) with its count, the carried measures and the span of a session."""
    rows = raw.withColumn("analysis_date", _date(raw)).withColumn("s", F.explode(_entries()))
    carried = F.col("s.attr") == CARRIER
    total = lambda c: F.sum(F.when(carried, c))
    of_type = lambda t: F.count_if(carried & (F.col("event_type") == t))
    in_session = F.when(F.col("s.attr") == "session", F.unix_micros("timestamp"))
    return rows.groupBy("s.level", "s.k1", "s.k2", "analysis_date", "s.attr", "s.vs", "s.vn").agg(
        F.count(F.lit(1)).alias("n"),
        *[of_type(t).alias(name) for name, t in COUNTED.items()],
        F.count_if(carried & F.col("is_full_play")).alias("full_plays"),
        F.count_if(carried & (F.col("device_type") == "mobile")).alias("mobile"),
        total(F.col("played_duration_ms")).alias("played_ms"),
        total(F.col("engagement_score")).alias("engagement"), F.count(F.when(carried, F.col("engagement_score"))).alias("engagement_n"),
        total(F.col("play_completion_ratio")).alias("completion"), F.count(F.when(carried, F.col("play_completion_ratio"))).alias("completion_n"),
        ((F.max(in_session) - F.min(in_session)) / 1000).alias("span_ms"))


def daily_levels(raw: DataFrame) -> DataFrame:
    """One row per level, keys and day with everything that A10-A12 report."""
    counted = _counts(raw)
    known = F.col("vs").isNotNull()

    def mode(attr: str) -> Column:
        return F.min(F.when((F.col("attr") == attr) & known, F.struct((-F.col("n")).alias("neg"), "vn", "vs")))

    def distinct(attr: str) -> Column:
        return F.count_if((F.col("attr") == attr) & known)
    ratio = lambda a, b: round6(a / F.nullif(b, F.lit(0)))
    events = F.sum(F.when(F.col("attr") == CARRIER, F.col("n")))
    platforms = F.create_map(*[x for p in PLATFORMS_A for x in (
        F.lit(p), F.coalesce(F.sum(F.when((F.col("attr") == "platform") & (F.col("vs") == p), F.col("n"))), F.lit(0)))])
    return counted.groupBy(*KEYS).agg(
        events.alias("total_events"),
        *[F.sum(c).alias(c) for c in (*COUNTED, "full_plays", "mobile")],
        F.coalesce(F.sum("played_ms"), F.lit(0)).cast("long").alias("played_ms"),
        ratio(F.sum("engagement"), F.sum("engagement_n")).alias("engagement"),
        ratio(F.sum("completion"), F.sum("completion_n")).alias("completion"),
        F.floor(F.avg("span_ms")).cast("long").alias("session_ms"),
        mode(CARRIER)["vn"].alias("hour"),
        *[mode(a)["vs"].alias(f"top_{a}") for a in ("platform", "device", "genre", "artist", "track")],
        *[distinct(a).alias(f"distinct_{a}") for a in ("track", "artist", "session", "listener", "user", "premium")],
        F.to_json(F.map_filter(platforms, lambda k, v: v > 0)).alias("platforms"),
        _json_counts(F.collect_list(F.when((F.col("attr") == "location") & known, F.struct("vs", "n")))).alias("locations"))


def daily_tables(raw: DataFrame, trend_days: int = 7) -> dict[str, DataFrame]:
    """``user``, ``track`` and ``platform``: the tables of A10, A11 and A12, of which one scan of ``raw`` is the source."""
    spark = raw.sparkSession
    path = checkpoint_path(spark, f"daily-levels-{uuid.uuid4().hex}")
    levels = daily_levels(raw)
    # The folder names the level; rows of a day lie together as far as the aggregation left them so.
    # Both aggregations get a partition for every TASK_ROWS events at least, so that none outgrows its task.
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", max(int(own), -(-raw.count() // TASK_ROWS)))
    try:
        levels.write.partitionBy("level").parquet(path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
    stored = spark.read.schema(levels.schema).parquet(path)
    rate = lambda a, b: round6(F.col(a) / F.nullif(F.col(b), F.lit(0)))
    pick = lambda level: stored.where(F.col("level") == level)
    user = pick("user").select(
        F.col("k1").alias("user_id"), "analysis_date", "total_events", F.col("played_ms").alias("total_play_time_ms"),
        F.col("distinct_track").alias("unique_tracks"), F.col("distinct_artist").alias("unique_artists"), "top_genre",
        F.col("top_platform").alias("favorite_platform"), F.col("engagement").alias("average_engagement_score"),
        F.col("distinct_session").alias("listening_sessions"), F.col("top_device").alias("preferred_device"),
        F.col("hour").alias("most_active_hour"), rate("skips", "total_events").alias("skip_rate"), rate("full_plays", "plays").alias("completion_rate"))
    day = F.datediff(F.col("analysis_date"), F.lit("1970-01-01"))
    before = Window.partitionBy("k1", "k2").orderBy(day).rangeBetween(-trend_days, -1)
    trend = F.col("plays") / (1 + F.coalesce(F.sum("plays").over(before), F.lit(0)) / trend_days)
    track = pick("track").select(
        F.col("k1").alias("track_id"), F.col("k2").alias("artist_id"), "analysis_date", F.col("plays").alias("total_plays"),
        F.col("distinct_listener").alias("unique_listeners"), F.col("played_ms").alias("total_play_time_ms"),
        F.col("completion").alias("average_completion_ratio"), rate("skips", "total_events").alias("skip_rate"),
        rate("likes", "total_events").alias("like_rate"), rate("shares", "total_events").alias("share_rate"),
        F.col("adds").alias("playlist_adds"), F.col("platforms").alias("platform_distribution"),
        F.col("locations").alias("geographic_distribution"), F.col("hour").alias("peak_listening_hour"), round6(trend).alias("trending_score"))
    platform = pick("platform").select(
        F.col("k1").alias("platform"), "analysis_date", "total_events", F.col("distinct_user").alias("unique_users"),
        F.col("played_ms").alias("total_streaming_time_ms"), F.col("session_ms").alias("average_session_duration_ms"), "top_genre",
        F.col("top_artist").alias("most_popular_artist"), F.col("top_track").alias("most_popular_track"),
        F.col("engagement").alias("average_engagement_score"), rate("distinct_premium", "distinct_user").alias("premium_user_ratio"),
        rate("mobile", "total_events").alias("mobile_usage_ratio"), F.col("hour").alias("peak_usage_hour"))
    return {"user": user, "track": track, "platform": platform}
