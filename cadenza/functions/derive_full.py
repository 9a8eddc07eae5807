"""Row-level projections for shape A events (flatten and derived fields).

All rules are column expressions; a chain of them collapses into one
``Project`` inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.common import session_cached

# --- fixed values: platform categories --------------------------------------
PREMIUM_PLATFORMS = ["spotify", "apple_music", "tidal"]
AD_SUPPORTED_PLATFORMS = ["youtube_music", "soundcloud", "pandora"]
INTERACTIVE_TYPES = ["like", "share", "playlist_add"]
# -----------------------------------------------------------------------------

FLAT_COLUMNS = [
    "event_id", "event_type", "timestamp", "processing_timestamp",
    "track_id", "track_name", "track_duration_ms", "track_explicit", "track_popularity",
    "track_energy", "track_valence", "track_tempo", "track_genres",
    "artist_id", "artist_name", "artist_followers", "artist_verified", "artist_country",
    "artist_genres", "album_id", "album_name", "album_release_date",
    "user_id", "session_id", "device_type", "user_location", "subscription_type",
    "user_age_group", "platform", "stream_quality", "bandwidth_kbps", "buffer_events",
    "played_duration_ms", "skip_reason", "playlist_id", "shuffle_mode", "repeat_mode",
]
DERIVED_COLUMNS = [
    "hour_of_day", "day_of_week", "is_weekend", "month", "year",
    "track_duration_seconds", "is_long_track", "is_short_track",
    "play_completion_ratio", "is_full_play", "is_skip", "engagement_score",
    "platform_category",
]

def _empty() -> Column:
    return F.array().cast("array<string>")


def flatten_event(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested shape A event to the 37 base columns of the raw table.

    Missing genre lists become ``[]``; album and play fields are null when
    the struct is absent. ``keep`` columns (e.g. ``batch_file``) pass through.
    """
    t, ar, al, u, p, s = (F.col(c) for c in
                          ("track", "artist", "album", "user_interaction", "play_event", "streaming_event"))
    return df.select(
        *(keep or []),
        "event_id", "event_type", "timestamp", "processing_timestamp",
        t["id"].alias("track_id"), t["name"].alias("track_name"),
        t["duration_ms"].alias("track_duration_ms"),
        F.coalesce(t["explicit"], F.lit(False)).alias("track_explicit"),
        t["popularity"].alias("track_popularity"), t["energy"].alias("track_energy"),
        t["valence"].alias("track_valence"), t["tempo"].alias("track_tempo"),
        F.coalesce(t["genres"], _empty()).alias("track_genres"),
        ar["id"].alias("artist_id"), ar["name"].alias("artist_name"),
        ar["followers"].alias("artist_followers"),
        F.coalesce(ar["verified"], F.lit(False)).alias("artist_verified"),
        ar["country"].alias("artist_country"),
        F.coalesce(ar["genres"], _empty()).alias("artist_genres"),
        al["id"].alias("album_id"), al["name"].alias("album_name"),
        al["release_date"].alias("album_release_date"),
        u["user_id"].alias("user_id"), u["session_id"].alias("session_id"),
        u["device_type"].alias("device_type"), u["location"].alias("user_location"),
        u["subscription_type"].alias("subscription_type"),
        u["user_age_group"].alias("user_age_group"),
        s["platform"].alias("platform"), s["stream_quality"].alias("stream_quality"),
        s["bandwidth_kbps"].alias("bandwidth_kbps"), s["buffer_events"].alias("buffer_events"),
        p["played_duration_ms"].alias("played_duration_ms"), p["skip_reason"].alias("skip_reason"),
        p["playlist_id"].alias("playlist_id"), p["shuffle_mode"].alias("shuffle_mode"),
        p["repeat_mode"].alias("repeat_mode"),
    )


def raw_play_ratio(played: Column, duration_ms: Column) -> Column:
    """played / duration, null without a play event or a non-zero duration."""
    return F.when(duration_ms != 0, played / duration_ms)


def engagement_score(event_type: Column, ratio: Column, has_play: Column, repeat_mode: Column) -> Column:
    """P5: 0.5 base, +0.3*uncapped ratio, +0.4 interactive, +0.1 repeat, -0.2 skip; clamp 0..1."""
    score = (F.lit(0.5)
             + F.coalesce(ratio * 0.3, F.lit(0.0))
             + F.when(event_type.isin(*INTERACTIVE_TYPES), 0.4).otherwise(0.0)
             + F.when(has_play & (repeat_mode != "off"), 0.1).otherwise(0.0)
             - F.when(event_type == "skip", 0.2).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def platform_category(platform: Column) -> Column:
    """P6."""
    return (F.when(platform.isin(*PREMIUM_PLATFORMS), "premium")
            .when(platform.isin(*AD_SUPPORTED_PLATFORMS), "ad_supported")
            .otherwise("other"))


def derive_fields(flat: DataFrame) -> DataFrame:
    """P2-P6 on flat rows: time parts, duration, completion, engagement, category.

    ``day_of_week`` counts Monday as 0. A null or zero duration leaves the
    duration and completion fields null.
    """
    return flat.select("*", *_derived_columns())


@session_cached
def _derived_columns() -> list[Column]:
    ts = F.col("timestamp")
    dur = F.col("track_duration_ms")
    has_play = F.col("played_duration_ms").isNotNull()
    secs = F.when(dur != 0, dur / 1000.0)
    ratio = raw_play_ratio(F.col("played_duration_ms"), dur)
    dow = F.weekday(ts).cast("long")
    return [
        F.hour(ts).cast("long").alias("hour_of_day"),
        dow.alias("day_of_week"),
        (dow >= 5).alias("is_weekend"),
        F.month(ts).cast("long").alias("month"),
        F.year(ts).cast("long").alias("year"),
        secs.alias("track_duration_seconds"),
        (secs > 300).alias("is_long_track"),
        (secs < 120).alias("is_short_track"),
        # least() skips nulls, so guard it to keep "no ratio" null
        F.when(ratio.isNotNull(), F.least(ratio, F.lit(1.0))).alias("play_completion_ratio"),
        (ratio >= 0.8).alias("is_full_play"),
        (ratio < 0.3).alias("is_skip"),
        engagement_score(F.col("event_type"), ratio, has_play, F.col("repeat_mode")).alias("engagement_score"),
        platform_category(F.col("platform")).alias("platform_category"),
    ]


def raw_music_events(nested: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested shape A events to the 50-column raw table (P1 then P2-P6)."""
    return derive_fields(flatten_event(nested, keep))
