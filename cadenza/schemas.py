"""Declared schemas and closed value sets.

Events are never schema-inferred: the nested shapes below are applied with
``from_json`` / ``spark.read.schema(...)``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's (enums) -----------------
# Shape A ("full") event types, platforms and genres.
EVENT_TYPES_A = ["play", "skip", "like", "share", "playlist_add", "download", "search"]
PLATFORMS_A = ["spotify", "apple_music", "youtube_music", "amazon_music", "tidal",
               "soundcloud", "pandora"]
GENRES_A = ["pop", "rock", "hip_hop", "electronic", "jazz", "classical", "country",
            "r_and_b", "indie", "alternative", "folk", "reggae", "blues", "metal",
            "punk", "other"]
REPEAT_MODES = ["off", "track", "context"]

# Shape B ("simple") event types and platforms.
EVENT_TYPES_B = ["play", "pause", "skip", "like", "share"]
PLATFORMS_B = ["spotify", "apple_music", "youtube_music", "soundcloud"]
# --------------------------------------------------------------------------


def _s(name, t=T.StringType(), nullable=True):
    return T.StructField(name, t, nullable)


STR_ARRAY = T.ArrayType(T.StringType())

TRACK_A = T.StructType([
    _s("id"), _s("name"), _s("artist_id"), _s("album_id"),
    _s("duration_ms", T.LongType()), _s("explicit", T.BooleanType()),
    _s("popularity", T.LongType()), _s("energy", T.DoubleType()),
    _s("valence", T.DoubleType()), _s("tempo", T.DoubleType()),
    _s("genres", STR_ARRAY),
])
ARTIST_A = T.StructType([
    _s("id"), _s("name"), _s("genres", STR_ARRAY), _s("followers", T.LongType()),
    _s("verified", T.BooleanType()), _s("country"),
])
ALBUM_A = T.StructType([
    _s("id"), _s("name"), _s("artist_id"), _s("release_date", T.TimestampType()),
    _s("track_count", T.LongType()), _s("genres", STR_ARRAY),
])
USER_A = T.StructType([
    _s("user_id"), _s("session_id"), _s("device_type"), _s("location"),
    _s("subscription_type"), _s("user_age_group"),
])
PLAY_A = T.StructType([
    _s("played_duration_ms", T.LongType()), _s("skip_reason"), _s("playlist_id"),
    _s("shuffle_mode", T.BooleanType()), _s("repeat_mode"),
])
STREAM_A = T.StructType([
    _s("platform"), _s("stream_quality"), _s("bandwidth_kbps", T.LongType()),
    _s("buffer_events", T.LongType()),
])

# Nested shape A event, as carried in a JSON message.
EVENT_A = T.StructType([
    _s("event_id"), _s("event_type"), _s("timestamp", T.TimestampType()),
    _s("processing_timestamp", T.TimestampType()),
    _s("track", TRACK_A), _s("artist", ARTIST_A), _s("album", ALBUM_A),
    _s("user_interaction", USER_A), _s("play_event", PLAY_A),
    _s("streaming_event", STREAM_A),
])

TRACK_B = T.StructType([
    _s("id"), _s("title"), _s("artist"), _s("album"), _s("duration", T.LongType()),
    _s("genre"), _s("release_year", T.LongType()),
])
ARTIST_B = T.StructType([_s("id"), _s("name"), _s("genre"), _s("followers", T.LongType())])
USER_B = T.StructType([_s("user_id"), _s("session_id"), _s("timestamp"), _s("location")])
STREAM_B = T.StructType([_s("platform"), _s("quality"), _s("bitrate", T.LongType())])

# Nested shape B event; the timestamp stays text (ISO with optional "Z").
EVENT_B = T.StructType([
    _s("event_id"), _s("event_type"), _s("track", TRACK_B), _s("artist", ARTIST_B),
    _s("user_interaction", USER_B), _s("streaming_event", STREAM_B), _s("timestamp"),
])

# Track catalog with golden labels.
CATALOG = T.StructType([
    _s("id"), _s("title"), _s("artist"), _s("album"), _s("genre"),
    _s("duration", T.LongType()), _s("release_year", T.LongType()), _s("platform"),
    _s("expected_mood"), _s("expected_genres", STR_ARRAY), _s("expected_context"),
    _s("similar_tracks", STR_ARRAY),
])
