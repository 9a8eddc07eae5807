"""Music events derived from the driver's ``events`` table.

The test tables hold no music data, so every music column is a fixed,
deterministic function of one ``events`` row (``event_id`` e, ``user_id`` u,
``ts``, ``event_type``, ``value`` and ``props`` = ``{"k": n}``). The mapping is
row-local: no join, no shuffle, one fused projection that scales with the
scan. ``cadenza.plans.oracle`` holds the same mapping as a DuckDB CTE; keep
the two in step.

Artist slot ``a = k % 20``: slots 0-14 are the fifteen catalog artists (so the
rule tables fire on real rows), slots 15-19 are plain ``Artist a`` names (so
the genre fallbacks fire too). Track ``k`` < 15 carries the catalog title.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.common import session_cached
from cadenza.sources.tables import read_table
from cadenza.schemas import GENRES_A, PLATFORMS_A, PLATFORMS_B

# --- fixed values: the fifteen-track catalog (titles, artists, albums, years,
# genres) in catalog order -----------------------------------------------------
CATALOG_TITLES = [
    "Hotel California", "Bohemian Rhapsody", "Stairway to Heaven",
    "Sweet Child O Mine", "Billie Jean", "Like a Rolling Stone", "Imagine",
    "Smells Like Teen Spirit", "Superstition", "Respect", "Purple Haze",
    "Good Vibrations", "What's Going On", "Johnny B. Goode",
    "I Want to Hold Your Hand",
]
CATALOG_ARTISTS = [
    "Eagles", "Queen", "Led Zeppelin", "Guns N Roses", "Michael Jackson",
    "Bob Dylan", "John Lennon", "Nirvana", "Stevie Wonder", "Aretha Franklin",
    "Jimi Hendrix", "The Beach Boys", "Marvin Gaye", "Chuck Berry", "The Beatles",
]
CATALOG_ALBUMS = [
    "Hotel California", "A Night at the Opera", "Led Zeppelin IV",
    "Appetite for Destruction", "Thriller", "Highway 61 Revisited", "Imagine",
    "Nevermind", "Talking Book", "I Never Loved a Man the Way I Love You",
    "Are You Experienced", "Smiley Smile", "What's Going On",
    "Chuck Berry Is on Top", "Meet the Beatles!",
]
CATALOG_YEARS = [1976, 1975, 1971, 1987, 1982, 1965, 1971, 1991, 1972, 1967,
                 1967, 1966, 1971, 1958, 1963]
# ------------------------------------------------------------------------------

# Adapter value pools (ours, not the reference's).
GENRE_POOL_B = ["rock", "pop", "hip_hop", "electronic", "jazz", "classical",
                "folk", "soul", "funk", "other"]
DEVICES = ["mobile", "desktop", "tablet"]
COUNTRIES = ["US", "UK", "DE", "FR", "JP"]
CITIES = ["New York", "Los Angeles", "London", "Miami", "Paris"]
AGE_GROUPS = ["18-24", "25-34", "35-44", "45+"]
QUALITIES = ["high", "medium", "low"]
BITRATES = [320, 128, 64]
N_ARTIST_SLOTS = 20


def read_events(spark: SparkSession, sf_dir: str, since: dt.date | None = None,
                until: dt.date | None = None) -> DataFrame:
    """Scan ``events`` with an optional half-open ``[since, until)`` date range.

    The range is put on the raw ``ts`` column so it reaches the Parquet scan
    as a pushed filter (row-group skipping) instead of being evaluated after
    the music columns are built.
    """
    df = read_table(spark, sf_dir, "events", spread_key="event_id")
    if since is not None:
        df = df.filter(F.col("ts") >= F.lit(dt.datetime.combine(since, dt.time())).cast("timestamp_ntz"))
    if until is not None:
        df = df.filter(F.col("ts") < F.lit(dt.datetime.combine(until, dt.time())).cast("timestamp_ntz"))
    return df


def pick(values: list, idx: Column) -> Column:
    """Item ``idx`` (0-based) of a literal list; folds into generated code."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


@session_cached
def _key_columns() -> list[Column]:
    k = F.get_json_object("props", "$.k").cast("int")
    return [F.col("*"), k.alias("_k"), (k % N_ARTIST_SLOTS).alias("_a"), F.col("ts").cast("timestamp").alias("_ts")]


def _keys(events: DataFrame) -> DataFrame:
    return events.select(*_key_columns())


def _title(k: Column) -> Column:
    return F.when(k < 15, pick(CATALOG_TITLES, k)).otherwise(F.concat(F.lit("Track "), k.cast("string")))


def _artist(a: Column) -> Column:
    return F.when(a < 15, pick(CATALOG_ARTISTS, a)).otherwise(F.concat(F.lit("Artist "), a.cast("string")))


def _user(u: Column) -> Column:
    return F.concat(F.lit("user-"), F.lpad(u.cast("string"), 6, "0"))


def _session(u: Column, ts: Column) -> Column:
    return F.concat(_user(u), F.lit("-"), F.date_format(ts, "yyyy-MM-dd"))


def event_type_a(e: Column, src: Column) -> Column:
    return (F.when(src.isin("view", "click"), "play")
            .when(src == "error", "skip")
            .when(src == "purchase", pick(["like", "share", "playlist_add"], e % 3))
            .when(src == "signup", "download"))


def event_type_b(e: Column, src: Column) -> Column:
    return (F.when(src.isin("view", "click"), "play")
            .when(src == "error", "skip")
            .when(src == "signup", "pause")
            .when(src == "purchase", F.when(e % 2 == 0, "like").otherwise("share")))


def flat_events_a(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Shape A events as the 37 flat base columns, one per ``events`` row.

    Flat output lets Catalyst drop every column a query does not use before
    it is computed; ``nest_a`` rebuilds the nested message form.
    """
    return _keys(events).select(*(keep or []), *_flat_a_columns())


@session_cached
def _flat_a_columns() -> list[Column]:
    k, a, e, u, ts = F.col("_k"), F.col("_a"), F.col("event_id"), F.col("user_id"), F.col("_ts")
    etype = event_type_a(e, F.col("event_type"))
    is_play = etype == "play"
    has_album = (k % 5) != 4
    genres = F.when(k % 16 == 15, F.array().cast("array<string>")).otherwise(F.array(pick(GENRES_A, k % 16)))
    return [
        F.concat(F.lit("evt-"), e.cast("string")).alias("event_id"),
        etype.alias("event_type"),
        ts.alias("timestamp"),
        ts.alias("processing_timestamp"),
        F.concat(F.lit("track-"), k.cast("string")).alias("track_id"),
        _title(k).alias("track_name"),
        F.when(k == 0, F.lit(None)).when(k == 50, F.lit(0)).otherwise(60000 + k * 4000).cast("long").alias("track_duration_ms"),
        (k % 4 == 0).alias("track_explicit"),
        F.when(k % 10 != 3, k).cast("long").alias("track_popularity"),
        F.when(k % 13 != 0, (k % 11) / 10.0).alias("track_energy"),
        F.when(k % 17 != 0, (k % 5) / 4.0).alias("track_valence"),
        F.when(k % 19 == 0, F.lit(0.0)).otherwise((60 + k).cast("double")).alias("track_tempo"),
        genres.alias("track_genres"),
        F.concat(F.lit("artist-"), a.cast("string")).alias("artist_id"),
        _artist(a).alias("artist_name"),
        (a * 1000).cast("long").alias("artist_followers"),
        (a < 10).alias("artist_verified"),
        pick(COUNTRIES, a % 5).alias("artist_country"),
        F.array(pick(GENRES_A, a % 16)).alias("artist_genres"),
        F.when(has_album, F.concat(F.lit("album-"), a.cast("string"))).alias("album_id"),
        F.when(has_album, F.when(a < 15, pick(CATALOG_ALBUMS, a))
               .otherwise(F.concat(F.lit("Album "), a.cast("string")))).alias("album_name"),
        F.when(has_album, F.make_timestamp(F.when(a < 15, pick(CATALOG_YEARS, a)).otherwise(2000 + a),
                                           F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))).alias("album_release_date"),
        _user(u).alias("user_id"),
        _session(u, ts).alias("session_id"),
        pick(DEVICES, e % 3).alias("device_type"),
        pick(COUNTRIES, u % 5).alias("user_location"),
        F.when(u % 2 == 0, "premium").otherwise("free").alias("subscription_type"),
        pick(AGE_GROUPS, u % 4).alias("user_age_group"),
        pick(PLATFORMS_A, u % 7).alias("platform"),
        pick(QUALITIES, e % 3).alias("stream_quality"),
        (64 * (1 + e % 5)).cast("long").alias("bandwidth_kbps"),
        (e % 4).cast("long").alias("buffer_events"),
        F.when(is_play, F.floor(F.col("value") * 2000).cast("long")).alias("played_duration_ms"),
        F.when(is_play & (e % 5 == 0), "user_skip").alias("skip_reason"),
        F.when(is_play & (e % 4 == 0), F.concat(F.lit("playlist-"), (u % 10).cast("string"))).alias("playlist_id"),
        F.when(is_play, e % 2 == 0).alias("shuffle_mode"),
        F.when(is_play, F.when(e % 10 < 7, "off").when(e % 10 < 9, "track").otherwise("context")).alias("repeat_mode"),
    ]


def nest_a(flat: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flat shape A columns back to the nested message shape (inverse of P1).

    ``album`` is absent when ``album_id`` is null and ``play_event`` when
    ``played_duration_ms`` is null.
    """
    return flat.select(*(keep or []), *_nest_a_columns())


@session_cached
def _nest_a_columns() -> list[Column]:
    c = F.col
    return [
        "event_id", "event_type", "timestamp", "processing_timestamp",
        F.struct(c("track_id").alias("id"), c("track_name").alias("name"), c("artist_id").alias("artist_id"),
                 c("album_id").alias("album_id"), c("track_duration_ms").alias("duration_ms"),
                 c("track_explicit").alias("explicit"), c("track_popularity").alias("popularity"),
                 c("track_energy").alias("energy"), c("track_valence").alias("valence"),
                 c("track_tempo").alias("tempo"), c("track_genres").alias("genres")).alias("track"),
        F.struct(c("artist_id").alias("id"), c("artist_name").alias("name"), c("artist_genres").alias("genres"),
                 c("artist_followers").alias("followers"), c("artist_verified").alias("verified"),
                 c("artist_country").alias("country")).alias("artist"),
        F.when(c("album_id").isNotNull(), F.struct(
            c("album_id").alias("id"), c("album_name").alias("name"), c("artist_id").alias("artist_id"),
            c("album_release_date").alias("release_date"),
            F.lit(None).cast("long").alias("track_count"),
            c("artist_genres").alias("genres"))).alias("album"),
        F.struct(c("user_id").alias("user_id"), c("session_id").alias("session_id"),
                 c("device_type").alias("device_type"), c("user_location").alias("location"),
                 c("subscription_type").alias("subscription_type"),
                 c("user_age_group").alias("user_age_group")).alias("user_interaction"),
        F.when(c("played_duration_ms").isNotNull(), F.struct(
            c("played_duration_ms").alias("played_duration_ms"), c("skip_reason").alias("skip_reason"),
            c("playlist_id").alias("playlist_id"), c("shuffle_mode").alias("shuffle_mode"),
            c("repeat_mode").alias("repeat_mode"))).alias("play_event"),
        F.struct(c("platform").alias("platform"), c("stream_quality").alias("stream_quality"),
                 c("bandwidth_kbps").alias("bandwidth_kbps"),
                 c("buffer_events").alias("buffer_events")).alias("streaming_event"),
    ]


def nested_events_a(events: DataFrame) -> DataFrame:
    """Shape A ("full") nested events, one per ``events`` row."""
    return nest_a(flat_events_a(events))


def nested_events_b(events: DataFrame) -> DataFrame:
    """Shape B ("simple") nested events; ``timestamp`` is ISO text with ``Z``."""
    return _keys(events).select(*_nested_b_columns())


@session_cached
def _nested_b_columns() -> list[Column]:
    k, a, e, u, ts = F.col("_k"), F.col("_a"), F.col("event_id"), F.col("user_id"), F.col("_ts")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    genre = pick(GENRE_POOL_B, k % 10)
    return [
        F.concat(F.lit("evt-"), e.cast("string")).alias("event_id"),
        event_type_b(e, F.col("event_type")).alias("event_type"),
        F.struct(
            F.concat(F.lit("track-"), k.cast("string")).alias("id"),
            _title(k).alias("title"),
            _artist(a).alias("artist"),
            F.when(a < 15, pick(CATALOG_ALBUMS, a)).otherwise(F.concat(F.lit("Album "), a.cast("string"))).alias("album"),
            (60 + k * 4).cast("long").alias("duration"),
            genre.alias("genre"),
            F.when(a < 15, pick(CATALOG_YEARS, a)).otherwise(2000 + a).cast("long").alias("release_year"),
        ).alias("track"),
        F.struct(
            F.concat(F.lit("artist-"), a.cast("string")).alias("id"),
            _artist(a).alias("name"),
            genre.alias("genre"),
            (a * 1000).cast("long").alias("followers"),
        ).alias("artist"),
        F.struct(
            _user(u).alias("user_id"),
            _session(u, ts).alias("session_id"),
            iso.alias("timestamp"),
            pick(CITIES, u % 5).alias("location"),
        ).alias("user_interaction"),
        F.struct(
            pick(PLATFORMS_B, u % 4).alias("platform"),
            pick(QUALITIES, e % 3).alias("quality"),
            pick(BITRATES, e % 3).cast("long").alias("bitrate"),
        ).alias("streaming_event"),
        iso.alias("timestamp"),
    ]
