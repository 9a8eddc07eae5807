"""Dimension lookups (J1, J3), the track catalog and catalog search (F2).

Dimensions are derived from the events with Spark (one aggregation per
dimension), so they grow with the data. A lookup join is a plain equi-join
on the id: Spark broadcasts the dimension only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime,
after the dimension's aggregation has run) and otherwise shuffles both
sides on the key. The attributes are made distinct by a hash aggregate first,
so ``min`` over strings sorts the few distinct rows, not the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.reports import modes
from cadenza.operators.rules import enrich_rules


def lookup_join(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of facts to a dimension by id; no fact row is lost."""
    return fact.join(dim, key, "left")


def track_catalog(events_b: DataFrame) -> DataFrame:
    """One row per track from shape B enrichment input, with rule labels.

    Attributes are functionally dependent on ``track_id``, so ``min`` picks
    the value; the platform is the most frequent one (ties to the smallest).
    The rule labels are computed once per track, after the aggregation.
    """
    base = events_b.select("track_id", "track_title", "artist_name", "album", "genre", "release_year", "duration").distinct().groupBy("track_id").agg(
        F.min("track_title").alias("track_title"), F.min("artist_name").alias("artist_name"),
        F.min("album").alias("album"), F.min("genre").alias("genre"),
        F.min("release_year").alias("release_year"), F.min("duration").alias("duration"))
    plat = modes(events_b, ["track_id"], {"platform": F.col("platform")})
    return (enrich_rules(base.join(plat, "track_id", "left"))
            .select("track_id", "track_title", "artist_name", "album", "genre", "release_year", "duration",
                    "platform", "mood_analysis", "predicted_genres", "listening_context", "similar_tracks"))


def artist_dimension(raw: DataFrame) -> DataFrame:
    """Artist attributes by ``artist_id`` from shape A raw rows."""
    attributes = ["artist_id", "artist_name", "artist_followers", "artist_verified", "artist_country"]
    return raw.select(*attributes).distinct().groupBy("artist_id").agg(
        F.min("artist_name").alias("artist_name"), F.max("artist_followers").alias("artist_followers"),
        F.max(F.col("artist_verified").cast("int")).cast("boolean").alias("artist_verified"),
        F.min("artist_country").alias("artist_country"))


def album_dimension(raw: DataFrame) -> DataFrame:
    """Album attributes by ``album_id`` (events without an album are left out)."""
    return (raw.filter(F.col("album_id").isNotNull()).select("album_id", "album_name", "album_release_date").distinct()
            .groupBy("album_id")
            .agg(F.min("album_name").alias("album_name"), F.min("album_release_date").alias("album_release_date")))


def search_catalog(catalog: DataFrame, genre: str | None = None, artist: str | None = None,
                   mood: str | None = None, platform: str | None = None) -> DataFrame:
    """tracks matching every given filter.

    genre: case-blind substring of the track's genre or of one of its
    predicted genres; artist and mood: case-blind substring; platform: exact.
    """
    cond: Column = F.lit(True)
    if genre is not None:
        wanted = genre.lower()
        cond = cond & (F.lower(F.col("genre")).contains(wanted)
                       | F.coalesce(F.exists("predicted_genres", lambda g: F.lower(g).contains(wanted)), F.lit(False)))
    if artist is not None:
        cond = cond & F.lower(F.col("artist_name")).contains(artist.lower())
    if mood is not None:
        cond = cond & F.lower(F.col("mood_analysis")).contains(mood.lower())
    if platform is not None:
        cond = cond & (F.col("platform") == platform)
    return catalog.filter(cond)


def genre_track_counts(catalog: DataFrame) -> DataFrame:
    """Tracks and distinct artists per genre, case-blind, and over all genres (genre null)."""
    return catalog.select(F.lower("genre").alias("genre"), "artist_name").groupingSets(
        [[F.col("genre")], []], "genre").agg(F.count(F.lit(1)).alias("tracks"), F.countDistinct("artist_name").alias("artists"),
                                             (F.grouping("genre") == 1).alias("all_genres"))
