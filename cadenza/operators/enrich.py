"""Enriched event tables (S6): shape A ``enriched_music_events`` and shape B
``enriched_events``, built from the rule enrichment and confidence scores.

Row-local projections over the raw or enrichment-input rows; the same code
runs in a ``foreachBatch`` sink or in batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import confidence as C
from cadenza.operators import rules

RULES_MODEL = "rules"  # enrichment_model label of rule-based enrichment

ENRICHED_A_COLUMNS = [
    "event_id", "event_type", "timestamp", "processing_timestamp", "track_id", "track_name", "artist_id",
    "artist_name", "album_id", "album_name", "platform", "user_id", "session_id", "enhanced_description",
    "mood_analysis", "genre_prediction", "similar_tracks", "listening_context", "enrichment_timestamp",
    "enrichment_model", "enrichment_confidence",
]
ENRICHED_B_COLUMNS = [
    "event_id", "event_type", "track_title", "artist_name", "platform", "event_description", "mood_analysis",
    "predicted_genres", "listening_context", "similar_tracks", "enrichment_confidence", "timestamp",
    "enrichment_timestamp",
]


def json_list(arr: Column) -> Column:
    """A string array as JSON text laid out ``["a", "b"]`` (null when empty or null).

    Each element is quoted by ``to_json`` (so quotes and backslashes are
    escaped), then joined with ``", "``.
    """
    quoted = F.transform(arr, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"^\[(.*)\]$", 1))
    return F.when(F.size(F.coalesce(arr, F.array())) > 0,
                  F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def enriched_music_events(raw: DataFrame, enriched_at: Column | None = None,
                          model: str = RULES_MODEL, keep: list[str] | None = None) -> DataFrame:
    """Shape A raw rows to the 21-column enriched table.

    Labels come from the artist/track rules (R1-R5) with the first track
    genre as the genre; confidence is the data-completeness score (P8). ``keep``
    columns of ``raw`` are passed through after the others.
    """
    c = F.col
    base = raw.select(
        "*", c("track_name").alias("track_title"),
        F.coalesce(F.try_element_at(c("track_genres"), F.lit(1)), F.lit("")).alias("genre"))
    labelled = rules.enrich_rules(base)
    conf = C.data_confidence(c("track_genres"), c("track_energy"), c("track_valence"), c("track_tempo"),
                             c("track_popularity"), c("device_type"), c("user_location"),
                             c("played_duration_ms").isNotNull())
    return labelled.select(
        *[c(x) for x in ENRICHED_A_COLUMNS[:13]],
        c("event_description").alias("enhanced_description"), "mood_analysis",
        c("predicted_genres").alias("genre_prediction"), "similar_tracks", "listening_context",
        (enriched_at if enriched_at is not None else F.current_timestamp()).alias("enrichment_timestamp"),
        F.lit(model).alias("enrichment_model"), conf.alias("enrichment_confidence"), *(keep or []))


def enriched_events_b(enr: DataFrame, enriched_at: Column | None = None) -> DataFrame:
    """Shape B enrichment input to the 13-column production enriched row (R6 + Q9).

    Lists are stored as JSON text; ``timestamp`` is the event time in ISO form.
    """
    c = F.col
    df = rules.enrich_production(enr)
    conf = C.production_confidence(c("track_title"), c("track_artist"), c("genre"), c("user_location"),
                                   c("platform"))
    return df.select(
        "event_id", "event_type", "track_title", "artist_name", "platform",
        c("enhanced_description").alias("event_description"), "mood_analysis",
        json_list(c("genre_prediction")).alias("predicted_genres"), "listening_context",
        json_list(c("similar_tracks")).alias("similar_tracks"), conf.alias("enrichment_confidence"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        (enriched_at if enriched_at is not None else F.current_timestamp()).alias("enrichment_timestamp"))
