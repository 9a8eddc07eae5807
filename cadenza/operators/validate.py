"""Parse, validate and quarantine.

A message is parsed with ``from_json`` against the declared schema. Every
rule is a boolean column that adds an error code; the codes of one row are
collected with ``array`` + ``filter(x -> x is not null)``. Rows without codes
go on as clean (names trimmed, defaults filled); the rest keep their raw
text and codes for the dead-letter table. No row ever leaves its task, and
nothing is counted on the driver: counts are ``observe`` metrics or a
``groupBy`` the caller runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cadenza.functions.common import round6, session_cached
from cadenza.functions.text import strip
from cadenza.schemas import EVENT_A, EVENT_TYPES_A, GENRES_A, PLATFORMS_A, REPEAT_MODES
from cadenza.sources.messages import parse_once

# --- fixed values: field limits --------------------------------------------------
TRACK_NAME_MAX = 300
ARTIST_NAME_MAX = 200
ALBUM_NAME_MAX = 300
COUNTRY_MAX = 2
DESCRIPTION_MAX = 1000
USER_ID_MIN = 8
# -------------------------------------------------------------------------------

def parse_json(raw: DataFrame, schema=EVENT_A, value_col: str = "value") -> DataFrame:
    """V1: text column to the nested event plus ``parse_ok``.

    Parsed in PERMISSIVE mode with a corrupt-record field, so malformed text
    is flagged (Spark returns an all-null struct for it, not a null) and its
    raw text is kept for the dead-letter table.
    """
    rest = [c for c in raw.columns if c != value_col]
    return parse_once(raw, schema, value_col).select(
        F.col(value_col).alias("raw_value"), *[F.col("e")[f.name].alias(f.name) for f in schema.fields], *rest, "parse_ok")


def _err(cond: Column, code: str) -> Column:
    return F.when(cond, F.lit(code))


def _name_errors(name: Column, prefix: str, max_len: int) -> list[Column]:
    # length on the raw value, then the blank test; the trimmed value is kept later
    return [
        _err(name.isNull(), f"{prefix}_missing"),
        _err(F.length(name) > max_len, f"{prefix}_too_long"),
        _err(name.isNotNull() & (F.length(strip(name)) == 0), f"{prefix}_empty"),
    ]


def _range(c: Column, lo=None, hi=None) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return c.isNotNull() & cond


def _enum_array_bad(arr: Column, allowed: list[str]) -> Column:
    return arr.isNotNull() & ~F.forall(arr, lambda g: g.isin(*allowed))


def event_errors(raw_json: Column | None = None) -> Column:
    """V3-V9 (+ V12 when ``raw_json`` is given): array of error codes for a parsed shape A row."""
    t, ar, al, u, p, s = (F.col(c) for c in
                          ("track", "artist", "album", "user_interaction", "play_event", "streaming_event"))
    codes = [
        # V3 required fields
        _err(F.col("event_type").isNull(), "event_type_missing"),
        _err(t.isNull(), "track_missing"),
        _err(ar.isNull(), "artist_missing"),
        _err(u.isNull(), "user_interaction_missing"),
        _err(s.isNull(), "streaming_event_missing"),
        _err(t.isNotNull() & t["id"].isNull(), "track_id_missing"),
        _err(t.isNotNull() & t["artist_id"].isNull(), "track_artist_id_missing"),
        _err(ar.isNotNull() & ar["id"].isNull(), "artist_id_missing"),
        _err(al.isNotNull() & (al["id"].isNull() | al["artist_id"].isNull()), "album_id_missing"),
        _err(u.isNotNull() & u["user_id"].isNull(), "user_id_missing"),
        _err(u.isNotNull() & u["session_id"].isNull(), "session_id_missing"),
        _err(s.isNotNull() & s["platform"].isNull(), "platform_missing"),
        _err(p.isNotNull() & p["played_duration_ms"].isNull(), "played_duration_missing"),
        # V4 ranges (null passes)
        _err(_range(t["duration_ms"], lo=0), "duration_out_of_range"),
        _err(_range(t["popularity"], 0, 100), "popularity_out_of_range"),
        _err(_range(t["energy"], 0.0, 1.0), "energy_out_of_range"),
        _err(_range(t["valence"], 0.0, 1.0), "valence_out_of_range"),
        _err(_range(t["tempo"], lo=0.0), "tempo_out_of_range"),
        _err(_range(ar["followers"], lo=0), "followers_out_of_range"),
        _err(_range(al["track_count"], lo=1), "track_count_out_of_range"),
        _err(_range(p["played_duration_ms"], lo=0), "played_duration_out_of_range"),
        _err(_range(s["bandwidth_kbps"], lo=0), "bandwidth_out_of_range"),
        _err(_range(s["buffer_events"], lo=0), "buffer_events_out_of_range"),
        # V5 lengths
        _err(F.length(ar["country"]) > COUNTRY_MAX, "artist_country_too_long"),
        _err(F.length(u["location"]) > COUNTRY_MAX, "location_too_long"),
        # V6 enums
        _err(F.col("event_type").isNotNull() & ~F.col("event_type").isin(*EVENT_TYPES_A), "event_type_invalid"),
        _err(s["platform"].isNotNull() & ~s["platform"].isin(*PLATFORMS_A), "platform_invalid"),
        _err(_enum_array_bad(t["genres"], GENRES_A), "track_genre_invalid"),
        _err(_enum_array_bad(ar["genres"], GENRES_A), "artist_genre_invalid"),
        _err(_enum_array_bad(al["genres"], GENRES_A), "album_genre_invalid"),
        # V7
        _err(p.isNotNull() & p["repeat_mode"].isNotNull() & ~p["repeat_mode"].isin(*REPEAT_MODES),
             "repeat_mode_invalid"),
        # V8 a play needs its play_event
        _err((F.col("event_type") == "play") & p.isNull(), "play_without_play_event"),
        # V9 track and artist agree
        _err(t["artist_id"].isNotNull() & ar["id"].isNotNull() & (t["artist_id"] != ar["id"]),
             "artist_mismatch"),
    ]
    codes += _name_errors(t["name"], "track_name", TRACK_NAME_MAX)
    codes += _name_errors(ar["name"], "artist_name", ARTIST_NAME_MAX)
    codes += [F.when(al.isNotNull(), c) for c in _name_errors(al["name"], "album_name", ALBUM_NAME_MAX)]
    if raw_json is not None:
        codes.append(_err(~business_rules_ok(raw_json), "business_rule"))
    return F.filter(F.array(*codes), lambda x: x.isNotNull())


def business_rules_ok(raw_json: Column) -> Column:
    """Platform present; spotify events carry a ``popularity`` key (null
    counts as present); ``user_id`` at least 8 characters. Key presence is read
    from the raw text because a parsed null cannot tell absent from null."""
    platform = F.get_json_object(raw_json, "$.streaming_event.platform")
    track_keys = F.json_object_keys(F.get_json_object(raw_json, "$.track"))
    user_id = F.get_json_object(raw_json, "$.user_interaction.user_id")
    has_pop = F.coalesce(F.array_contains(track_keys, "popularity"), F.lit(False))
    return (F.coalesce(platform != "", F.lit(False))
            & ((platform != "spotify") | has_pop)
            & F.coalesce(F.length(user_id) >= USER_ID_MIN, F.lit(False)))


def message_uuid(text: Column) -> Column:
    """An id for a message that carries none: the same for the same text, so a
    message that is loaded or delivered again is known again."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def clean_event(df: DataFrame) -> DataFrame:
    """V5 + V11: trim names and fill defaults on rows that passed."""
    t, ar, al, p = F.col("track"), F.col("artist"), F.col("album"), F.col("play_event")
    empty = F.array().cast("array<string>")
    own = message_uuid(F.col("raw_value")) if "raw_value" in df.columns else F.expr("uuid()")
    return (df
            .withColumn("event_id", F.coalesce(F.col("event_id"), own))
            .withColumn("timestamp", F.coalesce(F.col("timestamp"), F.current_timestamp()))
            .withColumn("processing_timestamp", F.coalesce(F.col("processing_timestamp"), F.current_timestamp()))
            .withColumn("track", t.withField("name", strip(t["name"]))
                        .withField("explicit", F.coalesce(t["explicit"], F.lit(False)))
                        .withField("genres", F.coalesce(t["genres"], empty)))
            .withColumn("artist", ar.withField("name", strip(ar["name"]))
                        .withField("verified", F.coalesce(ar["verified"], F.lit(False)))
                        .withField("genres", F.coalesce(ar["genres"], empty)))
            .withColumn("album", F.when(al.isNotNull(), al.withField("name", strip(al["name"]))
                                        .withField("genres", F.coalesce(al["genres"], empty))))
            .withColumn("play_event", F.when(p.isNotNull(), p
                                             .withField("shuffle_mode", F.coalesce(p["shuffle_mode"], F.lit(False)))
                                             .withField("repeat_mode", F.coalesce(p["repeat_mode"], F.lit("off"))))))


def validate(parsed: DataFrame, business_rules: bool = False) -> DataFrame:
    """Add ``errors`` (array of codes) and ``is_valid`` to parsed rows.

    A row that did not parse carries the single code ``parse_error``.
    """
    # two projections: ``is_valid`` reads the computed array instead of
    # repeating the whole rule expression
    return (parsed.select("*", _errors_column(business_rules).alias("errors"))
                  .withColumn("is_valid", F.size("errors") == 0))


@session_cached
def _errors_column(business_rules: bool) -> Column:
    raw = F.col("raw_value") if business_rules else None
    return F.when(~F.col("parse_ok"), F.array(F.lit("parse_error"))).otherwise(event_errors(raw))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean valid events, and the dead-letter rows."""
    good = clean_event(checked.filter("is_valid")).drop("raw_value", "parse_ok", "errors", "is_valid", "attempt")
    bad = checked.filter(~F.col("is_valid")).select("raw_value", "errors", *[
        c for c in checked.columns if c in ("batch_id", "batch_file", "source_file", "received_at", "attempt")])
    return good, bad


def validation_counts(checked: DataFrame) -> DataFrame:
    """V14 + V15: one row with valid and invalid counts and the success rate (0 when empty)."""
    ok = F.count_if(F.col("is_valid"))
    bad = F.count_if(~F.col("is_valid"))
    return checked.agg(ok.alias("valid_events"), bad.alias("invalid_events"),
                       F.coalesce(round_rate(ok, bad), F.lit(0.0)).alias("success_rate"))


def round_rate(ok: Column, bad: Column) -> Column:
    return round6(ok / F.nullif(ok + bad, F.lit(0)))


def error_breakdown(checked: DataFrame) -> DataFrame:
    """Count of each error code over all rows (one row per code)."""
    return (checked.select(F.explode("errors").alias("error_code"))
            .groupBy("error_code").agg(F.count(F.lit(1)).alias("events")))


def observe_counts(checked: DataFrame, name: str = "validation"):
    """Attach valid/invalid counters to a DataFrame without a second pass.

    Returns ``(df, observation)``; read ``observation.get`` after an action.
    """
    obs = Observation(name)
    df = checked.observe(obs, F.count_if(F.col("is_valid")).alias("valid"),
                         F.count_if(~F.col("is_valid")).alias("invalid"))
    return df, obs


def description_ok(desc: Column) -> Column:
    """An enriched description holds at most 1000 characters."""
    return desc.isNull() | (F.length(desc) <= DESCRIPTION_MAX)
