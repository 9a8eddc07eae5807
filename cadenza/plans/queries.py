"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Each query reads the given tables (through the adapter) and applies cadenza
operators; ``cadenza.plans.oracle.ORACLE`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import confidence as C
from cadenza.functions import text as TX
from cadenza.functions.derive_full import derive_fields, raw_music_events
from cadenza.functions.derive_simple import enrichment_input_b, loose_parse_b, processed_events
from cadenza.operators import daily, enrich, lookups, metrics, reports, rules, validate
from cadenza.schemas import EVENT_A
from cadenza.session import checkpoint_path, shuffles_removed
from cadenza.sources import messages, sinks
from cadenza.sources.adapter import flat_events_a, nested_events_a, nested_events_b, read_events
from cadenza.sources.tables import read_table
from cadenza.streaming import compaction
from cadenza.streaming import pipeline as stream
from cadenza.streaming.window_state import HOUR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = reports.DEFAULT_AS_OF


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def to_ntz(df: DataFrame) -> DataFrame:
    """Present instants as zone-free timestamps (UTC wall time) at the output."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def raw_a(spark: SparkSession, sf_dir: str, days: int | None = None, as_of: dt.date = AS_OF) -> DataFrame:
    """The 50-column raw table, optionally only the last ``days`` days (pushed to the scan)."""
    since = as_of - dt.timedelta(days=days) if days is not None else None
    return derive_fields(flat_events_a(read_events(spark, sf_dir, since=since)))


@register("platform_performance")
def q_platform_performance(spark, sf_dir):
    return reports.platform_performance(raw_a(spark, sf_dir, 7), AS_OF)


def processed_b(spark: SparkSession, sf_dir: str, level_on: str = "adjusted") -> DataFrame:
    """Shape B events through the loose parse and Q1-Q8."""
    return processed_events(loose_parse_b(nested_events_b(read_events(spark, sf_dir))), level_on)


@register("raw_music_events")
def q_raw_music_events(spark, sf_dir):
    # nested message -> P1 flatten -> P2-P6, the full 50-column raw table
    return raw_music_events(nested_events_a(read_events(spark, sf_dir)))


@register("daily_events_summary")
def q_daily_events_summary(spark, sf_dir):
    return reports.daily_events_summary(raw_a(spark, sf_dir, 30), AS_OF)


@register("top_tracks_weekly")
def q_top_tracks_weekly(spark, sf_dir):
    return reports.top_tracks_weekly(raw_a(spark, sf_dir, 7), AS_OF)


@register("event_window_metrics")
def q_event_window_metrics(spark, sf_dir):
    return metrics.window_metrics(raw_a(spark, sf_dir))


@register("processed_events")
def q_processed_events(spark, sf_dir):
    return processed_b(spark, sf_dir).drop("processing_time")


@register("processed_events_base_level")
def q_processed_events_base_level(spark, sf_dir):
    return processed_b(spark, sf_dir, "base").drop("processing_time")


@register("engagement_metrics")
def q_engagement_metrics(spark, sf_dir):
    return metrics.engagement_metrics(metrics.with_event_time(processed_b(spark, sf_dir)))


@register("genre_metrics")
def q_genre_metrics(spark, sf_dir):
    return metrics.genre_metrics(metrics.with_event_time(processed_b(spark, sf_dir)))


@register("platform_metrics")
def q_platform_metrics(spark, sf_dir):
    return metrics.platform_metrics(metrics.with_event_time(processed_b(spark, sf_dir)))


def landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged shape A messages written to a landing folder, read back parsed.

    The landing folder sits under the shared checkpoint dir; it stands where
    a message topic or an upload bucket would be in production.
    """
    path = landed_a_path(spark, sf_dir)
    return messages.read_landing(spark, path, EVENT_A)


def landed_a_path(spark: SparkSession, sf_dir: str, packed: bool = False) -> str:
    path = fresh_dir(spark, "landing-a")
    with shuffles_removed(spark):
        return messages.land_text(messages.damaged_messages(read_events(spark, sf_dir)), path, packed)


def checked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(landed_messages(spark, sf_dir))


@register("validation_summary")
def q_validation_summary(spark, sf_dir):
    return validate.validation_counts(checked_messages(spark, sf_dir))


@register("validation_errors")
def q_validation_errors(spark, sf_dir):
    return validate.error_breakdown(checked_messages(spark, sf_dir))


@register("valid_events_raw")
def q_valid_events_raw(spark, sf_dir):
    good, _ = validate.split_valid(checked_messages(spark, sf_dir))
    return raw_music_events(good)


@register("user_daily_analytics")
def q_user_daily_analytics(spark, sf_dir):
    return reports.user_daily_analytics(raw_a(spark, sf_dir))


@register("track_daily_analytics")
def q_track_daily_analytics(spark, sf_dir):
    return reports.track_daily_analytics(raw_a(spark, sf_dir))


@register("platform_daily_analytics")
def q_platform_daily_analytics(spark, sf_dir):
    return reports.platform_daily_analytics(raw_a(spark, sf_dir))


@register("daily_tables")
def q_daily_tables(spark, sf_dir):
    """A10-A12 in one scan: the rows of all three tables, marked by their level."""
    parts = [df.select(F.lit(level).alias("level"), "*") for level, df in daily.daily_tables(raw_a(spark, sf_dir)).items()]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


def enrich_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment_input_b(nested_events_b(read_events(spark, sf_dir)))


def _c(*names):
    return [F.col(n) for n in names]


@register("rule_enrichment")
def q_rule_enrichment(spark, sf_dir):
    df = rules.enrich_rules(enrich_input(spark, sf_dir))
    conf = C.local_confidence(*_c("track_title", "track_artist", "genre", "artist_name", "platform", "album",
                                  "release_year"))
    return df.select("event_id", "event_description", "mood_analysis", "predicted_genres", "listening_context",
                     "similar_tracks", conf.alias("enrichment_confidence"))


@register("rule_enrichment_table")
def q_rule_enrichment_table(spark, sf_dir):
    # the rules as a stored table: the events' side of the join knows neither their number nor their order
    path = fresh_dir(spark, "rules")
    spark.createDataFrame(rules.rules_as_rows(), rules.RULES_SCHEMA).write.parquet(path)
    rules_df = spark.read.parquet(path)
    df = rules.match_rules_table(enrich_input(spark, sf_dir), rules_df)
    conf = C.local_confidence(*_c("track_title", "track_artist", "genre", "artist_name", "platform", "album",
                                  "release_year"))
    return df.select("event_id", "event_description", "mood_analysis", "predicted_genres", "listening_context",
                     "similar_tracks", conf.alias("enrichment_confidence"))


@register("production_enrichment")
def q_production_enrichment(spark, sf_dir):
    df = rules.enrich_production(enrich_input(spark, sf_dir))
    conf = C.production_confidence(*_c("track_title", "track_artist", "genre", "user_location", "platform"))
    return df.select("event_id", "enhanced_description", "mood_analysis", "genre_prediction", "listening_context",
                     "similar_tracks", conf.alias("enrichment_confidence"))


@register("extended_enrichment")
def q_extended_enrichment(spark, sf_dir):
    df = rules.enrich_extended(enrich_input(spark, sf_dir))
    conf = C.famous_confidence(*_c("track_title", "track_artist", "genre", "user_location", "platform",
                                   "artist_name"))
    return df.select("event_id", "enhanced_description", "mood_analysis", "genre_prediction", "listening_context",
                     "similar_tracks", conf.alias("enrichment_confidence"))


@register("confidence_scores")
def q_confidence_scores(spark, sf_dir):
    c = F.col
    return enrich_input(spark, sf_dir).select(
        "event_id",
        C.production_confidence(c("track_title"), c("track_artist"), c("genre"), c("user_location"),
                                c("platform")).alias("production_confidence"),
        C.famous_confidence(c("track_title"), c("track_artist"), c("genre"), c("user_location"), c("platform"),
                            c("artist_name")).alias("famous_confidence"),
        C.simple_confidence(c("track_title"), c("track_artist"), c("artist_name"), c("platform"), c("album"),
                            c("release_year")).alias("simple_confidence"),
        C.local_confidence(c("track_title"), c("track_artist"), c("genre"), c("artist_name"), c("platform"),
                           c("album"), c("release_year")).alias("local_confidence"))


@register("prompt_context")
def q_prompt_context(spark, sf_dir):
    c = F.col
    raw = raw_a(spark, sf_dir)
    return raw.select(
        "event_id",
        TX.prompt_context(c("event_type"), c("track_name"), c("artist_name"), c("platform"), c("track_genres"),
                          c("track_duration_ms"), c("track_energy"), c("track_valence"), c("track_tempo"),
                          c("device_type"), c("user_location"), c("played_duration_ms"), c("skip_reason"),
                          c("shuffle_mode"), c("repeat_mode")).alias("context_text"),
        C.data_confidence(c("track_genres"), c("track_energy"), c("track_valence"), c("track_tempo"),
                          c("track_popularity"), c("device_type"), c("user_location"),
                          c("played_duration_ms").isNotNull()).alias("data_confidence"))


@register("answer_cleaning")
def q_answer_cleaning(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations", spread_key="conv_id").filter(F.col("role") == "assistant")
    t = F.col("text")
    return conv.select("conv_id", "turn",
                       TX.clean_description(t).alias("description"), TX.clean_mood(t).alias("mood"),
                       TX.clean_context(t).alias("listening_context"), TX.clean_genres(t).alias("genres"),
                       TX.clean_similar(t).alias("similar_tracks"),
                       TX.clean_genres_variant(t).alias("genres_variant"),
                       TX.clean_tracks_variant(t).alias("tracks_variant"))


@register("track_catalog")
def q_track_catalog(spark, sf_dir):
    return lookups.track_catalog(enrich_input(spark, sf_dir))


@register("catalog_search")
def q_catalog_search(spark, sf_dir):
    cat = lookups.track_catalog(enrich_input(spark, sf_dir))
    return lookups.search_catalog(cat, genre="Rock")


@register("catalog_search_mood")
def q_catalog_search_mood(spark, sf_dir):
    cat = lookups.track_catalog(enrich_input(spark, sf_dir))
    return lookups.search_catalog(cat, genre="hard_rock", mood="Energetic")


@register("catalog_search_artist")
def q_catalog_search_artist(spark, sf_dir):
    cat = lookups.track_catalog(enrich_input(spark, sf_dir))
    return lookups.search_catalog(cat, artist="THE", platform="spotify")


@register("genre_track_counts")
def q_genre_track_counts(spark, sf_dir):
    return lookups.genre_track_counts(lookups.track_catalog(enrich_input(spark, sf_dir)))


@register("events_with_dimensions")
def q_events_with_dimensions(spark, sf_dir):
    raw = raw_a(spark, sf_dir)
    facts = raw.select("event_id", "event_type", "track_id", "artist_id", "album_id", "played_duration_ms")
    out = lookups.lookup_join(facts, lookups.artist_dimension(raw), "artist_id")
    return lookups.lookup_join(out, lookups.album_dimension(raw), "album_id")


# --- streams and sinks: each run drains into a fresh folder of the checkpoint dir ----

def fresh_dir(spark: SparkSession, name: str) -> str:
    import uuid
    return checkpoint_path(spark, f"runs/{name}-{uuid.uuid4().hex[:12]}")


def landed_b(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "landing-b")
    return messages.land_text(messages.to_json_text(nested_events_b(read_events(spark, sf_dir))), path)


# Files of one delivery, and of one micro-batch; where deliveries are large, as many more
# as hold about FILE_MESSAGES each.
DELIVERY_FILES = 2
FILE_MESSAGES = 20_000


def deliveries(spark: SparkSession, sf_dir: str, to_text) -> tuple[str, int]:
    """A landing of four deliveries, the second eight days of a month first, then the first,
    the last and the third; each brings every tenth event of the one before once more.

    ``to_text`` makes messages of events rows, which land in gzip. A file holds rows of one delivery only,
    and files are read in the order in which they were written. Returns the landing and
    the number of files that each delivery has.
    """
    path = fresh_dir(spark, "deliveries")
    events = read_events(spark, sf_dir)
    quarter = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))
    sizes = [r["count"] for r in read_table(spark, sf_dir, "events").groupBy(quarter).count().collect()]  # at most five rows
    files = max(DELIVERY_FILES, min(sum(sizes) // (4 * FILE_MESSAGES), min(sizes, default=0) // 1000))  # no file without rows
    before = None
    for q in (1, 0, 3, 2):
        own = quarter == q
        rows = events.where(own if before is None else own | (quarter == before) & (F.col("event_id") % 10 == 0))
        with shuffles_removed(spark):
            to_text(rows.repartition(files)).write.mode("append").text(path, compression="gzip")
        before = q
    return path, files


def landed_deliveries_a(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    return deliveries(spark, sf_dir, messages.damaged_messages)


def landed_deliveries_b(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    return deliveries(spark, sf_dir, lambda rows: messages.to_json_text(nested_events_b(rows)))


def streamed(spark: SparkSession, start, landed: tuple[str, int | None], **kwargs) -> str:
    """The tables of a pipeline that has read all of a landing, so many files a batch: a delivery, or without
    a number as many as the pipeline's bound in bytes admits."""
    out = fresh_dir(spark, "stream")
    landing, files = landed
    stream.drain(start, spark, landing, out, max_files_per_trigger=files, **kwargs)
    return out


@register("stream_window_metrics")
def q_stream_window_metrics(spark, sf_dir):
    out = streamed(spark, stream.start_full_pipeline, landed_deliveries_a(spark, sf_dir), outputs=["metrics"])
    return spark.read.parquet(f"{out}/music_event_metrics").drop(*HOUR)


def keyed_stream(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    out = streamed(spark, stream.start_simple_pipeline, landed_deliveries_b(spark, sf_dir), outputs=["metrics"], kinds=[kind])
    return spark.read.parquet(f"{out}/{kind}_metrics").drop(*HOUR)


@register("stream_engagement_metrics")
def q_stream_engagement_metrics(spark, sf_dir):
    return keyed_stream(spark, sf_dir, "engagement")


@register("stream_genre_metrics")
def q_stream_genre_metrics(spark, sf_dir):
    return keyed_stream(spark, sf_dir, "genre")


@register("stream_platform_metrics")
def q_stream_platform_metrics(spark, sf_dir):
    return keyed_stream(spark, sf_dir, "platform")


@register("stream_late_events")
def q_stream_late_events(spark, sf_dir):
    # with a lateness of a day: per day, the events in windows and the late ones, which are in none
    out = streamed(spark, stream.start_full_pipeline, landed_deliveries_a(spark, sf_dir), outputs=["metrics"], watermark="1 day")
    counted = spark.read.parquet(f"{out}/music_event_metrics").groupBy("event_date").agg(F.sum("total_events").alias("in_windows"))
    late = sinks.read_batches(spark, out, "late_events").groupBy(F.to_date("event_ts").alias("event_date")).agg(F.count("*").alias("late"))
    return counted.join(late, "event_date", "full").select(
        "event_date", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("in_windows", "late")))


@register("stream_dedup_counts")
def q_stream_dedup_counts(spark, sf_dir):
    # redelivered events come in later batches; the stored rows hold each once
    out = streamed(spark, stream.start_full_pipeline, landed_deliveries_a(spark, sf_dir), outputs=["raw"])
    rows = stream.read_committed(spark, out, "raw_music_events")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                          F.countDistinct("event_id").alias("distinct_events"))


@register("stream_enriched_events")
def q_stream_enriched_events(spark, sf_dir):
    # the rows that were published downstream, beside their table; both through the commits
    out = streamed(spark, stream.start_full_pipeline, landed_deliveries_a(spark, sf_dir), outputs=["enriched"])
    table = stream.read_committed(spark, out, "enriched_music_events").drop("batch_id", "event_date", "enrichment_timestamp")
    topic = stream.read_committed(spark, out, "enriched_topic").select(
        "event_id", F.get_json_object("value", "$.mood_analysis").alias("published_mood"))
    return table.join(topic, "event_id", "full")


@register("compacted_platform_performance")
def q_compacted_platform_performance(spark, sf_dir):
    # the view over a streamed table: the batches of a date packed into bins, and the rest from their folders
    out = streamed(spark, stream.start_full_pipeline, landed_deliveries_a(spark, sf_dir), outputs=["raw"])
    compaction.compact(spark, out, "raw_music_events", target_bytes=1 << 16, tail=1)
    return reports.platform_performance(compaction.read_compacted(spark, out, "raw_music_events"), AS_OF)


@register("delivery_attempts")
def q_delivery_attempts(spark, sf_dir):
    # How often the messages of each error came back before they were given up
    out = streamed(spark, stream.start_full_pipeline, (landed_a_path(spark, sf_dir, packed=True), None), outputs=[],
                   attempts=stream.MAX_ATTEMPTS, packed=True)
    log = sinks.read_batches(spark, out, "attempts").groupBy("message_id", F.element_at("errors", 1).alias("error_code")).agg(
        F.count("*").alias("attempts"), F.max("attempt").alias("last_attempt"), F.count_if("final").alias("finals"))
    dead = sinks.read_batches(spark, out, "dead_letters").where(F.col("raw_value").isNotNull()).groupBy(
        F.md5("raw_value").alias("message_id")).agg(F.count("*").alias("dead"))
    return log.join(dead, "message_id", "left").groupBy("error_code", "last_attempt").agg(
        F.count("*").alias("messages"), F.sum("attempts").alias("attempts"), F.sum("finals").alias("finals"), F.sum("dead").alias("dead_letters"))


@register("error_rate_windows")
def q_error_rate_windows(spark, sf_dir):
    failures = (read_events(spark, sf_dir).filter(F.col("event_type") == "error")
                .select(F.col("ts").cast("timestamp").alias("failed_at")))
    return stream.error_alerts(failures, time_col="failed_at", only_alerts=False)


# Arrival times of the quarantine rows: of every 10,000 messages, 8,000 come evenly over
# six minutes and 2,000 in two seconds ten minutes later; the next ones half an hour after.
ARRIVAL = ("timestampadd(MILLISECOND, CAST((n % 10000) * 45 + IF(n % 10000 >= 8000, 240000 - (n % 10000 - 8000) * 44, 0) AS INT), "
           "timestampadd(MINUTE, CAST(n DIV 10000 * 30 AS INT), TIMESTAMP'2024-01-01 00:00:00'))")


@register("sustained_error_alerts")
def q_sustained_error_alerts(spark, sf_dir):
    _, bad = validate.split_valid(checked_messages(spark, sf_dir))
    number = F.regexp_extract("raw_value", '"event_id":"evt-([0-9]+)"', 1).cast("long")
    arrived = bad.withColumn("n", number).withColumn("received_at", F.expr(ARRIVAL))
    return stream.sustained_alerts(arrived, per_second=1.0)


# Events of one file of the intake; every fifth such file is cut off, every 250th event has its own.
FILE_EVENTS = 500


def landed_files(spark: SparkSession, sf_dir: str) -> str:
    """A landing of whole files: arrays of events, single events, and broken files."""
    path = fresh_dir(spark, "landing-files")
    text = messages.to_json_text(nested_events_a(read_events(spark, sf_dir)), keep=["event_id"])
    n = F.substring_index("event_id", "-", -1).cast("long")
    group = F.floor(n / FILE_EVENTS)
    alone = n % 250 == 0
    files = text.groupBy(F.when(alone, F.concat(F.lit("one-"), n)).otherwise(F.concat(F.lit("many-"), group)).alias("file"),
                         alone.alias("alone"), (group % 5 == 4).alias("cut")).agg(F.array_sort(F.collect_list("value")).alias("values"))
    array = F.concat(F.lit("["), F.array_join("values", ",\n"), F.when(F.col("cut"), F.lit("")).otherwise(F.lit("]")))
    files.select("file", F.when(F.col("alone"), F.col("values")[0]).otherwise(array).alias("value")).write.partitionBy("file").text(path)
    return path


@register("file_intake")
def q_file_intake(spark, sf_dir):
    # run twice: the second run finds nothing new
    landing, out = landed_files(spark, sf_dir), fresh_dir(spark, "file-intake")
    for _ in range(2):
        stream.drain(stream.start_full_pipeline, spark, landing, out, outputs=["raw"], whole_files=True,
                     archive_dir=fresh_dir(spark, "archive"))
    loaded = stream.read_committed(spark, out, "raw_music_events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))
    refused = stream.read_committed(spark, out, "dead_letters").where(F.col("raw_value").startswith("[")).agg(
        F.lit("broken file").alias("kind"), F.count("*").alias("n"))
    return loaded.unionByName(refused)


@register("envelope_decode")
def q_envelope_decode(spark, sf_dir):
    from cadenza.schemas import EVENT_B
    text = messages.to_json_text(nested_events_b(read_events(spark, sf_dir)), keep=["event_id"])
    n = F.substring_index("event_id", "-", -1).cast("long")
    env = messages.encode_envelope(text, bare=(n % 2 == 1))
    # no pre-filter on decode_ok: Catalyst would push it below the projections
    # and evaluate the decode chain twice; undecodable rows parse to nulls
    decoded = messages.decode_envelope(env)
    parsed = decoded.select(F.from_json("value", EVENT_B).alias("e")).select("e.*")
    return processed_events(loose_parse_b(parsed)).drop("processing_time")


@register("json_export_roundtrip")
def q_json_export_roundtrip(spark, sf_dir):
    out = fresh_dir(spark, "json-export")
    messages.write_json_events(nested_events_a(read_events(spark, sf_dir)), out)
    back = messages.read_landing(spark, out, EVENT_A).drop("raw_value", "parse_ok")
    return raw_music_events(back)


RETENTION_AS_OF = dt.date(2024, 4, 25)


@register("retained_partitions")
def q_retained_partitions(spark, sf_dir):
    out = fresh_dir(spark, "raw-table")
    sinks.write_table(raw_a(spark, sf_dir), out, "raw_music_events")
    sinks.apply_retention(spark, out, "raw_music_events", RETENTION_AS_OF)
    table = spark.read.parquet(out)
    return table.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"),
                                           F.countDistinct("user_id").alias("users"),
                                           F.coalesce(F.sum("played_duration_ms"), F.lit(0)).cast("long")
                                           .alias("played_ms"))


@register("business_rule_check")
def q_business_rule_check(spark, sf_dir):
    # V12 reads the raw message text: key presence is invisible after parsing
    text = spark.read.text(landed_a_path(spark, sf_dir))
    ok = validate.business_rules_ok(F.col("value"))
    return text.groupBy(ok.alias("passed")).agg(F.count(F.lit(1)).alias("messages"))


@register("context_text_b")
def q_context_text_b(spark, sf_dir):
    c = F.col
    df = enrich_input(spark, sf_dir)
    ts_text = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
    return df.select(
        "event_id",
        TX.production_context(c("event_type"), c("track_title"), c("track_artist"), c("album"), c("release_year"),
                              c("genre"), c("duration"), c("platform"), c("quality"), c("user_location"),
                              ts_text).alias("production_context"),
        TX.simple_context(c("track_title"), c("track_artist"), c("album"), c("duration"), c("genre"),
                          c("release_year"), c("artist_name"), c("artist_genre"), c("followers"), c("event_type"),
                          c("platform"), c("user_location")).alias("simple_context"))


@register("enriched_music_events")
def q_enriched_music_events(spark, sf_dir):
    # the enrichment time is pinned to the processing time so reruns are identical
    return enrich.enriched_music_events(raw_a(spark, sf_dir), enriched_at=F.col("processing_timestamp"))


@register("enriched_events")
def q_enriched_events(spark, sf_dir):
    return enrich.enriched_events_b(enrich_input(spark, sf_dir), enriched_at=F.col("event_ts"))


@register("sql_platform_performance")
def q_sql_platform_performance(spark, sf_dir):
    # the same view through spark.sql over a temp view of the raw rows
    from cadenza.plans.views import register_views
    register_views(spark, raw_a(spark, sf_dir, 7))
    return spark.table("platform_performance")


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as date-partitioned, clustered Parquet (S5/S9), written anew for each call."""
    path = fresh_dir(spark, "raw-music-events")
    sinks.write_table(raw_a(spark, sf_dir), path, "raw_music_events")
    return spark.read.parquet(path)


@register("table_platform_performance")
def q_table_platform_performance(spark, sf_dir):
    # the view over the stored table: the date window becomes a partition filter
    return reports.platform_performance(raw_table(spark, sf_dir), AS_OF)
