"""Message sources and sinks: JSON text, base64 envelopes, JSON files.

Batch and stream share these: ``events_as_json`` produces the text a topic
or a landing folder would carry; ``decode_envelope`` (S4) unwraps
``{"data": "<base64>"}`` or a bare base64 string; ``read_json_events``
(S2) reads files that hold one event or an array of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Written timestamps keep microseconds; reads use Spark's default ISO-8601
# parser, which accepts any fraction length and a "Z" or offset.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
READ_OPTIONS: dict = {}


def to_json_text(nested: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One JSON object per event in ``value`` (nulls left out);
    ``keep`` columns are also passed through beside the text."""
    body = F.to_json(F.struct(*nested.columns), JSON_OPTIONS)
    return nested.select(*(keep or []), body.alias("value"))


# --- fault injection for the validation checks (ours) --------------------------
# One fault per event, by event number n: (modulus, fault, applies to plays only)
FAULTS = [
    (97, "popularity_out_of_range", False),
    (89, "parse_error", False),
    (83, "repeat_mode_invalid", True),
    (79, "artist_mismatch", False),
    (73, "track_name_empty", False),
    (71, "play_without_play_event", True),
    (67, "session_id_missing", False),
    (61, "track_artist_id_missing", False),
    (59, "event_type_invalid", False),
    (53, "track_genre_invalid", False),
    (47, "location_too_long", False),
    (43, "energy_out_of_range", False),
    (41, "buffer_events_out_of_range", False),
]
# ---------------------------------------------------------------------------------


def fault_of(n: Column, is_play: Column) -> Column:
    """The fault injected into event number ``n`` (null for a clean event)."""
    out = None
    for mod, name, play_only in FAULTS:
        cond = (n % mod == 0) & (is_play if play_only else F.lit(True))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def damaged_messages(events: DataFrame) -> DataFrame:
    """JSON messages of shape A events with known faults injected.

    Faults follow ``FAULTS`` by the source ``event_id``, so a checker knows
    which error each message must raise. They are applied to flat columns
    before nesting, so the nested struct is built once per row.
    """
    from cadenza.sources.adapter import event_type_a, flat_events_a, nest_a
    fault = fault_of(F.col("event_id"), event_type_a(F.col("event_id"), F.col("event_type")) == "play")
    flat = flat_events_a(events.withColumn("_fault", fault), keep=["_fault"])
    f = F.col("_fault")
    flat = (flat
            .withColumn("track_popularity", F.when(f == "popularity_out_of_range", F.lit(150).cast("long"))
                        .otherwise(F.col("track_popularity")))
            .withColumn("track_name", F.when(f == "track_name_empty", F.lit("   ")).otherwise(F.col("track_name")))
            .withColumn("repeat_mode", F.when(f == "repeat_mode_invalid", F.lit("invalid"))
                        .otherwise(F.col("repeat_mode")))
            .withColumn("played_duration_ms", F.when(f == "play_without_play_event", F.lit(None).cast("long"))
                        .otherwise(F.col("played_duration_ms"))))
    nested = nest_a(flat, keep=["_fault"])
    nested = nested.withColumn("track", F.when(f == "artist_mismatch",
                                               F.col("track").withField("artist_id", F.lit("artist-mismatch")))
                               .otherwise(F.col("track")))
    def damaged(part: str, name: str, fault: str, value: Column) -> Column:
        return F.when(f == fault, F.col(part).withField(name, value)).otherwise(F.col(part))
    for part, name, fault, value in [
            ("user_interaction", "session_id", "session_id_missing", F.lit(None).cast("string")),
            ("user_interaction", "location", "location_too_long", F.lit("USA")),
            ("track", "artist_id", "track_artist_id_missing", F.lit(None).cast("string")),
            ("track", "genres", "track_genre_invalid", F.array(F.lit("noise"))),
            ("track", "energy", "energy_out_of_range", F.lit(1.5)),
            ("streaming_event", "buffer_events", "buffer_events_out_of_range", F.lit(-1).cast("long"))]:
        nested = nested.withColumn(part, damaged(part, name, fault, value))
    nested = nested.withColumn("event_type", F.when(f == "event_type_invalid", F.lit("dance")).otherwise(F.col("event_type")))
    text = F.to_json(F.struct(*[c for c in nested.columns if c != "_fault"]), JSON_OPTIONS)
    return nested.select(F.when(f == "parse_error", F.concat(F.lit("corrupt:"), text)).otherwise(text).alias("value"))


def encode_envelope(text: DataFrame, bare: bool | Column = False) -> DataFrame:
    """Wrap ``value`` as base64, inside ``{"data": ...}`` unless ``bare`` (a flag or a per-row condition)."""
    b64 = F.base64(F.encode(F.col("value"), "UTF-8"))
    wrapped = F.to_json(F.struct(b64.alias("data")))
    cond = bare if isinstance(bare, Column) else F.lit(bool(bare))
    return text.select(F.when(cond, b64).otherwise(wrapped).alias("value"))


def decode_envelope(env: DataFrame, value_col: str = "value") -> DataFrame:
    """``{"data": "<b64>"}`` or bare base64 text to the decoded JSON text.

    Adds ``decode_ok``; bad base64 or bad UTF-8 leaves ``value`` null so the
    row goes to quarantine instead of failing the task.
    """
    return (env.select(F.col(value_col).alias("envelope"), unwrapped(F.col(value_col)).alias("value"))
               .withColumn("decode_ok", F.col("value").isNotNull()))


def unwrapped(raw: Column) -> Column:
    """The text inside an envelope; null where it cannot be decoded."""
    inner = F.when(F.trim(raw).startswith("{"), F.get_json_object(raw, "$.data")).otherwise(F.trim(raw))
    return F.try_validate_utf8(F.try_to_binary(inner, F.lit("base64")).cast("string"))


def read_json_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON files holding one event or an array of events, one row per event.

    The multi-line JSON source reads each file as one document; a top-level
    array yields one row per element, a single object one row. The source
    file name is kept as ``source_file``. A file that does not parse is one
    row with ``parse_ok`` false and its text in ``raw_value``. Files are split
    across tasks, never gathered on the driver.
    """
    full = T.StructType(schema.fields + [T.StructField("raw_value", T.StringType())])
    return (spark.read.schema(full).options(**READ_OPTIONS).option("multiLine", "true")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "raw_value").json(path)
            .withColumn("parse_ok", F.col("raw_value").isNull())
            .withColumn("source_file", F.col("_metadata.file_path")))


def write_json_events(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export events as JSON lines, one file per task."""
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)


# Folders of messages may be in gzip. A micro-batch that is bounded in bytes takes their text
# as so many times the size of the files (12 times for the messages made here).
PACKED = 16


def land_text(text: DataFrame, path: str, packed: bool = False) -> str:
    """Write a ``value`` text column as a landing folder (one file per task; ``packed``: in gzip), replacing what it held."""
    text.write.mode("overwrite").text(path, compression="gzip" if packed else None)
    return path


def file_events(text: Column) -> Column:
    """The texts of the events in a file that holds one event or an array of them.

    A file that is neither is one text, so that it is quarantined whole.
    """
    elements = F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
    whole = F.array(text)
    return F.when(text.rlike(r"^\s*\["), F.coalesce(elements, whole)).otherwise(whole)


def read_landing(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None, archive_dir: str | None = None,
                 whole_files: bool = False, envelope: bool = False, redrive: str | None = None, packed: bool = False) -> DataFrame:
    """Messages parsed at the scan, batch or stream.

    A message is a line, or with ``whole_files`` an event of a file that holds
    one or an array of them; with ``envelope`` it is unwrapped first (S4). Text
    is parsed with ``from_json``; every row keeps its message in ``raw_value``
    (the envelope, where that cannot be unwrapped), so a dead letter always
    has its message and the business rules can look at the text. Blank lines
    are no messages. ``attempt`` is 1, or the number that a message carries that
    comes back from the ``redrive`` folder (V13). A micro-batch of a stream takes
    ``max_files_per_trigger`` files, or else as many as hold ``max_bytes_per_trigger``
    (one at least); of the redrive folder always the latter. With ``packed`` the landing
    is in gzip, as the redrive folder is; those bytes are of the text, see ``PACKED``.
    """
    packed_bytes = max(1, max_bytes_per_trigger // PACKED) if max_bytes_per_trigger else None
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif streaming and max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", packed_bytes if packed else max_bytes_per_trigger)
    if streaming and archive_dir:
        # S3: move each fully processed input file to the archive folder
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    text = reader.text(path, wholetext=whole_files)
    lines = text.select("value", F.col("_metadata.file_name").alias("batch_file"), F.lit(1).alias("attempt"))
    if whole_files:
        lines = lines.withColumn("value", F.explode(file_events(F.col("value"))))
    lines = lines.where(F.col("value").rlike(r"\S"))
    if redrive:
        back = spark.readStream if streaming else spark.read
        if streaming and max_bytes_per_trigger:
            back = back.option("maxBytesPerTrigger", packed_bytes)
        lines = lines.unionByName(back.schema(REDRIVE).option("recursiveFileLookup", "true").json(redrive))
    if envelope:
        rest = [c for c in lines.columns if c != "value"]
        lines = lines.select(unwrapped(F.col("value")).alias("value"), F.col("value").alias("envelope"), *rest)
    parsed = parse_topic(lines, schema)
    if envelope:
        parsed = parsed.withColumn("raw_value", F.coalesce("raw_value", "envelope"))
    return parsed.select(*[f.name for f in schema.fields], "raw_value", "parse_ok", "batch_file", "attempt")


# A message on its way back: its text as it came, the number of the attempt it is
# to be, and the file it first came in.
REDRIVE = "value string, attempt int, batch_file string"


def read_topic(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1 on a message bus: a Kafka topic as a stream of ``value`` text.

    Needs the ``spark-sql-kafka`` package on the cluster's classpath (not
    bundled here). Message attributes travel as Kafka headers; the
    partition and offset are kept so a replay can be traced.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets)
              .option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "headers", "partition", "offset",
                                F.col("timestamp").alias("published_at"))


def parse_topic(messages_df: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse ``value`` text against ``schema``: its fields, the text itself as ``raw_value``, and ``parse_ok``."""
    rest = [c for c in messages_df.columns if c != "value"]
    return parse_once(messages_df, schema, "value").select(
        *[F.col("e")[f.name].alias(f.name) for f in schema.fields], *rest, F.col("value").alias("raw_value"), "parse_ok")


_CORRUPT = "_corrupt_record"  # parser column for malformed text


def parse_once(text: DataFrame, schema: T.StructType, value_col: str) -> DataFrame:
    """The columns of ``text``, the parsed struct ``e`` and ``parse_ok``.

    The struct comes out of a generator of one row, which the optimizer does
    not merge with what reads its fields: merged, every one of them would
    parse the text again.
    """
    full = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return text.select("*", F.explode(F.array(parsed)).alias("e")).withColumn(
        "parse_ok", F.col("e").isNotNull() & F.col(f"e.{_CORRUPT}").isNull())
