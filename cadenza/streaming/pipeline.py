"""Structured Streaming pipelines.

The stream path reuses the batch operators unchanged: a ``readStream`` of
messages goes through ``validate`` -> ``clean`` -> ``flatten`` -> ``derive``.

* *Redelivery (W6).* Event ids are kept in a RocksDB state store, keyed, and
  expire ``redelivery`` after they *arrived*, the time for which the message
  bus keeps messages. Looking an id up costs a batch its own rows and nothing
  else; as arrival never runs backwards, no event is too late to be kept.
* *Sinks.* One ``foreachBatch`` writes all tables of a micro-batch. Each has a
  partition per batch id that a replay overwrites. ``commits`` gets the batch
  id last; ``read_committed`` reads no batch beyond it, so the tables of a batch
  (the enriched rows and their published JSON, say) appear together or not at all.
* *Windows (W1-W5).* ``streaming.window_state`` keeps them as mergeable state.
* *Failed messages (V13)* come back through a redrive folder until their last
  attempt, then go to the dead letters; every failed delivery is in ``attempts``.

State lives in the checkpoint folder, so a restarted or rescheduled query
resumes where it stopped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.functions.common import round6
from cadenza.functions.derive_full import raw_music_events
from cadenza.functions.derive_simple import loose_parse_b, processed_events
from cadenza.operators import enrich, metrics, validate
from cadenza.schemas import EVENT_A, EVENT_B
from cadenza.session import SHUFFLE_CLEANUP, checkpoint_path
from cadenza.sources import messages, sinks
from cadenza.streaming import window_state

# Allowed lateness of event time on the command line: a window takes no event
# once one that is this much later than its end has been seen.
DEFAULT_WATERMARK = "1 day"
# --- fixed values: retention of the message bus, delivery attempts -----------------
REDELIVERY = "7 days"
MAX_ATTEMPTS = 5
# -------------------------------------------------------------------------------------
# Message bytes of a micro-batch without a number of files: the state has a fixed number of
# partitions, so the batch, not the input, decides what one task reads.
BATCH_BYTES = 4 << 30
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None, **source) -> DataFrame:
    """Shape A messages from a landing folder, parsed and checked.

    ``source`` are options of ``messages.read_landing``: whole files, an archive
    folder, envelopes, a redrive folder.
    """
    src = messages.read_landing(spark, landing, EVENT_A, streaming=True, max_files_per_trigger=max_files_per_trigger,
                                **{"max_bytes_per_trigger": BATCH_BYTES, **source})
    return validate.validate(src.withColumn("received_at", F.current_timestamp()))


def raw_stream(checked: DataFrame, redelivery: str | None = None) -> DataFrame:
    """Valid events as raw rows; with ``redelivery``, each id once within that time."""
    if redelivery is not None:
        checked = delivered_once(checked, redelivery)
    good, _ = validate.split_valid(checked)
    return raw_music_events(good)


def delivered_once(checked: DataFrame, redelivery: str = REDELIVERY) -> DataFrame:
    """Valid events whose id has not arrived within ``redelivery``; every invalid message.

    All columns are shuffled to the state, so a valid event goes on without its text, unless
    that stands in for its id; otherwise only failed messages need theirs.
    """
    valid_id = F.coalesce("event_id", validate.message_uuid(F.col("raw_value")))
    return (checked.withColumn("_delivery", F.when(F.col("is_valid"), F.concat(F.lit("event:"), valid_id)).otherwise(F.expr("uuid()")))
            .withColumn("raw_value", F.when(~F.col("is_valid") | F.col("event_id").isNull(), F.col("raw_value")))
            .withWatermark("received_at", redelivery).dropDuplicatesWithinWatermark(["_delivery"]).drop("_delivery"))


def simple_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None, **source) -> DataFrame:
    """L2's input: shape B messages, loosely parsed, with ``errors`` and ``is_valid`` (V2 refuses only what is no JSON)."""
    src = messages.read_landing(spark, landing, EVENT_B, streaming=True, max_files_per_trigger=max_files_per_trigger,
                                **{"max_bytes_per_trigger": BATCH_BYTES, **source})
    return (src.withColumn("received_at", F.current_timestamp())
            .withColumn("errors", F.when(F.col("parse_ok"), F.array().cast("array<string>")).otherwise(F.array(F.lit("parse_error"))))
            .withColumn("is_valid", F.col("parse_ok")))


def error_alerts(failures: DataFrame, per_second: float = 10.0, span: str = "5 minutes",
                 step: str = "1 minute", time_col: str = "received_at", only_alerts: bool = True) -> DataFrame:
    """Failure rate over sliding windows (``span`` every ``step``), a mean that a burst lifts too.

    Every failure counts (the alert's filter counts all failed executions);
    ``alert`` is true where the rate exceeds ``per_second``. Works on a
    stream (after ``withWatermark``) or a batch. Each row lands in
    span/step windows (5 here), a fixed fan-out.
    """
    seconds = _seconds(span)
    out = (failures.groupBy(F.window(time_col, span, step).alias("w"))
           .agg(F.count(F.lit(1)).alias("errors"))
           .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "errors",
                   round6(F.col("errors") / F.lit(float(seconds))).alias("errors_per_second"))
           .withColumn("alert", F.col("errors_per_second") > per_second))
    return out.filter("alert") if only_alerts else out


def _seconds(span: str) -> int:
    n, unit = span.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def sustained_alerts(failures: DataFrame, per_second: float = 10.0, minutes: int = 5, time_col: str = "received_at") -> DataFrame:
    """Stretches of at least ``minutes`` consecutive minutes, each with a failure rate above ``per_second``.

    One row per stretch: its first minute, its end, its length, all its failures
    and the highest rate. Failures are counted per minute first; of those counts
    (one a minute, however many failures) the minutes above the rate are numbered,
    and a run of them shares the difference of minute and number.
    """
    counts = (failures.groupBy(F.window(time_col, "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("errors"))
              .select(F.col("w.start").alias("minute"), "errors").where(F.col("errors") / F.lit(60.0) > per_second))
    number = F.unix_timestamp("minute") / 60
    runs = counts.withColumn("run", F.floor(number) - F.row_number().over(Window.orderBy("minute")))
    return (runs.groupBy("run").agg(F.min("minute").alias("alert_start"), (F.max("minute") + F.expr("INTERVAL 1 MINUTE")).alias("alert_end"),
                                    F.count(F.lit(1)).alias("minutes"), F.sum("errors").alias("errors"),
                                    round6(F.max(F.col("errors") / F.lit(60.0))).alias("peak_per_second"))
            .where(F.col("minutes") >= minutes).drop("run"))


# --- one micro-batch -------------------------------------------------------------------

FULL_OUTPUTS = ("raw", "topics", "enriched", "metrics")
SIMPLE_OUTPUTS = ("processed", "metrics")
SIMPLE_METRICS = ("engagement", "genre", "platform")
METRIC_COLUMNS = ("event_id", "timestamp", "user_id", "track_id", "engagement_score", "platform", "event_type")


def fan_out_batch(out_root: str, lateness: str | None = None, attempts: int = 1, distinct: str = "exact",
                  outputs: Collection[str] = FULL_OUTPUTS) -> Callable[[DataFrame, int], None]:
    """S5-S8, A1/A2 and V13 of shape A in one ``foreachBatch``.

    Writes ``raw_music_events``; the whole event to ``raw_topic`` and
    ``enrichment_topic``; ``enriched_music_events`` and ``enriched_topic``;
    ``music_event_metrics``; ``dead_letters`` and ``attempts``. ``outputs`` leaves
    some out.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        good, bad = validate.split_valid(batch)
        held = (batch if outputs else bad).persist()  # valid events are held for their tables only
        try:
            good = good.drop("received_at")
            raw = sinks.with_event_date(raw_music_events(good, ["batch_file"]))
            if "raw" in outputs:
                sinks.write_batch(raw.drop("batch_file"), out_root, "raw_music_events", batch_id, ["event_date"])
            if "topics" in outputs:
                for topic in ("raw_topic", "enrichment_topic"):
                    sinks.write_batch(event_messages(good), out_root, topic, batch_id)
            if "enriched" in outputs:
                bad = bad.unionByName(_write_enriched(raw, out_root, batch_id))
            _write_failed(bad, out_root, batch_id, attempts)
            if "metrics" in outputs:
                metric = window_state.event_metrics(distinct)
                counted = raw.select(*METRIC_COLUMNS).persist()  # read several times
                in_time = window_state.split_late(counted, "timestamp", metric.duration, lateness, out_root, batch_id)
                window_state.update(in_time, metric, out_root, batch_id)
                counted.unpersist()
            _commit(batch.sparkSession, out_root, batch_id)
        finally:
            held.unpersist()
    return run


def simple_batch(out_root: str, lateness: str | None = None, attempts: int = 1,
                 kinds: Collection[str] = SIMPLE_METRICS, outputs: Collection[str] = SIMPLE_OUTPUTS) -> Callable[[DataFrame, int], None]:
    """A3-A5, S5 and V13 of shape B in one ``foreachBatch``.

    A row whose event time cannot be read is stored, but belongs to no window:
    it is in ``late_events`` without a window.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = batch.where("is_valid"), batch.where("NOT is_valid")
            rows = metrics.with_event_time(processed_events(loose_parse_b(good))).persist()
            if "processed" in outputs:
                sinks.write_batch(rows.drop("event_ts"), out_root, "processed_events", batch_id)
            _write_failed(bad.select("raw_value", "errors", "batch_file", "received_at", "attempt"), out_root, batch_id, attempts)
            if "metrics" in outputs:
                in_time = window_state.split_late(rows, "event_ts", metrics.KEYED_WINDOW, lateness, out_root, batch_id)
                for kind in kinds:
                    window_state.update(in_time, window_state.keyed_metrics(kind), out_root, batch_id)
            _commit(batch.sparkSession, out_root, batch_id)
            rows.unpersist()
        finally:
            batch.unpersist()
    return run


def _write_enriched(raw: DataFrame, out_root: str, batch_id: int) -> DataFrame:
    """S6 + S8: enriched rows and their JSON. Returns the events that enrichment made unfit (V10), as failed messages."""
    rows = enrich.enriched_music_events(raw, keep=["event_date", "batch_file"]).persist()
    fit = validate.description_ok(F.col("enhanced_description"))
    body = F.to_json(F.struct(*enrich.ENRICHED_A_COLUMNS), messages.JSON_OPTIONS)
    sinks.write_batch(rows.where(fit).drop("batch_file"), out_root, "enriched_music_events", batch_id, ["event_date"])
    sinks.write_batch(rows.where(fit).select("event_type", "platform", "timestamp", "event_id", "batch_file", body.alias("value")),
                 out_root, "enriched_topic", batch_id)
    return rows.where(~fit).select(body.alias("raw_value"), F.array(F.lit("description_too_long")).alias("errors"), "batch_file",
                                   F.current_timestamp().alias("received_at"), F.lit(None).cast("int").alias("attempt"))


def _write_failed(bad: DataFrame, out_root: str, batch_id: int, attempts: int) -> None:
    """Log each failed delivery; send it round again, or to the dead letters after its last attempt.

    A message that enrichment refused (no attempt number) does not come back.
    """
    last = F.coalesce(F.col("attempt") >= attempts, F.lit(True))
    if attempts > 1:
        sinks.write_batch(bad.select(F.md5("raw_value").alias("message_id"), "attempt", "errors", last.alias("final"), "received_at"), out_root, "attempts", batch_id)
        (bad.where(~last).select(F.col("raw_value").alias("value"), (F.col("attempt") + 1).alias("attempt"), "batch_file")
         .write.mode("overwrite").json(f"{redrive_folder(out_root)}/batch-{batch_id}", compression="gzip"))
        bad = bad.where(last)
    sinks.write_batch(bad, out_root, "dead_letters", batch_id)


def redrive_folder(out_root: str) -> str:
    return f"{out_root}/redrive"


def event_messages(good: DataFrame) -> DataFrame:
    """One JSON message per valid event, the whole event, with routing
    attributes (event type, platform, timestamp, event id and the source file)."""
    body = F.to_json(F.struct(*[f.name for f in EVENT_A.fields]), messages.JSON_OPTIONS)
    return good.select("event_type", F.col("streaming_event.platform").alias("platform"), "timestamp", "event_id", "batch_file", body.alias("value"))


def _commit(spark: SparkSession, out_root: str, batch_id: int) -> None:
    spark.range(1).select(F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(f"{out_root}/commits/batch_id={batch_id}")


def read_committed(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """A table of a pipeline up to its last whole batch (batches follow each other, so that is one number)."""
    last = spark.read.parquet(f"{out_root}/commits").agg(F.max("batch_id").alias("last"))
    return sinks.read_batches(spark, out_root, table).join(F.broadcast(last), F.col("batch_id") <= F.col("last")).drop("last")


# --- pipelines ---------------------------------------------------------------------------

def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for a stateful query: state in RocksDB, in as many partitions as the cluster
    has cores (a checkpoint fixes that number); the caller's session keeps its settings. The
    shuffles of a micro-batch go with it, and its tables are in zstd."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")  # a lookup less for each row kept
    own.conf.set(SHUFFLE_CLEANUP, "true")
    own.conf.set("spark.sql.parquet.compression.codec", "zstd")
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return own


def _start(spark: SparkSession, rows: DataFrame, batch: Callable[[DataFrame, int], None], out_root: str, name: str, available_now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    return (rows.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint_path(spark, f"streams/{_tag(out_root)}/{name}")).trigger(**trigger).start())


def _source(spark: SparkSession, out_root: str, attempts: int, source: dict) -> dict:
    if attempts > 1:
        redrive = spark._jvm.org.apache.hadoop.fs.Path(redrive_folder(out_root))
        redrive.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(redrive)
        return {**source, "redrive": redrive_folder(out_root)}
    return source


def start_full_pipeline(spark: SparkSession, landing: str, out_root: str, watermark: str | None = None,
                        available_now: bool = True, attempts: int = 1, distinct: str = "exact",
                        outputs: Collection[str] = FULL_OUTPUTS, redelivery: str = REDELIVERY, **source) -> list[StreamingQuery]:
    """L1: the streaming query of the shape A pipeline.

    ``watermark`` is the allowed lateness of the window metrics: later events are
    in every table but the metrics, and in ``late_events``; without it no event
    is late. ``attempts`` is how often a failed message is tried (V13);
    ``source`` goes to ``event_stream``.
    """
    own = stream_session(spark)
    checked = delivered_once(event_stream(own, landing, **_source(spark, out_root, attempts, source)), redelivery)
    return [_start(spark, checked, fan_out_batch(out_root, watermark, attempts, distinct, outputs), out_root, "fanout", available_now)]


def start_simple_pipeline(spark: SparkSession, landing: str, out_root: str, watermark: str | None = None,
                          available_now: bool = True, attempts: int = 1, kinds: Collection[str] = SIMPLE_METRICS,
                          outputs: Collection[str] = SIMPLE_OUTPUTS, redelivery: str = REDELIVERY, **source) -> list[StreamingQuery]:
    """L2: shape B messages to ``processed_events`` and the three 5-minute metric tables, in one query."""
    own = stream_session(spark)
    checked = delivered_once(simple_stream(own, landing, **_source(spark, out_root, attempts, source)), redelivery)
    return [_start(spark, checked, simple_batch(out_root, watermark, attempts, kinds, outputs), out_root, "simple", available_now)]


def drain(start: Callable[..., list[StreamingQuery]], *args, attempts: int = 1, **kwargs) -> None:
    """Run a pipeline over what is there, as often as a failed message can come back."""
    for _ in range(attempts):
        for q in start(*args, available_now=True, attempts=attempts, **kwargs):
            q.awaitTermination()


def run_to_completion(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain a streaming DataFrame with ``availableNow`` into Parquet and wait.

    A stateful one should be built on ``stream_session``.
    """
    (df.writeStream.outputMode(mode).format("parquet").option("path", out_path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def _tag(path: str) -> str:
    return hashlib.sha1(path.encode()).hexdigest()[:12]


def observed_counts(checked: DataFrame, name: str = "validation") -> DataFrame:
    """V14 on a stream: valid and invalid counts per micro-batch, reported in
    ``query.lastProgress["observedMetrics"][name]`` without an extra pass."""
    return checked.observe(name, F.count_if(F.col("is_valid")).alias("valid"),
                           F.count_if(~F.col("is_valid")).alias("invalid"))
