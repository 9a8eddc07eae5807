"""What one task or the driver gets stays bounded when the tables grow."""

import os
import tempfile
import time

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from cadenza.operators import daily, validate
from cadenza.plans import queries
from cadenza.sources import messages, sinks, tables
from cadenza.sources.adapter import nested_events_a, read_events
from cadenza.streaming import compaction
from cadenza.streaming import pipeline as stream

SF = "/root/testdata/sf0.001"


def land(df, path, **options):
    df.coalesce(1).write.mode("append").text(path, **options)


def files_in(path, ending=""):
    return [f"{d}/{f}" for d, _, names in os.walk(path) for f in names if not f.startswith(("_", ".")) and f.endswith(ending)]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def removed(spark, before):
    """No shuffle files but those of ``before``; removal may lag behind."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return not left


def test_more_rows_make_more_scan_tasks(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 50)
    events = read_events(spark, SF)
    assert events.select(F.spark_partition_id()).distinct().count() >= 15
    assert events.count() == 1000


def test_daily_tables_get_partitions_by_events(spark, monkeypatch):
    monkeypatch.setattr(daily, "TASK_ROWS", 10)
    own, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: seen.append(spark.conf.get("spark.sql.shuffle.partitions")) or real(*a, **k))
    daily.daily_tables(queries.raw_a(spark, SF))
    assert seen == ["100"] and spark.conf.get("spark.sql.shuffle.partitions") == own


def test_a_batch_is_bounded_in_bytes(spark, monkeypatch):
    """One batch a file here; the messages that come back are bounded likewise."""
    root = tempfile.mkdtemp(prefix="cadenza-bytes-")
    text = messages.to_json_text(nested_events_a(read_events(spark, SF).where("event_id < 9")))
    number = F.regexp_extract("value", "evt-([0-9]+)", 1).cast("int") % 3
    for i in range(3):
        land(text.where(number == i).unionByName(spark.createDataFrame([(f"broken {i}",)], "value string")), f"{root}/landing")
    monkeypatch.setattr(stream, "BATCH_BYTES", 1)
    stream.drain(stream.start_full_pipeline, spark, f"{root}/landing", f"{root}/out", outputs=["raw"], attempts=2)
    for table, n in (("raw_music_events", 9), ("dead_letters", 3)):
        rows = stream.read_committed(spark, f"{root}/out", table)
        assert rows.count() == n and rows.select("batch_id").distinct().count() == 3


def test_only_failed_messages_carry_their_text_to_the_state(spark):
    root = tempfile.mkdtemp(prefix="cadenza-text-")
    text = messages.to_json_text(nested_events_a(read_events(spark, SF).where("event_id < 4")))
    anonymous = text.limit(1).select(F.regexp_replace("value", '"event_id":"[^"]*",', "").alias("value"))
    land(text.unionByName(anonymous).unionByName(spark.createDataFrame([("broken",)], "value string")), f"{root}/landing")
    own = stream.stream_session(spark)
    rows = stream.delivered_once(stream.event_stream(own, f"{root}/landing")).select("event_id", "is_valid", "raw_value")
    stream.run_to_completion(rows, f"{root}/out", f"{root}/ck")
    got = {(r.event_id is not None, r.is_valid, r.raw_value is not None) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {(True, True, False), (False, True, True), (False, False, True)}


def test_large_deliveries_have_more_files(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_MESSAGES", 5000)
    path, files = queries.landed_deliveries_b(spark, "/root/testdata/sf0.1")
    names = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
    assert files == 5 and len(names) == 4 * files
    names.sort(key=os.path.getmtime)
    days = spark.read.text(names[:files]).select(F.substring(F.get_json_object("value", "$.timestamp"), 9, 2).cast("int").alias("d"))
    assert tuple(days.agg(F.min("d"), F.max("d")).first()) == (9, 16)


def test_compaction_cuts_ranges_for_tasks_not_files(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="cadenza-ranges-")
    raw = stream.sinks.with_event_date(stream.raw_music_events(nested_events_a(read_events(spark, SF))))
    stream.sinks.write_batch(raw, root, "raw_music_events", 0, ["event_date"])
    stream._commit(spark, root, 0)
    cuts, target = [], type(raw)
    real = target.repartitionByRange
    monkeypatch.setattr(target, "repartitionByRange", lambda self, n, *keys: cuts.append(n) or real(self, n, *keys))
    compaction.compact(spark, root, "raw_music_events", target_bytes=1 << 12, tail=0)
    assert cuts == [spark.sparkContext.defaultParallelism]
    packed = f"{root}/raw_music_events__packed"
    files = [f for _, _, names in os.walk(packed) for f in names if f.endswith(".parquet")]
    assert len(files) > 60  # the files stay as small as they were asked for
    assert compaction.read_compacted(spark, root, "raw_music_events").count() == 1000


def test_messages_that_come_back_are_packed(spark):
    root = tempfile.mkdtemp(prefix="cadenza-redrive-")
    broken = spark.range(300).select(F.concat(F.lit("broken message "), "id", F.lit(" of a sender")).alias("value"))
    land(broken, f"{root}/landing")
    before = shuffle_files(spark)
    stream.drain(stream.start_full_pipeline, spark, f"{root}/landing", f"{root}/out", outputs=[], attempts=3)
    assert removed(spark, before)  # the shuffles of its batches
    back = files_in(f"{root}/out/redrive")
    assert back and all(f.endswith(".json.gz") for f in back)
    assert sum(map(os.path.getsize, back)) < 2 * sum(map(os.path.getsize, files_in(f"{root}/landing")))  # two times each
    log = sinks.read_batches(spark, f"{root}/out", "attempts").groupBy("message_id").agg(F.count("*").alias("n"))
    assert log.count() == 300 and {r.n for r in log.collect()} == {3}
    assert sinks.read_batches(spark, f"{root}/out", "dead_letters").distinct().count() == 300


def test_a_packed_landing_is_bounded_by_its_text(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="cadenza-packed-")
    text = messages.to_json_text(nested_events_a(read_events(spark, SF).where("event_id < 30")))
    number = F.regexp_extract("value", "evt-([0-9]+)", 1).cast("int") % 3
    for i in range(3):
        land(text.where(number == i), f"{root}/landing", compression="gzip")
    files = files_in(f"{root}/landing")
    monkeypatch.setattr(stream, "BATCH_BYTES", sum(map(os.path.getsize, files)))  # a file of it as text
    stream.drain(stream.start_full_pipeline, spark, f"{root}/landing", f"{root}/out", outputs=["raw"], packed=True)
    rows = stream.read_committed(spark, f"{root}/out", "raw_music_events")
    assert rows.count() == 30 and rows.select("batch_id").distinct().count() == 3


def test_only_failed_messages_are_held_where_no_table_takes_events(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="cadenza-held-")
    text = messages.to_json_text(nested_events_a(read_events(spark, SF).where("event_id < 9")))
    land(text.unionByName(spark.createDataFrame([("broken",)], "value string")), f"{root}/landing")
    held, frame = [], type(text)
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: held.append(self.count()) or real(self, *a))
    stream.fan_out_batch(f"{root}/out", outputs=[])(validate.validate(messages.read_landing(spark, f"{root}/landing", stream.EVENT_A))
                                                    .withColumn("received_at", F.current_timestamp()), 0)
    assert held == [1] and sinks.read_batches(spark, f"{root}/out", "dead_letters").count() == 1


def test_deliveries_are_packed_and_leave_no_shuffles(spark):
    before = shuffle_files(spark)
    landing, files = queries.landed_deliveries_a(spark, SF)
    events = read_events(spark, SF)
    quarter = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))
    again = events.where((F.col("event_id") % 10 == 0) & (quarter != 2)).count()  # the third quarter comes last
    assert len(files_in(landing, ".txt.gz")) == len(files_in(landing)) == 4 * files
    assert spark.read.text(landing).count() == events.count() + again
    out = queries.streamed(spark, stream.start_full_pipeline, (landing, files), outputs=["enriched"])
    assert removed(spark, before)
    for table in ("enriched_topic", "enriched_music_events"):
        assert files_in(f"{out}/{table}", ".zstd.parquet") == files_in(f"{out}/{table}", ".parquet")
        assert stream.read_committed(spark, out, table).select("event_id").distinct().count() > 700
