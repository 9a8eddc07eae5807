"""The streaming pipeline writes the same rows a batch run computes."""

import os
import tempfile

from pyspark.sql import functions as F

from cadenza.operators import validate
from cadenza.sources import messages
from cadenza.sources.adapter import nested_events_a, read_events
from cadenza.streaming import pipeline as stream

SF = "/root/testdata/sf0.001"


def test_full_pipeline_fan_out(spark):
    root = tempfile.mkdtemp(prefix="cadenza-stream-")
    landing = messages.land_text(messages.damaged_messages(read_events(spark, SF)), f"{root}/landing")
    for q in stream.start_full_pipeline(spark, landing, f"{root}/out"):
        q.awaitTermination()
    batch = validate.validate(messages.read_landing(spark, landing, stream.EVENT_A))
    n_valid = batch.filter("is_valid").count()
    n_bad = batch.filter("NOT is_valid").count()
    raw = spark.read.parquet(f"{root}/out/raw_music_events")
    assert raw.count() == n_valid and "event_date" in raw.columns
    assert spark.read.parquet(f"{root}/out/dead_letters").count() == n_bad
    topic = spark.read.parquet(f"{root}/out/enrichment_topic")
    assert topic.count() == n_valid
    assert set(topic.columns) >= {"event_type", "platform", "timestamp", "event_id", "batch_file", "value"}
    assert topic.filter(F.col("batch_file").startswith("part-")).count() == n_valid
    metrics = spark.read.parquet(f"{root}/out/music_event_metrics")
    assert metrics.agg(F.sum("total_events")).first()[0] <= n_valid
    assert metrics.count() > 0


def test_full_pipeline_metrics_count_every_event_once(spark):
    """Redelivered, late and last events: the metrics equal those of one batch over the distinct events."""
    from cadenza.operators import metrics
    root = tempfile.mkdtemp(prefix="cadenza-metrics-")
    events = read_events(spark, SF)
    parts = [events.filter("event_id >= 300"), events.filter("event_id < 500")]  # overlapping, the earlier days last
    for i, part in enumerate(parts):
        messages.to_json_text(nested_events_a(part)).write.text(f"{root}/landing/part{i}")
        for q in stream.start_full_pipeline(spark, f"{root}/landing/*", f"{root}/out"):
            q.awaitTermination()
    good, _ = validate.split_valid(validate.validate(messages.read_landing(spark, f"{root}/landing/*", stream.EVENT_A)))
    want = metrics.window_metrics(stream.raw_music_events(good).dropDuplicates(["event_id"]))
    got = spark.read.parquet(f"{root}/out/music_event_metrics").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.agg(F.sum("total_events")).first()[0] == good.select("event_id").distinct().count()


def test_restart_resumes_from_checkpoint(spark):
    root = tempfile.mkdtemp(prefix="cadenza-restart-")
    landing = f"{root}/landing"
    events = read_events(spark, SF)
    first = events.filter(F.col("event_id") < 500)
    messages.to_json_text(nested_events_a(first)).write.text(f"{landing}/part1")
    raw = stream.raw_stream(stream.event_stream(spark, f"{landing}/*"))
    out, ck = f"{root}/out", f"{root}/ck"
    stream.run_to_completion(raw.select("event_id"), out, ck)
    n1 = spark.read.parquet(out).count()
    rest = events.filter(F.col("event_id") >= 500)
    messages.to_json_text(nested_events_a(rest)).write.text(f"{landing}/part2")
    stream.run_to_completion(raw.select("event_id"), out, ck)  # same checkpoint: only new files
    ids = spark.read.parquet(out)
    assert n1 == 500 and ids.count() == events.count() == ids.distinct().count()


def test_simple_pipeline_and_observed_counts(spark):
    root = tempfile.mkdtemp(prefix="cadenza-simple-")
    from cadenza.sources.adapter import nested_events_b
    landing = messages.land_text(messages.to_json_text(nested_events_b(read_events(spark, SF))), f"{root}/landing")
    for q in stream.start_simple_pipeline(spark, landing, f"{root}/out"):
        q.awaitTermination()
    assert spark.read.parquet(f"{root}/out/processed_events").count() == 1000
    for kind in ("engagement", "genre", "platform"):
        m = spark.read.parquet(f"{root}/out/{kind}_metrics")
        assert 0 < m.agg(F.sum("count")).first()[0] <= 1000
    # per-batch validation counters on a stream
    dam = messages.land_text(messages.damaged_messages(read_events(spark, SF)), f"{root}/damaged")
    q = (stream.observed_counts(stream.event_stream(spark, dam)).select("event_id").writeStream
         .format("noop").option("checkpointLocation", f"{root}/ck-obs").trigger(availableNow=True).start())
    q.awaitTermination()
    seen = [p["observedMetrics"]["validation"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(int(s["valid"]) + int(s["invalid"]) for s in seen) == 1000
    assert sum(int(s["invalid"]) for s in seen) > 0


def test_sql_views_equal_dataframe_views(spark):
    from cadenza.operators import reports
    from cadenza.plans.queries import raw_a
    from cadenza.plans.views import register_views
    raw = raw_a(spark, SF)
    register_views(spark, raw)
    for name, fn in (("daily_events_summary", reports.daily_events_summary),
                     ("top_tracks_weekly", reports.top_tracks_weekly),
                     ("platform_performance", reports.platform_performance)):
        a = sorted(map(tuple, spark.table(name).collect()))
        b = sorted(map(tuple, fn(raw).collect()))
        assert a == b, name
