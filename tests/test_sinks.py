"""Sinks, retention, archive, observation counters and alerts."""

import datetime as dt
import os
import tempfile
import time

from pyspark.sql import functions as F

from cadenza.operators import validate
from cadenza.plans.queries import raw_a
from cadenza.schemas import EVENT_A
from cadenza.sources import messages, sinks
from cadenza.sources.adapter import nested_events_a, read_events
from cadenza.streaming import pipeline as stream

SF = "/root/testdata/sf0.001"


def test_partitioned_table_and_retention(spark):
    out = tempfile.mkdtemp(prefix="cadenza-table-")
    raw = raw_a(spark, SF)
    sinks.write_table(raw, out, "raw_music_events")
    days = sorted(d for d in os.listdir(out) if d.startswith("event_date="))
    assert len(days) == raw.select(F.to_date("timestamp")).distinct().count()
    dropped = sinks.apply_retention(spark, out, "raw_music_events", dt.date(2024, 4, 25))
    kept = spark.read.parquet(out)
    assert dropped and all(d < "event_date=2024-01-26" for d in dropped)
    assert kept.agg(F.min("event_date")).first()[0] >= dt.date(2024, 1, 26)
    expected = raw.filter(F.to_date("timestamp") >= F.lit("2024-01-26")).count()
    assert kept.count() == expected
    # files inside a day are sorted by the clustering columns
    one_day = spark.read.parquet(f"{out}/{days[-1]}")
    assert one_day.count() > 0


def test_retained_filter(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 1, 1),)], "event_date date")
    assert sinks.retained(df, "raw_music_events", dt.date(2024, 2, 1)).count() == 1


def test_stream_archives_processed_files(spark):
    root = tempfile.mkdtemp(prefix="cadenza-archive-")
    landing, archive = f"{root}/landing", f"{root}/archive"
    messages.to_json_text(nested_events_a(read_events(spark, SF))).coalesce(2).write.text(landing)
    # one file per micro-batch: a batch's files are archived once the next batch starts
    src = messages.read_landing(spark, landing, EVENT_A, streaming=True, archive_dir=archive,
                                max_files_per_trigger=1)
    stream.run_to_completion(src.select("event_id"), f"{root}/out", f"{root}/ck")
    assert spark.read.parquet(f"{root}/out").count() == 1000
    archived = []
    for _ in range(20):
        archived = [f for _, _, fs in os.walk(archive) for f in fs if f.startswith("part-")]
        if archived:
            break
        time.sleep(0.5)
    assert archived


def test_observe_counts(spark):
    df = spark.createDataFrame([("{bad",), ('{"event_id":"e"}',)], "value string")
    checked, obs = validate.observe_counts(validate.validate(validate.parse_json(df, EVENT_A)))
    checked.write.format("noop").mode("overwrite").save()
    assert obs.get == {"valid": 0, "invalid": 2}


def test_error_alert_flags(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, s % 60),) for s in range(3001 + 10)]
    df = spark.createDataFrame(rows, "failed_at timestamp")
    out = stream.error_alerts(df, time_col="failed_at", only_alerts=False)
    flagged = out.filter("alert").collect()
    assert flagged and all(r.errors_per_second > 10 for r in flagged)
    assert stream.error_alerts(df, time_col="failed_at").count() == len(flagged)


def test_views_prune_date_partitions(spark):
    import __spark_entry__ as E
    df = E.queries()["table_platform_performance"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan
    assert df.count() > 0
