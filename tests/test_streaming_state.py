"""Window state, lateness, redelivery, retries, commits and file intake of the streams."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from cadenza.operators import metrics, rules, validate
from cadenza.sources import messages
from cadenza.sources.adapter import nested_events_a, nested_events_b, read_events
from cadenza.streaming import pipeline as stream
from cadenza.streaming import window_state

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def land(df, path):
    df.coalesce(1).write.mode("append").text(path)


@pytest.mark.parametrize("distinct", ["exact", "sketch"])
def test_state_merges_to_the_batch_metrics(spark, distinct):
    """Three micro-batches over the same windows, one of them replayed, give what one pass gives."""
    root = tempfile.mkdtemp(prefix="cadenza-state-")
    raw = stream.raw_music_events(nested_events_a(read_events(spark, SF))).withColumn(
        "timestamp", F.date_trunc("HOUR", "timestamp"))  # many events a window
    metric = window_state.event_metrics(distinct)
    n = F.substring_index("event_id", "-", -1).cast("int") % 3
    for i in (0, 1, 2, 2):
        window_state.update(raw.where(n == i), metric, root, i)
    want = metrics.window_metrics(raw)
    got = spark.read.parquet(f"{root}/music_event_metrics").select(*want.columns)
    assert rows_of(got) == rows_of(want)
    # a replayed older batch starts from what was there before it
    versions = spark.read.parquet(f"{root}/state/music_event_metrics").groupBy("event_date", "event_hour").agg(F.countDistinct("batch_id").alias("n"))
    assert versions.agg(F.max("n")).first()[0] <= 2


def test_work_of_a_batch_reads_its_own_hours_only(spark, monkeypatch):
    """The state read by a batch is one folder per hour it touches, whatever is stored."""
    root = tempfile.mkdtemp(prefix="cadenza-reads-")
    raw = stream.raw_music_events(nested_events_a(read_events(spark, SF)))
    metric = window_state.event_metrics()
    window_state.update(raw, metric, root, 0)
    seen = []
    real = window_state._versions
    monkeypatch.setattr(window_state, "_versions", lambda s, state, periods: seen.append(real(s, state, periods)) or seen[-1])
    hour = raw.select(F.date_trunc("HOUR", "timestamp")).first()[0]
    own = raw.where(F.date_trunc("HOUR", "timestamp") == hour)
    window_state.update(own, metric, root, 1)
    assert seen == [{f"event_date={hour.date()}/event_hour={hour.hour}": [0]}]
    got = spark.read.parquet(f"{root}/music_event_metrics")
    assert got.agg(F.sum("total_events")).first()[0] == raw.count() + own.count()


def test_late_events_are_counted_not_lost(spark):
    root = tempfile.mkdtemp(prefix="cadenza-late-")
    events = read_events(spark, SF)
    for cond in (F.dayofmonth("ts") >= 15, F.dayofmonth("ts") < 15):
        land(messages.to_json_text(nested_events_b(events.where(cond))), f"{root}/landing")
    land(spark.createDataFrame([('{"event_id":"x","event_type":"play","timestamp":"no time"}',)], "value string"), f"{root}/landing")
    stream.drain(stream.start_simple_pipeline, spark, f"{root}/landing", f"{root}/out", watermark="1 day", max_files_per_trigger=1)
    total = 1001
    assert spark.read.parquet(f"{root}/out/processed_events").count() == total
    late = spark.read.parquet(f"{root}/out/late_events")
    progress = spark.read.parquet(f"{root}/out/progress").agg(F.sum("on_time"), F.sum("late")).first()
    assert tuple(progress) == (total - late.count(), late.count())
    assert late.where("window_start IS NULL").count() == 1 and late.count() > 100
    for kind in ("engagement", "genre", "platform"):
        table = spark.read.parquet(f"{root}/out/{kind}_metrics")
        assert table.agg(F.sum("count")).first()[0] == total - late.count()
    closed = window_state.closed_windows(spark, f"{root}/out", "genre_metrics", "1 day")
    last = window_state.closed_windows(spark, f"{root}/out", "genre_metrics", "1 day", closing=True)
    assert 0 < closed.count() < last.count() == spark.read.parquet(f"{root}/out/genre_metrics").count()


def test_redelivery_in_later_batches(spark):
    """Both shapes, events with and without an id of their own, across restarts."""
    root = tempfile.mkdtemp(prefix="cadenza-redelivery-")
    events = read_events(spark, SF)
    for shape, nested, start, table in (("a", nested_events_a, stream.start_full_pipeline, "raw_music_events"),
                                        ("b", nested_events_b, stream.start_simple_pipeline, "processed_events")):
        text = messages.to_json_text(nested(events))
        if shape == "a":  # every third message carries no id
            own = F.regexp_replace("value", '"event_id":"[^"]*",', "")
            text = text.select(F.when(F.abs(F.hash("value")) % 3 == 0, own).otherwise(F.col("value")).alias("value"))
        n = text.distinct().count()
        for _ in range(2):
            land(text, f"{root}/{shape}")
            stream.drain(start, spark, f"{root}/{shape}", f"{root}/out-{shape}")
        assert spark.read.parquet(f"{root}/out-{shape}/{table}").count() == n


def test_failed_messages_come_back_five_times(spark):
    root = tempfile.mkdtemp(prefix="cadenza-attempts-")
    good = messages.to_json_text(nested_events_a(read_events(spark, SF).limit(20)))
    land(good.unionByName(spark.createDataFrame([("{broken",), ("[]",)], "value string")), f"{root}/landing")
    # envelopes: a whole one, and two that hold no text
    land(messages.encode_envelope(good), f"{root}/envelopes")
    land(spark.createDataFrame([("%%%",), ('{"data":"####"}',)], "value string"), f"{root}/envelopes")
    for folder, envelope in (("landing", False), ("envelopes", True)):
        out = f"{root}/out-{folder}"
        stream.drain(stream.start_full_pipeline, spark, f"{root}/{folder}", out, attempts=5, envelope=envelope, outputs=["raw"])
        log = spark.read.parquet(f"{out}/attempts")
        assert sorted(r.attempt for r in log.collect()) == [a for a in range(1, 6) for _ in range(2)]
        assert log.where("final").select("attempt").distinct().collect() == [(5,)]
        dead = spark.read.parquet(f"{out}/dead_letters")
        assert sorted(r.raw_value for r in dead.collect()) == sorted(["{broken", "[]"] if not envelope else ["%%%", '{"data":"####"}'])
        assert spark.read.parquet(f"{out}/raw_music_events").count() == 20
    # shape B
    land(spark.createDataFrame([("nothing",), ('{"event_id":"b1"}',)], "value string"), f"{root}/b")
    stream.drain(stream.start_simple_pipeline, spark, f"{root}/b", f"{root}/out-b", attempts=3)
    assert spark.read.parquet(f"{root}/out-b/dead_letters").select("raw_value", "attempt").collect() == [("nothing", 3)]
    assert spark.read.parquet(f"{root}/out-b/processed_events").count() == 1


def test_tables_of_a_batch_appear_together(spark):
    root = tempfile.mkdtemp(prefix="cadenza-commit-")
    land(messages.to_json_text(nested_events_a(read_events(spark, SF))), f"{root}/landing")
    stream.drain(stream.start_full_pipeline, spark, f"{root}/landing", f"{root}/out")
    tables = {t: stream.read_committed(spark, f"{root}/out", t).count() for t in ("raw_music_events", "raw_topic", "enrichment_topic", "enriched_music_events", "enriched_topic")}
    assert set(tables.values()) == {1000}
    # a batch that died between its tables is not read, and its replay adds nothing twice
    checked = validate.validate(messages.read_landing(spark, f"{root}/landing", stream.EVENT_A).limit(30).withColumn("received_at", F.current_timestamp()))
    last = 7
    good, _ = validate.split_valid(checked)
    raw = stream.sinks.with_event_date(stream.raw_music_events(good, ["batch_file"]))
    stream.sinks.write_batch(raw.drop("batch_file"), f"{root}/out", "raw_music_events", last, ["event_date"])
    assert stream.read_committed(spark, f"{root}/out", "raw_music_events").count() == 1000
    for _ in range(2):
        stream.fan_out_batch(f"{root}/out", outputs=["raw", "enriched"])(checked, last)
    assert stream.read_committed(spark, f"{root}/out", "raw_music_events").count() == 1030
    assert stream.read_committed(spark, f"{root}/out", "enriched_topic").count() == 1030
    event = json.loads(spark.read.parquet(f"{root}/out/raw_topic").first().value)
    assert {"track", "artist", "streaming_event", "user_interaction"} <= set(event)


def test_long_descriptions_are_dead_letters(spark):
    root = tempfile.mkdtemp(prefix="cadenza-v10-")
    event = nested_events_a(read_events(spark, SF).limit(2))
    long_name = event.withColumn("artist", F.col("artist").withField("name", F.repeat(F.lit("x"), 200))).withColumn(
        "track", F.col("track").withField("name", F.repeat(F.lit("y"), 300))).withColumn(
        "streaming_event", F.col("streaming_event").withField("platform", F.lit("spotify")))
    land(messages.to_json_text(long_name), f"{root}/landing")
    monkey = rules.DESCRIPTION_TEMPLATE
    assert len(monkey) < 1000
    stream.drain(stream.start_full_pipeline, spark, f"{root}/landing", f"{root}/out", outputs=["enriched"])
    assert spark.read.parquet(f"{root}/out/enriched_music_events").count() == 2
    assert spark.createDataFrame([("z" * 1001,), ("z" * 1000,), (None,)], "d string").where(validate.description_ok(F.col("d"))).count() == 2


def test_file_kinds(spark):
    root = tempfile.mkdtemp(prefix="cadenza-files-")
    one = messages.to_json_text(nested_events_a(read_events(spark, SF).limit(3)))
    texts = [r.value for r in one.collect()]
    files = [texts[0], "[" + ",\n".join(texts) + "]", "[" + ",".join(texts), "{\n" + texts[1][1:], "[]", "  \n", "plain"]
    spark.createDataFrame([(str(i), t) for i, t in enumerate(files)], "f string, value string").write.partitionBy("f").text(f"{root}/in")
    got = messages.read_landing(spark, f"{root}/in", stream.EVENT_A, whole_files=True)
    assert got.where("parse_ok").count() == 5
    assert sorted(r.raw_value.strip() for r in got.where("NOT parse_ok").collect()) == sorted([files[2], "plain"])


def test_each_message_is_parsed_once(spark):
    import __spark_entry__ as E
    for name in ("validation_errors", "valid_events_raw", "validation_summary"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, name
    landing = messages.land_text(messages.to_json_text(nested_events_a(read_events(spark, SF))), tempfile.mkdtemp() + "/l")
    good, _ = validate.split_valid(validate.validate(messages.read_landing(spark, landing, stream.EVENT_A)))
    assert stream.raw_music_events(good)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_sustained_alerts(spark):
    """A burst does not fire, nor four minutes; five minutes and more do, with a gap between two stretches."""
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for minute, n in [(0, 5000), *((m, 601) for m in range(10, 14)), *((m, 601) for m in range(20, 25)), (26, 601), *((m, 700 + m) for m in range(40, 47)), (50, 600)]:
        rows += [(t0 + dt.timedelta(minutes=minute, seconds=59 * i / n),) for i in range(n)]
    got = stream.sustained_alerts(spark.createDataFrame(rows, "received_at timestamp")).orderBy("alert_start").collect()
    assert [((r.alert_start - t0).seconds // 60, (r.alert_end - t0).seconds // 60, r.minutes, r.errors) for r in got] == [
        (20, 25, 5, 5 * 601), (40, 47, 7, sum(700 + m for m in range(40, 47)))]


def test_rules_of_any_number(spark):
    """The index join equals a nested loop: short, empty and overlapping needles, ties of priority, hot texts."""
    import random
    r = random.Random(4)
    texts = ["", "Abba", "ab", "a", None, "the the", "Über Ähre", "x" * 50] + ["".join(r.choice("abcü ") for _ in range(r.randrange(12))) for _ in range(80)]
    events = [(i, r.choice(texts), r.choice(texts), r.choice(["Rock", "folk", None]), "p") for i in range(300)] + [(1000 + i, "abba cab", "the the", "pop", "p") for i in range(200)]
    table = [(r.randrange(40), r.choice(rules.TABLE_FIELDS), "".join(r.choice("abcü ") for _ in range(r.randrange(6))), r.choice(rules.TABLE_OUTPUTS), [f"v{i}"]) for i in range(300)]
    df = spark.createDataFrame(events, "event_id int, track_title string, artist_name string, genre string, platform string")
    got = {x.event_id: x for x in rules.match_rules_table(df, spark.createDataFrame(table, rules.RULES_SCHEMA)).collect()}
    plain = {x.event_id: x for x in rules.match_rules_table(df, spark.createDataFrame([], rules.RULES_SCHEMA)).collect()}
    assert len(got) == len(plain) == len(events)
    for i, title, artist, _, _ in events:
        low = {"track_title": (title or "").lower(), "artist_name": (artist or "").lower()}
        for k, out in enumerate(rules.TABLE_OUTPUTS):
            hits = [(p, v) for p, f, n, o, v in table if o == out and n in low[f]]
            want = min(hits)[1] if hits else plain[i][out]
            assert got[i][out] == (want[0] if hits and k < 2 else want)


def test_bins():
    from cadenza.streaming.compaction import bins
    assert bins([(0, 5), (2, 5), (3, 12), (4, 1), (7, 1)], 10, 3) == [[0, 2], [3]]
    assert bins([(0, 5), (2, 5), (3, 12), (4, 1), (7, 1)], 10, 1) == [[0, 2], [3], [4, 7]]
    assert bins([], 10, 0) == []


def test_compaction(spark):
    """Rows stay, folders become few, old readers survive one compaction, uncommitted batches stay out, dates prune."""
    import os
    from cadenza.streaming import compaction
    root = tempfile.mkdtemp(prefix="cadenza-compact-")
    raw = stream.sinks.with_event_date(stream.raw_music_events(nested_events_a(read_events(spark, SF))))
    n = F.substring_index("event_id", "-", -1).cast("int") % 6
    for i in range(6):
        stream.sinks.write_batch(raw.where(n == i), root, "raw_music_events", i, ["event_date"])
        if i < 5:
            stream._commit(spark, root, i)
    want = rows_of(raw.where(n < 5).select("event_id", "event_date"))
    early = stream.read_committed(spark, root, "raw_music_events").select("event_id", "event_date")
    early.schema  # listed before the swap
    for k in range(3):
        written = compaction.compact(spark, root, "raw_music_events", target_bytes=1 << 40, tail=2)
        assert (written > 0) == (k == 0)
        got = compaction.read_compacted(spark, root, "raw_music_events").select("event_id", "event_date")
        assert rows_of(got) == want
        if k == 0:
            assert rows_of(early) == want
    day = sorted(os.listdir(f"{root}/raw_music_events"))[5]
    assert len([f for f in os.listdir(f"{root}/raw_music_events/{day}") if f.startswith("batch_id")]) <= 3
    date = day.split("=")[1]
    plan = got.where(F.col("event_date") == date)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") == 2
    # a bin without its marker is not read
    compaction.compact(spark, root, "raw_music_events", target_bytes=1, tail=0)
    stream._commit(spark, root, 5)
    assert rows_of(compaction.read_compacted(spark, root, "raw_music_events").select("event_id", "event_date")) == rows_of(raw.select("event_id", "event_date"))
