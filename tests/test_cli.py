"""The command line runs load -> reports and a one-shot stream."""

import os
import tempfile

from cadenza.__main__ import cmd_load, cmd_reports, cmd_stream
from cadenza.sources import messages
from cadenza.sources.adapter import read_events


class Args:
    def __init__(self, **kw):
        self.__dict__.update(kw)


def test_load_then_reports_then_stream(spark):
    root = tempfile.mkdtemp(prefix="cadenza-cli-")
    landing = messages.land_text(messages.damaged_messages(read_events(spark, "/root/testdata/sf0.001")),
                                 f"{root}/landing")
    cmd_load(spark, Args(landing=landing, out=f"{root}/wh"))
    raw = spark.read.parquet(f"{root}/wh/raw_music_events")
    bad = spark.read.parquet(f"{root}/wh/dead_letters")
    assert raw.count() + bad.count() == 1000 and bad.count() > 0
    # the same landing again adds no row
    cmd_load(spark, Args(landing=landing, out=f"{root}/wh"))
    assert spark.read.parquet(f"{root}/wh/raw_music_events").count() == raw.count()
    assert spark.read.parquet(f"{root}/wh/dead_letters").count() == bad.count()
    raw = spark.read.parquet(f"{root}/wh/raw_music_events")
    cmd_reports(spark, Args(raw=f"{root}/wh/raw_music_events", as_of="2024-01-31", days=None, out=f"{root}/rep"))
    for name in ("daily_events_summary", "top_tracks_weekly", "platform_performance", "user_analytics",
                 "track_analytics", "platform_analytics"):
        assert os.path.isdir(f"{root}/rep/{name}")
    assert spark.read.parquet(f"{root}/rep/user_analytics").count() > 0
    full = sorted(map(repr, map(tuple, spark.read.parquet(f"{root}/rep/user_analytics").collect())))
    # a full rerun replaces every day
    cmd_reports(spark, Args(raw=f"{root}/wh/raw_music_events", as_of="2024-01-31", days=None, out=f"{root}/rep"))
    assert sorted(map(repr, map(tuple, spark.read.parquet(f"{root}/rep/user_analytics").collect()))) == full
    # incremental rerun: only the last 3 days are recomputed and replaced, the rest stays
    cmd_reports(spark, Args(raw=f"{root}/wh/raw_music_events", as_of="2024-01-31", days=3, out=f"{root}/rep"))
    again = sorted(map(repr, map(tuple, spark.read.parquet(f"{root}/rep/user_analytics").collect())))
    assert again == full
    cmd_stream(spark, Args(pipeline="full", landing=landing, out=f"{root}/st", watermark="0 seconds", once=True))
    assert spark.read.parquet(f"{root}/st/raw_music_events").count() == raw.count()
