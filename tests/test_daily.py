"""The three daily tables of one scan equal those that are computed one by one."""

from pyspark.sql import functions as F

from cadenza.operators import daily, reports
from cadenza.plans.queries import raw_a

SINGLE = {"user": reports.user_daily_analytics, "track": reports.track_daily_analytics, "platform": reports.platform_daily_analytics}


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_null_keys_values_and_sessions(spark):
    raw = raw_a(spark, "/root/testdata/sf0.001")
    every = lambda n, c: F.when(F.xxhash64("event_id") % n == 0, F.lit(None)).otherwise(F.col(c))
    raw = raw.withColumns({c: every(n, c) for n, c in ((3, "user_id"), (4, "artist_id"), (5, "platform"), (6, "session_id"), (7, "track_genres"),
                                                       (8, "user_location"), (9, "engagement_score"), (10, "device_type"))})
    got = daily.daily_tables(raw)
    for level, single in SINGLE.items():
        want = single(raw)
        assert got[level].columns == want.columns
        # The single tables join their parts on the keys, which loses some of what null keys have.
        keys = [c for c in ("user_id", "track_id", "artist_id", "platform") if c in want.columns[:2]]
        known = " AND ".join(f"{k} IS NOT NULL" for k in keys) or "true"
        assert rows(got[level].where(known)) == rows(want.where(known))
        assert got[level].count() == want.count()


def test_null_user_is_a_group(spark):
    raw = raw_a(spark, "/root/testdata/sf0.001").withColumn("user_id", F.lit(None).cast("string"))
    got = daily.daily_tables(raw)["user"]
    assert got.agg(F.sum("total_events")).first()[0] == raw.count()
    assert got.where("unique_tracks = 0 OR favorite_platform IS NULL").count() == 0


def test_no_rows(spark):
    got = daily.daily_tables(raw_a(spark, "/root/testdata/sf0.001").limit(0))
    assert [df.count() for df in got.values()] == [0, 0, 0]


def test_the_raw_rows_are_scanned_once(spark):
    plan = daily.daily_levels(raw_a(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
