"""A hot key holding a third of all rows: results stay exact and the plans
combine map-side before any shuffle."""

import glob
import os
import sys
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import rows_of  # noqa: E402

SF = "/root/testdata/sf0.01"
HOT = ["user_daily_analytics", "platform_daily_analytics", "track_daily_analytics", "platform_performance",
       "top_tracks_weekly", "event_window_metrics", "daily_tables"]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    d = tempfile.mkdtemp(prefix="cadenza-skew-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # every third event belongs to user 7, and a third of all events play track k=9
    hot = (ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
             .withColumn("props", F.when(F.col("event_id") % 3 == 1, F.lit('{"k": 9}')).otherwise(F.col("props"))))
    hot.repartition(4).write.parquet(f"{d}/events.parquet")
    return d


@pytest.mark.parametrize("name", HOT)
def test_hot_keys_exact(spark, skewed_dir, name):
    df = E.queries()[name](spark, skewed_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    files = glob.glob(f"{skewed_dir}/events.parquet/*.parquet")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet({files!r})")
    cur = con.execute(E.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_partial_aggregation_before_every_shuffle(spark, skewed_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in HOT:
            plan = E.queries()[name](spark, skewed_dir)._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            for i, line in enumerate(lines):
                if "Exchange hashpartitioning" in line and i + 1 < len(lines):
                    below = lines[i + 1]
                    # a hash shuffle feeding an aggregate is always fed by a partial aggregate
                    if "HashAggregate" in below or "ObjectHashAggregate" in below:
                        assert "partial_" in below or "merge_" in below, (name, below)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
