"""Stored tables."""

import time

from pyspark.sql import functions as F

from cadenza.llm import common


def test_shuffles_of_stored_tables_are_removed(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(files.apply(i).getName()) for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    before = shuffled()
    out = common.stored(spark.range(5000).groupBy((F.col("id") % 50).alias("x")).count(), "test")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert out.count() == 50 and spark.conf.get(common.CLEANUP) == "false"
