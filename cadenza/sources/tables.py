"""Scans of the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows of one task of a spread scan: what follows makes up to some twenty entries
# of one row, so this bounds a task's memory whatever the size of the table.
TASK_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_key: str | None = None) -> DataFrame:
    """A table as it is now; nothing is kept between calls.

    If the files give fewer read splits than the cluster's default parallelism (a
    small table, or one large file with a single row group), or than one for every
    ``TASK_ROWS`` rows (narrow rows: a split holds millions), rows are hash-spread on
    ``spread_key`` so that the row-level work that follows uses every core and a
    task's share does not grow with the table. Filters and column pruning still
    reach the scan through the repartition.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread_key is not None:
        try:
            # the count reads the files' footers only
            want = max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
            splits = df.rdd.getNumPartitions()
        except Exception:  # no RDD view (e.g. a remote session): leave the scan as it is
            want, splits = 0, 0
        if splits < want:
            df = df.repartition(want, spread_key)
    return df
