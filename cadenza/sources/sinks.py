"""Table sinks.

Tables are Parquet folders partitioned by ``event_date`` and sorted inside
each file by the clustering columns, so a date filter prunes whole folders
and row-group min/max statistics skip blocks inside them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: clustering columns and retention per table --------------------
CLUSTER_BY = {
    "raw_music_events": ["platform", "artist_id", "user_id"],
    "enriched_music_events": ["platform", "enrichment_model"],
    "music_event_metrics": ["window_start"],
    "user_analytics": ["user_id"],
    "track_analytics": ["track_id", "artist_id"],
    "platform_analytics": ["platform"],
}
RETENTION_DAYS = {
    "raw_music_events": 90, "enriched_music_events": 90, "music_event_metrics": 365,
    "user_analytics": 365, "track_analytics": 365, "platform_analytics": 365,
}
# -----------------------------------------------------------------------------------


def with_event_date(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return df if "event_date" in df.columns else df.withColumn("event_date", F.to_date(time_col))


def layout(df: DataFrame, cluster_by: list[str], date_col: str = "event_date") -> DataFrame:
    """Group rows of a date into the same task and sort them by the cluster columns.

    Ranges are cut by sampled size over the date, the clustering columns and
    the event id, so a hot day and platform spread over many tasks and a file
    holds neighbouring rows only.
    """
    keys = [date_col] + cluster_by
    spread = [c for c in ("event_id",) if c in df.columns and c not in keys]
    return df.repartitionByRange(*keys, *spread).sortWithinPartitions(*keys)


def append_partitioned(df: DataFrame, path: str, cluster_by: list[str] | None = None,
                       time_col: str = "timestamp", replace_partitions: bool = False) -> None:
    """Append to a date-partitioned Parquet table (created on first write).

    ``replace_partitions`` overwrites only the dates present in ``df``
    (dynamic partition overwrite), so a recomputed day replaces its old rows
    and every other day is left untouched.
    """
    df = with_event_date(df, time_col)
    if cluster_by:
        df = layout(df, cluster_by)
    writer = df.write.partitionBy("event_date")
    if replace_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)
    _mark_success(df.sparkSession, path)


def _mark_success(spark: SparkSession, path: str) -> None:
    # appends keep Spark's commit marker, so readers can tell a finished table
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.create(p, True).close()


def append(df: DataFrame, path: str) -> None:
    """Append without partitioning (dead letters, topic files)."""
    df.write.mode("append").parquet(path)


def write_batch(df: DataFrame, root: str, table: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    """Write the rows of a micro-batch as a partition per batch id, which a replay overwrites.

    The table's schema is kept beside it, as a batch without rows leaves no file.
    """
    spark = df.sparkSession
    df = df.withColumn("batch_id", F.lit(batch_id))
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/schemas/{table}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{root}/schemas/{table}")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*(partition_by or []), "batch_id").parquet(f"{root}/{table}"))


def read_batches(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of ``write_batch``, with the columns of its batches even if none has rows."""
    return spark.read.schema(spark.read.parquet(f"{root}/schemas/{table}").schema).parquet(f"{root}/{table}")


def not_stored(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``keys`` the table at ``path`` does not hold yet (all, if there is no table).

    A date among the keys is compared as the partition it names; only the key
    columns of the table are read, and only the partitions of the dates that
    ``df`` holds.
    """
    try:
        table = df.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return df
    if "event_date" in keys:  # one value a day of the load
        dates = [r[0] for r in df.select("event_date").distinct().collect()]
        table = table.where(F.col("event_date").isin([d for d in dates if d is not None]) | F.col("event_date").isNull())
    return df.join(table.select(*keys), keys, "left_anti")


def write_table(df: DataFrame, path: str, table: str, time_col: str = "timestamp",
                replace_partitions: bool = False) -> None:
    """Write a named table with its layout (partition by date, sort by cluster columns)."""
    append_partitioned(df, path, CLUSTER_BY.get(table), time_col, replace_partitions)


def apply_retention(spark: SparkSession, path: str, table: str, as_of: dt.date) -> list[str]:
    """Delete partitions older than the table's retention, as of ``as_of``.

    Works on partition folders only (a metadata listing, one entry per day);
    retained data is never read or rewritten. Returns the deleted folders.
    """
    cutoff = as_of - dt.timedelta(days=RETENTION_DAYS[table])
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("event_date="):
            try:
                day = dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:  # rows without a date stay
                continue
            if day < cutoff:
                fs.delete(st.getPath(), True)
                dropped.append(name)
    return dropped


def retained(df: DataFrame, table: str, as_of: dt.date) -> DataFrame:
    """S10 as a filter: rows of partitions still inside the retention window."""
    days = RETENTION_DAYS[table]
    return df.filter(F.col("event_date") >= F.date_sub(F.lit(as_of), days))
