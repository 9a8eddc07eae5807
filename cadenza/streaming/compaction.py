"""S5/S9 for streamed tables: small batch folders packed into clustered files.

A pipeline writes a folder per date and batch, ``<table>/event_date=/batch_id=``.
``compact`` packs the folders of a date, in the order of their batches, into bins of
about ``target_bytes``: next fit, a bin closes when it is full. The rows of a bin are
written as clustered files under ``<table>__packed/event_date=/hi=`` (``hi`` is
its last batch), and a marker under ``<table>__bins`` makes it count. Bins of a date
follow each other without a gap, so the highest marked ``hi`` of a date says
which batches are read from bins and which from their own folders. Rows are
moved once; what does not fill a bin stays, at most ``tail`` folders a date.

Readers survive the swap: the folders of a bin are removed by the next compaction,
not by the one that packed them, and a bin without its marker is not read. A
compaction that is repeated after a failure writes the same bins again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources import sinks
from cadenza.streaming import pipeline

TARGET_BYTES = 128 << 20
TAIL = 16
# Folder bytes that one task of a compaction sorts: the ranges are cut by a sample that
# the driver holds, whose size follows from the number of tasks, not of files.
TASK_BYTES = 16 << 20


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, root: str, name: str) -> dict[str, list[int]]:
    """date -> numbers, in order, of the folders ``root``/event_date=/``name``=."""
    fs, pattern = _path(spark, f"{root}/event_date=*/{name}=*")
    found = fs.globStatus(pattern)
    jvm = spark._jvm
    listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)) if found else ""
    out: dict[str, list[int]] = {}
    for date, number in re.findall(rf"event_date=([^/,{{}}]+)/{name}=(\d+)", listed):
        out.setdefault(date, []).append(int(number))
    return {d: sorted(n) for d, n in out.items() if d != "__HIVE_DEFAULT_PARTITION__"}  # rows without a date stay where they are


def bins(sizes: list[tuple[int, int]], target_bytes: int, tail: int) -> list[list[int]]:
    """Batches, given with their sizes in order, by bin; those at the end that stay as they are are in none."""
    out, held, size = [], [], 0
    for batch, n in sizes:
        held.append(batch)
        size += n
        if size >= target_bytes:
            out.append(held)
            held, size = [], 0
    if len(held) > tail:
        out.append(held)
    return out


def compact(spark: SparkSession, root: str, table: str, target_bytes: int = TARGET_BYTES, tail: int = TAIL) -> int:
    """Pack the committed batches of ``table`` (see the module's head) in one job; the number of bins written."""
    last = spark.read.parquet(f"{root}/commits").agg(F.max("batch_id")).first()[0]
    packed = {d: his[-1] for d, his in _folders(spark, f"{root}/{table}__bins", "hi").items()}
    plan, size = [], 0  # a row per folder to pack
    for date, batches in _folders(spark, f"{root}/{table}", "batch_id").items():
        done = packed.get(date, -1)
        sizes = []
        for b in batches:
            fs, p = _path(spark, f"{root}/{table}/event_date={date}/batch_id={b}")
            if b <= done:  # packed by an earlier run
                fs.delete(p, True)
            elif b <= last:
                sizes.append((b, fs.getContentSummary(p).getLength()))
        for members in bins(sizes, target_bytes, tail):
            plan += [(date, b, members[-1]) for b in members]
            size += sum(n for b, n in sizes if b in members)
    if not plan:
        return 0
    where = spark.createDataFrame(plan, "event_date string, batch_id int, hi int").withColumn("event_date", F.to_date("event_date"))
    schema = sinks.read_batches(spark, root, table).schema
    rows = spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(
        *[f"{root}/{table}/event_date={d}/batch_id={b}" for d, b, _ in plan])
    keys = ["event_date", "hi", *(c for c in [*sinks.CLUSTER_BY.get(table, []), "event_id"] if c in rows.columns)]
    files = max(1, -(-size // target_bytes))
    tasks = min(files, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
    per_file = max(1, rows.count() * target_bytes // max(1, size))  # rows in target_bytes; the count reads footers only
    (rows.join(F.broadcast(where), ["event_date", "batch_id"]).drop("batch_id")  # one row a folder
     .repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
     .write.option("maxRecordsPerFile", per_file).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "hi").parquet(f"{root}/{table}__packed"))
    found = where.groupBy("event_date", "hi").agg(F.min("batch_id").alias("lo")).persist()
    found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "hi").parquet(f"{root}/{table}__bins")
    return found.count()


def read_compacted(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The committed rows of a table, from bins and from the batches after them; filters on event_date prune both."""
    marked = _folders(spark, f"{root}/{table}__bins", "hi")
    loose = pipeline.read_committed(spark, root, table)
    if not marked:
        return loose.drop("batch_id")
    last = spark.createDataFrame([(d, his[-1]) for d, his in marked.items()], "d string, hi int")  # one row a date
    loose = loose.join(F.broadcast(last), F.col("event_date").cast("string") == F.col("d"), "left").where(
        F.coalesce(F.col("batch_id") > F.col("hi"), F.lit(True))).drop("d", "hi", "batch_id")
    packed_root = f"{root}/{table}__packed"
    schema = loose.drop("event_date").schema
    packed = spark.read.schema(schema.add("event_date", "date").add("hi", "integer")).option("basePath", packed_root).parquet(
        *[f"{packed_root}/event_date={d}/hi={hi}" for d, his in marked.items() for hi in his])
    return packed.select(*loose.columns).unionByName(loose)
