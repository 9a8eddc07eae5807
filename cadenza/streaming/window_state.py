"""Window metrics of streams as mergeable state.

A micro-batch is reduced to one partial row per window and key (counts, sums,
extremes, sets or sketches of distinct values). The state of a period (an hour, or
a day where a window's state is a few numbers) is one small folder per version,
``state/<metric>/event_date=/event_hour=/batch_id=``: a batch reads the latest older
version of the periods it touches, merges its partial rows into them and writes
them as its own version; then the finished rows of those periods replace what the
metric's table held. So a batch's work follows from its own rows and from the
windows of its periods, never from the events stored so far; windows
still open are in the table too; and a batch that is replayed after a failure
starts from the same older version, so it counts nothing twice.

With a lateness, an event whose window ended before the watermark (the latest
event time of earlier batches less the lateness) changes no window: it goes to
the late table, one row per event, and is counted in the batch's progress row.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.common import round6
from cadenza.operators.metrics import KEYED_WINDOW, METRICS_WINDOW
from cadenza.schemas import EVENT_TYPES_A, PLATFORMS_A
from cadenza.sources import sinks

HOUR = ["event_date", "event_hour"]
DAY = ["event_date"]
# 2^12 registers: exact in practice for a few hundred values, 1.6 % error beyond.
SKETCH_LG_K = 12


@dataclass(frozen=True)
class Part:
    """A mergeable column: how rows make it, and how two of it become one."""
    make: Callable[[], Column]
    merge: Callable[[str], Column]


def _sum(make: Callable[[], Column]) -> Part:
    return Part(make, F.sum)


def _distinct(col: str, mode: str) -> tuple[Part, Callable[[str], Column]]:
    """The part that counts distinct ``col`` and how it is read: exactly as a set, or as a HyperLogLog sketch of fixed size."""
    if mode == "exact":
        return Part(lambda: F.collect_set(col), lambda c: F.array_distinct(F.flatten(F.collect_list(c)))), F.size
    if mode == "sketch":
        return (Part(lambda: F.hll_sketch_agg(col, SKETCH_LG_K), F.hll_union_agg),
                lambda c: F.hll_sketch_estimate(c).cast("int"))
    raise ValueError(f"unknown distinct mode {mode!r}")


@dataclass(frozen=True)
class Metric:
    """A windowed metric: its table, window, event time, keys, parts and finished columns."""
    name: str
    duration: str
    time_col: str
    parts: dict[str, Part]
    finish: Callable[[], list[Column]]
    keys: dict[str, Column] = field(default_factory=dict)
    period: list[str] = field(default_factory=lambda: HOUR)


def event_metrics(distinct: str = "exact") -> Metric:
    """A1 + A2: the columns of ``metrics.window_metrics``."""
    users, read_users = _distinct("user_id", distinct)
    tracks, read_tracks = _distinct("track_id", distinct)

    def counts(prefix: str, col: str, values: list[str]) -> dict[str, Part]:
        return {f"{prefix}_{i}": _sum(lambda v=v: F.count_if(F.col(col) == v)) for i, v in enumerate(values)}

    def distribution(prefix: str, values: list[str]) -> Column:
        pairs = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.col(f"{prefix}_{i}"))])
        return F.to_json(F.map_filter(pairs, lambda _, n: n > 0))

    parts = {
        "total_events": _sum(lambda: F.count(F.lit(1))), "users": users, "tracks": tracks,
        "score_sum": _sum(lambda: F.sum("engagement_score")), "scores": _sum(lambda: F.count("engagement_score")),
        "first_event_ts": Part(lambda: F.min("timestamp"), F.min), "last_event_ts": Part(lambda: F.max("timestamp"), F.max),
        **counts("platform", "platform", PLATFORMS_A), **counts("type", "event_type", EVENT_TYPES_A),
    }
    return Metric("music_event_metrics", METRICS_WINDOW, "timestamp", parts, lambda: [
        F.col("total_events"), read_users("users").alias("unique_users"), read_tracks("tracks").alias("unique_tracks"),
        distribution("platform", PLATFORMS_A).alias("platform_distribution"),
        distribution("type", EVENT_TYPES_A).alias("event_type_distribution"),
        F.coalesce(round6(F.col("score_sum") / F.nullif(F.col("scores"), F.lit(0))), F.lit(0.0)).alias("average_engagement_score"),
        F.col("first_event_ts"), F.col("last_event_ts")])


def keyed_metrics(kind: str) -> Metric:
    """A3, A4 or A5: count and one mean per five minutes and event type, genre or platform."""
    key, value, mean = {"engagement": ("event_type", F.col("engagement_score"), "avg_engagement"),
                        "genre": ("genre", F.col("genre_popularity"), "avg_popularity"),
                        "platform": ("platform", F.col("is_premium_platform").cast("double"), "premium_ratio")}[kind]
    return Metric(f"{kind}_metrics", KEYED_WINDOW, "event_ts",
                  {"count": _sum(lambda: F.count(F.lit(1))), "value_sum": _sum(lambda: F.sum(value)), "values": _sum(lambda: F.count(value))},
                  lambda: [F.col("count"), round6(F.col("value_sum") / F.nullif(F.col("values"), F.lit(0))).alias(mean)],
                  {key: F.coalesce(F.col(key), F.lit("unknown"))}, DAY)


def _window(rows: DataFrame, metric: Metric) -> DataFrame:
    return rows.groupBy(F.window(metric.time_col, metric.duration).alias("w"), *[c.alias(k) for k, c in metric.keys.items()])


def partials(rows: DataFrame, metric: Metric) -> DataFrame:
    """One mergeable row per window and key of ``rows``, with the period it belongs to."""
    made = _window(rows, metric).agg(*[p.make().alias(n) for n, p in metric.parts.items()])
    of = {"event_date": F.to_date("w.start"), "event_hour": F.hour("w.start")}
    return made.select(*[of[c].alias(c) for c in metric.period], F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *metric.keys, *metric.parts)


def merge(parts: DataFrame, metric: Metric) -> DataFrame:
    """Partial rows of the same window and key as one."""
    return parts.groupBy(*metric.period, "window_start", "window_end", *metric.keys).agg(
        *[p.merge(n).alias(n) for n, p in metric.parts.items()])


def finish(state: DataFrame, metric: Metric) -> DataFrame:
    """State rows as rows of the metric's table."""
    return state.select("window_start", "window_end", *metric.keys, *metric.finish(), *metric.period)


# --- versions of a period's state ----------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, state: str, periods: list[str]) -> dict[str, list[int]]:
    """For each of ``periods`` the batch ids that have a version of it, in order; one listing of their days."""
    jvm = spark._jvm
    days = sorted({p.split("/")[0].removeprefix("event_date=") for p in periods})
    inner = "*/" * periods[0].count("/")
    fs, _ = _folder(spark, state)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{state}/event_date={{{','.join(days)}}}/{inner}batch_id=*"))
    # one text instead of a call per folder
    listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)) if found else ""
    out: dict[str, list[int]] = {p: [] for p in periods}
    for period, version in re.findall(r"(event_date=[^,{}]+)/batch_id=(\d+)", listed):
        if period in out:
            out[period].append(int(version))
    return {p: sorted(v) for p, v in out.items()}


def _periods(parts: DataFrame, metric: Metric) -> list[str]:
    """Folder names of the periods that ``parts`` reach: one per hour or day of event time in a batch."""
    return ["/".join(f"{c}={r[c]}" for c in metric.period) for r in parts.select(*metric.period).distinct().collect()]


def update(rows: DataFrame, metric: Metric, root: str, batch_id: int) -> None:
    """Merge the windows of a micro-batch into the state of their periods and publish those periods."""
    spark = rows.sparkSession
    parts = partials(rows, metric).persist()
    try:
        periods = _periods(parts, metric)
        if not periods:
            return
        state = f"{root}/state/{metric.name}"
        older = {p: [v for v in versions if v < batch_id] for p, versions in _versions(spark, state, periods).items()}
        reader = spark.read.schema(parts.schema).option("basePath", state)
        merged = parts
        if paths := [f"{state}/{p}/batch_id={v[-1]}" for p, v in older.items() if v]:
            merged = parts.unionByName(reader.parquet(*paths).select(*parts.columns))
        _replace(merge(merged, metric).withColumn("batch_id", F.lit(batch_id)), state, metric.period, ["batch_id"])
        own = reader.parquet(*[f"{state}/{p}/batch_id={batch_id}" for p in periods])
        _replace(finish(own, metric), f"{root}/{metric.name}", metric.period, [])
        fs, _ = _folder(spark, state)
        for p, versions in older.items():  # a replay of this batch needs the latest older one only
            for v in versions[:-1]:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{p}/batch_id={v}"), True)
    finally:
        parts.unpersist()


def _replace(df: DataFrame, path: str, period: list[str], within: list[str]) -> None:
    """Write the periods of ``df`` in place of theirs, one file each."""
    (df.repartition(*period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*period, *within).parquet(path))


# --- lateness ----------------------------------------------------------------------------

def _progress(spark: SparkSession, root: str, batch_id: int) -> dt.datetime | None:
    """The latest event time of all batches before ``batch_id``."""
    for b in range(batch_id - 1, -1, -1):
        path = f"{root}/progress/batch_id={b}"
        fs, p = _folder(spark, path)
        if fs.exists(p):
            return spark.read.parquet(path).first().max_event_ts
    return None


def split_late(rows: DataFrame, time_col: str, duration: str, lateness: str | None, root: str, batch_id: int) -> DataFrame:
    """The rows that are in time. The others, late or without an event time, are written to
    ``late_events`` (event_id, event time, window start, watermark), and the batch's progress
    row counts both.

    Without a lateness no row is late.
    """
    spark = rows.sparkSession
    latest = _progress(spark, root, batch_id)
    watermark = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {lateness}") if latest is not None and lateness else F.lit(None).cast("timestamp")
    start = _window_start(time_col, duration)
    out = F.col(time_col).isNull() | F.coalesce(start + F.expr(f"INTERVAL {duration}") <= watermark, F.lit(False))
    marked = rows.select("*", start.alias("_window_start"), out.alias("_late"), watermark.alias("_watermark"))
    seen = marked.agg(F.max(time_col), F.max("_watermark"), F.count_if(~F.col("_late")), F.count_if("_late")).first()
    sinks.write_batch(marked.where("_late").select("event_id", F.col(time_col).alias("event_ts"), F.col("_window_start").alias("window_start"),
                                                   F.col("_watermark").alias("watermark")), root, "late_events", batch_id)
    known = max((t for t in (latest, seen[0]) if t is not None), default=None)
    spark.createDataFrame([(known, *seen[1:])], "max_event_ts timestamp, watermark timestamp, on_time long, late long").coalesce(1).write.mode(
        "overwrite").parquet(f"{root}/progress/batch_id={batch_id}")
    return marked.where("NOT _late").select(*rows.columns)


def _window_start(time_col: str, duration: str) -> Column:
    """The start of the window of a time; unlike ``F.window`` it keeps rows that have none."""
    n, unit = duration.split()
    size = int(n) * {"second": 1, "minute": 60, "hour": 3600}[unit.removesuffix("s")]
    return F.timestamp_seconds(F.floor(F.unix_timestamp(time_col) / size) * size)


def closed_windows(spark: SparkSession, root: str, metric: str, lateness: str, closing: bool = False) -> DataFrame:
    """The windows of a metric's table that no event in time can change any more; with
    ``closing`` (no further input is to come) the last ones as well."""
    table = spark.read.parquet(f"{root}/{metric}").drop(*HOUR)
    if closing:
        return table
    latest = spark.read.parquet(f"{root}/progress").agg(F.max("max_event_ts").alias("latest"))
    return table.join(F.broadcast(latest), F.col("window_end") <= F.col("latest") - F.expr(f"INTERVAL {lateness}")).drop("latest")
