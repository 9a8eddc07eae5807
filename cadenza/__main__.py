"""Command line for cluster runs (``spark-submit --py-files cadenza.zip cadenza/__main__.py ...``
or ``python -m cadenza ...`` locally).

  load     JSON messages of a landing folder -> raw table + dead letters (batch)
  reports  raw table -> daily, weekly and platform views and daily analytics
  compact  streamed table -> small batch folders packed into clustered files
  stream   landing folder -> streaming pipeline (full: shape A, simple: shape B)

Outputs are Parquet folders; the raw table is partitioned by ``event_date``.
The checkpoint folder comes from ``spark.checkpoint.dir`` of the session.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from cadenza.functions.derive_full import raw_music_events
from cadenza.operators import daily, reports, validate
from cadenza.schemas import EVENT_A
from cadenza.session import build_session
from cadenza.sources import messages, sinks
from cadenza.streaming import compaction, pipeline

TREND_DAYS = 7


def cmd_load(spark, args) -> None:
    """A landing loaded again adds no row, and a message that it holds twice is
    stored once: events go by their id (messages without one get one from their
    text) and are looked up among the stored rows of their dates, dead letters go by
    their text."""
    checked = validate.validate(messages.read_landing(spark, args.landing, EVENT_A))
    good, bad = validate.split_valid(checked)
    raw = sinks.with_event_date(raw_music_events(good)).dropDuplicates(["event_id"])
    bad = bad.dropDuplicates(["raw_value"])
    raw = sinks.not_stored(raw, f"{args.out}/raw_music_events", ["event_id", "event_date"])
    sinks.write_table(raw, f"{args.out}/raw_music_events", "raw_music_events")
    sinks.append(sinks.not_stored(bad, f"{args.out}/dead_letters", ["raw_value"]), f"{args.out}/dead_letters")


def cmd_reports(spark, args) -> None:
    """Views as of ``--as-of``; daily tables for all days, or with ``--days N``
    only the last N days (incremental: the read is pruned to those partitions
    plus the trending score's look-back, and only those days are written).
    Written days replace their partitions, so a repeated run adds no row."""
    raw = spark.read.parquet(args.raw)
    as_of = dt.date.fromisoformat(args.as_of)
    daily_in = raw
    if args.days:
        daily_in = reports.since(raw, as_of, args.days + TREND_DAYS)
    outputs = {
        "daily_events_summary": reports.daily_events_summary(raw, as_of),
        "top_tracks_weekly": reports.top_tracks_weekly(raw, as_of),
        "platform_performance": reports.platform_performance(raw, as_of),
        **{f"{level}_analytics": df for level, df in daily.daily_tables(daily_in, TREND_DAYS).items()},
    }
    for name, df in outputs.items():
        if name.endswith("_analytics"):
            df = df.withColumnRenamed("analysis_date", "event_date")
            if args.days:
                df = df.filter(F.col("event_date") >= F.date_sub(F.lit(as_of), args.days))
            sinks.write_table(df, f"{args.out}/{name}", name, time_col="event_date", replace_partitions=True)
        else:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")


def cmd_stream(spark, args) -> None:
    start = pipeline.start_full_pipeline if args.pipeline == "full" else pipeline.start_simple_pipeline
    if args.once:
        pipeline.drain(start, spark, args.landing, args.out, watermark=args.watermark, attempts=getattr(args, "attempts", 1))
        return
    for q in start(spark, args.landing, args.out, watermark=args.watermark, available_now=False, attempts=args.attempts):
        q.awaitTermination()


def cmd_compact(spark, args) -> None:
    compaction.compact(spark, args.root, args.table)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cadenza")
    p.add_argument("--master", default=None, help="only for local runs; leave unset under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("load")
    s.add_argument("--landing", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("reports")
    s.add_argument("--raw", required=True)
    s.add_argument("--as-of", required=True)
    s.add_argument("--days", type=int, default=None, help="recompute only the last N days of the daily tables")
    s.add_argument("--out", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--pipeline", choices=["full", "simple"], default="full")
    s.add_argument("--landing", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--watermark", default=pipeline.DEFAULT_WATERMARK, help="lateness that a window allows")
    s.add_argument("--attempts", type=int, default=pipeline.MAX_ATTEMPTS, help="tries of a message that fails")
    s.add_argument("--once", action="store_true", help="process what is there, then stop")
    s = sub.add_parser("compact")
    s.add_argument("--root", required=True, help="output folder of a stream")
    s.add_argument("--table", default="raw_music_events")
    args = p.parse_args(argv)
    spark = build_session(args.master)
    {"load": cmd_load, "reports": cmd_reports, "stream": cmd_stream, "compact": cmd_compact}[args.cmd](spark, args)


if __name__ == "__main__":
    main()
