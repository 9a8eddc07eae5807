"""The warehouse views as Spark SQL (L4): temp views over a raw table.

``register_views`` exposes a raw (flat, derived) DataFrame as
``raw_music_events`` and defines the three views over it in SQL, so users who
query with ``spark.sql`` get the same plans Catalyst builds for the
DataFrame functions in ``cadenza.operators.reports``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cadenza.operators.reports import DEFAULT_AS_OF


def _date_expr(raw: DataFrame) -> str:
    return "event_date" if "event_date" in raw.columns else "to_date(`timestamp`)"


def view_sql(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> dict[str, str]:
    d = _date_expr(raw)
    day = f"DATE'{as_of.isoformat()}'"
    r6 = "CAST(ROUND(CAST({} AS DECIMAL(38,12)), 6) AS DOUBLE)".format
    return {
        "daily_events_summary": f"""
            SELECT {d} AS event_date, COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users,
              COUNT(DISTINCT track_id) AS unique_tracks, COUNT(DISTINCT artist_id) AS unique_artists,
              {r6('AVG(engagement_score)')} AS avg_engagement,
              CAST(SUM(CASE WHEN event_type = 'play' THEN 1 ELSE 0 END) AS BIGINT) AS total_plays,
              CAST(SUM(CASE WHEN event_type = 'skip' THEN 1 ELSE 0 END) AS BIGINT) AS total_skips,
              CAST(SUM(CASE WHEN event_type = 'like' THEN 1 ELSE 0 END) AS BIGINT) AS total_likes
            FROM raw_music_events WHERE {d} >= date_sub({day}, 30)
            GROUP BY {d} ORDER BY event_date DESC""",
        "top_tracks_weekly": f"""
            SELECT track_id, track_name, artist_name, COUNT(*) AS play_count,
              COUNT(DISTINCT user_id) AS unique_listeners, {r6('AVG(engagement_score)')} AS avg_engagement,
              {r6('AVG(play_completion_ratio)')} AS avg_completion
            FROM raw_music_events WHERE {d} >= date_sub({day}, 7) AND event_type = 'play'
            GROUP BY track_id, track_name, artist_name HAVING COUNT(*) >= 10
            ORDER BY play_count DESC, avg_engagement DESC, track_id LIMIT 100""",
        "platform_performance": f"""
            SELECT platform, COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users,
              {r6('AVG(engagement_score)')} AS avg_engagement,
              {r6('SUM(played_duration_ms) / 1000 / 3600')} AS total_hours_streamed,
              {r6('COUNT(CASE WHEN is_full_play THEN 1 END) / COUNT(*)')} AS completion_rate
            FROM raw_music_events WHERE {d} >= date_sub({day}, 7)
            GROUP BY platform ORDER BY total_events DESC""",
    }


def register_views(spark: SparkSession, raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> list[str]:
    """Create the temp views; returns their names."""
    raw.createOrReplaceTempView("raw_music_events")
    names = []
    for name, sql in view_sql(raw, as_of).items():
        spark.sql(sql).createOrReplaceTempView(name)
        names.append(name)
    return names
