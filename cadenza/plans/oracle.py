"""DuckDB oracle SQL for the registered queries.

``RAW_A`` / ``EVENTS_B`` repeat the adapter mapping of
``cadenza.sources.adapter`` as CTEs over the pre-registered ``events`` view;
every oracle query is an independent SQL statement over them.
"""

from __future__ import annotations

from cadenza.functions import derive_simple as S
from cadenza.functions.derive_full import AD_SUPPORTED_PLATFORMS, PREMIUM_PLATFORMS
from cadenza.schemas import EVENT_TYPES_A, GENRES_A, PLATFORMS_A, PLATFORMS_B
from cadenza.sources import adapter as A

AS_OF = "DATE '2024-01-31'"


def lst(values) -> str:
    """A DuckDB list literal."""
    out = []
    for v in values:
        if isinstance(v, str):
            out.append("'" + v.replace("'", "''") + "'")
        else:
            out.append(str(v))
    return "[" + ", ".join(out) + "]"


def pick(values, idx: str) -> str:
    return f"({lst(values)})[({idx}) + 1]"


def inlist(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


# keyed rows of the events table: k, artist slot a, timestamp t (UTC)
KEYED = f"""
keyed AS (
  SELECT event_id AS e, user_id AS u, CAST(ts AS TIMESTAMP) AS t, event_type AS src_type,
         value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % {A.N_ARTIST_SLOTS} AS a
  FROM events
)"""

TITLE = f"CASE WHEN k < 15 THEN {pick(A.CATALOG_TITLES, 'k')} ELSE 'Track ' || CAST(k AS VARCHAR) END"
ARTIST = f"CASE WHEN a < 15 THEN {pick(A.CATALOG_ARTISTS, 'a')} ELSE 'Artist ' || CAST(a AS VARCHAR) END"
ALBUM = f"CASE WHEN a < 15 THEN {pick(A.CATALOG_ALBUMS, 'a')} ELSE 'Album ' || CAST(a AS VARCHAR) END"
YEAR = f"CASE WHEN a < 15 THEN {pick(A.CATALOG_YEARS, 'a')} ELSE 2000 + a END"
USER = "'user-' || lpad(CAST(u AS VARCHAR), 6, '0')"
SESSION = f"{USER} || '-' || strftime(t, '%Y-%m-%d')"

TYPE_A = f"""CASE WHEN src_type IN ('view', 'click') THEN 'play' WHEN src_type = 'error' THEN 'skip'
    WHEN src_type = 'purchase' THEN {pick(['like', 'share', 'playlist_add'], 'e % 3')}
    WHEN src_type = 'signup' THEN 'download' END"""
TYPE_B = """CASE WHEN src_type IN ('view', 'click') THEN 'play' WHEN src_type = 'error' THEN 'skip'
    WHEN src_type = 'signup' THEN 'pause'
    WHEN src_type = 'purchase' THEN CASE WHEN e % 2 = 0 THEN 'like' ELSE 'share' END END"""

# flat shape A rows: the 37 base columns
FLAT_A = f"""
flat_a0 AS (SELECT *, {TYPE_A} AS etype FROM keyed),
flat_a AS (
  SELECT 'evt-' || CAST(e AS VARCHAR) AS event_id, etype AS event_type,
    t AS "timestamp", t AS processing_timestamp,
    'track-' || CAST(k AS VARCHAR) AS track_id, {TITLE} AS track_name,
    CAST(CASE WHEN k = 0 THEN NULL WHEN k = 50 THEN 0 ELSE 60000 + k * 4000 END AS BIGINT) AS track_duration_ms,
    k % 4 = 0 AS track_explicit,
    CAST(CASE WHEN k % 10 <> 3 THEN k END AS BIGINT) AS track_popularity,
    CASE WHEN k % 13 <> 0 THEN CAST(k % 11 AS DOUBLE) / 10.0 END AS track_energy,
    CASE WHEN k % 17 <> 0 THEN CAST(k % 5 AS DOUBLE) / 4.0 END AS track_valence,
    CASE WHEN k % 19 = 0 THEN 0.0 ELSE CAST(60 + k AS DOUBLE) END AS track_tempo,
    CASE WHEN k % 16 = 15 THEN CAST([] AS VARCHAR[]) ELSE [{pick(GENRES_A, 'k % 16')}] END AS track_genres,
    'artist-' || CAST(a AS VARCHAR) AS artist_id, {ARTIST} AS artist_name,
    CAST(a * 1000 AS BIGINT) AS artist_followers, a < 10 AS artist_verified,
    {pick(A.COUNTRIES, 'a % 5')} AS artist_country,
    [{pick(GENRES_A, 'a % 16')}] AS artist_genres,
    CASE WHEN k % 5 <> 4 THEN 'album-' || CAST(a AS VARCHAR) END AS album_id,
    CASE WHEN k % 5 <> 4 THEN {ALBUM} END AS album_name,
    CASE WHEN k % 5 <> 4 THEN make_timestamp({YEAR}, 1, 1, 0, 0, 0) END AS album_release_date,
    {USER} AS user_id, {SESSION} AS session_id,
    {pick(A.DEVICES, 'e % 3')} AS device_type,
    {pick(A.COUNTRIES, 'u % 5')} AS user_location,
    CASE WHEN u % 2 = 0 THEN 'premium' ELSE 'free' END AS subscription_type,
    {pick(A.AGE_GROUPS, 'u % 4')} AS user_age_group,
    {pick(PLATFORMS_A, 'u % 7')} AS platform,
    {pick(A.QUALITIES, 'e % 3')} AS stream_quality,
    CAST(64 * (1 + e % 5) AS BIGINT) AS bandwidth_kbps,
    CAST(e % 4 AS BIGINT) AS buffer_events,
    CASE WHEN etype = 'play' THEN CAST(floor(value * 2000) AS BIGINT) END AS played_duration_ms,
    CASE WHEN etype = 'play' AND e % 5 = 0 THEN 'user_skip' END AS skip_reason,
    CASE WHEN etype = 'play' AND e % 4 = 0 THEN 'playlist-' || CAST(u % 10 AS VARCHAR) END AS playlist_id,
    CASE WHEN etype = 'play' THEN e % 2 = 0 END AS shuffle_mode,
    CASE WHEN etype = 'play' THEN CASE WHEN e % 10 < 7 THEN 'off' WHEN e % 10 < 9 THEN 'track' ELSE 'context' END END AS repeat_mode
  FROM flat_a0
)"""

# raw table: flat rows plus the 13 derived columns
RAW_A = KEYED + "," + FLAT_A + f""",
raw_a0 AS (
  SELECT *,
    CASE WHEN track_duration_ms <> 0 THEN CAST(played_duration_ms AS DOUBLE) / track_duration_ms END AS ratio,
    CASE WHEN track_duration_ms <> 0 THEN CAST(track_duration_ms AS DOUBLE) / 1000.0 END AS secs
  FROM flat_a
),
raw_a AS (
  SELECT * EXCLUDE (ratio, secs),
    CAST(hour("timestamp") AS BIGINT) AS hour_of_day,
    CAST(isodow("timestamp") - 1 AS BIGINT) AS day_of_week,
    isodow("timestamp") - 1 >= 5 AS is_weekend,
    CAST(month("timestamp") AS BIGINT) AS month,
    CAST(year("timestamp") AS BIGINT) AS year,
    secs AS track_duration_seconds, secs > 300 AS is_long_track, secs < 120 AS is_short_track,
    CASE WHEN ratio IS NOT NULL THEN least(ratio, 1.0) END AS play_completion_ratio,
    ratio >= 0.8 AS is_full_play, ratio < 0.3 AS is_skip,
    greatest(0.0, least(1.0,
      0.5 + coalesce(ratio * 0.3, 0.0)
      + CASE WHEN event_type IN ('like', 'share', 'playlist_add') THEN 0.4 ELSE 0.0 END
      + CASE WHEN played_duration_ms IS NOT NULL AND repeat_mode <> 'off' THEN 0.1 ELSE 0.0 END
      - CASE WHEN event_type = 'skip' THEN 0.2 ELSE 0.0 END)) AS engagement_score,
    CASE WHEN platform IN {inlist(PREMIUM_PLATFORMS)} THEN 'premium'
         WHEN platform IN {inlist(AD_SUPPORTED_PLATFORMS)} THEN 'ad_supported' ELSE 'other' END AS platform_category
  FROM raw_a0
)"""


def with_raw(body: str) -> str:
    return "WITH " + RAW_A + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["platform_performance"] = with_raw(f"""
SELECT platform, COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users,
  CAST(ROUND(CAST(AVG(engagement_score) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_engagement,
  CAST(ROUND(CAST(SUM(played_duration_ms) / 1000 / 3600 AS DECIMAL(38,12)), 6) AS DOUBLE) AS total_hours_streamed,
  CAST(ROUND(CAST(COUNT(CASE WHEN is_full_play THEN 1 END) / COUNT(*) AS DECIMAL(38,12)), 6) AS DOUBLE) AS completion_rate
FROM raw_a WHERE CAST("timestamp" AS DATE) >= {AS_OF} - INTERVAL 7 DAY
GROUP BY platform ORDER BY total_events DESC""")


def dist_json(col: str, values) -> str:
    """A2 in SQL: JSON object of non-zero counts in the order of ``values``."""
    parts = ", ".join(
        f"CASE WHEN count_if({col} = '{v}') > 0 THEN '\"{v}\":' || CAST(count_if({col} = '{v}') AS VARCHAR) END"
        for v in values)
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


ORACLE["raw_music_events"] = with_raw("SELECT * FROM raw_a")

ORACLE["daily_events_summary"] = with_raw(f"""
SELECT CAST("timestamp" AS DATE) AS event_date, COUNT(*) AS total_events,
  COUNT(DISTINCT user_id) AS unique_users, COUNT(DISTINCT track_id) AS unique_tracks,
  COUNT(DISTINCT artist_id) AS unique_artists, CAST(ROUND(CAST(AVG(engagement_score) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_engagement,
  CAST(SUM(CASE WHEN event_type = 'play' THEN 1 ELSE 0 END) AS BIGINT) AS total_plays,
  CAST(SUM(CASE WHEN event_type = 'skip' THEN 1 ELSE 0 END) AS BIGINT) AS total_skips,
  CAST(SUM(CASE WHEN event_type = 'like' THEN 1 ELSE 0 END) AS BIGINT) AS total_likes
FROM raw_a WHERE CAST("timestamp" AS DATE) >= {AS_OF} - INTERVAL 30 DAY
GROUP BY CAST("timestamp" AS DATE) ORDER BY event_date DESC""")

ORACLE["top_tracks_weekly"] = with_raw(f"""
SELECT track_id, track_name, artist_name, COUNT(*) AS play_count,
  COUNT(DISTINCT user_id) AS unique_listeners, CAST(ROUND(CAST(AVG(engagement_score) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_engagement,
  CAST(ROUND(CAST(AVG(play_completion_ratio) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_completion
FROM raw_a WHERE CAST("timestamp" AS DATE) >= {AS_OF} - INTERVAL 7 DAY AND event_type = 'play'
GROUP BY track_id, track_name, artist_name
HAVING COUNT(*) >= 10
ORDER BY play_count DESC, avg_engagement DESC, track_id LIMIT 100""")

ORACLE["event_window_metrics"] = with_raw(f"""
SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS window_start,
  time_bucket(INTERVAL 1 MINUTE, "timestamp") + INTERVAL 1 MINUTE AS window_end,
  COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users,
  COUNT(DISTINCT track_id) AS unique_tracks,
  {dist_json('platform', PLATFORMS_A)} AS platform_distribution,
  {dist_json('event_type', EVENT_TYPES_A)} AS event_type_distribution,
  COALESCE(CAST(ROUND(CAST(AVG(engagement_score) AS DECIMAL(38,12)), 6) AS DOUBLE), 0.0) AS average_engagement_score,
  MIN("timestamp") AS first_event_ts, MAX("timestamp") AS last_event_ts
FROM raw_a GROUP BY time_bucket(INTERVAL 1 MINUTE, "timestamp")""")

# --- shape B -----------------------------------------------------------------
LOOSE_B = f"""
loose_b AS (
  SELECT 'evt-' || CAST(e AS VARCHAR) AS event_id, {TYPE_B} AS event_type,
    {TITLE} AS track_title, {ARTIST} AS artist_name,
    {pick(A.GENRE_POOL_B, 'k % 10')} AS genre,
    {pick(PLATFORMS_B, 'u % 4')} AS platform,
    {pick(A.CITIES, 'u % 5')} AS user_location,
    strftime(t, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp"
  FROM keyed
)"""


def _case_map(expr: str, table: dict, default) -> str:
    def lit(v):
        return f"CAST({v} AS DOUBLE)" if isinstance(v, float) else "'" + v + "'"
    arms = " ".join(f"WHEN {expr} = '{k}' THEN {lit(v)}" for k, v in table.items())
    return f"CASE {arms} ELSE {lit(default)} END"


def _bands(value: bool) -> str:
    arms = " ".join(f"WHEN hr BETWEEN {lo} AND {hi} THEN " + (f"CAST({m} AS DOUBLE)" if value else f"'{n}'")
                    for lo, hi, n, m in S.TIME_BANDS)
    null_v = "CAST(1.0 AS DOUBLE)" if value else "'unknown'"
    other = "CAST(1.0 AS DOUBLE)" if value else "'other'"
    return f"CASE WHEN hr IS NULL THEN {null_v} {arms} ELSE {other} END"


def _level(expr: str) -> str:
    return f"CASE WHEN {expr} > 1.5 THEN 'high' WHEN {expr} > 0.8 THEN 'medium' ELSE 'low' END"


def processed_b(level_on: str = "adjusted") -> str:
    loc_arms = " ".join(
        "WHEN " + " OR ".join(f"loc LIKE '%{n}%'" for n in needles) + f" THEN base * CAST({m} AS DOUBLE)"
        for needles, m in S.LOCATION_BONUS)
    level_src = "engagement_score * time_multiplier" if level_on == "adjusted" else "engagement_score"
    return KEYED + "," + LOOSE_B + f""",
proc0 AS (
  SELECT *, {_case_map('event_type', S.ENGAGEMENT_BY_TYPE, S.DEFAULT_ENGAGEMENT)} AS base,
    lower(coalesce(user_location, '')) AS loc,
    hour(TRY_CAST("timestamp" AS TIMESTAMP)) AS hr
  FROM loose_b
),
proc1 AS (
  SELECT *, CASE {loc_arms} ELSE base END AS engagement_score,
    {_bands(False)} AS time_context, {_bands(True)} AS time_multiplier,
    {_case_map("lower(coalesce(genre, ''))", S.GENRE_POPULARITY, S.DEFAULT_GENRE_POPULARITY)} AS genre_popularity
  FROM proc0
),
processed AS (
  SELECT event_id, event_type, track_title, artist_name, genre, platform, user_location, "timestamp",
    engagement_score, {_level(level_src)} AS engagement_level,
    genre_popularity, genre_popularity > 0.7 AS is_popular_genre,
    {_case_map("lower(coalesce(platform, ''))", S.PLATFORM_QUALITY, 'unknown')} AS platform_quality,
    lower(coalesce(platform, '')) IN {inlist(S.PREMIUM_PLATFORMS_B)} AS is_premium_platform,
    time_context, time_multiplier, engagement_score * time_multiplier AS adjusted_engagement,
    TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts
  FROM proc1
)"""


def with_processed(body: str, level_on: str = "adjusted") -> str:
    return "WITH " + processed_b(level_on) + "\n" + body


ORACLE["processed_events"] = with_processed("SELECT * EXCLUDE (event_ts) FROM processed")
ORACLE["processed_events_base_level"] = with_processed("SELECT * EXCLUDE (event_ts) FROM processed", "base")


def _keyed_window(key: str, agg: str) -> str:
    b = "time_bucket(INTERVAL 5 MINUTE, event_ts)"
    return with_processed(f"""
SELECT {b} AS window_start, {b} + INTERVAL 5 MINUTE AS window_end,
  coalesce({key}, 'unknown') AS {key}, COUNT(*) AS count, {agg}
FROM processed WHERE event_ts IS NOT NULL
GROUP BY {b}, coalesce({key}, 'unknown')""")


ORACLE["engagement_metrics"] = _keyed_window("event_type", "CAST(ROUND(CAST(AVG(engagement_score) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_engagement")
ORACLE["genre_metrics"] = _keyed_window("genre", "CAST(ROUND(CAST(AVG(genre_popularity) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_popularity")
ORACLE["platform_metrics"] = _keyed_window(
    "platform", "CAST(ROUND(CAST(AVG(CAST(is_premium_platform AS DOUBLE)) AS DECIMAL(38,12)), 6) AS DOUBLE) AS premium_ratio")


# --- validation: the injected faults are the expected error codes ----------------
def _fault_sql(n: str, etype: str) -> str:
    from cadenza.sources.messages import FAULTS
    arms = " ".join(f"WHEN {n} % {mod} = 0" + (f" AND {etype} = 'play'" if play else "") + f" THEN '{name}'"
                    for mod, name, play in FAULTS)
    return f"CASE {arms} END"


FAULTS_CTE = KEYED + f""",
faults AS (SELECT e, {_fault_sql('e', f'({TYPE_A})')} AS fault FROM keyed)"""

ORACLE["validation_summary"] = "WITH " + FAULTS_CTE + """
SELECT COUNT(*) FILTER (WHERE fault IS NULL) AS valid_events,
  COUNT(*) FILTER (WHERE fault IS NOT NULL) AS invalid_events,
  COALESCE(CAST(ROUND(CAST(COUNT(*) FILTER (WHERE fault IS NULL) / COUNT(*) AS DECIMAL(38,12)), 6) AS DOUBLE), 0.0)
    AS success_rate
FROM faults"""

ORACLE["validation_errors"] = "WITH " + FAULTS_CTE + """
SELECT fault AS error_code, COUNT(*) AS events FROM faults WHERE fault IS NOT NULL GROUP BY fault"""

ORACLE["valid_events_raw"] = with_raw(f"""
SELECT * FROM raw_a
WHERE {_fault_sql("CAST(split_part(event_id, '-', 2) AS BIGINT)", 'event_type')} IS NULL""")


# --- daily analytics (A10-A12) ----------------------------------------------------
def R6(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def _mode_cte(name: str, keys: list[str], value_expr: str, src: str = "d", unnest: bool = False) -> str:
    k = ", ".join(keys)
    v = f"unnest({value_expr})" if unnest else value_expr
    return f"""
m_{name} AS (
  SELECT {k}, v AS {name} FROM (
    SELECT {k}, v, row_number() OVER (PARTITION BY {k} ORDER BY n DESC, v ASC) AS rn
    FROM (SELECT {k}, v, COUNT(*) AS n FROM (SELECT {k}, {v} AS v FROM {src}) WHERE v IS NOT NULL GROUP BY {k}, v))
  WHERE rn = 1)"""


def _daily(keys: list[str], main_aggs: str, modes: list[tuple], extra_ctes: str, select: str,
           joins: str = "") -> str:
    k = ", ".join(keys)
    mode_ctes = ",".join(_mode_cte(*m[:1], keys, *m[1:]) for m in modes)
    mode_joins = " ".join(f"LEFT JOIN m_{m[0]} USING ({k})" for m in modes)
    return with_raw(f""",
d AS (SELECT *, CAST("timestamp" AS DATE) AS analysis_date FROM raw_a),
main AS (SELECT {k}, {main_aggs} FROM d GROUP BY {k}),{mode_ctes}{extra_ctes}
SELECT {select} FROM main {mode_joins} {joins}""")


ORACLE["user_daily_analytics"] = _daily(
    ["user_id", "analysis_date"],
    f"""COUNT(*) AS total_events, CAST(COALESCE(SUM(played_duration_ms), 0) AS BIGINT) AS total_play_time_ms,
    COUNT(DISTINCT track_id) AS unique_tracks, COUNT(DISTINCT artist_id) AS unique_artists,
    {R6('AVG(engagement_score)')} AS average_engagement_score,
    COUNT(DISTINCT session_id) AS listening_sessions,
    {R6("count_if(event_type = 'skip') / NULLIF(COUNT(*), 0)")} AS skip_rate,
    {R6("COUNT(CASE WHEN is_full_play THEN 1 END) / NULLIF(count_if(event_type = 'play'), 0)")} AS completion_rate""",
    [("favorite_platform", "platform"), ("preferred_device", "device_type"),
     ("most_active_hour", "hour_of_day"), ("top_genre", "track_genres", "d", True)],
    "",
    """user_id, analysis_date, total_events, total_play_time_ms, unique_tracks, unique_artists, top_genre,
  favorite_platform, average_engagement_score, listening_sessions, preferred_device, most_active_hour,
  skip_rate, completion_rate""")

ORACLE["track_daily_analytics"] = _daily(
    ["track_id", "artist_id", "analysis_date"],
    f"""count_if(event_type = 'play') AS total_plays,
    COUNT(DISTINCT CASE WHEN event_type = 'play' THEN user_id END) AS unique_listeners,
    CAST(COALESCE(SUM(played_duration_ms), 0) AS BIGINT) AS total_play_time_ms,
    {R6('AVG(play_completion_ratio)')} AS average_completion_ratio,
    {R6("count_if(event_type = 'skip') / NULLIF(COUNT(*), 0)")} AS skip_rate,
    {R6("count_if(event_type = 'like') / NULLIF(COUNT(*), 0)")} AS like_rate,
    {R6("count_if(event_type = 'share') / NULLIF(COUNT(*), 0)")} AS share_rate,
    count_if(event_type = 'playlist_add') AS playlist_adds,
    {dist_json('platform', PLATFORMS_A)} AS platform_distribution""",
    [("peak_listening_hour", "hour_of_day")],
    """,
geo AS (
  SELECT track_id, artist_id, analysis_date,
    '{' || string_agg('"' || user_location || '":' || CAST(n AS VARCHAR), ',' ORDER BY user_location) || '}'
      AS geographic_distribution
  FROM (SELECT track_id, artist_id, analysis_date, user_location, COUNT(*) AS n FROM d
        WHERE user_location IS NOT NULL GROUP BY ALL)
  GROUP BY track_id, artist_id, analysis_date)""",
    f"""track_id, artist_id, analysis_date, total_plays, unique_listeners, total_play_time_ms,
  average_completion_ratio, skip_rate, like_rate, share_rate, playlist_adds, platform_distribution,
  geographic_distribution, peak_listening_hour,
  {R6('''total_plays / (1 + COALESCE(SUM(total_plays) OVER (PARTITION BY track_id, artist_id ORDER BY analysis_date
      RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) / 7)''')} AS trending_score""",
    "LEFT JOIN geo USING (track_id, artist_id, analysis_date)")

ORACLE["platform_daily_analytics"] = _daily(
    ["platform", "analysis_date"],
    f"""COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users,
    CAST(COALESCE(SUM(played_duration_ms), 0) AS BIGINT) AS total_streaming_time_ms,
    {R6('AVG(engagement_score)')} AS average_engagement_score,
    {R6("COUNT(DISTINCT CASE WHEN subscription_type = 'premium' THEN user_id END) / NULLIF(COUNT(DISTINCT user_id), 0)")}
      AS premium_user_ratio,
    {R6("count_if(device_type = 'mobile') / NULLIF(COUNT(*), 0)")} AS mobile_usage_ratio""",
    [("most_popular_artist", "artist_name"), ("most_popular_track", "track_name"),
     ("peak_usage_hour", "hour_of_day"), ("top_genre", "track_genres", "d", True)],
    """,
span AS (
  SELECT platform, analysis_date, CAST(floor(AVG(ms)) AS BIGINT) AS average_session_duration_ms
  FROM (SELECT platform, analysis_date, session_id,
          (epoch_us(MAX("timestamp")) - epoch_us(MIN("timestamp"))) / 1000 AS ms
        FROM d GROUP BY platform, analysis_date, session_id)
  GROUP BY platform, analysis_date)""",
    """platform, analysis_date, total_events, unique_users, total_streaming_time_ms, average_session_duration_ms,
  top_genre, most_popular_artist, most_popular_track, average_engagement_score, premium_user_ratio,
  mobile_usage_ratio, peak_usage_hour""",
    "LEFT JOIN span USING (platform, analysis_date)")

ORACLE["daily_tables"] = " UNION ALL BY NAME ".join(
    f"SELECT '{level}' AS level, * FROM ({ORACLE[f'{level}_daily_analytics']})" for level in ("user", "track", "platform"))


# --- enrichment (R1-R7, Q9-Q12), prompt text (P7, P8), answer cleaning (P9-P13) ---------
from cadenza.functions import confidence as CF  # noqa: E402
from cadenza.functions import text as TXT  # noqa: E402
from cadenza.operators import rules as RU  # noqa: E402


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def D(v: float) -> str:
    return f"CAST({v} AS DOUBLE)"


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def sql_sum(base: float, terms: list[tuple[str, float]]) -> str:
    return "(" + D(base) + "".join(f" + CASE WHEN {c} THEN {D(w)} ELSE {D(0.0)} END" for c, w in terms) + ")"


def case(pairs: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


def contains(col: str, needle: str) -> str:
    return f"contains({col}, {q(needle)})"


ENR_B = KEYED + f""",
enr_b AS (
  SELECT 'evt-' || CAST(e AS VARCHAR) AS event_id, {TYPE_B} AS event_type,
    'track-' || CAST(k AS VARCHAR) AS track_id, {TITLE} AS track_title, {ARTIST} AS track_artist,
    {ARTIST} AS artist_name, {ALBUM} AS album, CAST({YEAR} AS BIGINT) AS release_year,
    CAST(60 + k * 4 AS BIGINT) AS duration, {pick(A.GENRE_POOL_B, 'k % 10')} AS genre,
    {pick(A.GENRE_POOL_B, 'k % 10')} AS artist_genre, CAST(a * 1000 AS BIGINT) AS followers,
    {pick(PLATFORMS_B, 'u % 4')} AS platform, {pick(A.QUALITIES, 'e % 3')} AS quality,
    {pick(A.CITIES, 'u % 5')} AS user_location, strftime(t, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
    t AS event_ts
  FROM keyed
)"""


def genre_fallback(gl: str, idx: int, default: str) -> str:
    pairs = []
    for needles, *vals in RU.GENRE_FALLBACK:
        v = vals[idx]
        pairs.append((" OR ".join(contains(gl, n) for n in needles), lst(v) if isinstance(v, list) else q(v)))
    return case(pairs, default)


def artist_rule_sql(tl: str = "tl", al: str = "al", gl: str = "gl") -> dict[str, str]:
    either = [(f"({contains(tl, t)} OR {contains(al, a)})", r) for t, a, *r in RU.ARTIST_RULES]
    by_artist = {a: r for t, a, *r in RU.ARTIST_RULES}
    only = [(contains(al, a), by_artist[a]) for a in RU.ARTIST_ONLY_ORDER]
    return {
        "mood_analysis": case([(c, q(r[0])) for c, r in either], genre_fallback(gl, 0, q(RU.DEFAULT_MOOD))),
        "listening_context": case([(c, q(r[1])) for c, r in either], genre_fallback(gl, 1, q(RU.DEFAULT_CONTEXT))),
        "predicted_genres": case([(c, lst(r[2])) for c, r in only],
                                 genre_fallback(gl, 2, f"[{gl}, " + ", ".join(q(g) for g in RU.DEFAULT_GENRE_TAIL) + "]")),
        "similar_tracks": case([(c, lst(r[3])) for c, r in only], genre_fallback(gl, 3, lst(RU.DEFAULT_SIMILAR))),
    }


def local_conf_sql() -> str:
    famous = " OR ".join(contains("al", n) for n in CF.FAMOUS_15)
    return f"""least({sql_sum(0.5, [(present('track_title') + ' AND ' + present('track_artist'), 0.15),
                                    (present('genre'), 0.1), (present('artist_name'), 0.1), (present('platform'), 0.05),
                                    (f'({famous})', 0.1),
                                    (present('album') + ' AND COALESCE(release_year <> 0, false)', 0.05)])}, {D(0.95)})"""


LOWERED = """x AS (SELECT *, lower(coalesce(track_title, '')) AS tl, lower(coalesce(artist_name, '')) AS al,
    lower(coalesce(genre, '')) AS gl FROM enr_b)"""

_R = artist_rule_sql()
ORACLE["rule_enrichment"] = "WITH " + ENR_B + ",\n" + LOWERED + f"""
SELECT event_id,
  printf({q(RU.DESCRIPTION_TEMPLATE)}, track_title, artist_name, platform) AS event_description,
  {_R['mood_analysis']} AS mood_analysis, {_R['predicted_genres']} AS predicted_genres,
  {_R['listening_context']} AS listening_context, {_R['similar_tracks']} AS similar_tracks,
  {local_conf_sql()} AS enrichment_confidence
FROM x"""
# A nested loop over the rules table
_RULE_ROWS = ", ".join(f"({i}, {q(f)}, {q(n)}, {q(o)}, {lst(v)})" for i, f, n, o, v in RU.rules_as_rows())
ORACLE["rule_enrichment_table"] = "WITH " + ENR_B + ",\n" + LOWERED + f""",
rule(priority, field, needle, output, result) AS (VALUES {_RULE_ROWS}),
best AS (SELECT event_id, output, arg_min(result, priority) AS result FROM x JOIN rule
    ON contains(CASE field WHEN 'track_title' THEN tl ELSE al END, needle) GROUP BY event_id, output),
won AS (SELECT event_id, max(result) FILTER (output = 'mood_analysis') AS mood, max(result) FILTER (output = 'listening_context') AS context,
    max(result) FILTER (output = 'predicted_genres') AS genres, max(result) FILTER (output = 'similar_tracks') AS tracks FROM best GROUP BY event_id)
SELECT event_id, printf({q(RU.DESCRIPTION_TEMPLATE)}, track_title, artist_name, platform) AS event_description,
  coalesce(mood[1], {genre_fallback('gl', 0, q(RU.DEFAULT_MOOD))}) AS mood_analysis,
  coalesce(genres, {genre_fallback('gl', 2, "[gl, " + ", ".join(q(g) for g in RU.DEFAULT_GENRE_TAIL) + "]")}) AS predicted_genres,
  coalesce(context[1], {genre_fallback('gl', 1, q(RU.DEFAULT_CONTEXT))}) AS listening_context,
  coalesce(tracks, {genre_fallback('gl', 3, lst(RU.DEFAULT_SIMILAR))}) AS similar_tracks,
  {local_conf_sql()} AS enrichment_confidence
FROM x LEFT JOIN won USING (event_id)"""

PROD_CONF = f"""least({sql_sum(0.5, [(present('track_title') + ' AND ' + present('track_artist'), 0.2),
                                     (present('genre'), 0.1), (present('user_location'), 0.1),
                                     (present('platform'), 0.1)])}, {D(1.0)})"""
FAMOUS_CONF = f"""least({sql_sum(0.5, [(present('track_title') + ' AND ' + present('track_artist'), 0.2),
                                       (present('genre'), 0.1), (present('user_location'), 0.1),
                                       (present('platform'), 0.1),
                                       (f"lower(artist_name) IN {inlist(CF.FAMOUS_4)}", 0.1)])}, {D(1.0)})"""
SIMPLE_CONF = f"""least({sql_sum(0.5, [(present('track_title') + ' AND ' + present('track_artist'), 0.2),
                                       (present('artist_name'), 0.1), (present('platform'), 0.1),
                                       (f"artist_name IN {inlist(CF.FAMOUS_5)}", 0.1),
                                       (present('album') + ' AND COALESCE(release_year <> 0, false)', 0.1)])},
                        {D(0.95)})"""

TEXTED = """y AS (SELECT *, lower(concat_ws(' ', event_type, track_title, artist_name, album, genre, platform, quality,
      user_location)) AS txt, hour(event_ts) AS hr,
    lower(string_split_regex(trim(coalesce(genre, '')), '\\s+')[1]) AS g FROM enr_b)"""


def _hour_ctx(extra: list[tuple[str, str]]) -> str:
    pairs = [(f"(contains(txt, 'morning') OR hr IN {tuple(RU.MORNING_HOURS)})", q(RU.MORNING_CONTEXT)),
             (f"(contains(txt, 'night') OR hr IN {tuple(RU.NIGHT_HOURS)})", q(RU.NIGHT_CONTEXT))] + extra
    return case(pairs, q(RU.DEFAULT_CONTEXT))


def _base_genres(rock: str) -> str:
    tail = ", ".join(q(x) for x in RU.DEFAULT_GENRE_TAIL)
    return case([("g = 'rock'", rock), ("g = 'pop'", lst(RU.PRODUCTION_GENRES['pop']))], f"[g, {tail}]")


ORACLE["production_enrichment"] = "WITH " + ENR_B + ",\n" + TEXTED + f"""
SELECT event_id, 'User is enjoying music with ' || platform || ' quality streaming' AS enhanced_description,
  {case([(contains('txt', w), q(m)) for w, m in RU.PRODUCTION_MOOD], q(RU.DEFAULT_MOOD))} AS mood_analysis,
  {_base_genres(lst(RU.PRODUCTION_GENRES['rock']))} AS genre_prediction,
  {_hour_ctx([])} AS listening_context,
  {case([(f"contains(coalesce(artist_name, ''), {q(a)})", lst(v)) for a, v in RU.PRODUCTION_SIMILAR],
        lst(RU.DEFAULT_SIMILAR))} AS similar_tracks,
  {PROD_CONF} AS enrichment_confidence
FROM y"""

_EAG = "(contains(txt, 'eagles') OR contains(txt, 'hotel california'))"
_QUE = "contains(txt, 'queen')"
_ROCK_MOOD = case([(_EAG, q(RU.ARTIST_RULES[0][2])), (f"({_QUE} OR contains(txt, 'bohemian rhapsody'))",
                                                    q(RU.ARTIST_RULES[1][2]))], q(RU.PRODUCTION_MOOD[0][1]))
ORACLE["extended_enrichment"] = "WITH " + ENR_B + ",\n" + TEXTED + f"""
SELECT event_id, printf({q(RU.DESCRIPTION_TEMPLATE)}, track_title, artist_name, platform) AS enhanced_description,
  {case([("contains(txt, 'rock')", _ROCK_MOOD), ("contains(txt, 'pop')", q(RU.PRODUCTION_MOOD[1][1])),
         ("contains(txt, 'jazz')", q(RU.PRODUCTION_MOOD[2][1]))], q(RU.DEFAULT_MOOD))} AS mood_analysis,
  {_base_genres(case([("contains(txt, 'eagles')", lst(RU.ARTIST_RULES[0][4])), (_QUE, lst(RU.ARTIST_RULES[1][4]))],
                     lst(RU.PRODUCTION_GENRES['rock'])))} AS genre_prediction,
  {_hour_ctx([(_EAG, q(RU.ARTIST_RULES[0][3])), (_QUE, q(RU.ARTIST_RULES[1][3]))])} AS listening_context,
  {case([(contains('txt', a), lst(v)) for a, v in RU.EXTENDED_SIMILAR], lst(RU.DEFAULT_SIMILAR))} AS similar_tracks,
  {FAMOUS_CONF} AS enrichment_confidence
FROM y"""

ORACLE["confidence_scores"] = "WITH " + ENR_B + ",\n" + LOWERED + f"""
SELECT event_id, {PROD_CONF} AS production_confidence, {FAMOUS_CONF} AS famous_confidence,
  {SIMPLE_CONF} AS simple_confidence, {local_conf_sql()} AS local_confidence
FROM x"""


def FMT(x: str, d: int) -> str:
    """Fixed decimals as Spark's format_string prints them (half-up on the shortest decimal form)."""
    return f"CAST(CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), {d}) AS DECIMAL(38,{d})) AS VARCHAR)"


_PLAY = "played_duration_ms IS NOT NULL"
ORACLE["prompt_context"] = with_raw(f"""
SELECT event_id, concat_ws({q(TXT.CONTEXT_SEPARATOR)},
    'Event Type: ' || event_type, 'Track: ''' || track_name || ''' by ' || artist_name, 'Platform: ' || platform,
    CASE WHEN len(track_genres) > 0 THEN 'Track Genres: ' || array_to_string(track_genres, ', ') END,
    CASE WHEN COALESCE(track_duration_ms <> 0, false)
         THEN 'Duration: ' || {FMT('CAST(track_duration_ms AS DOUBLE) / 60000.0', 1)} || ' minutes' END,
    CASE WHEN track_energy IS NOT NULL THEN 'Energy Level: ' || {FMT('track_energy', 2)} END,
    CASE WHEN track_valence IS NOT NULL THEN 'Valence (Positivity): ' || {FMT('track_valence', 2)} END,
    CASE WHEN COALESCE(track_tempo <> 0, false) THEN 'Tempo: ' || {FMT('track_tempo', 0)} || ' BPM' END,
    CASE WHEN {present('device_type')} THEN 'Device: ' || device_type END,
    CASE WHEN {present('user_location')} THEN 'Location: ' || user_location END,
    CASE WHEN {_PLAY} THEN 'Played Duration: ' || {FMT('CAST(played_duration_ms AS DOUBLE) / 1000.0', 1)}
         || ' seconds' END,
    CASE WHEN {_PLAY} AND {present('skip_reason')} THEN 'Skip Reason: ' || skip_reason END,
    CASE WHEN {_PLAY} AND COALESCE(shuffle_mode, false) THEN 'Shuffle Mode: ON' END,
    CASE WHEN {_PLAY} AND COALESCE(repeat_mode, 'off') <> 'off' THEN 'Repeat Mode: ' || repeat_mode END
  ) AS context_text,
  least({sql_sum(0.0, [('len(COALESCE(track_genres, [])) > 0', 0.2), ('track_energy IS NOT NULL', 0.15),
                       ('track_valence IS NOT NULL', 0.15), ('COALESCE(track_tempo <> 0, false)', 0.1),
                       ('track_popularity IS NOT NULL', 0.1), (present('device_type'), 0.1),
                       (present('user_location'), 0.1), (_PLAY, 0.1)])}, {D(1.0)}) AS data_confidence
FROM raw_a""")


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def WORDS(x: str) -> str:
    return f"CASE WHEN {STRIP(x)} = '' THEN 0 ELSE len(string_split_regex({STRIP(x)}, '\\s+')) END"


_S = STRIP("text")
_L = f"lower({_S})"
_GITEMS = f"list_filter(list_transform(string_split({_L}, ','), lambda g: {STRIP('g')}), lambda g: g IN {inlist(GENRES_A)})"
ORACLE["answer_cleaning"] = f"""
SELECT conv_id, turn,
  CASE WHEN length({_S}) > {TXT.DESCRIPTION_LIMIT} THEN substring({_S}, 1, {TXT.DESCRIPTION_KEEP}) || '...' ELSE {_S} END
    AS description,
  CASE WHEN {WORDS(_L)} <= {TXT.MOOD_MAX_WORDS} THEN {_L} END AS mood,
  CASE WHEN {WORDS(_L)} <= {TXT.CONTEXT_MAX_WORDS} THEN {_L} END AS listening_context,
  CASE WHEN {_L} = 'none' THEN NULL WHEN len({_GITEMS}) > 0 THEN {_GITEMS} END AS genres,
  CASE WHEN lower({_S}) = 'none' THEN NULL
       ELSE list_slice(list_transform(string_split({_S}, ','), lambda x: {STRIP('x')}), 1, {TXT.SIMILAR_MAX}) END
    AS similar_tracks,
  list_slice(list_transform(string_split(regexp_replace({_S}, '[\\[\\]]', '', 'g'), ','),
             lambda x: lower({STRIP('x')})), 1, {TXT.VARIANT_GENRES_MAX}) AS genres_variant,
  list_slice(list_filter(list_transform(string_split({_S}, chr(10)), lambda x: {STRIP('x')}), lambda x: x <> ''),
             1, {TXT.VARIANT_TRACKS_MAX}) AS tracks_variant
FROM conversations WHERE role = 'assistant'"""

# --- catalog, search, dimensions ---------------------------------------------------------
CATALOG_CTE = ENR_B + """,
cat0 AS (SELECT track_id, min(track_title) AS track_title, min(artist_name) AS artist_name, min(album) AS album,
    min(genre) AS genre, min(release_year) AS release_year, min(duration) AS duration FROM enr_b GROUP BY track_id),
plat AS (SELECT track_id, platform FROM (
    SELECT track_id, platform, row_number() OVER (PARTITION BY track_id ORDER BY n DESC, platform) AS rn
    FROM (SELECT track_id, platform, COUNT(*) AS n FROM enr_b WHERE platform IS NOT NULL GROUP BY ALL)) WHERE rn = 1),
cx AS (SELECT c.*, p.platform, lower(coalesce(track_title, '')) AS tl, lower(coalesce(artist_name, '')) AS al,
    lower(coalesce(genre, '')) AS gl FROM cat0 c LEFT JOIN plat p USING (track_id)),
catalog AS (SELECT track_id, track_title, artist_name, album, genre, release_year, duration, platform,
""" + f"""  {_R['mood_analysis']} AS mood_analysis, {_R['predicted_genres']} AS predicted_genres,
  {_R['listening_context']} AS listening_context, {_R['similar_tracks']} AS similar_tracks FROM cx)"""

ORACLE["track_catalog"] = "WITH " + CATALOG_CTE + "\nSELECT * FROM catalog"
ORACLE["catalog_search"] = "WITH " + CATALOG_CTE + """
SELECT * FROM catalog WHERE contains(lower(genre), 'rock')
  OR len([g FOR g IN predicted_genres IF contains(lower(g), 'rock')]) > 0"""
ORACLE["catalog_search_mood"] = "WITH " + CATALOG_CTE + """
SELECT * FROM catalog WHERE (contains(lower(genre), 'hard_rock')
  OR len([g FOR g IN predicted_genres IF contains(lower(g), 'hard_rock')]) > 0) AND contains(lower(mood_analysis), 'energetic')"""
ORACLE["catalog_search_artist"] = "WITH " + CATALOG_CTE + """
SELECT * FROM catalog WHERE contains(lower(artist_name), 'the') AND platform = 'spotify'"""
ORACLE["genre_track_counts"] = "WITH " + CATALOG_CTE + """
SELECT lower(genre) AS genre, COUNT(*) AS tracks, COUNT(DISTINCT artist_name) AS artists, GROUPING(lower(genre)) = 1 AS all_genres
FROM catalog GROUP BY GROUPING SETS ((lower(genre)), ())"""

ORACLE["events_with_dimensions"] = with_raw(""",
ad AS (SELECT artist_id, min(artist_name) AS artist_name, max(artist_followers) AS artist_followers,
    CAST(max(CAST(artist_verified AS INTEGER)) AS BOOLEAN) AS artist_verified, min(artist_country) AS artist_country
  FROM raw_a GROUP BY artist_id),
ald AS (SELECT album_id, min(album_name) AS album_name, min(album_release_date) AS album_release_date
  FROM raw_a WHERE album_id IS NOT NULL GROUP BY album_id)
SELECT f.event_id, f.event_type, f.track_id, f.artist_id, f.album_id, f.played_duration_ms,
  ad.artist_name, ad.artist_followers, ad.artist_verified, ad.artist_country, ald.album_name, ald.album_release_date
FROM raw_a f LEFT JOIN ad USING (artist_id) LEFT JOIN ald USING (album_id)""")


# --- streams and sinks ---------------------------------------------------------------
_VALID = _fault_sql("CAST(split_part(event_id, '-', 2) AS BIGINT)", "event_type") + " IS NULL"
ORACLE["stream_window_metrics"] = with_raw(f""",
v AS (SELECT * FROM raw_a WHERE {_VALID})
SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS window_start,
  time_bucket(INTERVAL 1 MINUTE, "timestamp") + INTERVAL 1 MINUTE AS window_end,
  COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users, COUNT(DISTINCT track_id) AS unique_tracks,
  {dist_json('platform', PLATFORMS_A)} AS platform_distribution,
  {dist_json('event_type', EVENT_TYPES_A)} AS event_type_distribution,
  COALESCE({R6('AVG(engagement_score)')}, 0.0) AS average_engagement_score,
  MIN("timestamp") AS first_event_ts, MAX("timestamp") AS last_event_ts
FROM v GROUP BY time_bucket(INTERVAL 1 MINUTE, "timestamp")""")

for _kind in ("engagement", "genre", "platform"):
    ORACLE[f"stream_{_kind}_metrics"] = ORACLE[f"{_kind}_metrics"]

# The second eight days of a month arrive first, then the first, the last and the third
ORACLE["stream_late_events"] = with_raw(f""",
v AS (SELECT "timestamp" AS t, time_bucket(INTERVAL 1 MINUTE, "timestamp") + INTERVAL 1 MINUTE AS closes,
    CASE least((day("timestamp") - 1) // 8, 3) WHEN 1 THEN 0 WHEN 0 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS batch FROM raw_a WHERE {_VALID}),
seen AS (SELECT batch, max(max(t)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS watermark FROM v GROUP BY batch)
SELECT CAST(t AS DATE) AS event_date, COUNT(*) FILTER (NOT coalesce(closes <= watermark, false)) AS in_windows,
  COUNT(*) FILTER (closes <= watermark) AS late
FROM v JOIN seen USING (batch) GROUP BY 1""")

ORACLE["stream_dedup_counts"] = with_raw(f"""
SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT event_id) AS distinct_events
FROM raw_a WHERE {_VALID} GROUP BY event_type""")

ORACLE["compacted_platform_performance"] = ORACLE["platform_performance"].replace("FROM raw_a WHERE ", f"FROM raw_a WHERE {_VALID} AND ")

# Five attempts each, then one dead letter
ORACLE["delivery_attempts"] = "WITH " + FAULTS_CTE + """
SELECT fault AS error_code, 5 AS last_attempt, COUNT(*) AS messages, 5 * COUNT(*) AS attempts, COUNT(*) AS finals, COUNT(*) AS dead_letters
FROM faults WHERE fault IS NOT NULL GROUP BY fault"""

ORACLE["sustained_error_alerts"] = "WITH " + FAULTS_CTE + f""",
came AS (SELECT TIMESTAMP '2024-01-01' + to_minutes(CAST(e // 10000 * 30 AS BIGINT)) + to_milliseconds(CAST(
    CASE WHEN e % 10000 < 8000 THEN e % 10000 * 45 ELSE 600000 + (e % 10000 - 8000) END AS BIGINT)) AS t FROM faults WHERE fault IS NOT NULL),
rate AS (SELECT time_bucket(INTERVAL 1 MINUTE, t) AS m, COUNT(*) AS n FROM came GROUP BY 1 HAVING COUNT(*) / 60.0 > 1.0),
run AS (SELECT m, n, m - to_minutes(row_number() OVER (ORDER BY m)) AS r FROM rate)
SELECT min(m) AS alert_start, max(m) + INTERVAL 1 MINUTE AS alert_end, COUNT(*) AS minutes, CAST(SUM(n) AS BIGINT) AS errors,
  {R6('MAX(n / 60.0)')} AS peak_per_second
FROM run GROUP BY r HAVING COUNT(*) >= 5"""

ORACLE["file_intake"] = f"""WITH {KEYED},
f AS (SELECT e, {TYPE_A} AS etype, e % 250 <> 0 AND e // 500 % 5 = 4 AS broken FROM keyed)
SELECT etype AS kind, COUNT(*) AS n FROM f WHERE NOT broken GROUP BY etype
UNION ALL SELECT 'broken file', COUNT(DISTINCT e // 500) FROM f WHERE broken"""

ORACLE["error_rate_windows"] = f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, COUNT(*) AS errors,
  {R6('COUNT(*) / 300.0')} AS errors_per_second, {R6('COUNT(*) / 300.0')} > 10 AS alert
FROM (SELECT time_bucket(INTERVAL 1 MINUTE, CAST(ts AS TIMESTAMP)) - to_minutes(CAST(r.i AS BIGINT)) AS ws
      FROM events, range(5) AS r(i) WHERE event_type = 'error')
GROUP BY ws"""

ORACLE["envelope_decode"] = ORACLE["processed_events"]
ORACLE["json_export_roundtrip"] = ORACLE["raw_music_events"]

ORACLE["retained_partitions"] = with_raw("""
SELECT CAST("timestamp" AS DATE) AS event_date, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users,
  CAST(COALESCE(SUM(played_duration_ms), 0) AS BIGINT) AS played_ms
FROM raw_a WHERE CAST("timestamp" AS DATE) >= DATE '2024-04-25' - INTERVAL 90 DAY
GROUP BY CAST("timestamp" AS DATE)""")


# --- V12 business rules on raw text; Q13 context layouts -------------------------------
ORACLE["business_rule_check"] = "WITH " + FAULTS_CTE + f""",
m AS (SELECT f.fault, k.u, k.k FROM faults f JOIN keyed k USING (e))
SELECT NOT (fault IS NOT DISTINCT FROM 'parse_error' OR (u % 7 = 0 AND k % 10 = 3 AND fault IS DISTINCT FROM
    'popularity_out_of_range')) AS passed, COUNT(*) AS messages
FROM m GROUP BY 1"""

_PROD_LINES = ["", "    Music Event Context:", "    - Event Type: %s", "    - Track: %s by %s", "    - Album: %s (%s)",
               "    - Genre: %s", "    - Duration: %s seconds", "    - Platform: %s", "    - Quality: %s",
               "    - User Location: %s", "    - Timestamp: %s", "    "]
_SIMPLE_KEYS = ["Track: %s by %s", "Album: %s", "Duration: %s seconds", "Genre: %s", "Release Year: %s",
                "Artist: %s", "Artist Genre: %s", "Artist Followers: %s", "Event Type: %s", "Platform: %s",
                "User Location: %s"]


def _fmt_args(cols):
    return ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in cols)


ORACLE["context_text_b"] = "WITH " + ENR_B + f"""
SELECT event_id,
  printf({q(chr(10).join(_PROD_LINES))}, {_fmt_args(['event_type', 'track_title', 'track_artist', 'album',
      'release_year', 'genre', 'duration', 'platform', 'quality', 'user_location',
      "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') || '+00:00'"])}) AS production_context,
  {STRIP(f"printf({q(chr(10).join(['    ' + k if i else k for i, k in enumerate(_SIMPLE_KEYS)]))}, " + _fmt_args(
      ['track_title', 'track_artist', 'album', 'duration', 'genre', 'release_year', 'artist_name', 'artist_genre',
       'followers', 'event_type', 'platform', 'user_location']) + ")")} AS simple_context
FROM enr_b"""


# --- enriched tables (S6) ------------------------------------------------------------
_RA = artist_rule_sql()
ORACLE["enriched_music_events"] = with_raw(f""",
x AS (SELECT *, lower(coalesce(track_name, '')) AS tl, lower(coalesce(artist_name, '')) AS al,
    lower(coalesce(track_genres[1], '')) AS gl FROM raw_a)
SELECT event_id, event_type, "timestamp", processing_timestamp, track_id, track_name, artist_id, artist_name,
  album_id, album_name, platform, user_id, session_id,
  printf({q(RU.DESCRIPTION_TEMPLATE)}, track_name, artist_name, platform) AS enhanced_description,
  {_RA['mood_analysis']} AS mood_analysis, {_RA['predicted_genres']} AS genre_prediction,
  {_RA['similar_tracks']} AS similar_tracks, {_RA['listening_context']} AS listening_context,
  processing_timestamp AS enrichment_timestamp, 'rules' AS enrichment_model,
  least({sql_sum(0.0, [('len(COALESCE(track_genres, [])) > 0', 0.2), ('track_energy IS NOT NULL', 0.15),
                       ('track_valence IS NOT NULL', 0.15), ('COALESCE(track_tempo <> 0, false)', 0.1),
                       ('track_popularity IS NOT NULL', 0.1), (present('device_type'), 0.1),
                       (present('user_location'), 0.1), ('played_duration_ms IS NOT NULL', 0.1)])}, {D(1.0)})
    AS enrichment_confidence
FROM x""")


def JSON_LIST(x: str) -> str:
    return (f"CASE WHEN len(COALESCE({x}, [])) > 0 THEN "
            f"'[' || array_to_string(list_transform({x}, lambda v: '\"' || v || '\"'), ', ') || ']' END")


ORACLE["enriched_events"] = "WITH " + ENR_B + ",\n" + TEXTED + f"""
SELECT event_id, event_type, track_title, artist_name, platform,
  'User is enjoying music with ' || platform || ' quality streaming' AS event_description,
  {case([(contains('txt', w), q(m)) for w, m in RU.PRODUCTION_MOOD], q(RU.DEFAULT_MOOD))} AS mood_analysis,
  {JSON_LIST(_base_genres(lst(RU.PRODUCTION_GENRES['rock'])))} AS predicted_genres,
  {_hour_ctx([])} AS listening_context,
  {JSON_LIST(case([(f"contains(coalesce(artist_name, ''), {q(a)})", lst(v)) for a, v in RU.PRODUCTION_SIMILAR],
                  lst(RU.DEFAULT_SIMILAR)))} AS similar_tracks,
  {PROD_CONF} AS enrichment_confidence,
  strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
  event_ts AS enrichment_timestamp
FROM y"""

ORACLE["stream_enriched_events"] = ORACLE["enriched_music_events"].replace(
    "processing_timestamp AS enrichment_timestamp, ", "").replace("\nFROM x", f", {_RA['mood_analysis']} AS published_mood\nFROM x WHERE {_VALID}")

ORACLE["sql_platform_performance"] = ORACLE["platform_performance"]
ORACLE["table_platform_performance"] = ORACLE["platform_performance"]
