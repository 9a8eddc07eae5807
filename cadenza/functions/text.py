"""Prompt context text (P7, Q13) and model-answer cleaning.

Every function is a column expression over whole texts; nothing calls a
model (that needs a network and sits outside Spark).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.schemas import GENRES_A

# --- fixed values: answer limits ----------------------------------------------------
DESCRIPTION_LIMIT = 200      # longer answers keep 197 characters plus "..."
DESCRIPTION_KEEP = 197
MOOD_MAX_WORDS = 2
CONTEXT_MAX_WORDS = 3
SIMILAR_MAX = 3
VARIANT_GENRES_MAX = 5
VARIANT_TRACKS_MAX = 5
CONTEXT_SEPARATOR = " | "
# -------------------------------------------------------------------------------------

_WS = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Trim leading and trailing whitespace, no-break and other Unicode spaces included."""
    return F.regexp_replace(c, _WS, "")


def words(c: Column) -> Column:
    """Number of whitespace-separated words (0 for blank text)."""
    s = strip(c)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, r"\s+")))


def fmt(pattern: str, *cols: Column) -> Column:
    return F.format_string(pattern, *cols)


def prompt_context(event_type: Column, track_name: Column, artist_name: Column, platform: Column,
                   genres: Column, duration_ms: Column, energy: Column, valence: Column, tempo: Column,
                   device: Column, location: Column, played_ms: Column, skip_reason: Column,
                   shuffle_mode: Column, repeat_mode: Column) -> Column:
    """``" | "``-joined facts of a shape A event; absent facts are left out.

    ``concat_ws`` skips null parts, so each optional part is a ``when``
    without ``otherwise``. Numbers use fixed decimals (1, 2, 2, 0, 1).
    """
    has_play = played_ms.isNotNull()
    nonempty = lambda c: c.isNotNull() & (c != "")
    parts = [
        fmt("Event Type: %s", event_type),
        fmt("Track: '%s' by %s", track_name, artist_name),
        fmt("Platform: %s", platform),
        F.when(F.size(F.coalesce(genres, F.array())) > 0,
               F.concat(F.lit("Track Genres: "), F.array_join(genres, ", "))),
        F.when(F.coalesce(duration_ms != 0, F.lit(False)), fmt("Duration: %.1f minutes", duration_ms / 60000.0)),
        F.when(energy.isNotNull(), fmt("Energy Level: %.2f", energy)),
        F.when(valence.isNotNull(), fmt("Valence (Positivity): %.2f", valence)),
        F.when(F.coalesce(tempo != 0, F.lit(False)), fmt("Tempo: %.0f BPM", tempo)),
        F.when(nonempty(device), fmt("Device: %s", device)),
        F.when(nonempty(location), fmt("Location: %s", location)),
        F.when(has_play, fmt("Played Duration: %.1f seconds", played_ms / 1000.0)),
        F.when(has_play & nonempty(skip_reason), fmt("Skip Reason: %s", skip_reason)),
        F.when(has_play & F.coalesce(shuffle_mode, F.lit(False)), F.lit("Shuffle Mode: ON")),
        F.when(has_play & (F.coalesce(repeat_mode, F.lit("off")) != "off"), fmt("Repeat Mode: %s", repeat_mode)),
    ]
    return F.concat_ws(CONTEXT_SEPARATOR, *parts)


def production_context(event_type, title, artist, album, release_year, genre, duration, platform, quality,
                       location, timestamp) -> Column:
    """Q13, production layout: one ``- Key: value`` line per fact."""
    lines = ["", "    Music Event Context:",
             "    - Event Type: %s", "    - Track: %s by %s", "    - Album: %s (%s)", "    - Genre: %s",
             "    - Duration: %s seconds", "    - Platform: %s", "    - Quality: %s",
             "    - User Location: %s", "    - Timestamp: %s", "    "]
    return F.format_string("\n".join(lines), *[F.coalesce(c.cast("string"), F.lit("None")) for c in
                                               (event_type, title, artist, album, release_year, genre, duration,
                                                platform, quality, location, timestamp)])


def simple_context(title, artist, album, duration, genre, release_year, artist_name, artist_genre,
                   followers, event_type, platform, location) -> Column:
    """Q13, simple layout: ``Key: value`` lines, outer whitespace stripped."""
    keys = ["Track: %s by %s", "Album: %s", "Duration: %s seconds", "Genre: %s", "Release Year: %s",
            "Artist: %s", "Artist Genre: %s", "Artist Followers: %s", "Event Type: %s", "Platform: %s",
            "User Location: %s"]
    text = F.format_string("\n    ".join(keys), *[F.coalesce(c.cast("string"), F.lit("None")) for c in
                                                   (title, artist, album, duration, genre, release_year,
                                                    artist_name, artist_genre, followers, event_type, platform,
                                                    location)])
    return strip(text)


def clean_description(answer: Column) -> Column:
    """Trimmed; above 200 characters keep the first 197 and add ``...``."""
    s = strip(answer)
    return F.when(F.length(s) > DESCRIPTION_LIMIT,
                  F.concat(F.substring(s, 1, DESCRIPTION_KEEP), F.lit("..."))).otherwise(s)


def clean_short_label(answer: Column, max_words: int) -> Column:
    """P10: lower-cased, trimmed; kept only with at most ``max_words`` words."""
    s = F.lower(strip(answer))
    return F.when(words(s) <= max_words, s)


def clean_mood(answer: Column) -> Column:
    return clean_short_label(answer, MOOD_MAX_WORDS)


def clean_context(answer: Column) -> Column:
    return clean_short_label(answer, CONTEXT_MAX_WORDS)


def clean_genres(answer: Column) -> Column:
    """``none`` gives null; comma list, trimmed, only known genres; empty gives null."""
    s = F.lower(strip(answer))
    items = F.filter(F.transform(F.split(s, ","), strip), lambda g: g.isin(*GENRES_A))
    return F.when(s == "none", F.lit(None)).when(F.size(items) > 0, items)


def clean_similar(answer: Column) -> Column:
    """``none`` (any case) gives null; comma list, trimmed, first three."""
    s = strip(answer)
    return F.when(F.lower(s) == "none", F.lit(None)).otherwise(
        F.slice(F.transform(F.split(s, ","), strip), 1, SIMILAR_MAX))


def clean_genres_variant(answer: Column) -> Column:
    """Brackets removed, comma list, trimmed and lower-cased, first five."""
    s = F.regexp_replace(strip(answer), r"[\[\]]", "")
    return F.slice(F.transform(F.split(s, ","), lambda g: F.lower(strip(g))), 1, VARIANT_GENRES_MAX)


def clean_tracks_variant(answer: Column) -> Column:
    """One track per line, blank lines dropped, trimmed, first five."""
    lines = F.transform(F.split(strip(answer), "\n"), strip)
    return F.slice(F.filter(lines, lambda x: x != ""), 1, VARIANT_TRACKS_MAX)
