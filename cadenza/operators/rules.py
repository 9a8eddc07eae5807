"""Rule-based enrichment (R1-R7) and the rules-table match.

Rules are ordered data; each output is one ``CASE`` chain generated from the
table, so enrichment is a row-local projection: no join, no shuffle, the
same plan in batch and in a stream. ``match_rules_table`` takes a rules
DataFrame of any size instead and joins it by an index over the needles, for
rule sets kept as a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.common import session_cached

# --- fixed values: the artist/track rule table ------------------------------------
# (track needle, artist needle, mood, listening context, genres, similar tracks);
# needles are matched as lower-case substrings.
ARTIST_RULES = [
    ("hotel california", "eagles",
     "Melancholic, atmospheric, and introspective", "Evening relaxation or road trip vibes",
     ["classic_rock", "soft_rock", "country_rock"],
     ["Take It Easy", "Desperado", "One of These Nights", "Lyin' Eyes", "New Kid in Town"]),
    ("bohemian rhapsody", "queen",
     "Dramatic, theatrical, and emotionally powerful", "Party atmosphere or dramatic listening",
     ["progressive_rock", "hard_rock", "art_rock"],
     ["We Will Rock You", "Another One Bites the Dust", "Somebody to Love", "Killer Queen", "Don't Stop Me Now"]),
    ("stairway to heaven", "led zeppelin",
     "Epic, mystical, and transcendent", "Deep listening or spiritual experience",
     ["hard_rock", "progressive_rock", "blues_rock"],
     ["Whole Lotta Love", "Black Dog", "Kashmir", "Rock and Roll", "Immigrant Song"]),
    ("sweet child", "guns",
     "Energetic, passionate, and anthemic", "High-energy activities or driving",
     ["hard_rock", "glam_metal", "classic_rock"],
     ["November Rain", "Paradise City", "Welcome to the Jungle", "Patience", "Estranged"]),
    ("billie jean", "michael jackson",
     "Groovy, infectious, and danceable", "Dancing or party atmosphere",
     ["pop", "dance_pop", "funk"],
     ["Beat It", "Thriller", "Smooth Criminal", "Man in the Mirror", "Billie Jean"]),
    ("imagine", "john lennon",
     "Peaceful, idealistic, and inspiring", "Meditation or peaceful reflection",
     ["pop", "soft_rock", "protest_song"],
     ["Give Peace a Chance", "Working Class Hero", "Instant Karma", "Imagine", "Jealous Guy"]),
    ("smells like teen spirit", "nirvana",
     "Raw, rebellious, and angst-filled", "High-energy activities or teenage rebellion",
     ["grunge", "alternative_rock", "punk_rock"],
     ["Come As You Are", "Lithium", "In Bloom", "About a Girl", "All Apologies"]),
    ("superstition", "stevie wonder",
     "Funky, soulful, and groove-heavy", "Dancing or funky vibes",
     ["funk", "soul", "r&b"],
     ["Higher Ground", "Living for the City", "Sir Duke", "Superstition", "Isn't She Lovely"]),
    ("respect", "aretha franklin",
     "Empowering, soulful, and confident", "Empowerment or confidence boost",
     ["soul", "r&b", "gospel"],
     ["Think", "Natural Woman", "Chain of Fools", "Respect", "I Say a Little Prayer"]),
    ("purple haze", "jimi hendrix",
     "Psychedelic, experimental, and mind-bending", "Psychedelic experience or experimental listening",
     ["psychedelic_rock", "hard_rock", "blues_rock"],
     ["All Along the Watchtower", "Voodoo Child", "Foxy Lady", "Purple Haze", "Hey Joe"]),
    ("good vibrations", "beach boys",
     "Harmonious, sunny, and feel-good", "Summer vibes or feel-good moments",
     ["pop", "surf_rock", "baroque_pop"],
     ["God Only Knows", "Wouldn't It Be Nice", "California Girls", "Good Vibrations", "Surfin' USA"]),
    ("what's going on", "marvin gaye",
     "Smooth, socially conscious, and soulful", "Reflective listening or social awareness",
     ["soul", "r&b", "protest_song"],
     ["Mercy Mercy Me", "Inner City Blues", "Let's Get It On", "What's Going On", "Sexual Healing"]),
    ("johnny b. goode", "chuck berry",
     "Energetic, pioneering, and rock 'n' roll", "Dancing or rock 'n' roll celebration",
     ["rock_n_roll", "blues_rock", "classic_rock"],
     ["Maybellene", "Roll Over Beethoven", "Rock and Roll Music", "Johnny B. Goode", "Sweet Little Sixteen"]),
    ("i want to hold your hand", "beatles",
     "Infectious, youthful, and romantic", "Romantic moments or nostalgic listening",
     ["pop", "british_invasion", "rock_n_roll"],
     ["She Loves You", "A Hard Day's Night", "Help!", "I Want to Hold Your Hand", "Yesterday"]),
    ("like a rolling stone", "bob dylan",
     "Poetic, rebellious, and thought-provoking", "Reflective listening or cultural appreciation",
     ["folk_rock", "blues_rock", "protest_song"],
     ["Blowin' in the Wind", "The Times They Are A-Changin'", "Mr. Tambourine Man", "Like a Rolling Stone",
      "Knockin' on Heaven's Door"]),
]
# Order in which the genre and similar-track rules test artists (artist only).
ARTIST_ONLY_ORDER = ["eagles", "queen", "led zeppelin", "guns", "michael jackson", "bob dylan", "john lennon",
                     "nirvana", "stevie wonder", "aretha franklin", "jimi hendrix", "beach boys", "marvin gaye",
                     "chuck berry", "beatles"]
# Genre fallbacks: (genre needles, mood, context, genres, similar tracks); last row is the default.
GENRE_FALLBACK = [
    (["rock"], "Energetic, powerful, and dynamic", "High-energy activities or driving",
     ["classic_rock", "hard_rock", "progressive_rock"],
     ["Classic Rock Track 1", "Classic Rock Track 2", "Classic Rock Track 3"]),
    (["pop"], "Catchy, upbeat, and accessible", "Casual listening or party atmosphere",
     ["dance_pop", "synth_pop", "indie_pop"], ["Pop Hit 1", "Pop Hit 2", "Pop Hit 3"]),
    (["soul", "funk"], "Smooth, soulful, and groove-heavy", "Dancing or soulful vibes",
     ["soul", "r&b", "funk"], ["Soul Track 1", "Soul Track 2", "Soul Track 3"]),
    (["folk"], "Poetic, introspective, and authentic", "Reflective listening or cultural appreciation",
     ["folk_rock", "blues_rock", "protest_song"], ["Folk Song 1", "Folk Song 2", "Folk Song 3"]),
]
DEFAULT_MOOD = "Versatile and engaging"
DEFAULT_CONTEXT = "Casual listening during daily activities"
DEFAULT_GENRE_TAIL = ["alternative", "indie"]
DEFAULT_SIMILAR = ["Similar Track 1", "Similar Track 2", "Similar Track 3"]
DESCRIPTION_TEMPLATE = "User is enjoying %s by %s on %s with high-quality streaming"

# Production rules (R6) and their extension (R7), searched in the event text.
PRODUCTION_MOOD = [("rock", "Energetic, powerful, and dynamic"), ("pop", "Catchy, upbeat, and accessible"),
                   ("jazz", "Smooth, sophisticated, and relaxing")]
PRODUCTION_GENRES = {"rock": ["classic_rock", "hard_rock", "progressive_rock"],
                     "pop": ["dance_pop", "synth_pop", "indie_pop"]}
MORNING_CONTEXT = "Morning commute or workout"
NIGHT_CONTEXT = "Evening relaxation or party"
MORNING_HOURS = [6, 7, 8]
NIGHT_HOURS = [22, 23]
# R6 similar tracks by artist (case-sensitive artist test)
PRODUCTION_SIMILAR = [
    ("Queen", ["Bohemian Rhapsody", "We Will Rock You", "Another One Bites the Dust"]),
    ("Led Zeppelin", ["Stairway to Heaven", "Whole Lotta Love", "Black Dog"]),
    ("Eagles", ["Hotel California", "Take It Easy", "Desperado"]),
    ("Guns", ["Sweet Child O Mine", "November Rain", "Paradise City"]),
]
# R7 similar tracks (lower-case text test)
EXTENDED_SIMILAR = [
    ("eagles", ["Take It Easy", "Desperado", "One of These Nights"]),
    ("queen", ["We Will Rock You", "Another One Bites the Dust", "Somebody to Love"]),
    ("led zeppelin", ["Stairway to Heaven", "Whole Lotta Love", "Black Dog"]),
    ("guns", ["Sweet Child O Mine", "November Rain", "Paradise City"]),
]
# -------------------------------------------------------------------------------------

_RULE_COLS = ("track_needle", "artist_needle", "mood", "context", "genres", "similar")


def _lits(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _chain(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    out = None
    for cond, val in pairs:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default) if out is not None else default


def _genre_fallback(genre_l: Column, idx: int, default: Column) -> Column:
    pairs = []
    for needles, *vals in GENRE_FALLBACK:
        cond = None
        for n in needles:
            cond = genre_l.contains(n) if cond is None else (cond | genre_l.contains(n))
        v = vals[idx]
        pairs.append((cond, _lits(v) if isinstance(v, list) else F.lit(v)))
    return _chain(pairs, default)


@session_cached
def _artist_rule_columns() -> list[Column]:
    title_l = F.lower(F.coalesce(F.col("track_title"), F.lit("")))
    artist_l = F.lower(F.coalesce(F.col("artist_name"), F.lit("")))
    genre_l = F.lower(F.coalesce(F.col("genre"), F.lit("")))
    either = [(title_l.contains(t) | artist_l.contains(a), r) for t, a, *r in ARTIST_RULES]
    by_artist = {a: r for t, a, *r in ARTIST_RULES}
    artist_only = [(artist_l.contains(a), by_artist[a]) for a in ARTIST_ONLY_ORDER]
    mood = _chain([(c, F.lit(r[0])) for c, r in either], _genre_fallback(genre_l, 0, F.lit(DEFAULT_MOOD)))
    context = _chain([(c, F.lit(r[1])) for c, r in either], _genre_fallback(genre_l, 1, F.lit(DEFAULT_CONTEXT)))
    genres = _chain([(c, _lits(r[2])) for c, r in artist_only],
                    _genre_fallback(genre_l, 2, F.array(genre_l, *[F.lit(g) for g in DEFAULT_GENRE_TAIL])))
    similar = _chain([(c, _lits(r[3])) for c, r in artist_only], _genre_fallback(genre_l, 3, _lits(DEFAULT_SIMILAR)))
    return [F.format_string(DESCRIPTION_TEMPLATE, F.col("track_title"), F.col("artist_name"),
                            F.col("platform")).alias("event_description"),
            mood.alias("mood_analysis"), genres.alias("predicted_genres"),
            context.alias("listening_context"), similar.alias("similar_tracks")]


def enrich_rules(df: DataFrame) -> DataFrame:
    """R1-R5 on rows with ``track_title``, ``artist_name``, ``genre``, ``platform``.

    Mood and context test the track title or the artist; genres and similar
    tracks test the artist only; a row no rule matches takes the genre
    fallback.
    """
    return df.select("*", *_artist_rule_columns())


# --- J2: the same match with the rules held as a table ---------------------------------

RULES_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType()), T.StructField("field", T.StringType()),
    T.StructField("needle", T.StringType()), T.StructField("output", T.StringType()),
    T.StructField("value", T.ArrayType(T.StringType())),
])
TABLE_OUTPUTS = ("mood_analysis", "listening_context", "predicted_genres", "similar_tracks")
TABLE_FIELDS = ("track_title", "artist_name")
GRAM = 3  # characters of the pieces by which needles are looked up


def rules_as_rows() -> list[tuple]:
    """The artist/track rule table in long form: (priority, field, needle, output, value)."""
    rows = []
    for i, (t, a, mood, ctx, genres, similar) in enumerate(ARTIST_RULES):
        for out, val in (("mood_analysis", [mood]), ("listening_context", [ctx])):
            rows.append((i, "track_title", t, out, val))
            rows.append((i, "artist_name", a, out, val))
    for i, a in enumerate(ARTIST_ONLY_ORDER):
        _, _, _, _, genres, similar = next(r for r in ARTIST_RULES if r[1] == a)
        rows.append((i, "artist_name", a, "predicted_genres", genres))
        rows.append((i, "artist_name", a, "similar_tracks", similar))
    return rows


def _pieces(text: Column) -> Column:
    """All distinct pieces of 1 to ``GRAM`` characters of a text, and the empty one."""
    def of(n: int) -> Column:
        places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substr(text, i, F.lit(n)))
    return F.array_distinct(F.concat(F.array(F.lit("")), *[of(n) for n in range(1, GRAM + 1)]))


def _needle_pieces(needle: Column) -> Column:
    """The pieces of ``GRAM`` characters of a needle, or the needle itself if it has fewer."""
    places = F.sequence(F.lit(1), F.greatest(F.length(needle) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substr(needle, i, F.lit(GRAM))))


def needle_matches(values: DataFrame, needles: DataFrame) -> DataFrame:
    """(field, text, needle): every needle that a text of its field contains.

    An index join: a needle is looked up by the one of its pieces that the
    fewest texts hold, which any text that contains it must hold, and the pairs
    found are verified. ``values`` (field, text) and ``needles`` (field, needle)
    are distinct.
    """
    pieces = values.select("field", "text", F.explode(_pieces(F.col("text"))).alias("piece"))
    holders = pieces.groupBy("field", "piece").agg(F.count("*").alias("holders"))
    keyed = (needles.select("field", "needle", F.explode(_needle_pieces(F.col("needle"))).alias("piece"))
             .join(holders, ["field", "piece"], "left")
             .groupBy("field", "needle").agg(F.min(F.struct(F.coalesce("holders", F.lit(0)).alias("holders"), "piece")).alias("key"))
             .where("key.holders > 0").select("field", "needle", F.col("key.piece").alias("piece")))
    return pieces.join(keyed, ["field", "piece"]).where(F.col("text").contains(F.col("needle"))).select("field", "text", "needle")


def match_rules_table(df: DataFrame, rules: DataFrame) -> DataFrame:
    """First matching rule per output, rules given as a table of any size (``RULES_SCHEMA``).

    Needles are matched once per distinct title and artist (``needle_matches``);
    the best rule of each output is kept for every such text, and the events
    are joined with these by equality. Of a title's and an artist's rule the
    lower priority wins. Unmatched outputs take the genre fallback as in
    ``enrich_rules``. Nulls match as empty texts.
    """
    def lowered(field: str) -> Column:
        return F.lower(F.coalesce(F.col(field), F.lit("")))
    values = None
    for field in TABLE_FIELDS:
        own = df.select(F.lit(field).alias("field"), lowered(field).alias("text")).distinct()
        values = own if values is None else values.unionByName(own)
    table = rules.select("priority", "field", "needle", "output", F.col("value").alias("result"))
    found = needle_matches(values, table.select("field", "needle").distinct()).join(table, ["field", "needle"])
    best = found.groupBy("field", "text").agg(*[
        F.min(F.when(F.col("output") == out, F.struct("priority", "result"))).alias(out) for out in TABLE_OUTPUTS])
    for field in TABLE_FIELDS:
        own = best.where(F.col("field") == field).select(F.col("text").alias(f"_{field}"), *[F.col(out).alias(f"_{field}_{out}") for out in TABLE_OUTPUTS])
        df = df.join(own, lowered(field) == F.col(f"_{field}"), "left")
    genre_l = lowered("genre")
    defaults = [F.lit(DEFAULT_MOOD), F.lit(DEFAULT_CONTEXT),
                F.array(genre_l, *[F.lit(g) for g in DEFAULT_GENRE_TAIL]), _lits(DEFAULT_SIMILAR)]
    cols = []
    for idx, out in enumerate(TABLE_OUTPUTS):
        first = F.least(*[F.col(f"_{field}_{out}") for field in TABLE_FIELDS])["result"]
        cols.append(F.coalesce(first[0] if idx < 2 else first, _genre_fallback(genre_l, idx, defaults[idx])).alias(out))
    desc = F.format_string(DESCRIPTION_TEMPLATE, F.col("track_title"), F.col("artist_name"), F.col("platform"))
    helpers = [f"_{field}{rest}" for field in TABLE_FIELDS for rest in ("", *(f"_{out}" for out in TABLE_OUTPUTS))]
    return df.select("*", desc.alias("event_description"), *cols).drop(*helpers)


# --- R6 / R7: production rules on the event's own fields --------------------------------

def event_text(*cols: str) -> Column:
    """Lower-case text of the given fields, space-joined (nulls skipped)."""
    return F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in cols]))


TEXT_FIELDS = ("event_type", "track_title", "artist_name", "album", "genre", "platform", "quality", "user_location")


def _hour_context(text: Column, hour: Column, extra: list[tuple[Column, str]]) -> Column:
    pairs = [(text.contains("morning") | hour.isin(*MORNING_HOURS), F.lit(MORNING_CONTEXT)),
             (text.contains("night") | hour.isin(*NIGHT_HOURS), F.lit(NIGHT_CONTEXT))]
    pairs += [(c, F.lit(v)) for c, v in extra]
    return _chain(pairs, F.lit(DEFAULT_CONTEXT))


def _base_genres(genre: Column, rock_override: list[tuple[Column, list[str]]]) -> Column:
    g = F.lower(F.split(F.trim(F.coalesce(genre, F.lit(""))), r"\s+")[0])
    rock = _chain([(c, _lits(v)) for c, v in rock_override], _lits(PRODUCTION_GENRES["rock"]))
    return (F.when(g == "rock", rock).when(g == "pop", _lits(PRODUCTION_GENRES["pop"]))
            .otherwise(F.array(g, *[F.lit(x) for x in DEFAULT_GENRE_TAIL])))


def enrich_production(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """Description from the platform, mood from words in the event text,
    genres from the base genre, context from the hour (or the words morning /
    night), similar tracks from the artist name."""
    text = event_text(*[c for c in TEXT_FIELDS if c in df.columns])
    hour = F.hour(F.col(ts_col))
    mood = _chain([(text.contains(w), F.lit(m)) for w, m in PRODUCTION_MOOD], F.lit(DEFAULT_MOOD))
    artist = F.coalesce(F.col("artist_name"), F.lit(""))
    similar = _chain([(artist.contains(a), _lits(v)) for a, v in PRODUCTION_SIMILAR], _lits(DEFAULT_SIMILAR))
    return df.select(
        "*",
        F.concat(F.lit("User is enjoying music with "), F.col("platform"), F.lit(" quality streaming"))
        .alias("enhanced_description"),
        mood.alias("mood_analysis"),
        _base_genres(F.col("genre"), []).alias("genre_prediction"),
        _hour_context(text, hour, []).alias("listening_context"),
        similar.alias("similar_tracks"))


def enrich_extended(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """R6 with Eagles and Queen branches and the artist-and-track description."""
    text = event_text(*[c for c in TEXT_FIELDS if c in df.columns])
    hour = F.hour(F.col(ts_col))
    eagles = text.contains("eagles") | text.contains("hotel california")
    queen = text.contains("queen")
    rock_mood = _chain([(eagles, F.lit(ARTIST_RULES[0][2])),
                        (queen | text.contains("bohemian rhapsody"), F.lit(ARTIST_RULES[1][2]))],
                       F.lit(PRODUCTION_MOOD[0][1]))
    mood = _chain([(text.contains("rock"), rock_mood), (text.contains("pop"), F.lit(PRODUCTION_MOOD[1][1])),
                   (text.contains("jazz"), F.lit(PRODUCTION_MOOD[2][1]))], F.lit(DEFAULT_MOOD))
    genres = _base_genres(F.col("genre"), [(text.contains("eagles"), ARTIST_RULES[0][4]),
                                           (queen, ARTIST_RULES[1][4])])
    context = _hour_context(text, hour, [(eagles, ARTIST_RULES[0][3]), (queen, ARTIST_RULES[1][3])])
    similar = _chain([(text.contains(a), _lits(v)) for a, v in EXTENDED_SIMILAR], _lits(DEFAULT_SIMILAR))
    return df.select(
        "*",
        F.format_string(DESCRIPTION_TEMPLATE, F.col("track_title"), F.col("artist_name"), F.col("platform"))
        .alias("enhanced_description"),
        mood.alias("mood_analysis"), genres.alias("genre_prediction"),
        context.alias("listening_context"), similar.alias("similar_tracks"))
