"""Rule enrichment against the golden catalog labels, and text helpers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cadenza.functions import confidence as C
from cadenza.functions import text as TX
from cadenza.operators import rules
from cadenza.operators.reports import modes
from cadenza.sources import messages
from cadenza.sources.adapter import CATALOG_ALBUMS, CATALOG_ARTISTS, CATALOG_TITLES, CATALOG_YEARS

# Golden labels of the fifteen-track catalog (expected mood, genres, context, first similar track).
CATALOG_GENRES = ["rock", "rock", "rock", "rock", "pop", "folk", "pop", "rock", "funk", "soul", "rock", "pop",
                  "soul", "rock", "pop"]


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [(f"track_{i + 1:03d}", t, a, al, g, y, "spotify")
            for i, (t, a, al, y, g) in enumerate(zip(CATALOG_TITLES, CATALOG_ARTISTS, CATALOG_ALBUMS,
                                                     CATALOG_YEARS, CATALOG_GENRES))]
    return spark.createDataFrame(rows, "track_id string, track_title string, artist_name string, album string, "
                                       "genre string, release_year long, platform string")


# Golden labels of the catalog, in catalog order: (expected mood, expected genres, expected context).
GOLDEN = [
    ("Melancholic, atmospheric, and introspective", ["classic_rock", "soft_rock", "country_rock"],
     "Evening relaxation or road trip vibes"),
    ("Dramatic, theatrical, and emotionally powerful", ["progressive_rock", "hard_rock", "art_rock"],
     "Party atmosphere or dramatic listening"),
    ("Epic, mystical, and transcendent", ["hard_rock", "progressive_rock", "blues_rock"],
     "Deep listening or spiritual experience"),
    ("Energetic, passionate, and anthemic", ["hard_rock", "glam_metal", "classic_rock"],
     "High-energy activities or driving"),
    ("Groovy, infectious, and danceable", ["pop", "dance_pop", "funk"], "Dancing or party atmosphere"),
    ("Poetic, rebellious, and thought-provoking", ["folk_rock", "blues_rock", "protest_song"],
     "Reflective listening or cultural appreciation"),
    ("Peaceful, idealistic, and inspiring", ["pop", "soft_rock", "protest_song"],
     "Meditation or peaceful reflection"),
    ("Raw, rebellious, and angst-filled", ["grunge", "alternative_rock", "punk_rock"],
     "High-energy activities or teenage rebellion"),
    ("Funky, soulful, and groove-heavy", ["funk", "soul", "r&b"], "Dancing or funky vibes"),
    ("Empowering, soulful, and confident", ["soul", "r&b", "gospel"], "Empowerment or confidence boost"),
    ("Psychedelic, experimental, and mind-bending", ["psychedelic_rock", "hard_rock", "blues_rock"],
     "Psychedelic experience or experimental listening"),
    ("Harmonious, sunny, and feel-good", ["pop", "surf_rock", "baroque_pop"], "Summer vibes or feel-good moments"),
    ("Smooth, socially conscious, and soulful", ["soul", "r&b", "protest_song"],
     "Reflective listening or social awareness"),
    ("Energetic, pioneering, and rock 'n' roll", ["rock_n_roll", "blues_rock", "classic_rock"],
     "Dancing or rock 'n' roll celebration"),
    ("Infectious, youthful, and romantic", ["pop", "british_invasion", "rock_n_roll"],
     "Romantic moments or nostalgic listening"),
]


def test_rules_match_golden_labels(catalog):
    out = {r.track_id: r for r in rules.enrich_rules(catalog).collect()}
    for i, (mood, genres, context) in enumerate(GOLDEN):
        r = out[f"track_{i + 1:03d}"]
        assert (r.mood_analysis, r.predicted_genres, r.listening_context) == (mood, genres, context)
        assert len(r.similar_tracks) == 5
        assert r.event_description == (f"User is enjoying {CATALOG_TITLES[i]} by {CATALOG_ARTISTS[i]} on spotify "
                                       "with high-quality streaming")


def test_rules_table_equals_case_chains(spark, catalog):
    extra = spark.createDataFrame(
        [("x1", "Unknown Song", "Nobody", "A", "folk", 2001, "tidal"),
         ("x2", "Other", "Someone", "B", "Soul", 2002, "tidal"),
         ("x3", "Other", "Someone", "B", "electronic", 2002, "tidal")], catalog.schema)
    df = catalog.unionByName(extra)
    table = spark.createDataFrame(rules.rules_as_rows(), rules.RULES_SCHEMA)
    cols = ["track_id", "mood_analysis", "listening_context", "predicted_genres", "similar_tracks"]
    a = sorted(map(tuple, rules.enrich_rules(df).select(cols).collect()))
    b = sorted(map(tuple, rules.match_rules_table(df, table).select(cols).collect()))
    assert a == b
    fb = {r.track_id: r for r in rules.enrich_rules(extra).collect()}
    assert fb["x1"].mood_analysis == "Poetic, introspective, and authentic"
    assert fb["x2"].similar_tracks == ["Soul Track 1", "Soul Track 2", "Soul Track 3"]
    assert fb["x3"].predicted_genres == ["electronic", "alternative", "indie"]


def test_rules_table_has_no_limit(spark, catalog):
    """Above the 10,000 rules that were once the limit, rules that match nothing change nothing."""
    rows = rules.rules_as_rows()
    table = spark.createDataFrame(rows, rules.RULES_SCHEMA)
    many = table.unionByName(spark.range(12_000).select(
        F.lit(0).alias("priority"), F.lit("track_title").alias("field"), F.concat(F.lit("no such title "), "id").alias("needle"),
        F.lit("mood_analysis").alias("output"), F.array(F.lit("none")).alias("value")))
    got, want = (sorted(map(repr, rules.match_rules_table(catalog, t).collect())) for t in (many, table))
    assert got == want


def test_confidence_scores(catalog):
    c = F.col
    r = catalog.filter(c("artist_name") == "Queen").select(
        C.local_confidence(c("track_title"), c("artist_name"), c("genre"), c("artist_name"), c("platform"),
                           c("album"), c("release_year")).alias("local"),
        C.simple_confidence(c("track_title"), c("artist_name"), c("artist_name"), c("platform"), c("album"),
                            c("release_year")).alias("simple"),
        C.famous_confidence(c("track_title"), c("artist_name"), c("genre"), F.lit("London"), c("platform"),
                            c("artist_name")).alias("famous")).first()
    assert r.local == 0.95 and r.simple == 0.95 and r.famous == 1.0


def test_answer_cleaning(spark):
    long = "x" * 250
    df = spark.createDataFrame([(f"  {long}  ", "Upbeat Happy", "rock, Pop , dance", "A - B, C - D, E, F",
                                 "[Rock, Pop]", "One\n\n Two \nThree")],
                               "d string, m string, g string, s string, gv string, tv string")
    r = df.select(TX.clean_description(F.col("d")).alias("d"), TX.clean_mood(F.col("m")).alias("m"),
                  TX.clean_context(F.lit("way too many words here")).alias("c"),
                  TX.clean_genres(F.col("g")).alias("g"), TX.clean_genres(F.lit("NONE")).alias("g0"),
                  TX.clean_similar(F.col("s")).alias("s"), TX.clean_genres_variant(F.col("gv")).alias("gv"),
                  TX.clean_tracks_variant(F.col("tv")).alias("tv")).first()
    assert r.d == "x" * 197 + "..." and len(r.d) == 200
    assert r.m == "upbeat happy" and r.c is None
    assert r.g == ["rock", "pop"] and r.g0 is None
    assert r.s == ["A - B", "C - D", "E"]
    assert r.gv == ["rock", "pop"] and r.tv == ["One", "Two", "Three"]


def test_prompt_context_skips_absent_parts(spark):
    df = spark.createDataFrame(
        [("play", "Imagine", "John Lennon", "spotify", ["pop"], 183000, 0.25, None, 0.0, "mobile", None, 90500,
          None, True, "track")],
        "t string, n string, a string, p string, g array<string>, d long, e double, v double, tempo double, "
        "dev string, loc string, played long, skip string, sh boolean, rep string")
    c = F.col
    text = df.select(TX.prompt_context(c("t"), c("n"), c("a"), c("p"), c("g"), c("d"), c("e"), c("v"), c("tempo"),
                                       c("dev"), c("loc"), c("played"), c("skip"), c("sh"), c("rep"))).first()[0]
    assert text.split(" | ") == ["Event Type: play", "Track: 'Imagine' by John Lennon", "Platform: spotify",
                                 "Track Genres: pop", "Duration: 3.1 minutes", "Energy Level: 0.25",
                                 "Device: mobile", "Played Duration: 90.5 seconds", "Shuffle Mode: ON",
                                 "Repeat Mode: track"]


def test_modes_ties_go_to_smallest(spark):
    df = spark.createDataFrame([("u", "b", 3), ("u", "a", 3), ("u", "b", 5), ("u", "a", 5), ("v", "z", 1)],
                               "k string, s string, h int")
    out = {r.k: r for r in modes(df, ["k"], {"s": F.col("s"), "h": F.col("h")}).collect()}
    assert out["u"].s == "a" and out["u"].h == 3
    assert out["v"].s == "z" and out["v"].h == 1


def test_envelope_decoding(spark):
    payload = '{"event_id": "e1"}'
    import base64
    b64 = base64.b64encode(payload.encode()).decode()
    df = spark.createDataFrame([(json.dumps({"data": b64}),), (b64,), ("%%%not base64",),
                                (base64.b64encode(b"\xff\xfe").decode(),)], "value string")
    out = messages.decode_envelope(df).collect()
    assert [r.value for r in out[:2]] == [payload, payload]
    assert [r.decode_ok for r in out] == [True, True, False, False]


def test_json_file_with_array_or_object(spark, tmp_path):
    from cadenza.schemas import EVENT_B
    ev = {"event_id": "e1", "event_type": "play", "timestamp": "2024-01-01T10:00:00Z",
          "track": {"title": "Respect", "genre": "soul"}}
    (tmp_path / "one.json").write_text(json.dumps(ev))
    (tmp_path / "many.json").write_text(json.dumps([dict(ev, event_id=f"e{i}") for i in range(2, 5)], indent=2))
    df = messages.read_json_events(spark, str(tmp_path), EVENT_B)
    rows = sorted(r.event_id for r in df.collect())
    assert rows == ["e1", "e2", "e3", "e4"]
    assert df.filter(F.col("source_file").endswith("many.json")).count() == 3
