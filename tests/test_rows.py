"""Row-level rules on hand-made events (worked examples and invalid cases)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cadenza.functions.derive_full import raw_music_events
from cadenza.functions.derive_simple import processed_events
from cadenza.operators import validate
from cadenza.schemas import EVENT_A


def event_a(**over):
    e = {
        "event_id": "e-1", "event_type": "play", "timestamp": "2024-01-06T23:30:00.000000Z",
        "track": {"id": "t1", "name": "Hotel California", "artist_id": "a1", "duration_ms": 210000,
                  "popularity": 80, "energy": 0.5, "valence": 0.4, "tempo": 120.0, "genres": ["rock"]},
        "artist": {"id": "a1", "name": "Eagles", "genres": ["rock"], "followers": 10, "country": "US"},
        "user_interaction": {"user_id": "user-000001", "session_id": "s1", "device_type": "mobile",
                             "location": "US"},
        "play_event": {"played_duration_ms": 180000, "repeat_mode": "off"},
        "streaming_event": {"platform": "spotify"},
    }
    for path, v in over.items():
        cur = e
        keys = path.split("__")
        for k in keys[:-1]:
            cur = cur[k]
        if v is KeyError:
            cur.pop(keys[-1], None)
        else:
            cur[keys[-1]] = v
    return json.dumps(e)


def check(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return validate.validate(validate.parse_json(df, EVENT_A))


def errors_of(spark, text):
    return check(spark, [text]).select("errors").first()[0]


def test_sample_event_derived_fields(spark):
    # worked by hand: ratio 0.857143, full play, engagement 0.757143, premium
    good, _ = validate.split_valid(check(spark, [event_a()]))
    r = raw_music_events(good).first()
    assert round(r.play_completion_ratio, 6) == 0.857143
    assert r.is_full_play is True and r.is_skip is False
    assert round(r.engagement_score, 6) == 0.757143
    assert r.platform_category == "premium"
    assert r.day_of_week == 5 and r.is_weekend is True and r.hour_of_day == 23
    assert r.track_duration_seconds == 210.0 and r.is_long_track is False


def test_valid_event_has_no_errors(spark):
    assert errors_of(spark, event_a()) == []


@pytest.mark.parametrize("over,code", [
    ({"track__name": ""}, "track_name_empty"),
    ({"track__name": "   "}, "track_name_empty"),
    ({"track__name": "\t\n "}, "track_name_empty"),
    ({"track__popularity": 150}, "popularity_out_of_range"),
    ({"track__energy": 1.5}, "energy_out_of_range"),
    ({"track__tempo": -1.0}, "tempo_out_of_range"),
    ({"play_event": KeyError}, "play_without_play_event"),
    ({"track__artist_id": "other"}, "artist_mismatch"),
    ({"play_event__repeat_mode": "invalid"}, "repeat_mode_invalid"),
    ({"event_type": "dance"}, "event_type_invalid"),
    ({"streaming_event__platform": "napster"}, "platform_invalid"),
    ({"track__genres": ["dance"]}, "track_genre_invalid"),
    ({"artist__country": "USA"}, "artist_country_too_long"),
    ({"track__name": "x" * 301}, "track_name_too_long"),
    ({"artist__name": "y" * 201}, "artist_name_too_long"),
    ({"user_interaction__user_id": KeyError}, "user_id_missing"),
])
def test_invalid_cases(spark, over, code):
    assert code in errors_of(spark, event_a(**over))


def test_unparsable_text_is_quarantined(spark):
    chk = check(spark, ["{not json", event_a()])
    good, bad = validate.split_valid(chk)
    assert good.count() == 1
    row = bad.first()
    assert row.errors == ["parse_error"] and row.raw_value == "{not json"


def test_names_are_trimmed_and_defaults_filled(spark):
    good, _ = validate.split_valid(check(spark, [event_a(track__name="  Trimmed Name \t")]))
    r = good.first()
    assert r.track.name == "Trimmed Name"
    assert r.track.explicit is False and r.artist.verified is False


def test_null_popularity_passes_range(spark):
    assert errors_of(spark, event_a(track__popularity=None)) == []


def test_zero_duration_leaves_completion_null(spark):
    good, _ = validate.split_valid(check(spark, [event_a(track__duration_ms=0)]))
    r = raw_music_events(good).first()
    assert r.play_completion_ratio is None and r.track_duration_seconds is None
    assert round(r.engagement_score, 6) == 0.5


def test_business_rules_key_presence(spark):
    df = spark.createDataFrame([(event_a(),), (event_a(track__popularity=KeyError),),
                                (event_a(track__popularity=None),),
                                (event_a(user_interaction__user_id="short"),)], "value string")
    ok = [r[0] for r in df.select(validate.business_rules_ok(F.col("value"))).collect()]
    assert ok == [True, False, True, False]


def test_description_limit(spark):
    df = spark.createDataFrame([("a" * 1000,), ("a" * 1001,)], "d string")
    assert [r[0] for r in df.select(validate.description_ok(F.col("d"))).collect()] == [True, False]


def test_validation_counts_empty_is_zero(spark):
    empty = check(spark, []).limit(0)
    r = validate.validation_counts(empty).first()
    assert (r.valid_events, r.invalid_events, r.success_rate) == (0, 0, 0.0)


def test_shape_b_sample(spark):
    # Queen, rock, London, spotify, 23:30: score 1.1, evening_relaxation x1.2, adjusted 1.32, medium
    loose = spark.createDataFrame(
        [("e1", "play", "Bohemian Rhapsody", "Queen", "rock", "spotify", "London", "2024-01-01T23:30:00Z",
          dt.datetime(2024, 1, 1))],
        "event_id string, event_type string, track_title string, artist_name string, genre string, "
        "platform string, user_location string, timestamp string, processing_time timestamp")
    for level_on in ("adjusted", "base"):
        r = processed_events(loose, level_on).first()
        assert round(r.engagement_score, 6) == 1.1
        assert r.time_context == "evening_relaxation" and r.time_multiplier == 1.2
        assert round(r.adjusted_engagement, 6) == 1.32
        assert r.engagement_level == "medium"
        assert r.genre_popularity == 0.9 and r.is_popular_genre is True
        assert r.platform_quality == "high" and r.is_premium_platform is True


def test_shape_b_bad_timestamp_is_unknown(spark):
    loose = spark.createDataFrame(
        [("e1", "like", "x", "y", None, "tidal", None, "not a time", None)],
        "event_id string, event_type string, track_title string, artist_name string, genre string, "
        "platform string, user_location string, timestamp string, processing_time timestamp")
    r = processed_events(loose).first()
    assert r.time_context == "unknown" and r.time_multiplier == 1.0
    assert r.adjusted_engagement == 2.0 and r.engagement_level == "high"
    assert r.genre_popularity == 0.5 and r.platform_quality == "unknown"
