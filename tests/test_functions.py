import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions import numeric, records, text, time
from tidemill.plans import indicators, posts, prices, weather
from tidemill.plans.loads import coerce_numbers

UTC = dt.timezone.utc


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    ("change", "expected"),
    [(10.0, "extreme"), (-10.0, "extreme"), (9.99, "high"), (5.0, "high"), (2.0, "medium"), (1.99, "low"),
     (0.0, "low"), (None, "unknown")],
)
def test_volatility_bounds(spark, change, expected):
    df = spark.createDataFrame([(change,)], "c DOUBLE")
    assert one(df.select(prices.volatility_class("c"))) == expected


@pytest.mark.parametrize(
    ("income", "expected"),
    [(12696.0, "High income"), (12695.9, "Upper-middle income"), (4096.0, "Upper-middle income"),
     (1046.0, "Lower-middle income"), (1045.99, "Low income"), (None, "Low income")],
)
def test_income_bounds(spark, income, expected):
    df = spark.createDataFrame([(income,)], "c DOUBLE")
    assert one(df.select(numeric.band("c", indicators.INCOME_FLOORS, indicators.LOWEST_INCOME))) == expected


@pytest.mark.parametrize(
    ("score", "expected"),
    [(0.05, "positive"), (0.04999, "neutral"), (0.0, "neutral"), (-0.04999, "neutral"), (-0.05, "negative")],
)
def test_label_bounds(spark, score, expected):
    assert one(spark.createDataFrame([(score,)], "s DOUBLE").select(text.label(F.col("s")))) == expected


def test_flag_of_unknown_is_false(spark):
    df = spark.createDataFrame([(None,), (10,), (11,)], "rank INT")
    assert [r[0] for r in df.select(numeric.flag(F.col("rank") <= 10)).collect()] == [False, True, False]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a DOUBLE, b DOUBLE")
    out = df.select(numeric.ratio("a", "b"), numeric.change_pct("a", "b"), numeric.percent("a", "b", 2)).first()
    assert tuple(out) == (None, None, None)


def test_outlier_edges(spark):
    df = spark.createDataFrame([(14.0,), (14.1,), (None,)], "x DOUBLE")
    exactly = df.select(numeric.outlier("x", F.lit(10.0), F.lit(2.0)))
    assert [r[0] for r in exactly.collect()] == [False, True, False]
    # A spread of NULL (one row) or 0 (constant) counts as 1.
    for spread in (F.lit(None).cast("double"), F.lit(0.0)):
        assert [r[0] for r in df.select(numeric.outlier("x", F.lit(12.05), spread)).collect()] == [False, True, False]


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("5",), ("5x",), (None,), ("7.9",), ("NaN",), ("1e12",)], "score STRING")
    assert [r[0] for r in coerce_numbers(df, whole=["score"]).collect()] == [5, 0, 0, 7, 0, 0]


def test_rain_bounds_and_bad_dates(spark):
    df = spark.createDataFrame(
        [("a", "2024-12-30", 1.0, 3.0, 1.0), ("a", "2025-01-02", 1.1, 3.0, 1.0), ("a", "nonsense", None, None, 1.0)],
        "city STRING, date STRING, precipitation_mm DOUBLE, temp_max_c DOUBLE, temp_min_c DOUBLE",
    ).withColumns({"ingested_at": F.lit("2025-01-03"), "temp_mean_c": F.lit(2.0),
                   "wind_speed_max_kmh": F.lit(1.0), "solar_radiation_sum": F.lit(1.0)})
    out = {r["date"]: r for r in weather.weather_features(df, dt.date(2025, 1, 3)).collect()}
    assert [out[d]["is_rainy"] for d in (dt.date(2024, 12, 30), dt.date(2025, 1, 2), None)] == [False, True, False]
    weeks = weather.weekly_trend(weather.weather_features(df.where("date <> 'nonsense'"), dt.date(2025, 1, 3)))
    assert [r["week_start"] for r in weeks.collect()] == [dt.date(2024, 12, 30)]


def test_decode_keeps_wide_ids_and_separates_rejects(spark):
    log = spark.createDataFrame([('{"repo_id": 3000000000, "stars": 5, "extra": 1}',), ("{broken",)], "value STRING")
    empty = spark.createDataFrame([(None,)], "value STRING")
    assert records.decode(empty, schemas.REPOSITORY).where("repo_id IS NULL").count() == 1
    good, bad = records.decode(log, schemas.REPOSITORY).select("repo_id", "stars").collect()
    assert tuple(good) == (3000000000, 5) and tuple(bad) == (None, None)
    rejected = records.decode_with_rejects(log, schemas.REPOSITORY).where(f"{records.REJECT} IS NOT NULL")
    assert [r[records.REJECT] for r in rejected.collect()] == ["{broken"]


def test_fields_of_a_wrong_type_are_null(spark):
    text = '{"sensor_id": "s", "temperature_c": "warm", "humidity_pct": 7, "event_time": "soon"}'
    row = records.decode(spark.createDataFrame([(text,)], "value STRING"), schemas.SENSOR_READING).first()
    assert (row["sensor_id"], row["temperature_c"], row["humidity_pct"], row["event_time"]) == ("s", None, 7.0, None)


def test_encode_leaves_null_fields_out(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert one(records.encode(df)) == '{"a":1}'


def test_decode_bytes(spark):
    log = spark.createDataFrame([(bytearray(b'{"coin_id": "x", "market_cap_rank": 10}'),)], "value BINARY")
    row = prices.enrich_prices(prices.decode_prices(log)).first()
    assert (row["coin_id"], row["is_top10"], row["volatility_class"], row["event_time"]) == ("x", True, "unknown", None)


def test_bad_time_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00+02:00",), ("soon",)], "t STRING")
    out = [r[0] for r in df.select(time.parse_time("t").cast("timestamp_ntz")).collect()]
    assert out == [dt.datetime(2023, 12, 31, 22), None]


def test_clean_text_edges(spark):
    cases = {
        None: "", "": "", "[removed]": "", "[deleted]": "", "see https://a.b/c?d now": "see now",
        "a\t\n  b": "a b", "nice ☃ café, ok? yes! no-one": "nice café, ok? yes! no-one", " x ": "x",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t STRING")
    assert {r[0]: r[1] for r in df.select("t", text.clean("t")).collect()} == cases


LEXICON = {"good": (3.0, 0.7), "bad": (-2.5, -0.7), "fine": (0.8, 0.4)}


def test_sentiment_edges(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, "  ", ""), (3, "Good GOOD", None), (4, None, "bad, bad!"), (5, "goodness", "none")],
        "id INT, title STRING, body STRING",
    )
    out = {r["id"]: r for r in posts.score_posts(df, LEXICON).collect()}
    assert out[1]["sentiment_score"] == 0.0 and out[1]["sentiment_label"] == "neutral"
    assert out[2]["sentiment_label"] == "neutral" and out[5]["sentiment_label"] == "neutral"
    assert out[3]["compound_score"] == round(6 / (36 + 15) ** 0.5, 4) and out[3]["polarity_score"] == 0.7
    assert out[4]["sentiment_label"] == "negative"


def lexicon_table(spark, words):
    rows = [(word, valence, polarity) for word, (valence, polarity) in words.items()]
    return spark.createDataFrame(rows, "word STRING, valence DOUBLE, polarity DOUBLE")


def test_both_lexicon_forms_agree(spark, sf):
    from tidemill.registered.base import LEXICON as words
    from tidemill.registered.base import POSTS

    df = POSTS.df(spark, sf).select("post_id", "title", "body")
    table = lexicon_table(spark, words)
    inline = text.with_sentiment(df, words).drop("title", "body")
    joined = text.with_sentiment_table(df, table, "post_id").drop("title", "body")
    assert inline.exceptAll(joined).isEmpty() and joined.exceptAll(inline).isEmpty()


def test_salted_lexicon_join_agrees(spark, sf):
    from tidemill.registered.base import LEXICON as words
    from tidemill.registered.base import POSTS

    df = POSTS.df(spark, sf).select("post_id", "title", "body")
    table = lexicon_table(spark, words)
    joined = text.with_sentiment_table(df, table, "post_id", salts=4)
    assert text.with_sentiment(df, words).exceptAll(joined).isEmpty()


def test_weights_keep_their_digits(spark):
    df = spark.createDataFrame([(1, "one", "one two"), (2, "", "tiny " * 50), (3, "", "none")], "post_id INT, title STRING, body STRING")
    words = {"one": (0.13636363636, 0.5), "two": (-0.0004, 0.13636363636), "tiny": (-0.0004, 1e-9)}
    words |= {f"w{i}": (0.1234567890123456, i / 7) for i in range(10_000)}
    table = lexicon_table(spark, words)
    for lexicon in ({k: words[k] for k in ("one", "two", "tiny")}, words):
        out = {r["post_id"]: r for r in text.with_sentiment(df, lexicon).collect()}
        s = 2 * 0.13636363636 - 0.0004
        assert out[1]["compound_score"] == round(s / (s * s + 15) ** 0.5, 4)
        assert out[1]["polarity_score"] == round(1.13636363636 / 3, 4)
        assert out[2]["compound_score"] == round(-0.02 / (0.0004 + 15) ** 0.5, 4) and out[2]["polarity_score"] == 0.0
        assert out[3]["compound_score"] == 0.0
    joined = text.with_sentiment_table(df, table, "post_id")
    assert text.with_sentiment(df, words).exceptAll(joined).isEmpty()


def test_empty_and_large_lexicons(spark):
    df = spark.createDataFrame([("1", "good", "w7 w19999 x")], "post_id STRING, title STRING, body STRING")
    assert text.with_sentiment(df, {}).first()["sentiment_label"] == "neutral"
    large = {f"w{i}": (1.0, 0.5) for i in range(30_000)}
    assert text.with_sentiment(df, large).first()["polarity_score"] == 0.5


def test_ragged_weather_arrays(spark):
    log = spark.createDataFrame(
        [('{"city":"c","daily":{"time":["2024-01-01","2024-01-02"],"temperature_2m_max":[1.5]}}',)], "value STRING"
    )
    out = records.weather_rows(log).select("date", "temp_max_c", "temp_min_c").collect()
    assert [tuple(r) for r in out] == [("2024-01-01", 1.5, None), ("2024-01-02", None, None)]


def test_indicator_response_without_items(spark):
    log = spark.createDataFrame([("[{}, null]",), ("[{}]",), ("oops",)], "value STRING")
    assert records.indicator_rows(log).count() == 0
