"""Hand-made cases for cleaning, profiling and the scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from reelstats.functions.scalars import epoch_to_year_month, rating_from_label, truncate_toward_zero
from reelstats.operators import clean, profile

RAW = "user_id string, movie_id string, user_rating string, time_stamp string"


def test_drop_null_rows_all_vs_any(spark):
    df = spark.createDataFrame([("1", "2", "allstar10 rating", "0"), ("1", None, None, "5"),
                                (None, None, None, None)], RAW)
    assert clean.drop_null_rows(df, "all").count() == 2
    assert clean.drop_null_rows(df, "any").count() == 1


def test_nan_is_not_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (None, None)], "a int, b double")
    assert clean.drop_null_rows(df, "all").count() == 1
    assert clean.drop_null_rows(df, "any").count() == 1


def test_rating_labels(spark):
    df = spark.createDataFrame([("allstar10 rating",), ("allstar50 rating",), ("",), ("rating",),
                                (None,)], "user_rating string")
    got = [r[0] for r in df.select(rating_from_label("user_rating")).collect()]
    assert got == [1.0, 5.0, None, None, None]


def test_typed_ratings_malformed(spark):
    df = spark.createDataFrame([("abc", "1", "allstar20 rating", "12.5"),
                                ("99999999999", "2", "allstar30 rating", "100"),
                                ("7", "3", "allstar40 rating", None)], RAW)
    typed = clean.typed_ratings(df).collect()
    assert typed[0]["user_id"] is None and typed[0]["time_stamp"] is None
    assert typed[1]["user_id"] is None and typed[1]["time_stamp"] == 100
    assert typed[2]["user_id"] == 7 and typed[2]["user_rating"] == 4.0
    assert clean.typed_ratings(df, require_all=True).count() == 1
    assert clean.rejected_ratings(df).count() == 2


def test_attr_repair_cases(spark):
    movies = spark.createDataFrame(
        [("1", "张三更多...", "x"), ("2", "a...b", "y"), ("3", "更多", "z"), ("4", "主演: 李四", "w"),
         ("5", None, "v")], "movie_id string, movie_writer string, movie_starring string")
    got = {r.movie_id: (r.movie_writer, r.movie_starring)
           for r in clean.attr_repair(movies).collect()}
    assert got["1"] == ("张三/更多...", "x")
    assert got["2"] == ("a/更多...b", "y")
    assert got["3"] == ("更多", "z")
    assert got["4"] == ("未提供", "主演: 李四")
    assert got["5"] == (None, "v")


def test_movie_labels_removed(spark):
    movies = spark.createDataFrame([("编剧:王五", "主演:赵六")], "movie_writer string, movie_starring string")
    r = clean.clean_movie_labels(movies).first()
    assert (r.movie_writer, r.movie_starring) == ("王五", "赵六")


def test_profile_counts_and_duplicates(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("1", "a", "x"), ("1", "a", None),
                                (None, None, None), (None, None, None)],
                               "user_id string, movie_id string, user_tag string")
    p = profile.profile_table(df, "t").first()
    assert (p.n_rows, p.n_distinct, p.n_duplicates) == (5, 3, 2)
    assert (p.n_any_null, p.n_all_null) == (3, 2)


def test_distinct_with_null_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "user_tag string")
    assert df.agg(profile.distinct_with_null("user_tag")).first()[0] == 3


def test_anomaly_predicate_uses_all_columns(spark):
    movies = spark.createDataFrame(
        [("1", "n", "w", "s", "x:y"), ("2", "n", "w", "s", "t")],
        "movie_id string, movie_name string, movie_writer string, movie_starring string, movie_type string")
    assert [r.movie_id for r in profile.anomaly_rows(movies).collect()] == ["1"]


def test_year_month_utc(spark):
    secs = [0, 1_700_000_000, 951_782_400, -1]
    df = spark.createDataFrame([(str(s),) for s in secs] + [("junk",)], "t string")
    got = [r[0] for r in df.select(epoch_to_year_month("t")).collect()]
    want = [int(dt.datetime.fromtimestamp(s, dt.timezone.utc).strftime("%Y%m")) for s in secs]
    assert got == want + [None]


def test_year_month_independent_of_session_zone(spark):
    df = spark.createDataFrame([("1700000000",)], "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        assert df.select(epoch_to_year_month("t")).first()[0] == 202311
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_truncate_toward_zero(spark):
    df = spark.createDataFrame([(3.9,), (-2.5,), (None,)], "p double")
    assert [r[0] for r in df.select(truncate_toward_zero("p")).collect()] == [3.0, -2.0, None]


def test_clean_tables_pipeline(spark):
    ratings = spark.createDataFrame([("1", "2", "allstar30 rating", "5"), ("1", "2", "allstar30 rating", "5"),
                                     (None, None, None, None)], RAW)
    movies = spark.createDataFrame([("2", "编剧:a", "主演:b")], "movie_id string, movie_writer string, movie_starring string")
    tags = spark.createDataFrame([("1", "2", "x"), ("1", "2", "x")], "user_id string, movie_id string, user_tag string")
    m, r, t = clean.clean_tables(movies, ratings, tags)
    assert r.collect()[0].user_rating == 3.0 and r.count() == 1
    assert m.first().movie_writer == "a" and t.count() == 1


def test_fixture_epochs_independent_of_timestamp_mode_and_zone(spark):
    from reelstats.sources import fixtures
    from tests.conftest import SF001
    total = lambda: fixtures.ratings_raw(spark, SF001).agg(
        F.sum(F.col("time_stamp").cast("bigint"))).first()[0]
    base = total()
    keys = ["spark.sql.parquet.inferTimestampNTZ.enabled", "spark.sql.session.timeZone"]
    old = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "America/Los_Angeles")
        assert total() == base
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
