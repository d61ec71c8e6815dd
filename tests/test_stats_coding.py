"""Statistics, genre matching, coding and splits on hand-made frames."""

from pyspark.sql import functions as F

from reelstats.operators import coding, dashboard, stats


def test_genre_match_substring_case_and_null(spark):
    genres = spark.createDataFrame([("old",), ("Cold",), ("动画",), ("",)], "genre string")
    movies = spark.createDataFrame([("1", "cold/warm"), ("2", "儿童/动画/科幻"), ("3", None),
                                    ("4", "OLDIE")], "movie_id string, movie_type string")
    got = sorted(tuple(r) for r in stats.genre_match(genres, movies).select("genre", "movie_id").collect())
    want = sorted([("old", "1"), ("Cold", "1"), ("动画", "2"), ("old", "4"),
                   ("", "1"), ("", "2"), ("", "4")])
    assert got == want


def test_genre_match_plan_has_no_cartesian(spark):
    genres = spark.createDataFrame([("old",)], "genre string")
    movies = spark.createDataFrame([("1", "cold")], "movie_id string, movie_type string")
    plan = stats.genre_match(genres, movies)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_genre_top_n_ties_by_id(spark):
    movies = spark.createDataFrame([(str(i), "a/b") for i in range(1, 15)], "movie_id string, movie_type string")
    tags = spark.createDataFrame([("u", "1", "a")], "user_id string, movie_id string, user_tag string")
    avgs = spark.createDataFrame([(str(i), 4.0 if i % 2 else 3.0) for i in range(1, 15)],
                                 "movie_id string, avg double")
    top = stats.genre_top_n(movies, tags, avgs, 10).orderBy("rank").collect()
    assert [r.movie_id for r in top] == [1, 3, 5, 7, 9, 11, 13, 2, 4, 6]
    lists = stats.genre_top_n_lists(stats.genre_top_n(movies, tags, avgs, 10)).first()
    assert [x.movie_id for x in lists["items"]][:3] == [1, 3, 5]


def test_popularity_counts_skip_null_ids(spark):
    r = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", None)], "user_id string, movie_id string")
    got = {row.movie_id: row["count"] for row in stats.popular_items(r).collect()}
    assert got == {"a": 2, None: 0}


def test_dense_code_sorted_and_contiguous(spark):
    ids = [17, 3, 99, 3, 42, 1000, 5, 17, 8, 61]
    df = spark.createDataFrame([(i,) for i in ids], "movie_id int").repartition(5)
    codes = coding.dense_code(df, "movie_id", "code", num_partitions=3).orderBy("movie_id").collect()
    assert [r.movie_id for r in codes] == sorted(set(ids))
    assert [r.code for r in codes] == list(range(1, len(set(ids)) + 1))


def test_hash_split_disjoint_and_complete(spark):
    df = spark.range(0, 2000).select((F.col("id") % 97).cast("int").alias("user_id"),
                                     (F.col("id") * 7 % 503).cast("int").alias("movie_id"))
    s = coding.hash_split(df)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) == {"train", "test", "check"}
    # stable under repartitioning
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, coding.hash_split(df.repartition(7)).collect()))


def test_random_split_adds_up(spark):
    df = spark.range(0, 1000)
    s = coding.random_split(df, (0.8, 0.1, 0.1), 123)
    assert s.count() == 1000 and s.select("id").distinct().count() == 1000


def test_rating_histogram_shares(spark):
    r = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (5.0,)], "user_rating double")
    got = {row.name: (row.y, row.share) for row in dashboard.rating_histogram(r).collect()}
    assert got == {1.0: (2, 50.0), 2.0: (1, 25.0), 5.0: (1, 25.0)}


def test_releases_pivot_fills_zero(spark):
    m = spark.createDataFrame([("2020-01-05",), ("2020-01-09",), ("2021-12-01",), ("bad",)],
                              "movie_release_date string")
    rows = {r.year: r for r in dashboard.releases_pivot(m).collect()}
    assert rows[2020].m01 == 2 and rows[2020].m02 == 0 and rows[2021].m12 == 1


def test_split_is_not_tied_to_a_digit(spark):
    df = spark.createDataFrame([(u, i) for u in range(300) for i in range(40)], "user_id int, movie_id int")
    s = coding.hash_split(df)
    share = {r.split: r["count"] / 12000 for r in s.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.02
    digits = (s.where("split = 'test'").groupBy("user_id")
              .agg(F.count("*").alias("n"), F.count_distinct(F.col("movie_id") % 10).alias("d")).where("n >= 3"))
    assert digits.where("d = 1").count() < 0.1 * digits.count()


def test_dense_code_without_shuffle_reuse(spark):
    """Codes are contiguous even when no exchange is shared between two reads of the ranges."""
    import os

    from reelstats.plans.catalog import Ctx
    sf = "/root/testdata/sf0.1"
    assert os.path.isdir(sf)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        codes = coding.dense_code(Ctx(spark, sf).ratings, "movie_id", "movie_code")
        row = codes.agg(F.count("*").alias("n"), F.count_distinct("movie_code").alias("d"),
                        F.min("movie_code").alias("lo"), F.max("movie_code").alias("hi")).first()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert row.n > 10_000 and (row.d, row.lo, row.hi) == (row.n, 1, row.n)


def test_genre_match_expands_distinct_types_only(spark):
    movies = spark.createDataFrame([(str(i), "Cold/Steel" if i % 2 else "Warm") for i in range(4000)],
                                   "movie_id string, movie_type string")
    genres = spark.createDataFrame([("old",), ("warm",), ("",), ("x",)], "genre string")
    got = stats.genre_match(genres, movies)
    assert {(r.genre, r["count"]) for r in got.groupBy("genre").count().collect()} == {
        ("old", 2000), ("warm", 2000), ("", 4000)}
    assert "substring" not in stats.split_join(movies, movies.limit(0), "movie_type")._jdf.queryExecution().toString()


def test_random_split_loses_and_doubles_nothing(spark):
    from reelstats.session import materialize
    df = spark.range(20_000).withColumn("v", F.col("id") % 7)
    s = materialize(coding.random_split(df, (0.8, 0.1, 0.1), 5), "random-split-test")
    assert s.select("id", "v").exceptAll(df).count() == 0 and df.exceptAll(s.select("id", "v")).count() == 0
    share = {r.split: r["count"] / 20_000 for r in s.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.02 and set(share) == set(coding.SPLIT_NAMES)
