"""A hot user holding a third of the ratings, derived from the given tables.

The salted, copy-weighted similarity and the top-n recommendations must equal
a plain DuckDB self-join over the same rows.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from reelstats.operators import evaluate, itemcf, serve
from reelstats.operators.skew import split_join
from reelstats.plans.catalog import Ctx
from tests.conftest import SF001


def test_hot_user_similarity_and_top_n_equal_plain_sql(spark):
    train = Ctx(spark, SF001).train
    # every third rating moves to user 0, so user 0 holds ~1/3 of all rows
    hot = train.withColumn("user_id", F.when(F.col("movie_id") % 3 == 0, F.lit(0))
                           .otherwise(F.col("user_id")))
    rows = hot.select("user_id", "movie_id", "user_rating").collect()
    n_hot = sum(1 for r in rows if r.user_id == 0)
    assert n_hot * 4 > len(rows)   # a real hot key

    sim = itemcf.item_similarity(hot, chunk=64)      # user 0 is split into many buckets
    top = itemcf.item_cf_recommend(hot, 10, similarity=sim)

    con = duckdb.connect()
    con.execute("create table t (user_id int, movie_id int, user_rating double)")
    con.executemany("insert into t values (?, ?, ?)", [tuple(r) for r in rows])
    want_sim = con.execute("""
        with m as (select movie_id, avg(user_rating) mean from t group by movie_id),
        p as (select a.movie_id ia, b.movie_id ib, sum(least(a.user_rating, b.user_rating)) s
              from t a join t b on a.user_id = b.user_id and a.movie_id < b.movie_id group by 1, 2)
        select ia, ib, s / (ma.mean + mb.mean) from p join m ma on ma.movie_id = ia
        join m mb on mb.movie_id = ib""").fetchall()
    got_sim = {(r.item_a, r.item_b): r.sim for r in sim.collect()}
    assert len(got_sim) == len(want_sim)
    for a, b, v in want_sim:
        assert got_sim[(a, b)] == pytest.approx(v, rel=1e-12)

    con.execute("create table s (item_a int, item_b int, sim double)")
    con.executemany("insert into s values (?, ?, ?)", [(a, b, got_sim[(a, b)]) for a, b, _ in want_sim])
    want_top = con.execute("""
        with nb as (select item, neighbour, sim from (
            select *, row_number() over (partition by item order by sim desc, neighbour) rn from (
              select item_a item, item_b neighbour, sim from s union all
              select item_b, item_a, sim from s)) where rn <= 10),
        c as (select t.user_id, nb.neighbour movie_id, t.movie_id seed, nb.sim
              from t join nb on nb.item = t.movie_id)
        select user_id, rn, movie_id, seed, sim from (
          select *, row_number() over (partition by user_id order by sim desc, movie_id, seed) rn from c)
        where rn <= 10""").fetchall()
    got_top = [tuple(r) for r in top.select("user_id", "rank", "movie_id", "seed", "sim").collect()]
    assert sorted(got_top) == sorted(tuple(r) for r in want_top)


def hot_ratings(spark):
    """One user and one item hold a third of the rows each."""
    train = Ctx(spark, SF001).train.select("user_id", "movie_id", "user_rating")
    return (train.withColumn("user_id", F.when(F.col("movie_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
            .withColumn("movie_id", F.when(F.col("user_id") % 3 == 1, F.lit(7)).otherwise(F.col("movie_id"))))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_a_plain_join(spark, how):
    left = hot_ratings(spark)
    right = left.groupBy("movie_id").agg(F.avg("user_rating").alias("mean")).where("movie_id % 5 <> 0")
    got, want = split_join(left, right, "movie_id", how), left.join(right, "movie_id", how)
    cols = want.columns
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.collect()))
    nulls = left.unionByName(left.limit(5).withColumn("movie_id", F.lit(None).cast("int")))
    got, want = split_join(nulls, right, "movie_id", how), nulls.join(right, "movie_id", how)
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.collect()))


def test_hot_key_is_dealt_over_tasks(spark):
    left = spark.range(30_000).select((F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))).alias("k"), "id")
    right = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "64", "false")):
            spark.conf.set(k, v)
        for join, most in ((split_join(left, right, "k"), 3_000), (left.join(right, "k"), 100_000)):
            sizes = [r["count"] for r in join.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == 30_000
            assert max(sizes) <= most
        assert max(sizes) > 9_000  # the plain join puts the hot key into one task
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_min_activity_means_and_candidates_with_hot_keys(spark):
    hot = hot_ratings(spark)
    kept = itemcf.users_min_rated(hot, 3)
    keep = {r.user_id for r in hot.groupBy("user_id").count().where("count >= 3").collect()}
    assert kept.columns == hot.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in hot.collect() if r.user_id in keep)
    pred = evaluate.item_mean_predictions(hot, hot)
    means = {r.movie_id: r.m for r in hot.groupBy("movie_id").agg(F.avg("user_rating").alias("m")).collect()}
    assert pred.count() == hot.count()
    assert all(r.prediction == pytest.approx(means[r.movie_id]) for r in pred.collect())


def test_repeated_ids_do_not_multiply_recommendations(spark):
    recs = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (2, 1, 12)], "user_id int, rank int, movie_id int")
    movies = spark.createDataFrame([("10", "b", "t2"), ("10", "a", "t1"), ("10", None, "t0"), ("11", "c", None),
                                    ("x", "bad id", None)], "movie_id string, movie_name string, movie_type string")
    got = {(r.user_id, r.movie_id): (r.movie_name, r.movie_type) for r in serve.attach_names(recs, movies).collect()}
    assert got == {(1, 10): ("a", "t1"), (1, 11): ("c", None), (2, 12): (None, None)}
    codes = spark.createDataFrame([(10, 1), (10, 1), (9, 1)], "movie_id int, movie_code int")
    coded = spark.createDataFrame([(1, 1, 1), (1, 2, 5)], "user_id int, rank int, movie_code int")
    assert {(r.movie_code, r.movie_id) for r in serve.decode_items(coded, codes).collect()} == {(1, 9), (5, None)}
