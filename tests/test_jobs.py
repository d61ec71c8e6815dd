"""The batch jobs end to end, from '$'-delimited files to recommendations and JSON."""

import json
import os

from pyspark.sql import functions as F

from reelstats.plans import jobs
from reelstats.plans.catalog import QUERIES
from reelstats.session import local_path, scratch_path
from reelstats.sources import fixtures, io
from tests.conftest import SF001
from tests.helpers import rows_of


def test_jobs_end_to_end(spark):
    raw = scratch_path(spark, "raw-files")
    io.write_delimited(fixtures.movies_raw(spark, SF001), f"{raw}/Movie")
    io.write_delimited(fixtures.ratings_raw(spark, SF001), f"{raw}/Rating")
    io.write_delimited(fixtures.tags_raw(spark, SF001), f"{raw}/Tag")
    io.write_delimited(fixtures.posters(spark, SF001), f"{raw}/Poster")
    store = jobs.Store(spark, scratch_path(spark, "store"))

    jobs.ingest(spark, store, f"{raw}/Movie", f"{raw}/Rating", f"{raw}/Tag")
    jobs.clean_step(store)
    jobs.features(store)
    # the stored statistics equal the catalogue queries over the same data
    assert rows_of(store.read(jobs.T_POPULAR)) == rows_of(QUERIES["popular_items"](spark, SF001))
    assert rows_of(store.read(jobs.T_AVERAGE)) == rows_of(QUERIES["avg_rating"](spark, SF001))
    parts = {n: store.split(n).count() for n in ("train", "test", "check")}
    assert sum(parts.values()) == QUERIES["typed_ratings"](spark, SF001).count()

    jobs.models(store, top_n=30, ranks=(4,), regs=(0.1, 1.0), iters=(3,))
    assert store.read(jobs.T_ALS_GRID).count() == 2
    assert store.read(jobs.T_ITEM_MODEL).where(F.size("items") > 30).count() == 0

    jobs.evaluate_step(store)
    assert store.read(jobs.T_ITEM_EVAL).count() == 3 and store.read(jobs.T_ALS_EVAL).count() == 3

    jobs.recommend(store, n=20)
    item_recs = store.read(jobs.T_ITEM_RECS)
    # same result as the catalogue's decoded item-CF query
    assert rows_of(item_recs) == rows_of(QUERIES["decode_recs"](spark, SF001).drop("movie_type")
                                         .join(QUERIES["attr_repair"](spark, SF001).select(
                                             F.col("movie_id").cast("int").alias("movie_id"), "movie_type"),
                                             "movie_id", "left")
                                         .select("user_id", "rank", "movie_id", "movie_name", "movie_type"))
    als_recs = store.read(jobs.T_ALS_RECS)
    assert als_recs.groupBy("user_id").count().where("count != 20").count() == 0
    assert als_recs.where("movie_name is null").count() == 0

    out = scratch_path(spark, "web_data")
    jobs.dashboard_step(store, out, f"{raw}/Poster")
    (hist,) = [json.loads(r.value) for r in spark.read.text(f"{out}/userRL").collect()]
    assert sum(d["y"] for d in hist) == QUERIES["typed_ratings"](spark, SF001).count()
    (dates,) = [json.loads(r.value) for r in spark.read.text(f"{out}/MoviesDate").collect()]
    assert set(dates[0]) == {"year_data", "month_data", "count_num"}
    (top,) = [json.loads(r.value) for r in spark.read.text(f"{out}/RateMoreMoviesTop10").collect()]
    assert len(top) == 10 and set(top[0]) == {"movie_name", "rating_people_num"}
    counts = [d["rating_people_num"] for d in top]
    assert counts == sorted(counts, reverse=True)
    rejected = store.read(jobs.T_REJECTED).count()
    assert rejected + sum(parts.values()) == store.read(jobs.T_RATING_CLEAN).count() and rejected > 0
    assert {r.model: r.n_missing for r in store.read(jobs.T_UNRESOLVED).collect()} == {"item_cf": 0, "als": 0}
    assert os.path.isdir(local_path(f"{out}/PosterRecent"))


def test_recommend_from_text_inputs(spark):
    from reelstats.operators import als, coding
    from reelstats.plans.catalog import Ctx
    c = Ctx(spark, SF001)
    ratings = c.ratings
    root = scratch_path(spark, "text-inputs")
    users = coding.dense_code(ratings, "user_id", "code").select(
        F.col("user_id").cast("string").alias("key"), "code")
    items = c.codes.select(F.col("movie_id").cast("string").alias("key"), F.col("movie_code").alias("code"))
    tuple_text = lambda df, cols: df.select(
        F.concat(F.lit("("), F.concat_ws(",", *[F.col(x).cast("string") for x in cols]), F.lit(")")).alias("v"))
    tuple_text(users, ["key", "code"]).write.text(f"{root}/userZipCode")
    tuple_text(items, ["key", "code"]).write.text(f"{root}/itemZipCode")
    coded = (ratings.join(users.withColumnRenamed("key", "uk").withColumnRenamed("code", "uc"),
                          F.col("user_id").cast("string") == F.col("uk"))
             .join(c.codes, "movie_id"))
    tuple_text(coded, ["uc", "movie_code", "user_rating"]).write.text(f"{root}/train_data")
    train = coded.select(F.col("uc").alias("user_id"), "movie_code", "user_rating")
    als.save_model(als.fit_als(train, rank=4, max_iter=3, reg=0.1, seed=1), f"{root}/model")
    names = c.movies_raw.select("movie_id", F.col("movie_name").alias("name"))
    got = jobs.recommend_from_text(spark, f"{root}/userZipCode", f"{root}/itemZipCode",
                                   f"{root}/train_data", f"{root}/model", names, n=10)
    n_users = users.count()
    assert got.count() == 10 * n_users
    assert got.where("item_name is null or user_key is null or rating is null").count() == 0
    seen = coded.select(F.col("user_id").cast("string").alias("user_key"),
                        F.col("movie_id").cast("string").alias("item_key"))
    assert got.join(seen, ["user_key", "item_key"], "left_semi").count() == 0
