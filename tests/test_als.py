"""ALS invariants on a planted low-rank matrix (no exact oracle: random init)."""

import random
import time

import pytest
from pyspark.sql import functions as F

from reelstats.operators import als, evaluate
from reelstats.session import free_unused, scratch_path

SCHEMA = "user_id int, movie_code int, user_rating double"


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(7)
    users = {u: (rnd.uniform(0.5, 1.5), rnd.uniform(0.5, 1.5)) for u in range(1, 41)}
    items = {i: (rnd.uniform(0.5, 1.5), rnd.uniform(0.5, 1.5)) for i in range(1, 31)}
    rows = [(u, i, 1.0 + 2.0 * (a * c + b * d) / 2.25)
            for u, (a, b) in users.items() for i, (c, d) in items.items() if rnd.random() < 0.6]
    df = spark.createDataFrame(rows, SCHEMA)
    train = df.where((F.col("user_id") + F.col("movie_code")) % 5 != 0)
    check = df.where((F.col("user_id") + F.col("movie_code")) % 5 == 0)
    return train, check


def test_als_beats_item_mean_on_planted_rank2(spark, planted):
    train, check = planted
    model = als.fit_als(train, rank=2, max_iter=15, reg=0.01, seed=3)
    got = evaluate.rmse(als.predict(model, check)).first().rmse
    base = evaluate.rmse(evaluate.item_mean_predictions(
        train, check, item_col="movie_code")).first().rmse
    assert got < base and got < 0.2


def test_unknown_user_dropped(spark, planted):
    train, _ = planted
    model = als.fit_als(train, rank=2, max_iter=5, reg=0.1, seed=3)
    probe = spark.createDataFrame([(1, 1, 3.0), (12345, 1, 3.0)], SCHEMA)
    assert [r.user_id for r in als.predict(model, probe).collect()] == [1]


def test_same_seed_same_model(spark, planted):
    train, check = planted
    a = als.fit_als(train, rank=3, max_iter=5, reg=0.1, seed=11)
    b = als.fit_als(train, rank=3, max_iter=5, reg=0.1, seed=11)
    ra = evaluate.rmse(als.predict(a, check)).first().rmse
    rb = evaluate.rmse(als.predict(b, check)).first().rmse
    assert ra == pytest.approx(rb, rel=1e-9)


def test_recommend_unseen_invariants(spark, planted):
    train, _ = planted
    model = als.fit_als(train, rank=2, max_iter=5, reg=0.1, seed=3)
    users = train.select("user_id").distinct()
    recs = als.recommend_unseen(model, train, users, 5)
    assert recs.join(train, ["user_id", "movie_code"], "left_semi").count() == 0
    per_user = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.max("rank").alias("m"))
    assert per_user.where("n != 5 or m != 5").count() == 0
    assert per_user.count() == users.count()
    # a user who has seen all items but three gets those three, everybody else's list stays
    heavy = spark.createDataFrame([(2, i, 3.0) for i in range(1, 28)], "user_id int, movie_code int, user_rating double")
    again = als.recommend_unseen(model, train.select("user_id", "movie_code", "user_rating").unionByName(heavy), users, 5)
    assert {r.movie_code for r in again.where("user_id = 2").collect()} <= {28, 29, 30}
    assert sorted(map(tuple, again.where("user_id <> 2").collect())) == sorted(map(tuple, recs.where("user_id <> 2").collect()))
    # exactness: equals ranking every unseen item directly
    u = 1
    seen = {r.movie_code for r in train.where(f"user_id = {u}").collect()}
    cand = spark.createDataFrame([(u, i) for i in range(1, 31) if i not in seen],
                                 "user_id int, movie_code int")
    scored = sorted(((-r.prediction, r.movie_code) for r in als.predict(model, cand).collect()))
    want = [i for _, i in scored[:5]]
    got = [r.movie_code for r in als.recommend_unseen(model, train, users, 5)
           .where(f"user_id = {u}").orderBy("rank").collect()]
    assert got == want


def test_grid_search_and_best(spark, planted):
    train, check = planted
    grid = als.grid_search(train, check, ranks=(1, 2), regs=(0.01, 5.0), iters=(3,), seed=3)
    rows = grid.orderBy("order").collect()
    assert [(r.rank, r.reg) for r in rows] == [(1, 0.01), (1, 5.0), (2, 0.01), (2, 5.0)]
    best = als.best_params(grid).first()
    assert best.rmse == min(r.rmse for r in rows)


def test_best_params_first_wins_on_tie(spark):
    grid = spark.createDataFrame([(0, 10, 10, 0.1, 1.0), (1, 20, 10, 0.1, 1.0), (2, 30, 10, 0.1, 2.0)],
                                 "order int, rank int, max_iter int, reg double, rmse double")
    assert als.best_params(grid).first().rank == 10


def test_model_save_load(spark, planted):
    train, check = planted
    model = als.fit_als(train, rank=2, max_iter=3, reg=0.1, seed=3)
    path = scratch_path(spark, "als-model")
    als.save_model(model, path)
    again = als.load_model(path)
    a = sorted((r.user_id, r.movie_code, r.prediction) for r in als.predict(model, check).collect())
    b = sorted((r.user_id, r.movie_code, r.prediction) for r in als.predict(again, check).collect())
    assert a == b


def test_parallel_grid_equals_sequential(spark, planted):
    train, check = planted
    kw = dict(ranks=(1, 2), regs=(0.1,), iters=(2, 3), seed=5)
    a = als.grid_search(train, check, parallelism=1, **kw).orderBy("order").collect()
    b = als.grid_search(train, check, parallelism=3, **kw).orderBy("order").collect()
    assert [tuple(r)[:4] for r in a] == [tuple(r)[:4] for r in b]
    # the error is an average of partial sums, whose order is not fixed
    assert [r.rmse for r in a] == pytest.approx([r.rmse for r in b], rel=1e-12)


def shuffles(spark):
    """Shuffles that Spark holds files of."""
    return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


def test_shuffles_of_past_steps_are_deleted(spark, planted):
    train, _ = planted
    train = train.localCheckpoint()
    free_unused(spark)
    time.sleep(2)
    before = shuffles(spark)
    model = als.fit_als(train, rank=2, max_iter=9, reg=0.1, seed=3)
    for _ in range(40):  # deleted by a thread of its own
        if shuffles(spark) - before <= 8:
            break
        time.sleep(0.25)
    assert shuffles(spark) - before <= 8  # not two for each of nine steps
    assert model.rank == 2


def test_grid_keeps_one_stored_model_and_frees_the_fits(spark, planted, monkeypatch):
    train, check = planted
    running, most, fit = [], [], als.fit_als

    def counted(*a, **k):
        running.append(1)
        most.append(len(running))
        try:
            return fit(*a, **k)
        finally:
            running.pop()

    monkeypatch.setattr(als, "fit_als", counted)
    monkeypatch.setattr(als, "FITS_AT_ONCE", train.count())
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    grid, model = als.grid_fit(train, check, ranks=(1, 2), regs=(0.01, 5.0), iters=(2, 3), seed=3, parallelism=4)
    assert max(most) == 1  # one fit's ratings at a time
    best = als.best_params(grid).first()
    assert model.rank == best["rank"]
    assert evaluate.rmse(als.predict(model, check)).first().rmse == pytest.approx(best.rmse, rel=1e-12)
    for _ in range(40):
        free_unused(spark)
        if spark.sparkContext._jsc.getPersistentRDDs().size() <= cached:
            break
        time.sleep(0.25)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached  # no factors of the eight fits
