"""Pruned neighbour lists against all pairs: ties, copies, several heavy users, open bounds."""

import random

import pytest
from pyspark.sql import functions as F

from reelstats.operators import itemcf, neighbours


def ratings(spark, seed, heavy=3, items=120, copies=True):
    rng = random.Random(seed)
    rows = []
    for u in range(1, 60):
        for i in rng.sample(range(items), rng.randrange(2, 9)):
            rows += [(u, i, float(rng.randrange(1, 6)))] * (rng.randrange(1, 3) if copies else 1)
    for h in range(heavy):
        for i in rng.sample(range(items + 30), rng.randrange(40, items)):
            rows += [(1000 + h, i, float(rng.randrange(1, 6)))] * (rng.randrange(1, 3) if copies else 1)
    return spark.createDataFrame(rows, "user_id int, movie_id int, user_rating double")


def rows_of(df):
    return sorted((r["item"], r["rank"], r["neighbour"], round(r["sim"], 12)) for r in df.collect())


@pytest.mark.parametrize("seed,heavy,k", [(1, 1, 3), (2, 3, 5), (3, 0, 4), (4, 2, 200)])
@pytest.mark.parametrize("mean_key", ["item", "user"])
def test_lists_equal_those_of_all_pairs(spark, seed, heavy, k, mean_key):
    train = ratings(spark, seed, heavy)
    want = itemcf.item_neighbours(itemcf.item_similarity(train, mean_key=mean_key), k)
    got = neighbours.pruned_neighbours(train, k, mean_key=mean_key, chunk=12)
    assert rows_of(got) == rows_of(want)


def test_whole_number_ties_stay_in_order(spark):
    rows = [(u, i, 3.0) for u in range(1, 30) for i in (u, u + 1, u + 2)] + [(99, i, 3.0) for i in range(1, 200)]
    train = spark.createDataFrame(rows, "user_id int, movie_id int, user_rating double")
    want = itemcf.item_neighbours(itemcf.item_similarity(train), 4)
    assert rows_of(neighbours.pruned_neighbours(train, 4, chunk=50)) == rows_of(want)


def test_negative_ratings_are_not_pruned(spark):
    train = ratings(spark, 5).withColumn("user_rating", F.col("user_rating") - 2.3)
    want = itemcf.item_neighbours(itemcf.item_similarity(train), 3)
    out, formed = neighbours.pruned(train, 3, chunk=12)
    assert formed is None and rows_of(out) == rows_of(want)


def test_most_pairs_of_a_heavy_user_are_never_formed(spark):
    """Clusters of ten movies with one to four users each; one user more has rated all 200 movies."""
    rows = [(10 * c + u, 10 * c + i, float(3 + (i + u) % 3)) for c in range(20) for u in range(1 + c % 4) for i in range(10)]
    rows += [(9999, i, float(1 + i % 5)) for i in range(200)]
    train = spark.createDataFrame(rows, "user_id int, movie_id int, user_rating double")
    out, formed = neighbours.pruned(train, 5, chunk=50)
    assert rows_of(out) == rows_of(itemcf.item_neighbours(itemcf.item_similarity(train), 5))
    assert 0 < formed.count() < 0.15 * 200 * 199


def test_pairs_of_a_heavy_user_grow_with_the_history_alone(spark):
    """Every pair of the heavy user ties with the bound: k + 1 partners of each rating are formed, not all."""
    rows = [(2 * i + d, x, 3.0) for i in range(0, 240, 4) for d in (0, 1) for x in range(i, i + 4)]
    rows += [(9999, i, float(3 + i % 2)) for i in range(240)]
    train = spark.createDataFrame(rows, "user_id int, movie_id int, user_rating double")
    for k in (1, 4):
        out, formed = neighbours.pruned(train, k, chunk=50)
        assert rows_of(out) == rows_of(itemcf.item_neighbours(itemcf.item_similarity(train), k))
        assert formed.count() <= 240 * 2 * (k + 1)


def test_light_pairs_are_not_written_whole(spark, monkeypatch):
    train = ratings(spark, 6, heavy=1, items=60).where("user_id < 1000 or movie_id < 40")
    plain, written = neighbours.materialize, {}

    def watched(df, name, *args):
        written[name] = plain(df, name, *args)
        return written[name]
    monkeypatch.setattr(neighbours, "materialize", watched)
    out = neighbours.pruned_neighbours(train, 3, chunk=9)
    want = itemcf.item_neighbours(itemcf.item_similarity(train), 3)
    assert rows_of(out) == rows_of(want)
    assert "light-pairs" not in written
    heavy_items = {r.i for r in written["item-bounds"].collect()}
    assert {x for r in written["lifted-pairs"].collect() for x in (r.a, r.b)} <= heavy_items


@pytest.mark.parametrize("odd", [0.0, None])
def test_ratings_of_nothing_are_not_pruned(spark, odd):
    train = ratings(spark, 7).union(spark.createDataFrame([(1000, i, odd) for i in range(200, 215)],
                                                          "user_id int, movie_id int, user_rating double"))
    train = train.union(spark.createDataFrame([(2000, i, 2.0) for i in range(200, 215)], train.schema))  # a mean
    want = itemcf.item_neighbours(itemcf.item_similarity(train), 3)
    out, formed = neighbours.pruned(train, 3, chunk=12)
    assert formed is None and rows_of(out) == rows_of(want)
