"""Best neighbours summed in numpy against the pairs summed by Spark."""

import random

import numpy as np
import pytest

from reelstats.operators import itemcf, nearest

SCHEMA = "user_id int, movie_id int, user_rating double"


def lists_of(df):
    return sorted((r.seed, r.names, [x if x is None else round(x, 12) for x in r.sims]) for r in df.collect())


def both_ways(spark, rows, k, schema=SCHEMA, chunk=itemcf.DEFAULT_CHUNK, **options):
    train = spark.createDataFrame(rows, schema)
    rounds = list(itemcf.item_similarity_rounds(train, chunk=chunk, nearest=k, round_entries=64, **options))
    got = itemcf.nearest_lists(iter(rounds), k)
    want = itemcf.neighbour_lists(itemcf.item_neighbours(itemcf.item_similarity(train, chunk=chunk, **options), k))
    return rounds, lists_of(got), lists_of(want)


def ratings(seed, users=50, items=30):
    rng = random.Random(seed)
    rows = [(u, i, float(rng.randrange(1, 6))) for u in range(users) for i in rng.sample(range(items), rng.randrange(1, 12))]
    rows += [rng.choice(rows) for _ in range(20)] + [(5, 3, 2.5), (5, 3, 4.0)]
    return rows + [(u, 7, 3.0) for u in range(1, 900, 3)]  # one item holds most ratings


@pytest.mark.parametrize("k,chunk,mean_key,at_once", [
    (2, 6, "item", 8), (3, 2048, "user", 8), (3, 2048, "item", 1 << 20), (40, 6, "item", 1 << 20)])
def test_lists_equal_those_of_summed_pairs(spark, monkeypatch, k, chunk, mean_key, at_once):
    monkeypatch.setattr(nearest, "AT_ONCE", at_once)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        rounds, got, want = both_ways(spark, ratings(k), k, chunk=chunk, mean_key=mean_key)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len(rounds) > 1


def test_a_pair_never_becomes_a_row(spark):
    rows = [(u, i, float(1 + (u + i) % 5)) for u in range(40) for i in range(30)]
    rounds, got, want = both_ways(spark, rows, 4)
    assert got == want
    for one in rounds:
        plan = one._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "inline" not in plan.split("MapInArrow")[1]


def test_nulls_and_wide_ids(spark):
    rows = [(u, i * (1 << 58) - (1 << 60), None if (u + i) % 4 == 0 else float(u % 5)) for u in range(1, 20)
            for i in range(8) if (u * i) % 3 < 2]
    rows += [(None, 1, 2.0), (3, None, 2.0), (50, 11, None), (50, 12, None), (51, 11, None), (51, 13, 4.0)]
    _, got, want = both_ways(spark, rows, 3, "user_id int, movie_id long, user_rating double")
    assert got == want
    assert any(None in sims for _, _, sims in got)  # pairs without any rating


def test_other_types_are_summed_by_spark(spark):
    rows = [(u, f"m{i}", float(1 + (u * i) % 5)) for u in range(12) for i in range(u % 4, 9)]
    rounds, got, want = both_ways(spark, rows, 3, "user_id int, movie_id string, user_rating double")
    assert got == want
    assert not any("MapInArrow" in r._jdf.queryExecution().optimizedPlan().toString() for r in rounds)


def test_means_that_add_up_to_zero_fail_as_the_division_does(spark):
    rows = [(u, i, 2.0 if i == 1 else -2.0) for u in (1, 2) for i in (1, 2)]
    train = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception):  # noqa: B017 - the division by zero of a task
        itemcf.nearest_lists(itemcf.item_similarity_rounds(train, nearest=2), 2)
    pairs = tuple(np.array(x) for x in ([1], [2.0], [2], [4.0], [-2.0]))
    assert np.isnan(nearest.best(pairs, 2, False)[2]).all()


def test_neighbours_come_from_rounds(spark):
    train = spark.createDataFrame(ratings(9), SCHEMA)
    got = itemcf.nearest_neighbours(train, 4, chunk=6)
    want = itemcf.item_neighbours(itemcf.item_similarity(train, chunk=6), 4)
    assert got.dtypes == want.dtypes

    def rows(df): return sorted((r.item, r.rank, r.neighbour, round(r.sim, 12)) for r in df.collect())
    assert rows(got) == rows(want)


def test_wanted_items_meet_every_other(spark):
    train = spark.createDataFrame(ratings(10), SCHEMA)
    wanted = spark.createDataFrame([(3,), (7,), (7,), (11,), (999,)], "item int")
    for chunk in (6, 2048):
        rounds = itemcf.item_similarity_rounds(train, chunk=chunk, nearest=5, wanted=wanted)
        some = lists_of(itemcf.nearest_lists(rounds, 5))
        every = lists_of(itemcf.nearest_lists(itemcf.item_similarity_rounds(train, chunk=chunk, nearest=5), 5))
        assert some == [x for x in every if x[0] in (3, 7, 11)] and len(some) == 3


def test_queries_of_nearest_lists_shuffle_no_whole_similarity(spark, monkeypatch):
    from reelstats.plans.catalog import QUERIES

    def refused(*args, **options):
        raise AssertionError("the whole similarity in one shuffle")
    monkeypatch.setattr(itemcf, "item_similarity", refused)
    for name in ("item_neighbours", "item_cf_unseen_first"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("at_once,cell_rows", [(16, 50), (1 << 20, 50), (64, 1 << 22)])
def test_candidate_totals_equal_those_summed_by_spark(spark, monkeypatch, at_once, cell_rows):
    monkeypatch.setattr(nearest, "AT_ONCE", at_once)
    train = spark.createDataFrame(ratings(11) + [(5, 3, 2.5)] * 3 + [(None, 4, 2.0), (60, 77, None), (60, 78, None)], SCHEMA)
    near = itemcf.item_neighbours(itemcf.item_similarity(train)).localCheckpoint()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = itemcf.candidate_totals(train, near, cell_rows=cell_rows)
        assert "MapInArrow" in got._jdf.queryExecution().optimizedPlan().toString()
        rows = [tuple(r) for r in got.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    text = train.withColumn("user_id", train.user_id.cast("string"))  # summed by Spark
    plain = itemcf.candidate_totals(text, near, cell_rows=cell_rows)
    want = plain.withColumn("user_id", plain.user_id.cast("int"))
    assert got.dtypes == want.dtypes

    def key(r): return (r[0], r[1])
    assert sorted(rows, key=key) == sorted(map(tuple, want.collect()), key=key)
    assert len(rows) > 300
