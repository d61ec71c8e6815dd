"""Mergeable distinct sketches, key bitmaps and step counts."""

import random

from pyspark.sql import functions as F

from reelstats.operators import bitmaps, clean, profile, sketches
from reelstats.session import materialize


def test_merged_sketches_count_the_union(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 7_000).cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900).cast("int").alias("movie_id"),
        (F.col("id") % 12 * 2_700_000).cast("string").alias("time_stamp"))
    cols = ["user_id", "movie_id"]
    months = sketches.monthly_sketches(rows, cols)
    assert months.count() == 12
    got = {r.metric: r.estimate for r in sketches.estimates(sketches.merged(months, cols), cols).collect()}
    for c in cols:
        exact = rows.select(c).distinct().count()
        assert abs(got[c] - exact) <= 0.05 * exact
    one = sketches.merged(months, cols, ["year_month"])
    direct = {(r.year_month, r.metric): r.estimate for r in sketches.estimates(months, cols, ["year_month"]).collect()}
    again = {(r.year_month, r.metric): r.estimate for r in sketches.estimates(one, cols, ["year_month"]).collect()}
    assert all(abs(direct[k] - again[k]) <= 0.02 * direct[k] for k in direct)


def test_row_sketch_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "a int, b string")
    row = sketches.row_sketch(df).first()
    assert (row.n_rows, row.n_distinct) == (4, 3)
    assert sketches.row_sketch(df.where("false")).first().n_distinct == 0


def test_bitmaps_are_sets(spark):
    rng = random.Random(3)
    a = [rng.choice([rng.randrange(1, 200_000), rng.randrange(1, 50), 32_768, 32_769]) for _ in range(3_000)]
    b = [rng.choice(a) if rng.random() < 0.3 else rng.randrange(1, 300_000) for _ in range(2_000)]
    da, db = (spark.createDataFrame([(k,) for k in x] + [(None,)], "k int") for x in (a, b))
    ba, bb = bitmaps.key_bitmaps(da, "k"), bitmaps.key_bitmaps(db, "k")
    assert {r.k for r in bitmaps.members(ba, "k").collect()} == set(a)
    assert bitmaps.members(ba, "k").count() == len(set(a))
    assert bitmaps.sizes(bitmaps.union(ba, bb)).first().n == len(set(a) | set(b))
    assert bitmaps.sizes(bitmaps.intersect(ba, bb)).first().n == len(set(a) & set(b))
    assert {r.k for r in bitmaps.shared_keys(da, db, "k").collect()} == set(a) & set(b)
    assert bitmaps.sizes(bitmaps.intersect(ba, bb.where("false"))).first().n == 0


def test_a_hot_group_is_one_bitmap_a_bucket(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).cast("int").alias("u"),
        (F.col("id") % 1_000 + 1).cast("int").alias("k"))
    by_user = bitmaps.key_bitmaps(rows, "k", ["u"])
    assert by_user.count() == rows.select("u").distinct().count()
    want = {r.u: r.n for r in rows.groupBy("u").agg(F.count_distinct("k").alias("n")).collect()}
    assert {r.u: r.n for r in bitmaps.sizes(by_user, ["u"]).collect()} == want
    unseen = {r.u: r.n_unseen for r in bitmaps.unseen_counts(rows, "u", "k").collect()}
    assert unseen == {u: 1_000 - n for u, n in want.items()}


def test_steps_are_counted_by_the_pass_that_writes(spark):
    movies = spark.createDataFrame(
        [("1", "编剧:a", "主演:b"), ("1", "编剧:a", "主演:b"), ("2", None, "x:y"), (None, None, None), (None, None, None)],
        "movie_id string, movie_writer string, movie_starring string")
    df, counts = clean.counted_clean(movies, "movies", "all", clean.clean_movie_labels)
    seen = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one write")
    try:
        stored = materialize(df, "counted")
        seen = counts.rows()
        jobs = len(tracker.getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen == [("movies", "raw", 5, 3, 2, 3), ("movies", "deduped", 3, 2, 1, 2),
                    ("movies", "complete", 2, 1, 0, 2), ("movies", "cleaned", 2, 1, 0, 1)]
    assert stored.count() == 2 and jobs <= 3  # the shuffle and the write under adaptive execution, the footers of what is read back
    steps = spark.createDataFrame(seen, clean.STEP_COUNTS)
    got = profile.from_steps(steps).first().asDict()
    want = profile.profile_table(movies, "movies").first().asDict()
    assert got == {k: want[k] for k in got} and set(got) == set(want)


def test_raw_rows_are_counted_as_copies_after_the_shuffle(spark):
    schema = "user_id string, movie_id string, user_tag string"
    rows = [("1", "2", "a:b")] * 3 + [("1", None, "c")] * 2 + [(None, None, None)] * 4 + [("2", "2", "a")]
    df, counts = clean.counted_clean(spark.createDataFrame(rows, schema).repartition(3), "tags", "any")
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    metrics = [i for i, line in enumerate(plan) if "CollectMetrics" in line]
    shuffle = min(i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert len(metrics) == 1 and metrics[0] < shuffle  # one counter, above the shuffle
    assert sorted(map(tuple, materialize(df, "counted").collect())) == [("1", "2", "a:b"), ("2", "2", "a")]
    assert counts.rows() == [("tags", "raw", 10, 6, 4, 3), ("tags", "deduped", 4, 2, 1, 1), ("tags", "complete", 2, 0, 0, 1)]
    df, counts = clean.counted_clean(spark.createDataFrame([], schema), "tags")
    materialize(df, "counted")
    assert counts.rows() == [("tags", step, 0, 0, 0, 0) for step in ("raw", "deduped", "complete")]


def test_bitmaps_are_neither_sorted_nor_shuffled_to_be_built(spark):
    df = spark.createDataFrame([(i % 50, i % 7) for i in range(400)] + [(1, None), (None, 2)], "g int, k int")
    sets = bitmaps.sizes(bitmaps.key_bitmaps(df, "k", ["g"]), ["g"], "n")
    plan = sets._jdf.queryExecution().executedPlan().toString().splitlines()
    built = max(i for i, line in enumerate(plan) if "bitmap_construct_agg" in line)  # the lowest: reads the keys
    above = [line for line in plan[:built] if "Sort [" in line or "Exchange" in line]
    assert not [line for line in above if "bitmap" in line] and len([x for x in above if "Sort [" in x]) == 0
    assert {r.g: r.n for r in sets.collect()} == {**{g: 7 for g in range(50)}, None: 1}
