"""Item-CF: hand-computed case, brute force, salting and pruning equivalences."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from reelstats.operators import itemcf
from reelstats.operators.stats import top_n_per_group

SCHEMA = "user_id int, movie_id int, user_rating double"


def hand_frame(spark):
    rows = [(1, 1, 5.0), (1, 2, 3.0), (2, 1, 4.0), (2, 2, 4.0), (2, 3, 2.0), (3, 2, 1.0), (3, 3, 5.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_hand_similarities(spark):
    sim = {(r.item_a, r.item_b): r.sim for r in itemcf.item_similarity(hand_frame(spark)).collect()}
    assert sim[(1, 2)] == pytest.approx(7 / (4.5 + 8 / 3))
    assert sim[(1, 3)] == pytest.approx(2 / (4.5 + 3.5))
    assert sim[(2, 3)] == pytest.approx(3 / (8 / 3 + 3.5))
    assert len(sim) == 3


def test_hand_candidates_tie_and_two_seeds(spark):
    train = hand_frame(spark)
    top = itemcf.item_cf_recommend(train, 30).where("user_id = 3").orderBy("rank").collect()
    assert [(r.movie_id, r.seed) for r in top] == [(1, 2), (2, 3), (3, 2), (1, 3)]
    dedup = itemcf.item_cf_recommend(train, 30, dedupe=True).where("user_id = 3").orderBy("rank").collect()
    assert [(r.movie_id, r.seed) for r in dedup] == [(1, 2), (2, 3), (3, 2)]
    unseen = itemcf.remove_seen(itemcf.item_cf_recommend(train, 30), train, 20)
    got = unseen.where("user_id = 3").orderBy("rank").collect()
    assert [(r.rank, r.movie_id, r.seed) for r in got] == [(1, 1, 2), (2, 1, 3)]


def test_seen_multiset_keeps_extra_copies(spark):
    recs = spark.createDataFrame([(1, 1, 7), (1, 2, 7), (1, 3, 7)], "user_id int, rank int, movie_id int")
    seen = spark.createDataFrame([(1, 7, 5.0)], SCHEMA)
    assert itemcf.seen_multiset_diff(recs, seen).count() == 2


def random_ratings(seed, n_users=25, n_items=18, heavy=True):
    rnd = random.Random(seed)
    rows = []
    for u in range(1, n_users + 1):
        items = rnd.sample(range(1, n_items + 1), rnd.randint(1, 7))
        for i in items:
            rows.append((u, i, float(rnd.randint(1, 5))))
            if rnd.random() < 0.1:  # repeated rating of the same item
                rows.append((u, i, float(rnd.randint(1, 5))))
    if heavy:  # one user holding a large share of the rows, with repeats
        for i in range(1, n_items + 1):
            rows.append((999, i, float(rnd.randint(1, 5))))
            rows.append((999, i, float(rnd.randint(1, 5))))
    return rows


def brute_similarity(rows):
    by_user, by_item = defaultdict(list), defaultdict(list)
    for u, i, r in rows:
        by_user[u].append((i, r))
        by_item[i].append(Fraction(r))
    mean = {i: sum(v) / len(v) for i, v in by_item.items()}
    s = defaultdict(Fraction)
    for lst in by_user.values():
        for ia, ra in lst:
            for ib, rb in lst:
                if ia < ib:
                    s[(ia, ib)] += Fraction(min(ra, rb))
    return {k: v / (mean[k[0]] + mean[k[1]]) for k, v in s.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_salted_pairs_equal_plain(spark, seed):
    df = spark.createDataFrame(random_ratings(seed), SCHEMA)
    small = {tuple(r[:2]): (r.s, r.n_common) for r in itemcf.co_rating_sums(df, chunk=3).collect()}
    big = {tuple(r[:2]): (r.s, r.n_common) for r in itemcf.co_rating_sums(df, chunk=10**6).collect()}
    assert small == big


@pytest.mark.parametrize("seed", [3, 4])
def test_similarity_matches_brute_force(spark, seed):
    rows = random_ratings(seed)
    want = brute_similarity(rows)
    got = {(r.item_a, r.item_b): r.sim
           for r in itemcf.item_similarity(spark.createDataFrame(rows, SCHEMA), chunk=4).collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(float(v), rel=1e-12)


@pytest.mark.parametrize("n", [3, 5])
def test_pruned_neighbours_equal_full_lists(spark, n):
    train = spark.createDataFrame(random_ratings(5), SCHEMA)
    sim = itemcf.item_similarity(train)
    pruned = itemcf.item_cf_recommend(train, n, similarity=sim)
    cand = itemcf.item_cf_candidates(train, itemcf.item_neighbours(sim, None))
    full = top_n_per_group(cand, ["user_id"], [F.desc("sim"), F.asc("movie_id"), F.asc("seed")], n) \
        .select("user_id", "rank", "movie_id", "seed", "sim")
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, full.collect()))
    dedup = itemcf.item_cf_recommend(train, n, dedupe=True, similarity=sim)
    best = cand.groupBy("user_id", "movie_id").agg(F.max("sim").alias("sim"))
    want = top_n_per_group(best, ["user_id"], [F.desc("sim"), F.asc("movie_id")], n)
    assert sorted((r.user_id, r.rank, r.movie_id, r.sim) for r in dedup.collect()) == \
        sorted((r.user_id, r.rank, r.movie_id, r.sim) for r in want.collect())


def test_mixed_mean_key_drops_unmatched_items(spark):
    train = hand_frame(spark)
    # user ids 1..3 double as item ids 1..3, so every item finds a 'mean'
    sim = itemcf.item_similarity(train, mean_key="user").collect()
    assert len(sim) == 3
    extra = train.unionByName(spark.createDataFrame([(1, 50, 2.0), (2, 50, 3.0)], SCHEMA))
    ids = {r.item_b for r in itemcf.item_similarity(extra, mean_key="user").collect()}
    assert 50 not in ids


def test_item_lists_round_trip(spark):
    recs = itemcf.item_cf_recommend(hand_frame(spark), 30)
    lists = itemcf.to_item_lists(recs)
    back = itemcf.explode_item_lists(lists)
    assert sorted(map(tuple, back.collect())) == \
        sorted(map(tuple, recs.select("user_id", "rank", "movie_id").collect()))


def test_users_min_rated(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0)], SCHEMA)
    assert {r.user_id for r in itemcf.users_min_rated(df, 2).collect()} == {1}
    assert itemcf.users_min_rated(df, 1).count() == 3


def test_copies_weighted_equal_row_by_row(spark):
    rnd = random.Random(11)
    rows = []
    for u in range(1, 12):
        for i in rnd.sample(range(1, 10), 4):
            r = float(rnd.randint(1, 5))
            rows += [(u, i, r)] * rnd.choice([1, 1, 3, 6])   # groups of copies
    rows += [(50, i, 4.0) for i in range(1, 10) for _ in range(20)]  # one user of copies
    train = spark.createDataFrame(rows, SCHEMA)
    want = brute_similarity(rows)
    sim = itemcf.item_similarity(train, chunk=3)
    got = {(r.item_a, r.item_b): r.sim for r in sim.collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(float(v), rel=1e-12)
    # row-by-row candidates (no weights) ranked directly
    nb = itemcf.item_neighbours(sim, 5).select(F.col("item").alias("seed"),
                                                F.col("neighbour").alias("movie_id"), "sim")
    plain = train.select("user_id", F.col("movie_id").alias("seed")).join(nb, "seed")
    want_top = top_n_per_group(plain, ["user_id"], [F.desc("sim"), F.asc("movie_id"), F.asc("seed")], 5)
    got_top = itemcf.item_cf_recommend(train, 5, similarity=sim)
    cols = ["user_id", "rank", "movie_id", "seed", "sim"]
    assert sorted(map(tuple, got_top.select(cols).collect())) == \
        sorted(map(tuple, want_top.select(cols).collect()))


def test_user_subset_equals_filtered_full_result(spark):
    train = spark.createDataFrame(random_ratings(9), SCHEMA)
    sim = itemcf.item_similarity(train)
    users = spark.createDataFrame([(1,), (7,), (999,)], "user_id int")
    sub = itemcf.item_cf_recommend(train, 10, similarity=sim, users=users)
    full = itemcf.item_cf_recommend(train, 10, similarity=sim).where("user_id in (1, 7, 999)")
    assert sorted(map(tuple, sub.collect())) == sorted(map(tuple, full.collect()))


@pytest.mark.parametrize("heavy", [False, True])
def test_unseen_first_equals_brute_force(spark, heavy):
    rows = random_ratings(13)
    if heavy:  # one user has rated nearly every item
        items = sorted({r[1] for r in rows})
        rows = [r for r in rows if r[0] != 1] + [(1, i, 3.0) for i in items[:-2]]
    train = spark.createDataFrame(rows, SCHEMA)
    sim = itemcf.item_similarity(train)
    got = itemcf.recommend_unseen_first(train, 4, similarity=sim)
    # unpruned: every neighbour of every rated row, seen items removed, then the top 4
    cand = itemcf.item_cf_candidates(train, itemcf.item_neighbours(sim, None))
    cand = cand.join(train.select("user_id", "movie_id"), ["user_id", "movie_id"], "left_anti")
    want = top_n_per_group(cand, ["user_id"], [F.desc("sim"), F.asc("movie_id"), F.asc("seed")], 4)
    cols = ["user_id", "rank", "movie_id", "seed", "sim"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_similarity_properties(spark):
    train = spark.createDataFrame(random_ratings(21), SCHEMA)
    sim = itemcf.item_similarity(train)
    assert sim.where("item_a >= item_b or sim <= 0 or sim is null").count() == 0
    nb = {(r.item, r.neighbour): r.sim for r in itemcf.item_neighbours(sim).collect()}
    assert all(nb[(b, a)] == s for (a, b), s in nb.items())
    # n_common equals the number of co-rating row pairs
    rows = random_ratings(21)
    by_user = {}
    for u, i, _ in rows:
        by_user.setdefault(u, []).append(i)
    want = {}
    for items in by_user.values():
        for a in items:
            for b in items:
                if a < b:
                    want[(a, b)] = want.get((a, b), 0) + 1
    got = {(r.item_a, r.item_b): r.n_common for r in itemcf.co_rating_sums(train, chunk=5).collect()}
    assert got == want


def _above_lists(df):
    """The plan above the point where lists unfold to pairs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("inline(")]


def test_pairs_are_not_shuffled_after_they_unfold(spark):
    rng = random.Random(4)
    train = spark.createDataFrame([(u, i, float(rng.randint(1, 5))) for u in range(30) for i in rng.sample(range(40), 9)],
                                  SCHEMA)
    for df in (itemcf.item_similarity(train), itemcf.item_similarity(train, chunk=3), itemcf.co_rating_sums(train)):
        above = _above_lists(df)
        assert "Exchange" not in above and "Join" not in above


def test_lists_of_a_frequent_item_are_dealt_and_copies_weigh(spark):
    rng = random.Random(8)
    rows = [(u, i, float(rng.randint(1, 5))) for u in range(80)
            for i in [0] * 8 + rng.sample(range(1, 60), 6)]
    rows += rows[:40] + [(0, 0, 2.0), (None, 3, 1.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert itemcf.hot_keys(df.select("movie_id"), "movie_id")
    want = {}
    for u in range(80):
        mine = [(i, r) for v, i, r in rows if v == u and i is not None]
        for a, ra in mine:
            for b, rb in mine:
                if a < b:
                    s, n = want.get((a, b), (0.0, 0))
                    want[a, b] = (s + min(ra, rb), n + 1)
    for chunk in (3, 10**6):
        got = itemcf.co_rating_sums(df, chunk=chunk).collect()
        assert len(got) == len(want) and {(x.item_a, x.item_b): (x.s, x.n_common) for x in got} == want


def test_tasks_grow_with_the_rows_that_lists_make(spark):
    assert itemcf.tasks_for(spark.range(1), 10) == 4
    assert itemcf.tasks_for(spark.range(1), 100 * itemcf.TASK_ROWS + 1) == 101
    df = spark.createDataFrame([(1, i, 1.0) for i in range(5)] + [(2, 1, 1.0), (None, 1, 1.0)], SCHEMA)
    assert itemcf.pair_work(df, "user_id") == (5, 10)


@pytest.mark.parametrize("seed", [5, 6])
def test_held_back_neighbours_keep_every_list(spark, seed):
    rows = random_ratings(seed, n_users=60, n_items=30)
    train = spark.createDataFrame(rows + [(u, 1000, 3.0) for u in range(1, 9)], SCHEMA)  # only ever item_b
    sim = itemcf.item_similarity(train)
    items = train.select(F.col("movie_id").alias("item"))
    cols = ["item", "neighbour", "rank"]
    for k in (1, 4, 40):
        plain = sorted(map(tuple, itemcf.item_neighbours(sim, k).select(*cols).collect()))
        held = itemcf.item_neighbours(sim, k, items)
        assert sorted(map(tuple, held.select(*cols).collect())) == plain
    floors, _ = itemcf.kth_floors(sim, 4, items.distinct())
    known = [x for x in spark.range(1).select(floors.alias("f")).first()["f"] if x > float("-inf")]
    assert len(known) > 5


@pytest.mark.parametrize("dedupe", [False, True])
def test_only_candidates_that_reach_the_bound_are_sent(spark, dedupe):
    n = 5
    # sums of 2 to 40 common users: similarities differ widely within a list
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(1, 120) for i in range(1, 40) if (u * 7 + i * i) % 11 < 4]
    rows += [(500, 1, 4.0), (500, 1, 4.0), (501, 2, 1.0)]
    train = spark.createDataFrame(rows, SCHEMA)
    sim = itemcf.item_similarity(train)
    nb = itemcf.item_neighbours(sim, n)
    every = itemcf.weighted_candidates(train, nb)
    sent = itemcf.reachable_candidates(train, nb, n, dedupe=dedupe)
    assert 0 < sent.count() < every.count() * 0.8
    assert sent.exceptAll(every.select(*sent.columns)).count() == 0
    order = [F.desc("sim"), F.asc("movie_id"), F.asc("seed")]
    if dedupe:
        def best(df):
            one = df.groupBy("user_id", "movie_id").agg(F.max("sim").alias("sim"))
            return sorted(map(tuple, top_n_per_group(one, ["user_id"], order[:2], n).drop("sim").collect()))
    else:
        def best(df):
            return sorted(map(tuple, top_n_per_group(df, ["user_id"], order, n).drop("sim").collect()))
    assert best(sent) == best(every)


@pytest.mark.parametrize("cell_rows", [40, 1 << 22])
def test_candidate_totals_equal_the_unfolded_candidates(spark, cell_rows):
    rows = random_ratings(8, n_users=40, n_items=25) + [(None, 3, 2.0), (7, None, 2.0)]
    train = spark.createDataFrame(rows, SCHEMA)
    nb = itemcf.item_neighbours(itemcf.item_similarity(train))
    want = itemcf.item_cf_candidates(train, nb).groupBy("user_id", "movie_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("seed").alias("n_seeds"), F.max("sim").alias("best_sim"))
    got = itemcf.candidate_totals(train, nb, cell_rows=cell_rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_unseen_first_writes_no_whole_lists(spark, monkeypatch):
    n, written = 2, []
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(1, 60) for i in range(1, 40) if (u * 7 + i * i) % 11 < 3]
    rows += [(500, i, 3.0) for i in range(1, 30)]  # has seen most neighbours: read on
    train = spark.createDataFrame(rows, SCHEMA)
    plain = itemcf.materialize

    def watched(df, name, *args):
        out = plain(df, name, *args)
        written.append((name, out))
        return out
    monkeypatch.setattr(itemcf, "materialize", watched)
    got = itemcf.recommend_unseen_first(train, n)
    first = next(df for name, df in written if name == "ranked-lists")
    assert first.columns == ["seed", "names", "sims"]
    assert first.agg(F.max(F.size("names"))).first()[0] == 2 * n
    assert sum(name == "ranked-lists" for name, _ in written) > 1
    nb = itemcf.item_neighbours(itemcf.item_similarity(train))
    unseen = itemcf.weighted_candidates(train, nb).join(train.select("user_id", "movie_id"), ["user_id", "movie_id"], "left_anti")
    want = top_n_per_group(unseen, ["user_id"], [F.desc("sim"), F.asc("movie_id"), F.asc("seed")], n)
    cols = ["user_id", "rank", "movie_id", "seed"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


@pytest.mark.parametrize("chunk", [6, itemcf.DEFAULT_CHUNK])
def test_rounds_hold_every_pair_both_ways_once(spark, chunk):
    rows = random_ratings(21, n_users=50, n_items=30)
    rows += [(900, i, float(1 + i % 5)) for i in range(1, 29)] + [(901, 3, 2.0), (901, 3, 5.0), (901, 4, 1.0)] * 2
    rows += [(u, 7, 3.0) for u in range(1, 900, 3)]  # one item holds most ratings
    rows += [(None, 3, 2.0), (7, None, 2.0)]
    train = spark.createDataFrame(rows, SCHEMA)
    sim = itemcf.item_similarity(train)
    want = {(r.item, r.neighbour): r.sim for r in itemcf.item_neighbours(sim).collect()}
    rounds = [r.collect() for r in itemcf.item_similarity_rounds(train, chunk=chunk, round_entries=64)]
    assert len(rounds) > 3
    items = [{r.item_a for r in one} for one in rounds]
    assert sum(map(len, items)) == len(set().union(*items))  # an item's pairs are all in its round
    got = [((r.item_a, r.item_b), r.sim) for one in rounds for r in one]
    assert len(got) == len(want) and dict(got) == pytest.approx(want)
    for k in (2, 40):
        lists = itemcf.nearest_lists(itemcf.item_similarity_rounds(train, chunk=chunk, round_entries=64), k)
        plain = itemcf.neighbour_lists(itemcf.item_neighbours(sim, k))
        cols = ["seed", "names"]
        assert sorted(map(tuple, lists.select(*cols).collect())) == sorted(map(tuple, plain.select(*cols).collect()))


@pytest.mark.parametrize("dedupe", [False, True])
def test_recommendations_send_lists_in_rounds(spark, monkeypatch, dedupe):
    rows = random_ratings(22, n_users=60, n_items=40) + [(7, 3, 4.0)] * 3
    train = spark.createDataFrame(rows, SCHEMA)
    want = itemcf.item_cf_recommend(train, 5, dedupe=dedupe, similarity=itemcf.item_similarity(train))
    plain, seen = itemcf.item_similarity_rounds, []

    def watched(*args):
        for one in plain(*args, round_entries=64):
            seen.append(one)
            yield one
    monkeypatch.setattr(itemcf, "item_similarity_rounds", watched)
    got = itemcf.item_cf_recommend(train, 5, dedupe=dedupe)
    assert len(seen) > 2
    cols = ["user_id", "rank", "movie_id", "seed"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
