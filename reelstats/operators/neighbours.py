"""Exact nearest items without forming all pairs of the users with the longest histories.

A user with n ratings contributes n * n / 2 pairs, so a few heavy users make most
of them.  Users are taken rarest first, in two tiers:

1. The light users' best ``k`` of every item are summed in rounds.  The similarity of the
   k-th is a lower bound of the item's final k-th best, and the lists of items without a
   heavy rater are final.  A pair with such an item is final as well.
2. Pairs of items with heavy raters that light users share are summed again, from the
   ratings of those items alone; one stays if its sum plus the smaller of both items' heavy
   masses can reach the bound.
3. A pair that one heavy user alone shares has the similarity of that user's ratings over both means.  Of a
   user's items with equal ratings the k + 1 of the smallest means are as good as any other, so
   each item meets just those.
4. A pair that no light user and several heavy users share: seen from item A through heavy user h it is
   at most ``min(r_hA, r_hB)`` plus A's rating mass with its other heavy users; it is formed only if that
   can reach A's bound.
5. What stays is summed exactly over the heavy users that both items share, and ranked.

Copies of a rating count as weights.  A pair that ties with the k-th best is never
pruned.  Ratings must be positive (then no sum hides a mean; else nothing is pruned); the means may be any
of ``itemcf.item_means``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.operators.itemcf import DEFAULT_CHUNK, co_rating_groups, item_means, nearest_neighbours
from reelstats.operators.skew import split_join
from reelstats.operators.stats import top_n_per_group
from reelstats.session import materialize


def rating_rows(train: DataFrame, user_col: str, item_col: str, rating_col: str) -> DataFrame:
    """(u, i, r, w): distinct ratings with their number of copies."""
    return train.groupBy(F.col(user_col).alias("u"), F.col(item_col).alias("i"), F.col(rating_col).alias("r")).agg(
        F.count(F.lit(1)).alias("w"))


def both_ways(sums: DataFrame, also: list[str]) -> DataFrame:
    """(a, b, s, and ``also`` of a and b) in both directions from sums of unordered pairs."""
    def one(x, y):
        return F.struct(F.col(f"item_{x}").alias("a"), F.col(f"item_{y}").alias("b"), "s",
                        *[F.col(f"{c}_{z}").alias(f"{c}_{n}") for c in also for z, n in ((x, "a"), (y, "b"))])
    return sums.select(F.explode(F.array(one("a", "b"), one("b", "a"))).alias("p")).select("p.*")


def with_means(pairs: DataFrame, means: DataFrame) -> DataFrame:
    """Attach both items' means; a pair of an item without one is left out, as in the similarity."""
    return (pairs.join(means.select(F.col("item").alias("a"), F.col("mean").alias("ma")), "a")
            .join(means.select(F.col("item").alias("b"), F.col("mean").alias("mb")), "b"))


def one_row_each(rows: DataFrame) -> DataFrame:
    """(u, i, r, w) with an item's largest rating and all its copies: no pair of the user adds more than these say."""
    return rows.groupBy("u", "i").agg(F.max("r").alias("r"), F.sum("w").alias("w"))


def heavy_pairs(heavy: DataFrame, items: DataFrame, chunk: int) -> DataFrame:
    """(a, b): pairs through heavy users that can reach a's bound by heavy users alone.

    ``heavy`` holds one row per user and item (``one_row_each``), ``items`` holds (i, mean, bound, mass): bound null means that nothing is known yet.
    The rows of a user are dealt over blocks of about ``chunk`` rows, so a task meets at
    most chunk * chunk pairs of a user at once, and only rows that some open item can
    use take part.
    """
    widest = heavy.groupBy("u").agg(F.max("w").alias("wu"), F.count(F.lit(1)).alias("n"))
    least = items.agg(F.min("mean").alias("m")).scalar()
    rows = (split_join(materialize(heavy.join(items, "i"), "heavy-rows"), widest, "u")
            .withColumn("own", F.col("r") * F.col("w") * F.col("wu")).withColumn("least", least))
    # what a partner's row must add at least for the pair to count
    rows = rows.withColumn("need", F.coalesce(F.col("bound") * (F.col("mean") + F.col("least")) -
                                              (F.col("mass") - F.col("own")), F.lit(0.0)))
    slack = F.lit(1 - 1e-9)
    open_rows = rows.where(F.col("own") >= F.col("need") * slack)
    lowest = open_rows.groupBy("u").agg(F.min("need").alias("lowest"), F.max("w").alias("w_open"))
    partners = split_join(rows, lowest, "u").where(F.col("r") * F.col("w") * F.col("w_open") >= F.col("lowest") * slack)
    blocks = F.ceil(F.col("n") / chunk).cast("int")

    def dealt(df, mine, other):
        df = df.withColumn("nb", blocks).withColumn(mine, F.pmod(F.xxhash64("i"), F.col("nb")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))

    left = dealt(open_rows, "x", "y").select(
        "u", "x", "y", F.col("i").alias("a"), F.col("r").alias("ra"), F.col("w").alias("wa"), F.col("mean").alias("ma"),
        "bound", (F.col("mass") - F.col("own")).alias("rest"))
    right = dealt(partners, "y", "x").select("u", "x", "y", F.col("i").alias("b"), F.col("r").alias("rb"),
                                             F.col("w").alias("wb"), F.col("mean").alias("mb"))
    reach = F.least("ra", "rb") * F.col("wa") * F.col("wb") + F.col("rest")
    enough = F.col("bound").isNull() | (reach >= F.col("bound") * (F.col("ma") + F.col("mb")) * slack)
    return left.join(right, ["u", "x", "y"]).where((F.col("a") != F.col("b")) & enough).select("a", "b").distinct()


def best_partners(heavy: DataFrame, once: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(a, b): every item with those of its heavy user's items that no ``k`` others of equal ratings surpass.

    Two items that a user has rated alike add the same to any pair, so the one of the smaller mean is
    the nearer, or of equal means the smaller one.  A user's partners are as many as the user has
    different ratings, ``k + 1`` of each, whatever the history; a pair stays if it can reach a's bound.
    """
    alike = F.sort_array(F.collect_list(F.struct("r", "w"))).alias("alike")
    rows = heavy.groupBy("u", "i").agg(alike).join(items.select("i", "mean"), "i")
    # of each mean the smallest items, then the smallest means: sums of means may round to equal values
    smallest = top_n_per_group(rows, ["u", "alike", "mean"], [F.asc("i")], k + 1).drop("rank")
    last = (top_n_per_group(rows, ["u", "alike"], [F.asc("mean"), F.asc("i")], k + 1).groupBy("u", "alike")
            .agg(F.max("mean").alias("last")))
    partners = smallest.join(last, ["u", "alike"]).where(F.col("mean") <= F.col("last") * (1 + 1e-9))
    tops = partners.groupBy("u").agg(F.collect_list(F.struct(
        F.col("i").alias("b"), F.array_max("alike.r").alias("rb"),
        F.aggregate("alike.w", F.lit(0).cast("long"), lambda s, x: s + x).alias("wb"),
        F.col("mean").alias("mb"))).alias("tops"))
    widest = once.groupBy("u").agg(F.max("w").alias("wu"))
    mine = materialize(once.join(items, "i"), "heavy-rows")
    pairs = (split_join(mine, widest.join(tops, "u"), "u").select("i", "r", "w", "wu", "mean", "bound", "mass", F.inline("tops"))
             .withColumn("rest", F.col("mass") - F.col("r") * F.col("w") * F.col("wu")))
    reach = F.least("r", "rb") * F.col("w") * F.col("wb") + F.col("rest")
    enough = F.col("bound").isNull() | (reach >= F.col("bound") * (F.col("mean") + F.col("mb")) * F.lit(1 - 1e-9))
    return pairs.where((F.col("i") != F.col("b")) & enough).select(F.col("i").alias("a"), "b")


def heavy_sums(pairs: DataFrame, heavy: DataFrame) -> DataFrame:
    """(a, b, h): exact sum of the pairs (a, b) over the heavy users that rated both."""
    a = heavy.select(F.col("i").alias("a"), "u", F.col("r").alias("ra"), F.col("w").alias("wa"))
    b = heavy.select(F.col("i").alias("b"), "u", F.col("r").alias("rb"), F.col("w").alias("wb"))
    both = pairs.select("a", "b").join(a, "a").join(b, ["b", "u"])
    return both.groupBy("a", "b").agg(F.sum(F.least("ra", "rb") * F.col("wa") * F.col("wb")).alias("h"))


def pruned_neighbours(train: DataFrame, k: int, user_col: str = "user_id", item_col: str = "movie_id",
                      rating_col: str = "user_rating", mean_key: str = "item",
                      chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """(item, neighbour, sim, rank): the best ``k`` of every item, equal to ``item_neighbours(item_similarity(...), k)``.

    Users with more than ``chunk`` distinct ratings are the heavy ones; without any
    the pairs are summed as they are.
    """
    return pruned(train, k, user_col, item_col, rating_col, mean_key, chunk)[0]


def pruned(train: DataFrame, k: int, user_col: str = "user_id", item_col: str = "movie_id",
           rating_col: str = "user_rating", mean_key: str = "item",
           chunk: int = DEFAULT_CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """The neighbours, and the heavy users' pairs that were formed (a, b); None where nothing could be pruned."""
    rows = materialize(rating_rows(train, user_col, item_col, rating_col), "rating-rows")
    heavy_users = materialize(rows.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk).select("u"),
                              "heavy-users")
    low = rows.agg(F.min("r").alias("low"), F.count_if(F.col("r").isNull()).alias("unknown")).first()
    if heavy_users.isEmpty() or low["unknown"] or (low["low"] or 0.0) <= 0:
        return nearest_neighbours(train, k, user_col, item_col, rating_col, mean_key, chunk), None
    means = materialize(item_means(train, user_col, item_col, rating_col, mean_key), "item-means")
    heavy = materialize(split_join(rows, heavy_users, "u", "left_semi"), "heavy-ratings")
    once = materialize(one_row_each(heavy), "heavy-items")
    light = materialize(split_join(rows, heavy_users, "u", "left_anti"), "light-ratings")

    def copies(ratings):
        return ratings.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int")))).select("u", "i", "r")

    near = nearest_neighbours(copies(light), k, "u", "i", "r", chunk=chunk, means=means)
    kth = near.where(F.col("rank") == k).select(F.col("item").alias("i"), F.col("sim").alias("bound"))
    widest = once.groupBy("u").agg(F.max("w").alias("wu"))
    mass = (split_join(once, widest, "u").groupBy("i")
            .agg(F.sum(F.col("r") * F.col("w") * F.col("wu")).alias("mass"), F.count(F.lit(1)).alias("raters")))
    # the items with heavy raters: only their pairs with one another get more
    items = materialize(means.select(F.col("item").alias("i"), "mean").join(mass, "i").join(kth, "i", "left"), "item-bounds")
    several = once.join(items.where("raters > 1").select("i"), "i", "left_semi")
    found = materialize(best_partners(heavy, once, items, k).unionByName(
        heavy_pairs(several, items.drop("raters"), chunk)).distinct(), "heavy-pairs")

    # pairs of light users that heavy users can still lift to the bound
    also = ["mean", "bound", "mass"]
    rated = materialize(split_join(light, items.select("i"), "i", "left_semi"), "lifted-ratings")
    sums = co_rating_groups(copies(rated), "u", "i", "r", chunk, items.select(F.col("i").alias("item"), *also))
    most = F.col("s") + F.least("mass_a", "mass_b")
    stays = F.col("bound_a").isNull() | (most >= F.col("bound_a") * (F.col("mean_a") + F.col("mean_b")) * F.lit(1 - 1e-9))
    kept = materialize(both_ways(sums, also).where(stays).select("a", "b", "s"), "lifted-pairs")
    # each pair once, its light sum next to the mark that heavy users share it
    every = (kept.unionByName(found.withColumn("s", F.lit(0.0))).groupBy("a", "b").agg(F.sum("s").alias("s")))
    every = materialize(every, "candidate-pairs")
    total = every.join(heavy_sums(every, heavy), ["a", "b"], "left").withColumn(
        "s", F.col("s") + F.coalesce("h", F.lit(0.0)))
    sim = F.col("s") / (F.col("ma") + F.col("mb"))
    scored = with_means(total.select("a", "b", "s"), means).select(
        F.col("a").alias("item"), F.col("b").alias("neighbour"), sim.alias("sim"))
    # of the light lists, what no heavy user adds to
    marked = items.select(F.col("i").alias("item"), F.lit(True).alias("_own"))
    final = (near.join(marked, "item", "left").join(marked.toDF("neighbour", "_other"), "neighbour", "left")
             .where("_own is null or _other is null").select("item", "neighbour", "sim"))
    return top_n_per_group(scored.unionByName(final), ["item"], [F.desc("sim"), F.asc("neighbour")], k), found

