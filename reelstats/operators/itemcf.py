"""Item-based collaborative filtering.

similarity(A, B) = sum over users who rated both of min(r_uA, r_uB)
                   -------------------------------------------------
                             mean(A) + mean(B)

computed for A < B, mirrored into neighbour lists; a user's candidates are the
neighbours of every item they rated, ranked by similarity.

Plan notes
* Co-ratings travel as lists: every rating goes to its item with the part of
  its user's list that follows it, and the item's task unfolds and sums them.
  A pair costs a list entry (item, rating, weight, mean) in one shuffle; pairs
  themselves are never shuffled.  The means travel in the entries, so no
  pair is joined to them.
* A user with many ratings is split into ``ceil(n / chunk)`` buckets by item
  hash and every two buckets make a row of their own, so no list is longer
  than about ``chunk``.  An item with a large share of the ratings is dealt
  over tasks by the hash of the other item.
* Shuffles of lists are sized by the rows that the lists unfold to.
* Copies (the same user, item and rating repeated) are collapsed into a
  weight before the self-join, and repeated (user, seed) rows before the
  candidate join; weights turn back into row multiplicities at the end.
* Only the best ``n`` neighbours of each seed item can reach a user's top
  ``n`` under the order (sim desc, item asc, seed asc), so candidates are
  generated from per-item top-``n`` lists (exact, see tests).
* Lower bounds of an item's and of a user's ``n``-th best, from a part of their rows,
  tell which pairs and candidates need not be sorted or shuffled at all.
* Where only the best neighbours are wanted, items are taken in rounds: an item of the round
  meets whole lists, so all its pairs are in its task, and a round's shuffle ends with the round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from reelstats.operators.nearest import nearest_lists_of, summable, totals_of, whole
from reelstats.operators.skew import hot_keys, partitions, split_join
from reelstats.operators.stats import top_n_per_group
from reelstats.session import freed_shuffles, materialize, scratch_path

DEFAULT_CHUNK = 2048
TASK_ROWS = 1 << 20  # rows that one task makes of its lists
CELLS = 1 << 20      # hash cells of the items' bounds, 4 bytes each
CELL_ROWS = 1 << 22  # candidate rows that a cell of users and items unfolds
HEADS = 4            # neighbours of a seed that are read for a user's bound
ROUND_ENTRIES = 1 << 24  # list entries that a round of items is sent at least
ROUND_LENGTH = 2     # list entries that a round is sent for each rating, if that is more
MAX_ROUNDS = 64


def users_min_rated(df: DataFrame, n: int, user_col: str = "user_id") -> DataFrame:
    """Rows of users with at least ``n`` rows (count before any dedupe)."""
    if n <= 1:
        return df.where(F.col(user_col).isNotNull()) if n == 1 else df
    keep = (df.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= n).select(user_col))
    return split_join(df, keep, user_col, "left_semi").select(*df.columns)


def item_means(train: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
               rating_col: str = "user_rating", mean_key: str = "item") -> DataFrame:
    """(item, mean) used in the similarity denominator.

    ``mean_key="item"``: mean rating of each item (the intended reading).
    ``mean_key="user"``: mean rating of each *user*, looked up by the item id,
    reproducing the mixed-key join of the original job.
    """
    if mean_key not in ("item", "user"):
        raise ValueError("mean_key must be 'item' or 'user'")
    key = item_col if mean_key == "item" else user_col
    return (train.groupBy(key).agg(F.avg(rating_col).alias("mean"))
            .withColumnRenamed(key, "item"))


def pair_work(rows: DataFrame, user_col: str) -> tuple[int, int]:
    """(most ratings of a user, bound of the co-ratings): one pass over the user column."""
    n = F.col("_n").cast("double")
    row = (rows.where(F.col(user_col).isNotNull()).groupBy(user_col).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.max("_n").alias("most"), F.sum(n * (n - 1) / 2).alias("pairs")).first())
    return int(row["most"] or 0), int(row["pairs"] or 0)


def tasks_for(df: DataFrame, rows: int) -> int:
    """Partitions for ``rows`` rows that come out of a task's input, however small that input is."""
    return max(partitions(df.sparkSession), min(-(-rows // TASK_ROWS), 1 << 15))


def user_lists(rows: DataFrame, chunk: int, most: int, means: DataFrame | None = None) -> DataFrame:
    """(u, nb, b, mine): each user's entries sorted by item, in ``nb`` lists of about ``chunk`` entries.

    ``rows`` holds (u, i, r); copies are weights.  A user with at most ``chunk`` distinct
    (item, rating) rows has one list.  Others are dealt over buckets ``b`` by item hash.
    ``most`` is the largest number of rows of a user.  With ``means`` every entry carries
    its item's mean and what else that table says of it, and items without one drop out.
    """
    # Copies of one (user, item, rating) are collapsed into a weight first (map-side
    # combined), so repeated ratings add work once instead of quadratically.
    weighted = r = (rows.where(F.col("u").isNotNull() & F.col("i").isNotNull()).groupBy("u", "i", "r")
                    .agg(F.count(F.lit(1)).alias("w")))
    entry = ["i", "r", "w"]
    if means is not None:
        r = split_join(r, means.withColumnRenamed("item", "i"), "i", hot=hot_keys(rows.select("i"), "i"))
        entry += [c for c in means.columns if c != "item"]
    collected = F.sort_array(F.collect_list(F.struct(*entry))).alias("mine")
    if most <= chunk:
        return r.groupBy("u").agg(collected).select("u", F.lit(1).alias("nb"), F.lit(0).alias("b"), "mine")
    # found with a map-side combined count
    heavy = (weighted.groupBy("u").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk)
             .select("u", F.ceil(F.col("_n") / F.lit(chunk)).cast("int").alias("nb")))
    hot = hot_keys(rows.select("u"), "u")  # counted on the scan, not on the aggregate
    return (split_join(r, heavy, "u", "left", hot).withColumn("nb", F.coalesce(F.col("nb"), F.lit(1)))
            .groupBy("u", "nb", F.pmod(F.xxhash64("i"), F.col("nb")).cast("int").alias("b")).agg(collected))


def co_rating_lists(rows: DataFrame, chunk: int, most: int, means: DataFrame | None = None) -> DataFrame:
    """(same, mine, theirs): two of one user's ``user_lists``, each sorted by item.

    A list is paired with itself (``same``), and every two lists of a user make a row.
    """
    lists = user_lists(rows, chunk, most, means)
    if most <= chunk:
        return lists.select(F.lit(True).alias("same"), "mine", F.col("mine").alias("theirs"))
    others = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    many = lists.where("nb > 1")
    left = many.select("u", F.col("b").alias("b1"), others.alias("b2"), "mine")
    right = many.select("u", others.alias("b1"), F.col("b").alias("b2"), F.col("mine").alias("theirs"))
    return (lists.where("nb = 1").select(F.lit(True).alias("same"), "mine", F.col("mine").alias("theirs"))
            .unionByName(left.join(right, ["u", "b1", "b2"])
                         .select((F.col("b1") == F.col("b2")).alias("same"), "mine", "theirs")))


def whole_lists(lists: DataFrame, most: int, chunk: int, part: int, parts: int) -> DataFrame:
    """(mine, theirs) of ``user_lists``: every entry whose item is of round ``part``, with all lists of its user.

    Where entries say whether they are ``wanted``, only those that are.
    """
    chosen = F.filter("mine", lambda x: F.pmod(F.xxhash64(x["i"]), F.lit(parts)) == part) if parts > 1 else F.col("mine")
    if "wanted" in lists.schema["mine"].dataType.elementType.names:
        chosen = F.filter(chosen, lambda x: x["wanted"])
    if most <= chunk:
        return lists.select(chosen.alias("mine"), F.col("mine").alias("theirs"))
    many = lists.where("nb > 1")
    # the lists of a group have as many entries of this round as one list has in all: a list travels once for each group
    group = (F.col("b") / F.lit(parts)).cast("int")
    groups = F.explode(F.sequence(F.lit(0), F.ceil(F.col("nb") / F.lit(parts)).cast("int") - 1))
    left = many.select("u", group.alias("g"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b2"),
                       chosen.alias("mine")).where(F.size("mine") > 0)
    right = many.select("u", groups.alias("g"), F.col("b").alias("b2"), F.col("mine").alias("theirs"))
    return (lists.where("nb = 1").select(chosen.alias("mine"), F.col("mine").alias("theirs"))
            .unionByName(left.join(right, ["u", "g", "b2"]).select("mine", "theirs")))


def co_rating_groups(rows: DataFrame, user_col: str, item_col: str, rating_col: str, chunk: int,
                     means: DataFrame | None = None) -> DataFrame:
    """(item_a, item_b, s, n_common[, mean_a, mean_b]) with item_a < item_b; other columns of ``means`` come likewise.

    Every rating travels to its item once, with the part of its user's list that
    follows it: a co-rating costs a list entry of the shuffle, not a row, and all sums
    of item_a end where its lists are.  The lists of an item with a large share of
    the ratings are dealt over tasks by the hash of the other item.
    """
    named = rows.select(F.col(user_col).alias("u"), F.col(item_col).alias("i"), F.col(rating_col).alias("r"))
    also = [c for c in means.columns if c != "item"] if means is not None else []
    entry = ["i", "r", "w", *also]
    most, work = pair_work(named, "u")
    tasks = tasks_for(rows, work)
    # entries behind mine: known in my own list, counted in another bucket's
    start = F.when(F.col("same"), F.col("at") + 1).otherwise(
        F.size(F.filter("theirs.i", lambda x: x <= F.col("me.i"))))
    # lists of plain values, one per field: far smaller than lists of rows
    tails = [F.slice(F.col(f"theirs.{c}"), F.col("start") + 1, F.size("theirs") - F.col("start")).alias(f"l_{c}")
             for c in entry]
    sent = (co_rating_lists(named, chunk, most, means).select("same", "theirs", F.posexplode("mine").alias("at", "me"))
            .withColumn("start", start).where(F.col("start") < F.size("theirs"))
            .select(*[F.col(f"me.{c}").alias(f"m_{c}") for c in entry], *tails))
    met = unfolded(sent, entry, hot_keys(named.select("i"), "i", tasks), tasks)
    return summed(met.where(F.col("m_i") < F.col("l_i")), also)


def unfolded(sent: DataFrame, entry: list[str], hot: list[tuple[int, int]], tasks: int) -> DataFrame:
    """A row for each entry of the lists ``l_*`` that come with an item's entry ``m_*``, made in the item's task."""
    sent, keys = sent_to_items(sent, entry, hot, tasks)
    return sent.select(*keys, *[f"m_{c}" for c in entry[1:]], F.inline(F.arrays_zip(*[f"l_{c}" for c in entry])))


def sent_to_items(sent: DataFrame, entry: list[str], hot: list[tuple[int, int]], tasks: int) -> tuple[DataFrame, list[str]]:
    """The rows in their item's task, and the columns that say which that is.

    The lists of the ``hot`` items are dealt over tasks by the hash of the other item.
    """
    keys = ["m_i"]
    if hot:
        table = F.broadcast(sent.sparkSession.createDataFrame(hot, "_hash long, _tasks int"))
        dealt = (sent.withColumn("_hash", F.xxhash64("m_i")).join(table, "_hash", "left")
                 .withColumn("_tasks", F.coalesce("_tasks", F.lit(1)))
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1))))

        every = F.arrays_zip(*[f"l_{c}" for c in entry])
        mine = F.filter(every, lambda x: F.pmod(F.xxhash64(x["l_i"]), F.col("_tasks")) == F.col("_salt"))
        dealt = dealt.withColumn("_mine", F.when(F.col("_tasks") > 1, mine))
        sent = dealt.select(*[f"m_{c}" for c in entry], "_salt", *[
            F.when(F.col("_tasks") > 1, F.col(f"_mine.l_{c}")).otherwise(F.col(f"l_{c}")).alias(f"l_{c}") for c in entry])
        keys.append("_salt")
    return sent.repartition(tasks, *keys), keys


def summed(pairs: DataFrame, also: list[str]) -> DataFrame:
    """(item_a, item_b, s, n_common) of ``unfolded`` rows, summed where they lie, with what they say ``also`` of both items."""
    keys = ["m_i"] + [c for c in pairs.columns if c == "_salt"]
    ww = F.col("m_w") * F.col("l_w")
    sums = [F.sum(F.least("m_r", "l_r") * ww).alias("s"), F.sum(ww).cast("bigint").alias("n_common")]
    for c in also:  # one value per item
        sums += [F.first(f"m_{c}").alias(f"{c}_a"), F.first(f"l_{c}").alias(f"{c}_b")]
    out = ["s", "n_common", *[f"{c}_{x}" for c in also for x in ("a", "b")]]
    return (pairs.groupBy(*keys, "l_i").agg(*sums)
            .select(F.col("m_i").alias("item_a"), F.col("l_i").alias("item_b"), *out))


def co_rating_sums(rows: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
                   rating_col: str = "user_rating", chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """(item_a, item_b, s, n_common) with item_a < item_b.

    ``s`` sums min(r_a, r_b) over every pair of rating rows of one user (row
    multiplicity kept); ``n_common`` counts those pairs.
    """
    return co_rating_groups(rows, user_col, item_col, rating_col, chunk)


def item_similarity(train: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
                    rating_col: str = "user_rating", mean_key: str = "item",
                    chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """(item_a, item_b, sim) for every co-rated pair, item_a < item_b."""
    # with mean_key="user" items without a 'mean' drop out, as in the original job's inner join
    means = item_means(train, user_col, item_col, rating_col, mean_key)
    return with_similarity(co_rating_groups(train, user_col, item_col, rating_col, chunk, means))


def with_similarity(sums: DataFrame) -> DataFrame:
    """(item_a, item_b, sim) of sums that carry both means."""
    return sums.select("item_a", "item_b", (F.col("s") / (F.col("mean_a") + F.col("mean_b"))).alias("sim"))


def item_similarity_rounds(train: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
                           rating_col: str = "user_rating", mean_key: str = "item", chunk: int = DEFAULT_CHUNK,
                           nearest: int | None = None, wanted: DataFrame | None = None,
                           means: DataFrame | None = None, round_entries: int = ROUND_ENTRIES) -> Iterator[DataFrame]:
    """The ``item_similarity`` of every co-rated pair in both directions, a frame for each round of ``item_a``.

    With ``nearest`` a frame holds the ``neighbour_lists`` of that many best instead; where items are
    whole numbers a pair then never becomes a row (``operators.nearest``).  ``wanted`` (item) names the
    items to make pairs of as ``item_a``; each of them still meets every other.

    The users' lists are written once.  An item of a round meets the whole lists of its raters, so all its
    pairs lie in its task and what a round sends is over when its frame has been written.  The number of
    rounds grows until a round sends about ``ROUND_LENGTH`` entries a rating (at least ``round_entries``),
    up to ``MAX_ROUNDS``; it decides when a pair is summed, not the result.
    """
    named = train.select(F.col(user_col).alias("u"), F.col(item_col).alias("i"), F.col(rating_col).alias("r"))
    entry = ["i", "r", "w", "mean"]
    most, pairs = pair_work(named, "u")
    means = item_means(train, user_col, item_col, rating_col, mean_key) if means is None else means
    if wanted is not None:
        means = means.join(wanted.select("item").distinct().withColumn("wanted", F.lit(True)), "item", "left").fillna(
            False, ["wanted"])
    lists = materialize(user_lists(named, chunk, most, means), "user-lists")
    parts = max(1, min(-(-2 * pairs // max(round_entries, ROUND_LENGTH * named.count())), MAX_ROUNDS))
    tasks = tasks_for(train, 2 * pairs // parts)
    hot = hot_keys(named.select("i"), "i", tasks * parts)  # of all rounds, an item is in one
    for part in range(parts):
        sent = (whole_lists(lists, most, chunk, part, parts).select("theirs", F.explode("mine").alias("me"))
                .select(*[F.col(f"me.{c}").alias(f"m_{c}") for c in entry],
                        *[F.col(f"theirs.{c}").alias(f"l_{c}") for c in entry]))
        dealt = [(h, min(n, tasks)) for h, n in hot]
        if nearest is not None and summable(train, item_col, rating_col):
            yield nearest_of_sent(*sent_to_items(sent, entry, dealt, tasks), nearest)
            continue
        met = unfolded(sent, entry, dealt, tasks)
        sim = with_similarity(summed(met.where(F.col("m_i") != F.col("l_i")), ["mean"]))
        yield sim if nearest is None else neighbour_lists(nearest_of_pairs(sim, nearest))


def nearest_of_sent(sent: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``neighbour_lists`` of the ``k`` best of every item of ``sent_to_items``."""
    kind = sent.schema["m_i"].dataType.simpleString()
    ansi = sent.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    rows = sent.sortWithinPartitions("m_i").select(*[f"{x}_{c}" for x in ("m", "l") for c in ("i", "r", "w", "mean")])
    lists = rows.mapInArrow(nearest_lists_of(k, ansi), f"seed {kind}, names array<{kind}>, sims array<double>")
    if "_salt" not in keys:
        return lists
    # an item that was dealt over tasks has a list from each
    pairs = lists.select(F.col("seed").alias("item_a"), F.inline(F.arrays_zip("names", "sims"))).toDF("item_a", "item_b", "sim")
    return neighbour_lists(nearest_of_pairs(pairs, k))


def nearest_of_pairs(sim: DataFrame, k: int) -> DataFrame:
    """(item, neighbour, sim, rank): the ``k`` best of pairs in both directions."""
    directed = sim.select(F.col("item_a").alias("item"), F.col("item_b").alias("neighbour"), "sim")
    return top_n_per_group(directed, ["item"], [F.desc("sim"), F.asc("neighbour")], k)


def kth_floors(sim: DataFrame, k: int, items: DataFrame) -> tuple[Column, int]:
    """(array, cells): what the k-th best similarity of every item of a hash cell reaches at least.

    An item's pairs as ``item_a`` lie in one task; the k-th best of them is a lower bound of its final
    k-th best.  A cell holds the least bound of its ``items``, minus infinity if one of them has fewer
    than ``k`` such pairs.  The array has a bounded number of cells: with more items
    it holds back less.
    """
    cells = min(max(1 << 10, 1 << (2 * items.count()).bit_length()), CELLS)
    forward = sim.select(F.col("item_a").alias("item"), "sim")
    kth = (top_n_per_group(forward, ["item"], [F.desc("sim")], k).where(F.col("rank") == k)
           .select("item", F.col("sim").alias("bound")))
    lowest = (items.join(kth, "item", "left").groupBy(F.pmod(F.xxhash64("item"), F.lit(cells)).alias("id"))
              .agg(F.min("bound").alias("bound"), F.count_if(F.col("bound").isNull()).alias("open")))
    # single precision, rounded down; sums of the two evaluations may differ in their last digits
    floor = F.when(F.col("open") == 0, F.col("bound") - F.abs("bound") * 1e-6).cast("float")
    every = sim.sparkSession.range(cells).join(lowest, "id", "left").select(
        F.struct("id", F.coalesce(floor, F.lit(float("-inf")).cast("float")).alias("floor")).alias("c"))
    return every.agg(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["floor"]).alias("floors")).scalar(), cells


def item_neighbours(sim: DataFrame, k: int | None = None, items: DataFrame | None = None) -> DataFrame:
    """Symmetric (item, neighbour, sim) rows; with ``k`` only the best k per item.

    ``items`` (item), all items whose lists are wanted, lets pairs that cannot be among
    an item's best k be left out before they are sorted and shuffled.
    """
    # one pass over the pairs: each row yields both directions
    both = sim.select(F.explode(F.array(
        F.struct(F.col("item_a").alias("item"), F.col("item_b").alias("neighbour"), "sim"),
        F.struct(F.col("item_b").alias("item"), F.col("item_a").alias("neighbour"), "sim"),
    )).alias("p")).select("p.item", "p.neighbour", "p.sim")
    if k is None:
        return both
    if items is not None:
        kind = sim.schema["item_a"].dataType
        floors, cells = kth_floors(sim, k, items.select(F.col("item").cast(kind).alias("item")).distinct())
        floor = F.get(floors, F.pmod(F.xxhash64("item"), F.lit(cells)).cast("int"))
        both = both.where((floor == F.lit(float("-inf"))) | (F.col("sim") >= floor))
    return top_n_per_group(both, ["item"], [F.desc("sim"), F.asc("neighbour")], k)


def weighted_candidates(train: DataFrame, neighbours: DataFrame, user_col: str = "user_id",
                        item_col: str = "movie_id", min_rated: int = 1,
                        users: DataFrame | None = None) -> DataFrame:
    """(user, item, seed, sim, w): neighbours of each distinct rated (user, seed).

    ``w`` is the number of rating rows of that (user, seed); the unweighted
    candidate list repeats each row ``w`` times.  ``users`` restricts the
    seeds to a set of users before any candidate is generated.
    """
    rated = users_min_rated(train, min_rated, user_col)
    if users is not None:
        rated = rated.join(users.select(user_col), user_col, "left_semi")
    seeds = (rated
             .groupBy(F.col(user_col), F.col(item_col).alias("seed"))
             .agg(F.count(F.lit(1)).alias("w")))
    nb = neighbours.select(F.col("item").alias("seed"), F.col("neighbour").alias(item_col), "sim")
    hot = hot_keys(rated.select(F.col(item_col).alias("seed")), "seed")
    return split_join(seeds, nb, "seed", hot=hot).select(user_col, item_col, "seed", "sim", "w")


def neighbour_lists(neighbours: DataFrame) -> DataFrame:
    """(seed, names, sims): ranked (item, neighbour, sim, rank) rows as one row per item."""
    entry = F.struct("rank", F.col("neighbour").alias("name"), "sim")
    return (neighbours.groupBy(F.col("item").alias("seed")).agg(F.sort_array(F.collect_list(entry)).alias("l"))
            .select("seed", F.col("l.name").alias("names"), F.col("l.sim").alias("sims")))


def nearest_lists(rounds: Iterable[DataFrame], k: int) -> DataFrame:
    """``neighbour_lists`` of every item's best ``k``, from ``item_similarity_rounds``: written a round at a time."""
    paths, spark = [], None
    for sim in rounds:
        spark = sim.sparkSession
        lists = sim if "names" in sim.columns else neighbour_lists(nearest_of_pairs(sim, k))
        paths.append(scratch_path(spark, "nearest-lists"))
        with freed_shuffles(spark):
            lists.write.parquet(paths[-1])
    return spark.read.parquet(*paths)


def nearest_neighbours(train: DataFrame, k: int, user_col: str = "user_id", item_col: str = "movie_id",
                       rating_col: str = "user_rating", mean_key: str = "item", chunk: int = DEFAULT_CHUNK,
                       means: DataFrame | None = None) -> DataFrame:
    """(item, neighbour, sim, rank): ``item_neighbours`` of the ``item_similarity``, summed in rounds of items.

    ``means`` (item, mean) may be those of other ratings.
    """
    lists = nearest_lists(item_similarity_rounds(train, user_col, item_col, rating_col, mean_key, chunk, k, means=means), k)
    return lists.select(F.col("seed").alias("item"), F.posexplode(F.arrays_zip("names", "sims")).alias("_at", "_one")).select(
        "item", F.col("_one.names").alias("neighbour"), F.col("_one.sims").alias("sim"),
        (F.col("_at") + 1).cast("int").alias("rank"))


def reachable_candidates(train: DataFrame, neighbours: DataFrame, n: int, user_col: str = "user_id",
                         item_col: str = "movie_id", min_rated: int = 1, users: DataFrame | None = None,
                         dedupe: bool = False) -> DataFrame:
    """The ``weighted_candidates`` that can be among a user's best ``n``, from ranked neighbours.

    The first ``HEADS`` neighbours of all seeds of a user say what the user's n-th best
    similarity reaches at least; of the lists only what reaches it is sent.  A user
    with fewer than ``n`` such rows gets whole lists.  With ``dedupe`` rows of one item count once.
    """
    lists = materialize(neighbour_lists(neighbours), "neighbour-lists")
    return reachable_from_lists(train, lists, n, user_col, item_col, min_rated, users, dedupe)


def reachable_from_lists(train: DataFrame, lists: DataFrame, n: int, user_col: str = "user_id",
                         item_col: str = "movie_id", min_rated: int = 1, users: DataFrame | None = None,
                         dedupe: bool = False) -> DataFrame:
    """``reachable_candidates`` from written ``neighbour_lists``."""
    rated = users_min_rated(train, min_rated, user_col)
    if users is not None:
        rated = rated.join(users.select(user_col), user_col, "left_semi")
    seeds = materialize(rated.groupBy(F.col(user_col), F.col(item_col).alias("seed"))
                        .agg(F.count(F.lit(1)).alias("w")), "user-seeds")
    hot, hot_users = hot_keys(seeds.select("seed"), "seed"), hot_keys(seeds.select(user_col), user_col)
    heads = lists.select("seed", *[F.slice(c, 1, HEADS).alias(c) for c in (("names", "sims") if dedupe else ("sims",))])
    first = split_join(seeds.select(user_col, "seed"), heads, "seed", hot=hot)
    if dedupe:
        first = (first.select(user_col, F.inline(F.arrays_zip("names", "sims"))).groupBy(user_col, "names")
                 .agg(F.max("sims").alias("sim")))
    else:
        first = first.select(user_col, F.explode("sims").alias("sim"))
    # written, so that what the bounds were made of is not kept until the candidates are read
    least = materialize(top_n_per_group(first, [user_col], [F.desc("sim")], n).where(F.col("rank") == n)
                        .select(user_col, F.col("sim").alias("least")), "user-bounds")
    bounded = split_join(seeds, least, user_col, "left", hot_users)
    return (split_join(bounded, lists, "seed", hot=hot)
            .select(user_col, "seed", "w", "least", F.inline(F.arrays_zip("names", "sims")))
            .where(F.col("least").isNull() | (F.col("sims") >= F.col("least")))
            .select(user_col, F.col("names").alias(item_col), "seed", F.col("sims").alias("sim"), "w"))


def item_cf_candidates(train: DataFrame, neighbours: DataFrame, user_col: str = "user_id",
                       item_col: str = "movie_id", min_rated: int = 1) -> DataFrame:
    """(user, item, seed, sim): every neighbour of every rated row (copies kept)."""
    cand = weighted_candidates(train, neighbours, user_col, item_col, min_rated)
    return (cand.select(user_col, item_col, "seed", "sim",
                        F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int"))).alias("_c"))
            .drop("_c"))


def candidate_totals(train: DataFrame, neighbours: DataFrame, user_col: str = "user_id",
                     item_col: str = "movie_id", min_rated: int = 1, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(user, item, n_rows, n_seeds, best_sim) of the ``item_cf_candidates``, whose rows are never shuffled.

    Users are dealt over ``p`` and candidate items over ``q`` cells.  The seeds of a cell's users
    and the neighbours that lie in it meet in its task, which unfolds and sums them: a seed
    travels ``q`` times and a neighbour ``p`` times instead of once for every row that they make.
    Where users and items are whole numbers, the rows are summed in numpy (``operators.nearest``).
    """
    rated = users_min_rated(train, min_rated, user_col)
    seeds = materialize(rated.where(F.col(item_col).isNotNull()).groupBy(F.col(user_col).alias("u"), F.col(item_col).alias("seed"))
                        .agg(F.count(F.lit(1)).alias("w")), "user-seeds")
    # a bound of the rows from the lengths of the users' lists; it decides how rows are dealt, not the result
    lengths = seeds.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    degree = split_join(seeds, lengths, "u").groupBy("seed").agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.sum(F.col("n") - 1).cast("double").alias("d"))
    size = degree.agg(F.sum("c").alias("r"), F.sum("d").alias("s"), F.sum(F.col("c") * F.col("d")).alias("all"),
                      F.count(F.lit(1)).alias("items"), F.max("d").alias("most")).first()
    work = min(size["all"] or 0, (size["r"] or 0) * size["items"])
    cells = max(1, min(int(work / cell_rows), 1 << 15))
    p = max(1, min(cells, round((cells * (size["r"] or 0) / (2 * max(size["s"] or 0, 1))) ** 0.5)))
    q = -(-cells // p)
    user_cell, item_cell = F.pmod(F.xxhash64("u"), F.lit(p)), F.pmod(F.xxhash64("name"), F.lit(q))
    every_p, every_q = F.sequence(F.lit(0), F.lit(p - 1)), F.sequence(F.lit(0), F.lit(q - 1))
    raters = (seeds.groupBy("seed", user_cell.cast("int").alias("p")).agg(F.collect_list(F.struct("u", "w")).alias("l"))
              .select("seed", "p", F.explode(every_q).alias("q"), F.col("l.u").alias("us"), F.col("l.w").alias("ws")))
    near = (neighbours.select(F.col("item").alias("seed"), F.col("neighbour").alias("name"), "sim")
            .select("seed", F.explode(every_p).alias("p"), item_cell.cast("int").alias("q"), F.struct("name", "sim").alias("one")))
    met = (raters.unionByName(near, allowMissingColumns=True)
           .repartition(max(cells, partitions(train.sparkSession)), "p", "q").groupBy("p", "q", "seed")
           .agg(F.first("us", True).alias("us"), F.first("ws", True).alias("ws"), F.collect_list("one").alias("near")))
    kinds = whole(train, user_col), whole(neighbours, "neighbour")
    if min_rated > 0 and all(kinds) and isinstance(neighbours.schema["sim"].dataType, DoubleType):  # no null user
        cells = met.where(F.col("us").isNotNull()).sortWithinPartitions("p", "q").select(
            "p", "q", "us", "ws", F.col("near.name").alias("names"), F.col("near.sim").alias("sims"))
        of = {user_col: train.schema[user_col].dataType, item_col: neighbours.schema["neighbour"].dataType}
        return cells.mapInArrow(totals_of(*kinds, [user_col, item_col]), ", ".join(f"`{c}` {t.simpleString()}" for c, t in of.items())
                                + ", n_rows bigint, n_seeds bigint, best_sim double")
    rows = (met.where(F.col("us").isNotNull()).select("p", "q", "us", "ws", F.inline("near"))
            .select("p", "q", "name", "sim", F.inline(F.arrays_zip("us", "ws"))))
    return (rows.groupBy("p", "q", "us", "name").agg(
        F.sum("ws").alias("n_rows"), F.count(F.lit(1)).alias("n_seeds"), F.max("sim").alias("best_sim"))
            .select(F.col("us").alias(user_col), F.col("name").alias(item_col), "n_rows", "n_seeds", "best_sim"))


def _expand_ranks(top: DataFrame, user_col: str, n: int) -> DataFrame:
    """Weighted rows (ranked by ``_r0``, at most n per user) -> ranks 1..n.

    A row of weight w takes w consecutive ranks.  The window runs over at
    most n rows per user.
    """
    w = Window.partitionBy(user_col).orderBy("_r0").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum("w").over(w)
    return (top.withColumn("_end", cum).withColumn("_start", F.col("_end") - F.col("w") + 1)
            .where(F.col("_start") <= n)
            .withColumn("rank", F.explode(F.sequence(F.col("_start").cast("int"),
                                                     F.least(F.col("_end"), F.lit(n)).cast("int")))))


def item_cf_recommend(train: DataFrame, n: int = 30, user_col: str = "user_id",
                      item_col: str = "movie_id", rating_col: str = "user_rating",
                      dedupe: bool = False, mean_key: str = "item", min_rated: int = 1,
                      chunk: int = DEFAULT_CHUNK, similarity: DataFrame | None = None,
                      users: DataFrame | None = None) -> DataFrame:
    """Top ``n`` candidate rows per user, ranked 1..n.

    Default keeps the original behaviour: an item reached from two seeds
    appears twice.  ``dedupe=True`` keeps one row per item with its best
    similarity (``seed`` is then the smallest seed reaching it).  Without a ``similarity`` it is
    summed in rounds of items, with less on disk at a time.
    """
    # the similarity always uses every user; ``users`` only limits who is served
    if similarity is None:
        lists = nearest_lists(item_similarity_rounds(train, user_col, item_col, rating_col, mean_key, chunk, n), n)
        cand = reachable_from_lists(train, lists, n, user_col, item_col, min_rated, users, dedupe)
    else:
        nb = item_neighbours(similarity, n, train.select(F.col(item_col).alias("item")).where("item is not null"))
        cand = reachable_candidates(train, nb, n, user_col, item_col, min_rated, users, dedupe)
    if dedupe:
        # max of (sim, -seed): best similarity, then the smallest seed reaching it
        best = F.max(F.struct(F.col("sim"), F.negative("seed").alias("neg"))).alias("best")
        cand = (cand.groupBy(user_col, item_col).agg(best)
                .select(user_col, item_col, F.negative("best.neg").alias("seed"),
                        F.col("best.sim").alias("sim")))
        return (top_n_per_group(cand, [user_col], [F.desc("sim"), F.asc(item_col)], n)
                .select(user_col, "rank", item_col, "seed", "sim"))
    # every weighted row holds at least one rank, so the first n rows suffice
    top = top_n_per_group(cand, [user_col], [F.desc("sim"), F.asc(item_col), F.asc("seed")], n,
                          rank_col="_r0")
    return _expand_ranks(top, user_col, n).select(user_col, "rank", item_col, "seed", "sim")


def remove_seen(recs: DataFrame, seen: DataFrame, n: int = 20, user_col: str = "user_id",
                item_col: str = "movie_id") -> DataFrame:
    """Drop items the user already rated, keep the order, re-rank, keep ``n``."""
    kept = recs.join(seen.select(user_col, item_col), [user_col, item_col], "left_anti")
    order = [F.asc("_r0"), F.asc(item_col)] + ([F.asc("seed")] if "seed" in recs.columns else [])
    ranked = top_n_per_group(kept.withColumnRenamed("rank", "_r0"), [user_col], order, n)
    return ranked.drop("_r0").select(user_col, "rank", *[c for c in recs.columns
                                                         if c not in (user_col, "rank")])


def recommend_unseen_first(train: DataFrame, n: int = 20, user_col: str = "user_id",
                           item_col: str = "movie_id", rating_col: str = "user_rating",
                           mean_key: str = "item", min_rated: int = 1,
                           chunk: int = DEFAULT_CHUNK, similarity: DataFrame | None = None) -> DataFrame:
    """Top ``n`` candidate rows per user after removing already rated items.

    Exact without full neighbour lists.  The lists are read to depth ``2 * n`` first.
    The first unseen neighbours of a user's seeds say what the user's n-th best
    similarity reaches at least, and only what reaches it is sent.  A (user, seed) is read on to
    four times the depth only if its list goes on, its last similarity still
    reaches the user's n-th best row found, and fewer than ``n`` of its rows were unseen;
    deeper lists are made for those seeds alone.  Without a ``similarity`` the lists are
    summed in rounds of items, the deeper ones from the ratings of their own raters.
    """
    def ranked_lists(low, high, wanted=None):
        """``neighbour_lists`` from place ``low`` to ``high``, of all items or of the ``wanted`` ones."""
        if similarity is None:
            lists = nearest_lists(item_similarity_rounds(
                train, user_col, item_col, rating_col, mean_key, chunk, high, wanted), high)
            if low:
                lists = lists.where(F.size("names") > low).select(
                    "seed", *[F.slice(c, low + 1, high - low).alias(c) for c in ("names", "sims")])
        elif wanted is None:
            lists = neighbour_lists(item_neighbours(similarity, high, items))
        else:
            deep = top_n_per_group(item_neighbours(similarity).join(wanted, "item", "left_semi"), ["item"],
                                   [F.desc("sim"), F.asc("neighbour")], high)
            lists = neighbour_lists(deep.where(F.col("rank") > low))
        return materialize(lists, "ranked-lists")

    rated = users_min_rated(train, min_rated, user_col)
    seeds = materialize(rated.groupBy(F.col(user_col), F.col(item_col).alias("seed"))
                        .agg(F.count(F.lit(1)).alias("w")), "user-seeds")
    seen = seeds.select(user_col, F.col("seed").alias(item_col))
    hot, hot_users = hot_keys(seeds.select("seed"), "seed"), hot_keys(seeds.select(user_col), user_col)
    items = train.select(F.col(item_col).alias("item")).where("item is not null")

    def nth(rows):
        """(user, least): the n-th best similarity of the rows, of users that have as many."""
        return (top_n_per_group(rows.select(user_col, "sim"), [user_col], [F.desc("sim")], n)
                .where(F.col("rank") == n).select(user_col, F.col("sim").alias("least")))

    low, high, short, found = 0, 2 * n, seeds, None
    lists = ranked_lists(low, high)
    heads = lists.select("seed", F.slice("names", 1, HEADS).alias("names"), F.slice("sims", 1, HEADS).alias("sims"))
    # written, so that what the bounds were made of is not kept until the rows are read
    least = materialize(nth(split_join(seeds.select(user_col, "seed"), heads, "seed", hot=hot)
                            .select(user_col, F.inline(F.arrays_zip("names", "sims"))).toDF(user_col, item_col, "sim")
                            .join(seen, [user_col, item_col], "left_anti")), "user-bounds")
    while True:
        open_seeds = split_join(short, least, user_col, "left", hot_users)
        rows = (split_join(open_seeds, lists, "seed", hot=hot)
                .select(user_col, "seed", "w", "least", F.inline(F.arrays_zip("names", "sims")))
                .where(F.col("least").isNull() | (F.col("sims") >= F.col("least")))
                .select(user_col, F.col("names").alias(item_col), "seed", F.col("sims").alias("sim"), "w")
                .join(seen, [user_col, item_col], "left_anti"))
        rows = materialize(rows, "unseen-rows")
        found = rows if found is None else found.unionByName(rows)
        least = materialize(nth(found), "user-bounds")
        longer = lists.where(F.size("sims") == high - low).select("seed", F.element_at("sims", -1).alias("last"))
        going = split_join(split_join(short, longer, "seed", hot=hot), least, user_col, "left", hot_users)
        going = materialize(going.where(F.col("least").isNull() | (F.col("last") >= F.col("least")))
                            .select(user_col, "seed", "w"), "open-seeds")
        if going.isEmpty():
            break
        have = found.groupBy(user_col, "seed").agg(F.count(F.lit(1)).alias("_have"))
        short = materialize(going.join(have, [user_col, "seed"], "left").where(F.coalesce("_have", F.lit(0)) < n)
                            .drop("_have"), "open-seeds")
        if short.isEmpty():
            break
        low, high = high, 4 * high
        wanted = short.select(F.col("seed").alias("item")).distinct()
        lists = ranked_lists(low, high, wanted)
    top = top_n_per_group(found, [user_col], [F.desc("sim"), F.asc(item_col), F.asc("seed")], n, rank_col="_r0")
    return _expand_ranks(top, user_col, n).select(user_col, "rank", item_col, "seed", "sim")


def seen_multiset_diff(recs: DataFrame, seen: DataFrame, user_col: str = "user_id",
                       item_col: str = "movie_id") -> DataFrame:
    """Recommended (user, item) rows minus rated rows, one removal per rated row."""
    return recs.select(user_col, item_col).exceptAll(seen.select(user_col, item_col))


def to_item_lists(recs: DataFrame, user_col: str = "user_id", item_col: str = "movie_id") -> DataFrame:
    """(user, items array<int>) in rank order; lists are bounded by the top-n size."""
    return recs.groupBy(user_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", item_col))),
                    lambda x: x[item_col]).alias("items"))


def explode_item_lists(lists: DataFrame, user_col: str = "user_id",
                       item_col: str = "movie_id") -> DataFrame:
    """Inverse of ``to_item_lists``: (user, rank, item) rows."""
    return lists.select(user_col, F.posexplode("items").alias("pos", item_col)).select(
        user_col, (F.col("pos") + 1).cast("int").alias("rank"), item_col)
