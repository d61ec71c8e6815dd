"""Matrix factorisation with Spark ML ALS: fit, grid search, predict, top-K."""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.operators.evaluate import rmse
from reelstats.operators.innerproduct import BLOCK_ITEMS, top_products
from reelstats.session import free_unused, freed_shuffles, materialize, scratch_path

FITS_AT_ONCE = 1 << 23  # ratings that concurrent fits hold together; a larger table fills the cluster by itself

# The grid of the original model search, 3 ranks x 4 lambdas x 2 iteration counts.
REFERENCE_RANKS = (10, 20, 30)
REFERENCE_REGS = (0.01, 0.1, 1.0, 1.2)
REFERENCE_ITERS = (10, 20)


def fit_als(train: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
            seed: int = 42, user_col: str = "user_id", item_col: str = "movie_code",
            rating_col: str = "user_rating", checkpoint_interval: int = 1,
            num_blocks: int | None = None) -> ALSModel:
    """Explicit-feedback ALS.  Unknown users/items are dropped at prediction.

    Iterations checkpoint to the session's checkpoint folder every ``checkpoint_interval``
    steps.  A step sends every factor to most blocks, and Spark deletes the shuffles of the
    steps before at a checkpoint only: one item table written a step keeps one step's on disk.
    """
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol=user_col,
              itemCol=item_col, ratingCol=rating_col, implicitPrefs=False, nonnegative=False,
              coldStartStrategy="drop", checkpointInterval=checkpoint_interval)
    blocks = num_blocks or default_blocks(train)
    return als.setNumUserBlocks(blocks).setNumItemBlocks(blocks).fit(train)


def default_blocks(df: DataFrame, least: int = 10) -> int:
    """Blocks of users and of items: as many as the cluster runs tasks at once."""
    try:
        return max(least, df.sparkSession.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``prediction`` for each row with a known user and item."""
    return model.transform(pairs)


def grid_search(train: DataFrame, check: DataFrame, ranks=REFERENCE_RANKS,
                regs=REFERENCE_REGS, iters=REFERENCE_ITERS, seed: int = 42,
                user_col: str = "user_id", item_col: str = "movie_code",
                rating_col: str = "user_rating", parallelism: int = 1) -> DataFrame:
    """One row per fit: (order, rank, max_iter, reg, rmse) in the original loop order (see ``grid_fit``)."""
    return grid_fit(train, check, ranks, regs, iters, seed, user_col, item_col, rating_col, parallelism)[0]


def grid_fit(train: DataFrame, check: DataFrame, ranks=REFERENCE_RANKS, regs=REFERENCE_REGS,
             iters=REFERENCE_ITERS, seed: int = 42, user_col: str = "user_id", item_col: str = "movie_code",
             rating_col: str = "user_rating", parallelism: int = 1) -> tuple[DataFrame, ALSModel | None]:
    """The grid's rows and the model of its best fit, so that nobody has to fit it again.

    The inputs are written once to the shared folder, so a lost executor costs a
    read, not a recomputation.  With ``parallelism > 1`` independent fits run as concurrent Spark
    jobs (each fit is seeded, so the results do not change), as many as hold ``FITS_AT_ONCE`` ratings
    together.  Only the best model so far is kept, written and read again, and what a fit
    has cached and shuffled goes as soon as it is scored.
    """
    spark = train.sparkSession
    cols = [user_col, item_col, rating_col]
    tr, ck = materialize(train.select(*cols), "grid-train"), materialize(check.select(*cols), "grid-check")
    combos = list(enumerate(itertools.product(ranks, regs, iters)))
    best, lock = [], Lock()

    def run(item):
        order, (rank, reg, it) = item
        model = fit_als(tr, rank, it, reg, seed, user_col, item_col, rating_col)
        value = rmse(predict(model, ck), rating_col).first()["rmse"]
        with lock:  # on equal errors the earlier fit wins, as in ``best_params``
            if value is not None and (not best or (value, order) < best[0][0]):
                path = scratch_path(spark, "grid-model")
                save_model(model, path)
                best[:] = [((value, order), path)]
        del model
        free_unused(spark)
        return (order, int(rank), int(it), float(reg), float(value) if value is not None else None)

    at_once = min(parallelism, max(1, FITS_AT_ONCE // max(tr.count(), 1)))
    with freed_shuffles(spark):
        if at_once > 1:
            with ThreadPoolExecutor(max_workers=at_once) as pool:
                rows = list(pool.map(run, combos))
        else:
            rows = [run(c) for c in combos]
    grid = spark.createDataFrame(rows, "order int, rank int, max_iter int, reg double, rmse double")
    return grid, load_model(best[0][1]) if best else None


def best_params(metrics: DataFrame) -> DataFrame:
    """Arg-min of rmse; on equal rmse the earlier fit wins (strict '<' in the loop)."""
    best = F.min_by(F.struct("rank", "max_iter", "reg", "rmse"), F.struct("rmse", "order"))
    return (metrics.where(F.col("rmse").isNotNull()).agg(best.alias("b"))
            .select("b.rank", "b.max_iter", "b.reg", "b.rmse"))


def library_for_users(model: ALSModel, users: DataFrame, k: int,
                      user_col: str = "user_id", item_col: str = "movie_code") -> DataFrame:
    """Spark ML's own top ``k`` items per user, from the whole product: (user, rank, item, prediction)."""
    recs = model.recommendForUserSubset(users.select(user_col).distinct(), k)
    return (recs.select(user_col, F.posexplode("recommendations").alias("pos", "rec"))
            .select(user_col, (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col(f"rec.{item_col}").alias(item_col),
                    F.col("rec.rating").cast("double").alias("prediction")))


def _served(model: ALSModel, users: DataFrame, n: int, seen: DataFrame | None, user_col: str, item_col: str,
            **options) -> DataFrame:
    wanted = users.select(F.col(user_col).cast("int").alias("id")).distinct()
    if seen is not None:
        seen = seen.select(F.col(user_col).cast("int").alias("user"), F.col(item_col).cast("int").alias("item"))
    return top_products(model.userFactors.join(wanted, "id", "left_semi"), model.itemFactors, n, seen, **options)


def _ranked(lists: DataFrame, user_col: str, item_col: str) -> DataFrame:
    pairs = F.posexplode(F.arrays_zip("items", "scores")).alias("pos", "rec")
    return lists.select(F.col("user").alias(user_col), pairs).select(
        user_col, (F.col("pos") + 1).cast("int").alias("rank"), F.col("rec.items").alias(item_col),
        F.col("rec.scores").cast("double").alias("prediction"))


def recommend_for_users(model: ALSModel, users: DataFrame, k: int, user_col: str = "user_id",
                        item_col: str = "movie_code", **options) -> DataFrame:
    """Top ``k`` items per user (seen items not removed): (user, rank, item, prediction).

    The same lists as ``library_for_users`` without the whole product (``operators.innerproduct``).
    """
    return _ranked(_served(model, users, k, None, user_col, item_col, **options), user_col, item_col)


def recommend_unseen(model: ALSModel, seen: DataFrame, users: DataFrame, n: int = 20, user_col: str = "user_id",
                     item_col: str = "movie_code", **options) -> DataFrame:
    """Top ``n`` items per user among items the user has not rated.

    One search by falling item norm with seen items skipped inside: no list is
    served deeper than ``n``, whatever a user has seen.
    """
    return _ranked(_served(model, users, n, seen, user_col, item_col, **options), user_col, item_col)


def search_report(model: ALSModel, seen: DataFrame, users: DataFrame, n: int = 20, user_col: str = "user_id",
                  item_col: str = "movie_code", block: int = BLOCK_ITEMS) -> DataFrame:
    """(users, blocks, scored, share): (user, item block) pairs in all, and those that the search scored."""
    lists = _served(model, users, n, seen, user_col, item_col, block=block)
    blocks = model.itemFactors.agg(F.ceil(F.count(F.lit(1)) / block).alias("b")).scalar()
    return lists.agg(F.count(F.lit(1)).alias("users"), F.sum("blocks").alias("scored")).select(
        "users", (F.col("users") * blocks).alias("blocks"), "scored",
        F.try_divide("scored", F.col("users") * blocks).alias("share"))


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
