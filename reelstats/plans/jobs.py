"""Batch jobs: the application's steps, connected through stored tables.

Each step reads the tables of the previous steps from a store folder (any
Hadoop path: shared file system, object store) and replaces its own outputs.
Writing between steps keeps every job's lineage short, so a lost executor
costs at most a recomputation inside one step.

    ingest      delimited movie / rating / tag files -> raw tables
    clean       profile + dedupe / null drop / label cleanup -> cleaned tables
    features    attribute repair, popularity, monthly, averages, genre top 10,
                dense item codes, train / test / check split
    models      item-CF top lists and the ALS grid search + best model
    evaluate    precision / recall / F1 at K for both models
    recommend   top-N unseen movies per user with names, for both models
    dashboard   the small JSON datasets of the dashboard

Command line: ``python -m reelstats.plans.jobs STEP --store PATH [options]``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.operators import als, clean, coding, dashboard, evaluate, itemcf, profile, serve, stats
from reelstats.operators.skew import hot_keys, split_join
from reelstats.session import materialize
from reelstats.sources import io

# Stored table names, as the dashboard and downstream tools know them.
T_MOVIE, T_RATING, T_TAG = "Movie", "Rating", "Tag"
T_MOVIE_CLEAN, T_RATING_CLEAN, T_TAG_CLEAN = "MovieExpPre", "RatingExpPre", "TagExpPre"
T_PROFILE, T_REJECTED, T_UNRESOLVED = "Profile", "RatingRejected", "RecommendUnresolved"
T_STEPS, REJECTS = "CleanSteps", "Rejected"
T_POPULAR, T_MONTHLY, T_AVERAGE, T_GENRE_TOP = (
    "RateMoreMovies", "RateMoreRecentlyMovies", "AverageMovies", "GenresTopMovies")
T_CODE, T_CODES = "RatingCode", "MovieCode"   # RatingCode is partitioned by split
T_ITEM_MODEL, T_ALS_GRID, T_ALS_BEST, T_ALS_MODEL = (
    "ItemModel", "ALSGrid", "ALSBestParam", "ALSBestModel")
T_ITEM_EVAL, T_ALS_EVAL = "ItemEval", "ALSEval"
T_ITEM_RECS, T_ALS_RECS = "ItemRecommenderDF", "ALSRecommenderDF"


class Store:
    """Tables as parquet folders under one root path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return io.read_table(self.spark, self.path(name))

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        io.write_table(df, self.path(name), partition_by=partition_by)
        return self.read(name)

    def split(self, part: str) -> DataFrame:
        """One part of the coded ratings (a partition of the table: pruned, not copied)."""
        return self.read(T_CODE).where(F.col("split") == part).drop("split")


def ingest(spark: SparkSession, store: Store, movie_path: str, rating_path: str, tag_path: str,
           sep: str = "$") -> None:
    """Load the three delimited files: columns by header name, every column text; malformed lines to a reject table."""
    for path, name in ((movie_path, T_MOVIE), (rating_path, T_RATING), (tag_path, T_TAG)):
        good, rejected = io.scan_delimited(spark, path, sep=sep)
        store.write(good, name)
        store.write(rejected, name + REJECTS)


def clean_step(store: Store, how: str = "all") -> None:
    """Write the cleaned tables; the profile comes out of the same passes, one job a table."""
    tables = clean.counted_tables(store.read(T_MOVIE), store.read(T_RATING), store.read(T_TAG), how)
    counts = []
    for name, target in (("movies", T_MOVIE_CLEAN), ("ratings", T_RATING_CLEAN), ("tags", T_TAG_CLEAN)):
        df, steps = tables[name]
        store.write(df, target)
        counts += steps.rows()
    steps = store.write(store.spark.createDataFrame(counts, clean.STEP_COUNTS), T_STEPS)
    store.write(profile.from_steps(steps), T_PROFILE)


def features(store: Store, split: str = "hash", seed: int = 123, genre_n: int = 10) -> None:
    """Statistics, genre top lists, dense item codes and the model splits."""
    movies = clean.attr_repair(store.read(T_MOVIE_CLEAN))
    ratings, tags = store.read(T_RATING_CLEAN), store.read(T_TAG_CLEAN)
    store.write(stats.popular_items(ratings), T_POPULAR)
    store.write(stats.popular_items_by_month(ratings), T_MONTHLY)
    averages = store.write(stats.avg_rating(ratings), T_AVERAGE)
    store.write(stats.genre_top_n_lists(stats.genre_top_n(movies, tags, averages, genre_n)), T_GENRE_TOP)
    # rows that no model can read are kept as a table of their own, with their number in the profile
    store.write(clean.rejected_ratings(ratings, rating_is_label=False), T_REJECTED)
    typed = clean.typed_ratings(ratings, require_all=True, rating_is_label=False)
    codes = store.write(coding.dense_code(typed, "movie_id", "movie_code"), T_CODES)
    coded = coding.apply_code(typed, codes, "movie_id", "movie_code").select(
        "movie_code", "user_id", "user_rating", "time_stamp", "movie_id")
    parts = (coding.hash_split(coded) if split == "hash"
             else coding.random_split(materialize(coded, "coded"), (0.8, 0.1, 0.1), seed))
    # one table partitioned by part; train / test / check are its partitions
    store.write(parts, T_CODE, partition_by=["split"])


def models(store: Store, top_n: int = 30, ranks=als.REFERENCE_RANKS, regs=als.REFERENCE_REGS,
           iters=als.REFERENCE_ITERS, seed: int = 42) -> None:
    """Item-CF top lists per user; ALS grid search, best parameters and best model."""
    train, check = store.split("train"), store.split("check")
    top = itemcf.item_cf_recommend(train, top_n, item_col="movie_code")
    store.write(itemcf.to_item_lists(top, item_col="movie_code"), T_ITEM_MODEL)
    fits, model = als.grid_fit(train, check, ranks, regs, iters, seed)
    store.write(als.best_params(store.write(fits, T_ALS_GRID)), T_ALS_BEST)
    als.save_model(model, store.path(T_ALS_MODEL))


def evaluate_step(store: Store, ks=(10, 20, 30)) -> None:
    """Macro metrics for item-CF (min 1 test rating), micro metrics for ALS (min 2)."""
    train, test = store.split("train"), store.split("test")
    item_recs = itemcf.explode_item_lists(store.read(T_ITEM_MODEL), item_col="movie_code")
    store.write(evaluate.eval_macro_at_k(item_recs, test, ks, 1, item_col="movie_code"), T_ITEM_EVAL)
    model = als.load_model(store.path(T_ALS_MODEL))
    users = test.select("user_id").distinct().join(train.select("user_id"), "user_id", "left_semi")
    als_recs = als.recommend_for_users(model, users, max(ks))
    store.write(evaluate.eval_micro_at_k(als_recs, train, test, ks, 2, item_col="movie_code"),
                T_ALS_EVAL)


def recommend(store: Store, n: int = 20, users: list[int] | None = None) -> None:
    """Top ``n`` unseen movies per user with names, from both models."""
    train, codes = store.split("train"), store.read(T_CODES)
    movies = store.read(T_MOVIE_CLEAN)
    target = serve.for_users(train, users) if users else train
    lists = store.read(T_ITEM_MODEL)
    if users:
        lists = serve.for_users(lists, users)
    top = itemcf.explode_item_lists(lists, item_col="movie_code")
    unseen = materialize(itemcf.remove_seen(top, train, n, item_col="movie_code"), "unseen-recs")
    named = serve.decode_with_names(unseen, codes, movies)
    item_recs = store.write(named.select("user_id", "rank", "movie_id", "movie_name", "movie_type"), T_ITEM_RECS)
    model = als.load_model(store.path(T_ALS_MODEL))
    recs = materialize(als.recommend_unseen(model, train, target.select("user_id"), n), "als-recs")
    named = serve.with_truncated_rating(serve.decode_with_names(recs, codes, movies))
    als_recs = store.write(named.select("user_id", "rank", "movie_id", "movie_name", "movie_type",
                                        "prediction", "movie_rating"), T_ALS_RECS)
    missing = [serve.missing_names(df).withColumn("model", F.lit(name))
               for name, df in (("item_cf", item_recs), ("als", als_recs))]
    store.write(missing[0].unionByName(missing[1]), T_UNRESOLVED)


def recommend_from_text(spark: SparkSession, user_codes: str, item_codes: str, train_text: str,
                        model_path: str, names: DataFrame, users: DataFrame | None = None,
                        n: int = 10, name_col: str = "name") -> DataFrame:
    """Top ``n`` unseen items per user from tuple-text inputs and a saved ALS model.

    ``user_codes`` / ``item_codes``: lines ``(id,code)``; ``train_text``: lines
    ``(user_code,item_code,rating)``; ``names``: (item id, ``name_col``) rows, e.g.
    from ``io.read_jdbc``.  Output: user id, item id, item name and the
    predicted rating truncated to an integer, as the serving step expects.
    """
    ucodes = io.read_tuple_text(spark, user_codes, ["string", "int"], ["user_key", "user_id"])
    icodes = io.read_tuple_text(spark, item_codes, ["string", "int"], ["item_key", "movie_code"])
    train = io.read_tuple_text(spark, train_text, ["int", "int", "double"],
                               ["user_id", "movie_code", "user_rating"])
    model = als.load_model(model_path)
    targets = users if users is not None else train.select("user_id").distinct()
    recs = materialize(als.recommend_unseen(model, train, targets, n), "als-recs")
    id_col = names.columns[0]
    # one key per code and one name per key: the number of recommendations never changes
    ucodes = ucodes.groupBy("user_id").agg(F.min("user_key").alias("user_key"))
    icodes = icodes.groupBy("movie_code").agg(F.min("item_key").alias("item_key"))
    items = names.groupBy(F.col(id_col).alias("item_key")).agg(F.min(name_col).alias(name_col))
    # code, key and name of an item are one table; a user has at most n rows, so only items can be hot
    out = split_join(recs.join(ucodes, "user_id", "left"), icodes.join(items, "item_key", "left"), "movie_code", "left",
                     hot=hot_keys(recs, "movie_code"))
    return out.select("user_key", "item_key", F.col(name_col).alias("item_name"),
                      F.col("prediction").try_cast("int").alias("rating"), "rank")


def dashboard_step(store: Store, out: str, poster_path: str | None = None, sep: str = "$") -> None:
    """JSON datasets of the dashboard under ``out``."""
    movies, ratings, tags = store.read(T_MOVIE_CLEAN), store.read(T_RATING_CLEAN), store.read(T_TAG_CLEAN)
    typed = clean.typed_ratings(ratings, require_all=True, rating_is_label=False)
    sets = {
        "totals": dashboard.totals(typed, movies, tags),
        "userRL": dashboard.rating_histogram(typed).select("name", "y").orderBy("name"),
        "RateMoreMoviesTop10": dashboard.top_by_raters(movies, 10).select(
            "movie_name", F.col("rating_people_num").try_cast("int").alias("rating_people_num")),
        "MoviesDate": dashboard.release_labels(dashboard.releases_by_month(movies)),
        "GenrePreference": dashboard.genre_preference(tags),
        "RecentTop10": dashboard.recent_top(movies, 50, 10),
    }
    if poster_path:
        posters = io.read_delimited(spark_of(movies), poster_path, sep=sep)
        sets["PosterPopular"] = dashboard.poster_popular(movies, posters)
        sets["PosterRecent"] = dashboard.poster_recent(movies, posters)
        sets["PosterRated"] = dashboard.poster_rated(movies, posters)
    for name, df in sets.items():
        io.write_json_array(df, f"{out.rstrip('/')}/{name}")


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


STEPS = ["ingest", "clean", "features", "models", "evaluate", "recommend", "dashboard"]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("step", choices=STEPS)
    ap.add_argument("--store", required=True)
    ap.add_argument("--movies"), ap.add_argument("--ratings"), ap.add_argument("--tags")
    ap.add_argument("--posters")
    ap.add_argument("--out")
    ap.add_argument("--users", type=int, nargs="*")
    ap.add_argument("--split", default="hash", choices=["hash", "random"])
    args = ap.parse_args(argv)
    from reelstats.session import build_session
    spark = build_session()
    store = Store(spark, args.store)
    if args.step == "ingest":
        ingest(spark, store, args.movies, args.ratings, args.tags)
    elif args.step == "clean":
        clean_step(store)
    elif args.step == "features":
        features(store, args.split)
    elif args.step == "models":
        models(store)
    elif args.step == "evaluate":
        evaluate_step(store)
    elif args.step == "recommend":
        recommend(store, users=args.users)
    else:
        dashboard_step(store, args.out or store.path("web_data"), args.posters)


if __name__ == "__main__":
    main()
