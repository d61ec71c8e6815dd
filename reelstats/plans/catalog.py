"""Named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Each query reads the driver tables through the fixture views, so its work
grows with the scale factor.  Metric percentages are rounded to 6 decimals
(see FIXTURES.md section 3); everything else is returned at full precision.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelstats.functions.scalars import (
    epoch_to_year_month, strip_brackets, truncate_toward_zero,
)
from reelstats.operators import (
    als, bitmaps, clean, coding, dashboard, evaluate, itemcf, neighbours, profile, serve, sketches, stats,
)
from reelstats.operators.skew import split_join
from reelstats.plans import sql_text
from reelstats.session import materialize, scratch_path
from reelstats.sources import bucketed, documents, fixtures, io

KS = (10, 20, 30)
TOP_N = 30          # item-CF rows per user
SERVE_N = 20        # recommendations shown per user
DIGITS = 6          # rounding of reported metric percentages
# Best ALS parameters of the original grid search (rank, iterations, lambda).
ALS_RANK, ALS_ITERS, ALS_REG = 20, 20, 0.1
ALS_SEED = 42
SHRINK = (0, 1, 2, 5, 10, 20, 50)  # grid of the shrunken item means
SQL_MONTHS, SQL_GENRE, SQL_USER = (199501, 199603), "widget", "4"  # arguments of the table functions' queries
RATING_COLS = ("user_id", "movie_id", "user_rating", "time_stamp")
HEAVY_USER = 256    # distinct ratings above which a user's pairs are bounded first, in the query on a heavy user
GRID_PARALLELISM = 4  # concurrent ALS fits in the grid search


class Ctx:
    """Lazily built fixture views and shared intermediate frames of one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # raw views
    @cached_property
    def ratings_raw(self): return fixtures.ratings_raw(self.spark, self.sf_dir)
    @cached_property
    def movies_raw(self): return fixtures.movies_raw(self.spark, self.sf_dir)
    @cached_property
    def tags_raw(self): return fixtures.tags_raw(self.spark, self.sf_dir)
    @cached_property
    def posters(self): return fixtures.posters(self.spark, self.sf_dir)

    # cleaned tables (dedupe -> drop all-null rows -> labels)
    @cached_property
    def cleaned(self):
        return clean.clean_tables(self.movies_raw, self.ratings_raw, self.tags_raw, "all")
    @property
    def movies_clean(self): return self.cleaned[0]
    @property
    def ratings_clean(self): return self.cleaned[1]
    @property
    def tags_clean(self): return self.cleaned[2]
    @cached_property
    def movies_attr(self): return clean.attr_repair(self.movies_clean)

    # model inputs
    @cached_property
    def ratings(self):
        # one join and dedupe for the codes, the coded ratings and the split
        return materialize(fixtures.ratings(self.spark, self.sf_dir), "ratings")
    @cached_property
    def split(self):
        # written once, partitioned by part: the model queries read it many times; straight from
        # the tables unless the query has written the ratings for something else as well
        ratings = self.ratings if "ratings" in self.__dict__ else fixtures.ratings(self.spark, self.sf_dir)
        return materialize(coding.hash_split(ratings), "ratings_split", ["split"])
    @cached_property
    def train(self): return fixtures.split_part_of(self.split, "train")
    @cached_property
    def test(self): return fixtures.split_part_of(self.split, "test")
    @cached_property
    def check(self): return fixtures.split_part_of(self.split, "check")

    # item-CF on movie ids
    @cached_property
    def similarity(self): return itemcf.item_similarity(self.train)
    @cached_property
    def top30(self): return itemcf.item_cf_recommend(self.train, TOP_N)
    @cached_property
    def recs30(self):
        # for what shuffles the recommendations again: their own shuffles end with the copy
        return materialize(self.top30, "top30")
    @cached_property
    def unseen20(self): return itemcf.remove_seen(self.recs30, self.train, SERVE_N)

    # coded pipeline (dense movie codes, as the models use them)
    @cached_property
    def codes(self):
        return materialize(coding.dense_code(self.ratings, "movie_id", "movie_code"), "movie_codes")
    @cached_property
    def coded(self):
        return coding.apply_code(self.ratings, self.codes, "movie_id", "movie_code"), self.codes
    @cached_property
    def coded_split(self):
        return materialize(coding.hash_split(self.coded[0]), "rating_code_split", ["split"])
    @cached_property
    def coded_train(self): return fixtures.split_part_of(self.coded_split, "train")
    @cached_property
    def coded_test(self): return fixtures.split_part_of(self.coded_split, "test")
    @cached_property
    def coded_check(self): return fixtures.split_part_of(self.coded_split, "check")

    @cached_property
    def als_model(self):
        return als.fit_als(self.coded_train, ALS_RANK, ALS_ITERS, ALS_REG, ALS_SEED)


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---------------------------------------------------------------- profiling
def profile_counts(c: Ctx):
    return profile.profile_tables(_raw(c)).select("table_name", "n_rows")


def profile_duplicates(c: Ctx):
    return profile.profile_tables(_raw(c)).select("table_name", "n_rows", "n_distinct",
                                                  "n_duplicates")


def profile_nulls(c: Ctx):
    return profile.profile_tables(_raw(c)).select("table_name", "n_any_null", "n_all_null")


def _raw(c: Ctx):
    return {"movies": c.movies_raw, "ratings": c.ratings_raw, "tags": c.tags_raw}


def profile_distinct(c: Ctx):
    return profile.distinct_counts(c.ratings_clean, c.tags_raw)


def distinct_sketches(c: Ctx):
    """Distinct users and movies per month, and over all months from the merged sketches, next to the exact counts."""
    cols = ["user_id", "movie_id"]
    months = materialize(sketches.monthly_sketches(c.ratings_clean, cols), "month-sketches")
    all_months = sketches.merged(months, cols).withColumn("year_month", F.lit(0))
    found = sketches.estimates(months, cols, ["year_month"]).unionByName(
        sketches.estimates(all_months, cols, ["year_month"]))
    month = epoch_to_year_month("time_stamp")
    exact = [F.count_distinct(x).alias(x) for x in cols]
    by_month = c.ratings_clean.groupBy(month.alias("year_month")).agg(*exact)
    total = c.ratings_clean.agg(*exact).withColumn("year_month", F.lit(0))
    truth = by_month.unionByName(total).unpivot(["year_month"], cols, "metric", "n_exact")
    both = truth.withColumnsRenamed({"year_month": "_m", "metric": "_k"}).join(
        found, F.col("_m").eqNullSafe(F.col("year_month")) & (F.col("_k") == F.col("metric")))
    close = F.abs(F.col("estimate") - F.col("n_exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("n_exact"))
    return both.select("year_month", "metric", "n_exact", close.alias("within"))


def duplicate_sketches(c: Ctx):
    """Distinct whole rows by a sketch of row hashes, next to the exact number."""
    out = None
    for name, df in _raw(c).items():
        row = df.select(F.struct("*").alias("r"))
        one = sketches.row_sketch(df).withColumn("table_name", F.lit(name)).join(
            row.agg(F.count_distinct("r").alias("n_exact")), F.lit(True))
        out = one if out is None else out.unionByName(one)
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("n_exact"))
    return out.select("table_name", "n_rows", "n_exact", close.alias("within"))


def clean_step_counts(c: Ctx):
    """Rows after every cleaning step, counted by the passes that write the cleaned tables."""
    counts = []
    for name, (df, steps) in clean.counted_tables(c.movies_raw, c.ratings_raw, c.tags_raw).items():
        materialize(df, f"counted-{name}")
        counts += steps.rows()
    return c.spark.createDataFrame(counts, clean.STEP_COUNTS)


def profile_anomaly_any_col(c: Ctx):
    return profile.anomaly_rows(c.movies_raw)


def profile_rating_labels(c: Ctx):
    return profile.rating_label_count(c.ratings_raw)


def avg_activity_per_user(c: Ctx):
    return profile.avg_activity(c.ratings_clean, "user_id", "movie_id", "user_comm_avg")


def avg_activity_per_item(c: Ctx):
    return profile.avg_activity(c.ratings_clean, "movie_id", "user_id", "movie_comm_avg")


def top10_by_raters(c: Ctx):
    return dashboard.top_by_raters(c.movies_raw, 10)


# ---------------------------------------------------------------- cleaning
def clean_dedupe(c: Ctx):
    return clean.dedupe(c.ratings_raw)


def clean_drop_null_all(c: Ctx):
    return clean.drop_null_rows(clean.dedupe(c.ratings_raw), "all")


def clean_drop_null_any(c: Ctx):
    return clean.drop_null_rows(clean.dedupe(c.ratings_raw), "any")


def clean_labels(c: Ctx):
    return c.movies_clean


def clean_rating(c: Ctx):
    return c.ratings_clean


def attr_repair(c: Ctx):
    return c.movies_attr


def typed_ratings(c: Ctx):
    return fixtures.ratings(c.spark, c.sf_dir)


def rejected_ratings(c: Ctx):
    """Rows that the typed ratings leave out because an id or the rating does not parse."""
    return clean.rejected_ratings(clean.dedupe(c.ratings_raw))


def year_month(c: Ctx):
    return c.ratings_clean.select("user_id", "movie_id", "time_stamp",
                                  epoch_to_year_month("time_stamp").alias("year_month"))


def strip_brackets_q(c: Ctx):
    rowtext = F.concat(F.lit("["), F.col("user_tag"), F.lit("]"))
    return c.tags_raw.select(strip_brackets(rowtext).alias("genre")).distinct()


def distinct_tags(c: Ctx):
    return stats.distinct_tags(c.tags_clean)


# ---------------------------------------------------------------- statistics
def popular_items(c: Ctx):
    return stats.popular_items(c.ratings_clean)


def popular_items_by_month(c: Ctx):
    return stats.popular_items_by_month(c.ratings_clean)


def popular_topn_per_month(c: Ctx):
    return stats.popular_top_n_per_month(c.ratings_clean, 10)


def avg_rating(c: Ctx):
    return stats.avg_rating(c.ratings_clean)


def movies_with_avg(c: Ctx):
    return stats.movies_with_avg(c.movies_attr, stats.avg_rating(c.ratings_clean))


def genre_match(c: Ctx):
    return (stats.genre_match(stats.distinct_tags(c.tags_clean), c.movies_attr)
            .select("genre", "movie_id"))


def genre_top10(c: Ctx):
    return stats.genre_top_n(c.movies_attr, c.tags_clean, stats.avg_rating(c.ratings_clean), 10)


def genre_top10_lists(c: Ctx):
    """The nested form, its lists as ordered text."""
    lists = stats.genre_top_n_lists(genre_top10(c))
    ids = F.transform("items", lambda x: x["movie_id"].cast("string"))
    return lists.select("movie_type", F.size("items").alias("n_items"), F.array_join(ids, ",").alias("movie_ids"))


def popular_items_ranked(c: Ctx):
    """The stored order as positions, so that it is part of the result."""
    return coding.number_rows(stats.popular_items(c.ratings_clean), [F.desc("count"), F.asc("movie_id")])


def popular_items_by_month_ranked(c: Ctx):
    return coding.number_rows(stats.popular_items_by_month(c.ratings_clean),
                              [F.desc("year_month"), F.desc("count"), F.asc("movie_id")])


def avg_rating_ranked(c: Ctx):
    return coding.number_rows(stats.avg_rating(c.ratings_clean), [F.desc("avg"), F.asc("movie_id")])


def sql_popular_items(c: Ctx):
    return sql_text.popular_items_sql(c.ratings_clean)


def sql_popular_items_by_month(c: Ctx):
    return sql_text.popular_items_by_month_sql(c.ratings_clean)


def sql_avg_rating(c: Ctx):
    return sql_text.avg_rating_sql(c.ratings_clean)


def sql_top_of_month(c: Ctx):
    return sql_text.top_of_month_sql(c.ratings_clean, c.movies_attr, SQL_MONTHS, 10)


def sql_top_of_genre(c: Ctx):
    return sql_text.top_of_genre_sql(c.ratings_clean, c.movies_attr, SQL_GENRE, 10)


def sql_rated_by(c: Ctx):
    return sql_text.rated_by_sql(c.ratings_clean, c.movies_attr, SQL_USER)


# ---------------------------------------------------------------- coding / splits
def dense_code(c: Ctx):
    return coding.dense_code(c.ratings, "movie_id", "movie_code")


def rating_code(c: Ctx):
    return c.coded[0].select("movie_code", "user_id", "user_rating", "time_stamp", "movie_id")


def split_hash(c: Ctx):
    return c.split


def split_balance(c: Ctx):
    """Rows and users per part, and users (of those with three or more) whose items share one last digit."""
    users = c.split.groupBy("split", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("movie_id").alias("items"),
        F.count_distinct(F.col("movie_id") % 10).alias("digits"))
    many = F.col("items") >= 3
    return users.groupBy("split").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_users"), F.count(F.when(many, 1)).alias("n_users_3"),
        F.count(F.when(many & (F.col("digits") == 1), 1)).alias("n_one_digit"))


def split_random(c: Ctx):
    return coding.random_split(c.ratings, (0.8, 0.1, 0.1), 123)


def split_random_checks(c: Ctx):
    """Rows of the random split against its input: none lost, none doubled, three parts."""
    parts = materialize(coding.random_split(c.ratings, (0.8, 0.1, 0.1), 123), "random-split")
    cols = c.ratings.columns
    return _checks({
        "rows": parts.agg(F.count(F.lit(1)).alias("value")),
        "parts": parts.agg(F.count_distinct("split").alias("value")),
        "lost": c.ratings.exceptAll(parts.select(*cols)).agg(F.count(F.lit(1)).alias("value")),
        "doubled": parts.select(*cols).exceptAll(c.ratings).agg(F.count(F.lit(1)).alias("value")),
    })


def _checks(counts: dict[str, DataFrame]) -> DataFrame:
    """(name, value) rows of one-row counts."""
    out = None
    for name, df in counts.items():
        row = df.select(F.lit(name).alias("name"), F.coalesce(F.col("value").cast("bigint"), F.lit(0).cast("bigint"))
                        .alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def users_min_rated(c: Ctx):
    return itemcf.users_min_rated(c.test, 2)


# ---------------------------------------------------------------- item-CF
def rating_with_item_mean(c: Ctx):
    m = itemcf.item_means(c.train).withColumnRenamed("item", "movie_id")
    return split_join(c.train, m, "movie_id").select("user_id", "movie_id", "user_rating", "mean")


def rating_mean_key_mixed(c: Ctx):
    m = itemcf.item_means(c.train, mean_key="user").withColumnRenamed("item", "movie_id")
    return split_join(c.train, m, "movie_id").select("user_id", "movie_id", "user_rating", "mean")


def item_similarity(c: Ctx):
    return c.similarity


def item_neighbours(c: Ctx):
    return itemcf.nearest_neighbours(c.train, TOP_N)


def _with_heavy_user(c: Ctx):
    """The training ratings and one user more, who has rated every third movie."""
    movies = c.train.select("movie_id").where(F.col("movie_id") % 3 == 0).distinct()
    one = movies.select(F.lit(-1).alias("user_id"), "movie_id", (1 + F.col("movie_id") % 5).cast("double").alias("user_rating"))
    return c.train.select("user_id", "movie_id", "user_rating").unionByName(one)


def item_neighbours_heavy_user(c: Ctx):
    """Neighbour lists where one user has rated a third of the catalogue: most of that user's pairs are never formed."""
    return neighbours.pruned_neighbours(_with_heavy_user(c), TOP_N, chunk=HEAVY_USER)


def item_neighbours_all(c: Ctx):
    """Every co-rated pair in both directions (no per-item limit)."""
    return itemcf.item_neighbours(c.similarity)


def item_cf_candidates(c: Ctx):
    """Every neighbour of every rated row (whole lists), per user and candidate: rows, seeds, best similarity."""
    return itemcf.candidate_totals(c.train, itemcf.item_neighbours(c.similarity))


def item_cf_top30(c: Ctx):
    return c.top30


def item_cf_top30_dedup(c: Ctx):
    return itemcf.item_cf_recommend(c.train, TOP_N, dedupe=True)


def item_cf_unseen(c: Ctx):
    return c.unseen20


def item_cf_unseen_first(c: Ctx):
    """Rated items removed before the top 20 (instead of after the top 30)."""
    return itemcf.recommend_unseen_first(c.train, SERVE_N)


def recs_for_users(c: Ctx):
    """Serving a given set of users: the customers of one market segment."""
    customers = fixtures.table(c.spark, c.sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    users = customers.select(F.col("c_custkey").cast("int").alias("user_id"))
    top = itemcf.item_cf_recommend(c.train, TOP_N, users=users)
    return itemcf.remove_seen(top, serve.for_users(c.train, users), SERVE_N)


def seen_multiset_diff(c: Ctx):
    return itemcf.seen_multiset_diff(c.recs30, c.train)


def matched_multiset(c: Ctx):
    return c.recs30.select("user_id", "movie_id").intersectAll(c.test.select("user_id", "movie_id"))


def explode_recs(c: Ctx):
    return itemcf.explode_item_lists(itemcf.to_item_lists(c.top30))


def array_ops(c: Ctx):
    lists = itemcf.to_item_lists(c.top30)
    as_text = lambda arr: F.concat_ws(",", F.transform(arr, lambda x: x.cast("string")))
    return lists.select(
        "user_id",
        F.size("items").alias("n_items"),
        as_text(F.slice("items", 1, 10)).alias("top10"),
        as_text(F.array_sort("items")).alias("sorted_items"),
        F.size(F.array_distinct("items")).alias("n_distinct"))


def shared_users(c: Ctx):
    return c.test.select("user_id").distinct().join(c.top30.select("user_id"), "user_id",
                                                    "left_semi")


def unseen_items(c: Ctx):
    """Per training user, the number of catalogue items not yet rated."""
    n_items = c.train.agg(F.count_distinct("movie_id")).scalar()
    return (c.train.groupBy("user_id").agg(F.count_distinct("movie_id").alias("n_rated"))
            .select("user_id", (n_items - F.col("n_rated")).alias("n_unseen")))


def unseen_items_bitmap(c: Ctx):
    """``unseen_items`` from bitmaps of the coded items: one per user and bucket of codes."""
    return bitmaps.unseen_counts(c.coded_train, "user_id", "movie_code")


def shared_users_bitmap(c: Ctx):
    """``shared_users`` as the common keys of two sets of bitmaps."""
    shared = bitmaps.shared_keys(c.test, c.top30, "user_id")
    return shared.select(F.col("user_id").cast("int").alias("user_id"))


def overlap_sizes(c: Ctx):
    """Per user the size of the intersection of recommended and tested movies, as bit counts."""
    recs = bitmaps.key_bitmaps(c.top30, "movie_id", ["user_id"])
    test = bitmaps.key_bitmaps(c.test, "movie_id", ["user_id"])
    return bitmaps.sizes(bitmaps.intersect(recs, test, ["user_id"]), ["user_id"], "n_common")


def decode_recs(c: Ctx):
    """Item-CF on dense codes, unseen top 20, decoded to ids and names."""
    top = itemcf.item_cf_recommend(c.coded_train, TOP_N, item_col="movie_code")
    # read for the frequent items as well as for the join
    unseen = materialize(itemcf.remove_seen(top, c.coded_train, SERVE_N, item_col="movie_code"), "unseen-recs")
    named = serve.decode_with_names(unseen, c.coded[1], c.movies_attr)
    return named.select("user_id", "rank", "movie_id", "movie_name", "movie_type")


def missing_names(c: Ctx):
    """Recommendations whose name cannot be resolved from a table that lacks the movies without a type."""
    named = c.movies_attr.where(F.col("movie_type").isNotNull())
    return serve.missing_names(serve.attach_names(materialize(c.unseen20, "unseen-recs"), named))


# ---------------------------------------------------------------- evaluation
def eval_macro_at_k(c: Ctx):
    return evaluate.eval_macro_at_k(c.recs30, c.test, KS, 1, digits=DIGITS)


def eval_macro_multiset(c: Ctx):
    """Macro metrics on rows as they are: repeated recommendations and test rows count as often as they occur."""
    return evaluate.eval_macro_at_k(c.recs30, c.test, KS, 1, digits=DIGITS, multiset=True)


def grid_argmin(c: Ctx):
    """First-best over a grid with an exact answer: item means shrunk toward the global mean."""
    items = c.train.groupBy("movie_id").agg(F.sum("user_rating").alias("s"), F.count(F.lit(1)).alias("n"))
    mean = c.train.agg(F.avg("user_rating").alias("mu")).scalar()
    grid = F.posexplode(F.array(*[F.lit(float(r)) for r in SHRINK])).alias("order", "reg")
    rows = split_join(c.check, items, "movie_id").withColumn("mu", mean).select("user_rating", "s", "n", "mu", grid)
    pred = (F.col("s") + F.col("reg") * F.col("mu")) / (F.col("n") + F.col("reg"))
    err = F.col("user_rating") - pred
    fits = (rows.groupBy("order", "reg").agg(F.round(F.sqrt(F.avg(err * err)), DIGITS).alias("rmse"))
            .withColumn("rank", F.lit(0)).withColumn("max_iter", F.lit(0)))
    best = als.best_params(fits).select("reg", F.lit(True).alias("is_best"))
    return (fits.join(F.broadcast(best), "reg", "left").fillna(False, ["is_best"])
            .select("order", "reg", "rmse", "is_best"))


def eval_micro_at_k(c: Ctx):
    return evaluate.eval_micro_at_k(c.recs30, c.train, c.test, KS, 2, digits=DIGITS)


def rmse_item_mean(c: Ctx):
    return evaluate.rmse(evaluate.item_mean_predictions(c.train, c.check), digits=DIGITS)


def format_metrics(c: Ctx):
    m = evaluate.eval_micro_at_k(c.recs30, c.train, c.test, KS, 2, digits=DIGITS)
    return evaluate.format_metrics(m, ["k", "matched", "precision", "recall"])


def truncate_rating(c: Ctx):
    pred = evaluate.item_mean_predictions(c.train, c.check)
    return pred.select("user_id", "movie_id", "prediction",
                       truncate_toward_zero("prediction").alias("movie_rating"))


# ---------------------------------------------------------------- dashboard
def rating_histogram(c: Ctx):
    return dashboard.rating_histogram(c.ratings).withColumn("share", F.round("share", DIGITS))


def dashboard_totals(c: Ctx):
    return dashboard.totals(c.ratings, c.movies_clean, c.tags_clean)


def releases_by_month(c: Ctx):
    return dashboard.releases_by_month(c.movies_clean)


def releases_pivot(c: Ctx):
    return dashboard.releases_pivot(c.movies_clean)


def genre_preference(c: Ctx):
    return dashboard.genre_preference(c.tags_clean)


def recent_top10(c: Ctx):
    return dashboard.recent_top(c.movies_clean, 50, 10)


def poster_popular50(c: Ctx):
    return dashboard.poster_popular(c.movies_clean, c.posters, 50)


def poster_recent50(c: Ctx):
    return dashboard.poster_recent(c.movies_clean, c.posters, 50)


def poster_rated50(c: Ctx):
    return dashboard.poster_rated(c.movies_clean, c.posters, 50)


# ---------------------------------------------------------------- sources
def scan_delimited(c: Ctx):
    """Write the raw ratings as '$'-delimited text and scan them back."""
    path = scratch_path(c.spark, "ratings-delimited")
    io.write_delimited(c.ratings_raw, path)
    return io.read_delimited(c.spark, path, "user_id string, movie_id string, "
                             "user_rating string, time_stamp string")


def parse_tuple_text(c: Ctx):
    return io.parse_tuple_text(fixtures.code_text(c.spark, c.sf_dir), ["string", "int"],
                               ["id", "code"])


def table_round_trip(c: Ctx):
    """Cleaned movies stored as a table, replaced and read back."""
    path = scratch_path(c.spark, "stored-movies")
    io.write_table(c.movies_clean.limit(0), path)
    io.write_table(c.movies_clean, path)
    return io.read_table(c.spark, path)


def list_round_trip(c: Ctx):
    """The item-CF model stored as one list per user, read back and expanded."""
    path = scratch_path(c.spark, "item-lists")
    io.save_item_lists(itemcf.to_item_lists(c.top30), path)
    return itemcf.explode_item_lists(io.load_item_lists(c.spark, path))


def tuple_text_round_trip(c: Ctx):
    """Codes as tuple text files, read back with types."""
    path = scratch_path(c.spark, "code-text")
    io.write_text(fixtures.code_text(c.spark, c.sf_dir), path)
    return io.read_tuple_text(c.spark, path, ["string", "int"], ["id", "code"])


def metrics_text_round_trip(c: Ctx):
    """Metric lines written as text and read back."""
    path = scratch_path(c.spark, "metrics-text")
    io.write_text(format_metrics(c), path)
    return c.spark.read.text(path).withColumnRenamed("value", "line")


def dashboard_json_round_trip(c: Ctx):
    """Releases per month as the dashboard's array of objects, read back."""
    path = scratch_path(c.spark, "releases-json")
    io.write_json_array(dashboard.release_labels(dashboard.releases_by_month(c.movies_clean)), path)
    return io.read_json_array(c.spark, path, "year_data string, month_data string, count_num bigint")


def scan_rejects(c: Ctx):
    """Delimited ratings of which some lines are broken: good and rejected lines against all lines."""
    m, line = F.col("movie_id").cast("int") % 50, F.concat_ws("$", *[F.coalesce(x, F.lit("")) for x in RATING_COLS])
    broken = (F.when(m == 0, F.concat_ws("$", "user_id", "movie_id")).when(m == 1, F.concat(line, F.lit("$more")))
              .when(m == 2, F.concat(line, F.lit("x"))).otherwise(line))
    path = scratch_path(c.spark, "broken-lines")
    c.ratings_raw.select(broken.alias("value")).write.text(path)
    good, rejected = io.scan_delimited(c.spark, path, "user_id int, movie_id int, user_rating string, time_stamp bigint",
                                       header=False)
    return _checks({
        "lines": c.spark.read.text(path).agg(F.count(F.lit(1)).alias("value")),
        "good": good.agg(F.count(F.lit(1)).alias("value")),
        "good_movies": good.agg(F.sum("movie_id").alias("value")),
        "rejected": rejected.agg(F.count(F.lit(1)).alias("value")),
        "rejected_length": rejected.agg(F.sum(F.char_length("line")).alias("value")),
    })


def table_replace(c: Ctx):
    """A stored table replaced while a reader has it open: the reader's rows, the new rows, the copies kept."""
    path = scratch_path(c.spark, "replaced-movies")
    io.write_table(c.movies_raw, path)
    before = io.read_table(c.spark, path)
    io.write_table(c.movies_clean.where("movie_type is not null"), path)
    now = io.read_table(c.spark, path)
    return _checks({
        "open_reader": before.agg(F.count(F.lit(1)).alias("value")),
        "open_reader_no_type": before.agg(F.count_if(F.col("movie_type").isNull()).alias("value")),
        "new_reader": now.agg(F.count(F.lit(1)).alias("value")),
        "new_reader_no_type": now.agg(F.count_if(F.col("movie_type").isNull()).alias("value")),
    })


def _movie_documents(c: Ctx):
    """The movies as JSON documents of differing shapes: fields missing, added, of another type, and broken lines."""
    key = F.col("movie_id").cast("int")
    doc = F.struct(
        "movie_id", "movie_name", F.when(key % 7 != 0, F.col("movie_type")).alias("movie_type"),
        F.when(key % 5 == 0, F.struct(F.lit(True).alias("seen"), key.alias("n"))).alias("extra"),
        F.col("rating_people_num").cast("int").alias("people"))
    text = F.to_json(doc)
    text = F.when(key % 11 == 0, F.regexp_replace(text, '"people":([0-9]+)', '"people":{"n":$1}')).otherwise(text)
    path = scratch_path(c.spark, "movie-documents")
    c.movies_raw.select(F.when(key % 13 == 0, F.concat(F.lit("{"), text)).otherwise(text).alias("value")).write.text(path)
    return documents.read_documents(c.spark, path)


MOVIE_FIELDS = {"movie_id": ("$.movie_id", "string"), "movie_name": ("$.movie_name", "string"),
                "movie_type": ("$.movie_type", "string"), "people": ("$.people", "int"), "extra_n": ("$.extra.n", "int")}


def document_fields(c: Ctx):
    return documents.typed_fields(_movie_documents(c), MOVIE_FIELDS)


def document_report(c: Ctx):
    return documents.field_report(_movie_documents(c), MOVIE_FIELDS)


def bucketed_items(c: Ctx):
    """Codes, names and means joined from tables bucketed by movie: no shuffle of any of them."""
    means = c.ratings_clean.groupBy("movie_id").agg(F.avg("user_rating").alias("avg"))
    parts = {"codes": coding.dense_code(c.movies_clean, "movie_id", "movie_code"), "means": means,
             "names": c.movies_attr.select("movie_id", "movie_name", "movie_type")}
    n = bucketed.buckets_for(c.movies_raw)
    t = {k: bucketed.save_bucketed(df, bucketed.scratch_name(c.spark, f"movie_{k}"), "movie_id", n)
         for k, df in parts.items()}
    return t["codes"].join(t["names"], "movie_id").join(t["means"], "movie_id", "left")


# ---------------------------------------------------------------- ALS (rows-only checks)
def als_predict(c: Ctx):
    return als.predict(c.als_model, c.coded_check).select(
        "user_id", "movie_code", "user_rating", "prediction")


def rmse_als(c: Ctx):
    return evaluate.rmse(als.predict(c.als_model, c.coded_check), digits=DIGITS)


def als_grid(c: Ctx):
    return _marked(als.grid_search(c.coded_train, c.coded_check, seed=ALS_SEED, parallelism=GRID_PARALLELISM))


def _marked(grid):
    best = als.best_params(grid).select("rank", "max_iter", "reg", F.lit(True).alias("is_best"))
    return (grid.join(best, ["rank", "max_iter", "reg"], "left")
            .fillna(False, ["is_best"]).orderBy("order"))


def als_top30(c: Ctx):
    users = c.coded_test.select("user_id").distinct()
    return als.recommend_for_users(c.als_model, users, TOP_N)


def als_top20(c: Ctx):
    users = c.coded_train.select("user_id").distinct()
    recs = als.recommend_unseen(c.als_model, c.coded_train, users, SERVE_N)
    named = serve.decode_with_names(materialize(recs, "als-recs"), c.coded[1], c.movies_attr)
    return serve.with_truncated_rating(named).select(
        "user_id", "rank", "movie_id", "movie_name", "movie_type", "prediction", "movie_rating")


def eval_coded_lists(c: Ctx):
    """The evaluation of stored lists over codes, with lists that need no model: the 30 movies of the best mean."""
    best = c.coded_train.groupBy("movie_code").agg(F.avg("user_rating").alias("mean"), F.count(F.lit(1)).alias("n"))
    top = coding.number_rows(best.where("n >= 5"), [F.desc("mean"), F.asc("movie_code")], "rank").where(
        F.col("rank") <= max(KS)).select("rank", "movie_code")
    users = c.coded_test.select("user_id").distinct()
    # a fixed list of 30 rows for every user
    recs = users.join(F.broadcast(top.agg(F.sort_array(F.collect_list(F.struct("rank", "movie_code"))).alias("l"))),
                      F.lit(True)).select("user_id", F.explode("l").alias("r")).select(
        "user_id", F.col("r.rank").cast("int").alias("rank"), "r.movie_code")
    path = scratch_path(c.spark, "coded-lists")
    io.save_item_lists(itemcf.to_item_lists(recs, item_col="movie_code"), path)
    stored = itemcf.explode_item_lists(io.load_item_lists(c.spark, path), item_col="movie_code")
    return evaluate.eval_micro_at_k(stored, c.coded_train, c.coded_test, KS, 2, item_col="movie_code", digits=DIGITS)


def eval_als(c: Ctx):
    users = c.coded_test.select("user_id").distinct()
    recs = als.recommend_for_users(c.als_model, users, max(KS))
    return evaluate.eval_micro_at_k(recs, c.coded_train, c.coded_test, KS, 2,
                                    item_col="movie_code", digits=DIGITS)


def als_checks(c: Ctx):
    """Properties of the served lists, predictions and the stored model that hold whatever the factors are."""
    n_items = c.coded_train.select("movie_code").distinct()
    users = c.coded_test.select("user_id").distinct()
    top = materialize(als.recommend_for_users(c.als_model, users, TOP_N), "als-top")
    new = materialize(als.recommend_unseen(c.als_model, c.coded_train, c.coded_train.select("user_id").distinct(),
                                           SERVE_N), "als-new")
    pred = materialize(als.predict(c.als_model, c.coded_check).select("user_id", "movie_code", "prediction"),
                       "als-predictions")
    whole = materialize(als.library_for_users(c.als_model, users, TOP_N).select(
        "user_id", "rank", F.col("prediction").alias("library")), "als-library")
    path = scratch_path(c.spark, "als-model")
    als.save_model(c.als_model, path)
    again = als.predict(als.load_model(path), c.coded_check).select("user_id", "movie_code", "prediction")
    by_user = Window.partitionBy("user_id").orderBy("rank")

    def rows(df): return df.agg(F.count(F.lit(1)).alias("value"))
    def n_users(df): return df.agg(F.count_distinct("user_id").alias("value"))
    def gaps(df):
        per = df.groupBy("user_id").agg(F.count_distinct("rank").alias("n"), F.max("rank").alias("top"),
                                        F.count(F.lit(1)).alias("rows"))
        return rows(per.where("n <> top or n <> rows"))
    def rising(df):
        return rows(df.withColumn("before", F.lag("prediction").over(by_user)).where("prediction > before"))

    def not_best(df, best):
        """Ranks whose prediction is not the library's (single-precision sums in another order)."""
        both = df.join(best, ["user_id", "rank"], "full")
        close = F.abs(F.col("prediction") - F.col("library")) <= 1e-5 * F.greatest(F.abs("library"), F.lit(1.0))
        return rows(both.where(~F.coalesce(close, F.lit(False))))

    return _checks({
        "items": rows(n_items),
        "top30_not_the_librarys": not_best(top, whole),
        "top30_users": n_users(top), "top30_rows": rows(top), "top30_rank_gaps": gaps(top),
        "top30_rising": rising(top),
        "top20_users": n_users(new), "top20_rows": rows(new), "top20_rank_gaps": gaps(new),
        "top20_rising": rising(new),
        "top20_seen": rows(new.join(c.coded_train, ["user_id", "movie_code"], "left_semi")),
        "predicted_pairs": rows(pred),
        "saved_differences": rows(pred.exceptAll(again)),
    })


def als_pruning(c: Ctx):
    """How much of the product of users and items the top-20 search scores."""
    return als.search_report(c.als_model, c.coded_train, c.coded_train.select("user_id").distinct(), SERVE_N, block=256)


def als_grid_checks(c: Ctx):
    """The grid search: all fits scored, one best, none better and none as good before it, its model kept and stored."""
    fits, model = als.grid_fit(c.coded_train, c.coded_check, seed=ALS_SEED, parallelism=GRID_PARALLELISM)
    grid = materialize(_marked(fits), "als-grid")
    path = scratch_path(c.spark, "als-best-model")
    als.save_model(model, path)
    stored = als.load_model(path)
    error = evaluate.rmse(als.predict(stored, c.coded_check)).select("rmse", F.lit(stored.rank).alias("stored_rank"))
    best = grid.where("is_best").select(F.col("rmse").alias("b_rmse"), F.col("order").alias("b_order"),
                                        F.lit(1).alias("one"))
    against = grid.withColumn("one", F.lit(1)).join(F.broadcast(best), "one")
    return _checks({
        "fits": grid.agg(F.count(F.lit(1)).alias("value")),
        "combinations": grid.agg(F.count_distinct("rank", "max_iter", "reg").alias("value")),
        "without_rmse": grid.where("rmse is null").agg(F.count(F.lit(1)).alias("value")),
        "best": best.agg(F.count(F.lit(1)).alias("value")),
        "stored_not_best": grid.where("is_best").withColumnsRenamed({"rank": "best_rank", "rmse": "best_rmse"}).join(
            error, (F.abs(F.col("rmse") - F.col("best_rmse")) <= 1e-9) & (F.col("stored_rank") == F.col("best_rank")),
            "left_anti").agg(F.count(F.lit(1)).alias("value")),
        "better": against.where("rmse < b_rmse or (rmse = b_rmse and order < b_order)").agg(
            F.count(F.lit(1)).alias("value")),
    })


_ALL = [
    # profiling and cleaning
    profile_counts, profile_duplicates, profile_nulls, profile_distinct, profile_anomaly_any_col,
    profile_rating_labels, avg_activity_per_user, avg_activity_per_item, top10_by_raters,
    clean_dedupe, clean_drop_null_all, clean_drop_null_any, clean_labels, clean_rating,
    attr_repair, typed_ratings, rejected_ratings, year_month, distinct_tags,
    # statistics
    distinct_sketches, duplicate_sketches, clean_step_counts,
    popular_items, popular_items_by_month, popular_topn_per_month, avg_rating, movies_with_avg,
    genre_match, genre_top10, genre_top10_lists, popular_items_ranked, popular_items_by_month_ranked,
    avg_rating_ranked, sql_top_of_month, sql_top_of_genre, sql_rated_by, sql_popular_items, sql_popular_items_by_month, sql_avg_rating,
    # coding and splits
    dense_code, rating_code, split_hash, split_balance, split_random, split_random_checks, users_min_rated,
    # item-CF
    rating_with_item_mean, rating_mean_key_mixed, item_similarity, item_neighbours, item_neighbours_heavy_user,
    item_neighbours_all, item_cf_candidates, item_cf_top30, item_cf_top30_dedup, item_cf_unseen,
    item_cf_unseen_first, seen_multiset_diff, matched_multiset, explode_recs, array_ops,
    shared_users, unseen_items, shared_users_bitmap, unseen_items_bitmap, overlap_sizes, decode_recs, recs_for_users, missing_names,
    # evaluation
    eval_macro_at_k, eval_macro_multiset, eval_coded_lists, grid_argmin, eval_micro_at_k, rmse_item_mean, format_metrics, truncate_rating,
    # dashboard
    rating_histogram, dashboard_totals, releases_by_month, releases_pivot, genre_preference,
    recent_top10, poster_popular50, poster_recent50, poster_rated50,
    # sources
    scan_delimited, scan_rejects, parse_tuple_text, table_round_trip, table_replace, document_fields,
    document_report, bucketed_items, list_round_trip, tuple_text_round_trip,
    metrics_text_round_trip, dashboard_json_round_trip,
    # ALS
    als_predict, rmse_als, als_grid, als_top30, als_top20, als_pruning, eval_als, als_checks,
    als_grid_checks,
]

QUERIES = {fn.__name__: _q(fn) for fn in _ALL}
QUERIES["strip_brackets"] = _q(strip_brackets_q)

# Queries whose result depends on random initialisation or sampling: checked
# by row counts and invariants only.
ROWS_ONLY = {"split_random", "als_predict", "rmse_als", "als_grid", "als_top30", "als_top20",
             "eval_als", "als_pruning"}
