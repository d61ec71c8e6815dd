"""The small tables a dashboard reads: totals, histograms, top lists, posters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.functions.scalars import date_key, percent_of


def _stack(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def totals(ratings: DataFrame, movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Rating records, users, movies and genres as (metric, value) rows."""
    r = ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                    F.count_distinct("user_id").alias("n_users"))
    m = movies.agg(F.count_distinct("movie_id").alias("n_movies"))
    t = tags.agg(F.count_distinct("user_tag").alias("n_genres"))
    return _stack(r.unpivot([], ["n_ratings", "n_users"], "metric", "value"),
                  m.unpivot([], ["n_movies"], "metric", "value"),
                  t.unpivot([], ["n_genres"], "metric", "value"))


def rating_histogram(ratings: DataFrame, rating_col: str = "user_rating") -> DataFrame:
    """Ratings per level with the share of all ratings in percent.

    The share window runs over the aggregated levels only (a handful of rows).
    """
    levels = (ratings.where(F.col(rating_col).isNotNull())
              .groupBy(F.col(rating_col).alias("name")).agg(F.count(F.lit(1)).alias("y")))
    total = F.sum("y").over(Window.partitionBy())
    return levels.withColumn("share", percent_of("y", total))


def order_by_raters(movies: DataFrame) -> list:
    return [F.col("rating_people_num").try_cast("int").desc_nulls_last(),
            F.col("movie_rating").try_cast("double").desc_nulls_last(),
            F.asc("movie_id")]


def top_by_raters(movies: DataFrame, n: int = 10) -> DataFrame:
    """Most rated movies (by the raters column, then score; ties by id)."""
    return (movies.select("movie_id", "movie_name", "movie_rating", "rating_people_num")
            .orderBy(*order_by_raters(movies)).limit(n))


def releases_by_month(movies: DataFrame, date_col: str = "movie_release_date") -> DataFrame:
    """Number of movies released per (year, month) of a ``yyyy-MM-dd`` text date."""
    d = F.try_to_date(F.col(date_col), "yyyy-MM-dd")
    return (movies.select(F.year(d).alias("year"), F.month(d).alias("month"))
            .where(F.col("year").isNotNull())
            .groupBy("year", "month").agg(F.count(F.lit(1)).alias("count_num")))


def release_labels(releases: DataFrame) -> DataFrame:
    """The stored form: year and month as labelled text, in calendar order."""
    return (releases.orderBy("year", "month")
            .select(F.concat("year", F.lit("年")).alias("year_data"), F.concat("month", F.lit("月")).alias("month_data"),
                    "count_num"))


def releases_pivot(movies: DataFrame, date_col: str = "movie_release_date") -> DataFrame:
    """Wide form: one row per year, one column per month m01..m12."""
    per = releases_by_month(movies, date_col)
    wide = per.groupBy("year").pivot("month", list(range(1, 13))).agg(F.first("count_num"))
    return wide.select("year", *[F.coalesce(F.col(str(m)), F.lit(0)).cast("bigint")
                                 .alias(f"m{m:02d}") for m in range(1, 13)])


def genre_preference(tags: DataFrame) -> DataFrame:
    """Tag rows per genre value (the pie chart)."""
    return (tags.where(F.col("user_tag").isNotNull())
            .groupBy("user_tag").agg(F.count(F.lit(1)).alias("n")))


def with_posters(movies: DataFrame, posters: DataFrame) -> DataFrame:
    return movies.join(posters, "movie_id").drop("movie_url")


def poster_popular(movies: DataFrame, posters: DataFrame, n: int = 50) -> DataFrame:
    """Top ``n`` by raters, with poster address."""
    return (with_posters(movies, posters)
            .orderBy(F.col("rating_people_num").try_cast("int").desc_nulls_last(),
                     F.asc("movie_id")).limit(n))


def poster_recent(movies: DataFrame, posters: DataFrame, n: int = 50) -> DataFrame:
    """Latest ``n`` releases, with poster address."""
    return (with_posters(movies, posters)
            .orderBy(date_key("movie_release_date").desc_nulls_last(), F.asc("movie_id"))
            .limit(n))


def poster_rated(movies: DataFrame, posters: DataFrame, n: int = 50) -> DataFrame:
    """Top ``n`` by score, with poster address."""
    return (with_posters(movies, posters)
            .orderBy(F.col("movie_rating").try_cast("double").desc_nulls_last(),
                     F.asc("movie_id")).limit(n))


def recent_top(movies: DataFrame, recent_n: int = 50, n: int = 10) -> DataFrame:
    """Among the ``recent_n`` latest releases, the ``n`` most rated."""
    recent = (movies.orderBy(date_key("movie_release_date").desc_nulls_last(), F.asc("movie_id"))
              .limit(recent_n))
    return (recent.select("movie_id", "movie_name", "rating_people_num")
            .orderBy(F.col("rating_people_num").try_cast("int").desc_nulls_last(),
                     F.asc("movie_id")).limit(n))


__all__ = ["totals", "rating_histogram", "top_by_raters", "releases_by_month",
           "releases_pivot", "genre_preference", "poster_popular", "poster_recent",
           "poster_rated", "recent_top"]
