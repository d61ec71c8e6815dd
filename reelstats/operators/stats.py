"""Popularity, monthly popularity, mean scores and per-genre top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.functions.scalars import epoch_to_year_month, strip_brackets
from reelstats.operators.skew import split_join


def popular_items(ratings: DataFrame, item_col: str = "movie_id") -> DataFrame:
    """Ratings per item, most rated first (``count`` skips null ids)."""
    return (ratings.groupBy(item_col).agg(F.count(item_col).alias("count"))
            .orderBy(F.desc("count"), F.asc(item_col)))


def with_year_month(ratings: DataFrame, ts_col: str = "time_stamp") -> DataFrame:
    return ratings.withColumn("year_month", epoch_to_year_month(ts_col))


def popular_items_by_month(ratings: DataFrame, item_col: str = "movie_id",
                           ts_col: str = "time_stamp") -> DataFrame:
    """Ratings per (month, item), latest month first then most rated."""
    return (with_year_month(ratings, ts_col)
            .groupBy("year_month", item_col).agg(F.count(item_col).alias("count"))
            .select(item_col, "count", "year_month")
            .orderBy(F.desc("year_month"), F.desc("count"), F.asc(item_col)))


def top_n_per_group(df: DataFrame, group_cols: list[str], order_cols: list,
                    n: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n inside each group.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so a huge group sends at most n rows per map task.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n))


def popular_top_n_per_month(ratings: DataFrame, n: int = 10, item_col: str = "movie_id",
                            ts_col: str = "time_stamp") -> DataFrame:
    monthly = (with_year_month(ratings, ts_col)
               .groupBy("year_month", item_col).agg(F.count(item_col).alias("count")))
    return top_n_per_group(monthly, ["year_month"], [F.desc("count"), F.asc(item_col)], n)


def avg_rating(ratings: DataFrame, item_col: str = "movie_id",
               rating_col: str = "user_rating") -> DataFrame:
    """Mean rating per item, best first."""
    return (ratings.groupBy(item_col).agg(F.avg(rating_col).alias("avg"))
            .orderBy(F.desc("avg"), F.asc(item_col)))


def movies_with_avg(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movies joined with their mean rating (inner: unrated movies drop)."""
    return movies.join(averages, "movie_id")


def distinct_tags(tags: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Distinct non-null tag values, brackets removed, optional exclusions."""
    out = (tags.select(strip_brackets("user_tag").alias("genre"))
           .where(F.col("genre").isNotNull()).distinct())
    if exclude:
        out = out.where(~F.col("genre").isin(list(exclude)))
    return out


def _substrings(text: F.Column, max_len: F.Column) -> F.Column:
    """All distinct substrings of ``text`` up to ``max_len`` characters, the empty one included."""
    n = F.length(text)
    parts = F.flatten(F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.transform(F.sequence(F.lit(0), F.greatest(F.least(max_len, n - i + 1), F.lit(0))),
                              lambda j: F.substring(text, i, j))))
    return F.array_distinct(parts)


def matching_types(genres: DataFrame, types: DataFrame, type_col: str = "movie_type") -> DataFrame:
    """(type, genre) for every distinct type that contains the genre, whatever the case.

    Containment is an equi-join instead of a cartesian product: each distinct
    type is expanded into its substrings no longer than the longest genre.
    """
    g = genres.select("genre", F.lower("genre").alias("_key"))
    longest = g.agg(F.coalesce(F.max(F.length("_key")), F.lit(0)).alias("n")).scalar()
    distinct = types.where(F.col(type_col).isNotNull()).select(type_col).distinct().withColumn("_longest", longest)
    keys = _substrings(F.lower(F.col(type_col)), F.col("_longest"))
    parts = distinct.select(type_col, F.explode(keys).alias("_key"))
    return parts.join(g, "_key").select(type_col, "genre")


def genre_match(genres: DataFrame, movies: DataFrame, genre_col: str = "genre",
                type_col: str = "movie_type") -> DataFrame:
    """(genre, movie) where lower(type) contains lower(genre); null types never match.

    The distinct types are matched to the genres first, a small table; the movies
    join it on their type, the rows of frequent types dealt over tasks.
    """
    matches = matching_types(genres.select(F.col(genre_col).alias("genre")), movies, type_col)
    return split_join(movies, matches, type_col).select(*movies.columns, "genre")


def genre_top_n(movies: DataFrame, tags: DataFrame, averages: DataFrame, n: int = 10,
                exclude: list[str] | None = None) -> DataFrame:
    """Best ``n`` movies per genre by mean rating (ties: lower movie id first).

    Output is flat: movie_type (the genre), rank, movie_id int, avg.
    """
    scored = movies_with_avg(movies, averages)
    matched = genre_match(distinct_tags(tags, exclude), scored)
    ranked = top_n_per_group(matched, ["genre"],
                             [F.desc("avg"), F.asc(F.col("movie_id").try_cast("int"))], n)
    return ranked.select(F.col("genre").alias("movie_type"), "rank",
                         F.col("movie_id").try_cast("int").alias("movie_id"), "avg")


def genre_top_n_lists(flat: DataFrame) -> DataFrame:
    """Nested form: movie_type, items array<struct<movie_id, avg>> in rank order.

    Lists are bounded by ``n`` of ``genre_top_n``.
    """
    return flat.groupBy("movie_type").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "movie_id", "avg"))),
                    lambda x: F.struct(x["movie_id"].alias("movie_id"),
                                       x["avg"].alias("avg"))).alias("items"))
