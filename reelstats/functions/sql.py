"""SQL names for the library's expressions (SQL functions, inlined by the optimizer)."""

from __future__ import annotations

from pyspark.sql import SparkSession

# epoch seconds (text or number) -> yyyyMM in UTC; null for malformed input
CHANGE_DATE = """
CREATE OR REPLACE TEMPORARY FUNCTION change_date(x STRING) RETURNS INT
RETURN CAST(year(date_from_unix_date(CAST(floor(try_cast(x AS BIGINT) / 86400) AS INT))) * 100
          + month(date_from_unix_date(CAST(floor(try_cast(x AS BIGINT) / 86400) AS INT))) AS INT)
"""

# label text -> star value as double; null for malformed input
RATING_VALUE = """
CREATE OR REPLACE TEMPORARY FUNCTION rating_value(label STRING) RETURNS DOUBLE
RETURN try_cast(substring(label, 8, 1) AS DOUBLE)
"""


# Table functions over the session's views; {rating} and {movie} are their names.
TABLE_FUNCTIONS = [
    # the n most rated movies of a month (yyyyMM)
    """
CREATE OR REPLACE TEMPORARY FUNCTION top_of_month(ym INT, n INT)
RETURNS TABLE (movie_id STRING, count BIGINT, rank INT)
RETURN SELECT movie_id, count, rank FROM (
  SELECT movie_id, count(movie_id) AS count, row_number() OVER (ORDER BY count(movie_id) DESC, movie_id) AS rank
  FROM {rating} WHERE change_date(time_stamp) = top_of_month.ym GROUP BY movie_id)
WHERE rank <= top_of_month.n
""",
    # the n best rated movies whose type holds a genre
    """
CREATE OR REPLACE TEMPORARY FUNCTION top_of_genre(genre STRING, n INT)
RETURNS TABLE (movie_id STRING, movie_name STRING, avg DOUBLE, rank INT)
RETURN SELECT movie_id, movie_name, avg, rank FROM (
  SELECT m.movie_id, m.movie_name, a.avg, row_number() OVER (ORDER BY a.avg DESC, try_cast(m.movie_id AS INT)) AS rank
  FROM {movie} m JOIN (SELECT movie_id, avg(user_rating) AS avg FROM {rating} GROUP BY movie_id) a
    ON m.movie_id = a.movie_id
  WHERE contains(lower(m.movie_type), lower(top_of_genre.genre)))
WHERE rank <= top_of_genre.n
""",
    # what a user has rated, with names
    """
CREATE OR REPLACE TEMPORARY FUNCTION rated_by(user STRING)
RETURNS TABLE (movie_id STRING, movie_name STRING, user_rating DOUBLE, year_month INT)
RETURN SELECT r.movie_id, m.movie_name, r.user_rating, change_date(r.time_stamp)
FROM {rating} r LEFT JOIN {movie} m ON r.movie_id = m.movie_id WHERE r.user_id = rated_by.user
""",
]


def register_table_functions(spark: SparkSession, ratings, movies) -> None:
    """Register ``top_of_month``, ``top_of_genre`` and ``rated_by`` over the given cleaned tables.

    The tables become temporary views of the session with names of their own; the
    last registration is the one that the functions read.
    """
    register_sql_functions(spark)
    names = {}
    for name, df in (("rating", ratings), ("movie", movies)):
        names[name] = f"reelstats_{name}"
        df.createOrReplaceTempView(names[name])
    for text in TABLE_FUNCTIONS:
        spark.sql(text.format(**names))


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``change_date`` and ``rating_value`` for ``spark.sql`` text."""
    spark.sql(CHANGE_DATE)
    spark.sql(RATING_VALUE)
