"""The rating statistics as SQL text.

The same results as ``operators.stats``, for users who prefer ``spark.sql``.
Inputs are passed as DataFrame arguments (``{rating}``), so no session-wide
temporary view is created; both forms produce the same Catalyst plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelstats.functions.sql import register_sql_functions, register_table_functions

POPULAR = """
SELECT movie_id, count(movie_id) AS count
FROM {rating}
GROUP BY movie_id
ORDER BY count DESC, movie_id
"""

BY_MONTH = """
SELECT movie_id, count(movie_id) AS count, year_month
FROM (SELECT movie_id, user_rating, change_date(time_stamp) AS year_month FROM {rating})
GROUP BY year_month, movie_id
ORDER BY year_month DESC, count DESC, movie_id
"""

AVERAGE = """
SELECT movie_id, avg(user_rating) AS avg
FROM {rating}
GROUP BY movie_id
ORDER BY avg DESC, movie_id
"""


def _run(text: str, ratings: DataFrame) -> DataFrame:
    spark = ratings.sparkSession
    register_sql_functions(spark)
    return spark.sql(text, rating=ratings)


def popular_items_sql(ratings: DataFrame) -> DataFrame:
    return _run(POPULAR, ratings)


def popular_items_by_month_sql(ratings: DataFrame) -> DataFrame:
    return _run(BY_MONTH, ratings)


def avg_rating_sql(ratings: DataFrame) -> DataFrame:
    return _run(AVERAGE, ratings)


def top_of_month_sql(ratings: DataFrame, movies: DataFrame, months: list[int], n: int = 10) -> DataFrame:
    """The best months' lists by calls of one table function."""
    spark = ratings.sparkSession
    register_table_functions(spark, ratings, movies)
    calls = [f"SELECT {int(m)} AS year_month, * FROM top_of_month({int(m)}, {int(n)})" for m in months]
    return spark.sql(" UNION ALL ".join(calls))


def top_of_genre_sql(ratings: DataFrame, movies: DataFrame, genre: str, n: int = 10) -> DataFrame:
    spark = ratings.sparkSession
    register_table_functions(spark, ratings, movies)
    return spark.sql("SELECT * FROM top_of_genre(:genre, :n)", {"genre": genre, "n": n})


def rated_by_sql(ratings: DataFrame, movies: DataFrame, user: str) -> DataFrame:
    spark = ratings.sparkSession
    register_table_functions(spark, ratings, movies)
    return spark.sql("SELECT * FROM rated_by(:user)", {"user": user})
