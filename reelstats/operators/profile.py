"""Data profiling: one aggregation per table instead of one job per number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.functions.scalars import any_contains, any_null, any_not_null, has_rating_label


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """Row count, distinct rows, duplicates, rows with a null, all-null rows.

    ``n_distinct`` counts whole rows null-safely (as ``dropDuplicates`` does).
    """
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(row).alias("n_distinct"),
        _count_if(any_null(cols)).alias("n_any_null"),
        _count_if(~any_not_null(cols)).alias("n_all_null"),
        _count_if(any_contains(cols, ":")).alias("n_colon"),
    ).select(F.lit(name).alias("table_name"), "*",
             (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        p = profile_table(df, name)
        out = p if out is None else out.unionByName(p)
    return out


def from_steps(steps: DataFrame) -> DataFrame:
    """The profile of the raw tables from the stored counts of the cleaning steps (``clean.StepCounts``)."""
    def of(step, col): return F.max(F.when(F.col("step") == step, F.col(col)))
    raw = {c: of("raw", c).alias(c) for c in ("n_rows", "n_any_null", "n_all_null", "n_colon")}
    return steps.groupBy("table_name").agg(
        raw["n_rows"], of("deduped", "n_rows").alias("n_distinct"), raw["n_any_null"], raw["n_all_null"],
        raw["n_colon"]).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def anomaly_rows(movies: DataFrame) -> DataFrame:
    """Movies with a ``:`` in any column, projected to the name columns.

    The predicate looks at every column, so it is applied before the
    projection.
    """
    return (movies.where(any_contains(movies.columns, ":"))
            .select("movie_id", "movie_name", "movie_writer", "movie_starring"))


def rating_label_count(ratings: DataFrame) -> DataFrame:
    """Rows whose rating column holds one of the rating labels."""
    return ratings.agg(_count_if(has_rating_label("user_rating")).alias("n_labelled"))


def distinct_with_null(c: str) -> F.Column:
    """Number of distinct values, counting null as one value (like distinct().count())."""
    return (F.count_distinct(F.col(c))
            + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).cast("bigint")


def distinct_counts(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct users and movies among ratings, distinct tag values among tags.

    Long form (``metric``, ``value``): two independent aggregates are
    stacked, not joined.
    """
    r = ratings.agg(distinct_with_null("user_id").alias("n_users"),
                    distinct_with_null("movie_id").alias("n_movies"))
    t = tags.agg(distinct_with_null("user_tag").alias("n_tags"))
    r_long = r.unpivot([], ["n_users", "n_movies"], "metric", "value")
    t_long = t.unpivot([], ["n_tags"], "metric", "value")
    return r_long.unionByName(t_long)


def avg_activity(ratings: DataFrame, by: str, counted: str, name: str) -> DataFrame:
    """Mean over keys of the per-key count (count skips null values)."""
    per_key = ratings.groupBy(by).agg(F.count(counted).alias("n"))
    return per_key.agg(F.avg("n").alias(name))
