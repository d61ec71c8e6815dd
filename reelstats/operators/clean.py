"""Cleaning: duplicates, missing values, labelled text, typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reelstats.functions.scalars import (
    NOT_PROVIDED, STARRING_LABEL, STARRING_WORD, WRITER_LABEL, all_of, any_contains, any_not_null,
    any_null,
    mark_truncated, rating_from_label, remove_literal,
)


def dedupe(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Exact-duplicate rows removed (nulls compare equal); ``copies`` names a column for their number."""
    if copies is None:
        return df.dropDuplicates()
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def drop_null_rows(df: DataFrame, how: str = "all", cols: list[str] | None = None) -> DataFrame:
    """Drop rows with missing values.

    ``how="all"`` keeps a row unless every column is null (the source's
    behaviour); ``how="any"`` keeps only complete rows.  Unlike
    ``na.drop`` a NaN is not treated as missing.
    """
    return df.where(complete(cols or df.columns, how))


def complete(cols: list[str], how: str) -> Column:
    """True for the rows that ``drop_null_rows`` keeps."""
    if how == "all":
        return any_not_null(cols)
    if how == "any":
        return all_of([F.col(c).isNotNull() for c in cols])
    raise ValueError(f"how must be 'all' or 'any', got {how!r}")


def clean_movie_labels(movies: DataFrame) -> DataFrame:
    """Remove the writer / starring role labels from their columns."""
    return (movies
            .withColumn("movie_writer", remove_literal("movie_writer", WRITER_LABEL))
            .withColumn("movie_starring", remove_literal("movie_starring", STARRING_LABEL)))


def clean_rating_labels(ratings: DataFrame, col: str = "user_rating") -> DataFrame:
    """Replace the rating label text by its star value as double."""
    return ratings.withColumn(col, rating_from_label(col))


def clean_tables(movies: DataFrame, ratings: DataFrame, tags: DataFrame,
                 how: str = "all") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dedupe -> drop missing rows -> clean labels, for the three raw tables."""
    m = clean_movie_labels(drop_null_rows(dedupe(movies), how))
    r = clean_rating_labels(drop_null_rows(dedupe(ratings), how))
    t = drop_null_rows(dedupe(tags), how)
    return m, r, t


class StepCounts:
    """Rows, incomplete rows and empty rows after each cleaning step, counted by the pass that writes the table.

    ``mark`` puts one counter for several steps into the plan; the numbers are there when the frame
    that holds it has been written, without a job of their own.
    """

    KINDS = ("n_rows", "n_any_null", "n_all_null", "n_colon")

    def __init__(self, table: str):
        self.table, self.steps = table, []

    def mark(self, df: DataFrame, steps: dict[str, Column], cols: list[str]) -> DataFrame:
        """``steps``: name of a step -> how many of its rows a row of ``df`` stands for."""
        seen = Observation()
        text = [c for c, t in df.dtypes if c in cols and t == "string"]
        # tested once for all steps, in the code of the step before
        tests = [F.lit(True), any_null(cols), ~any_not_null(cols), any_contains(text, ":")]
        flags = {f"_{kind}": test for kind, test in zip(self.KINDS, tests)}
        self.steps += [(step, seen) for step in steps]
        counters = [F.coalesce(F.sum(F.when(F.col(f"_{kind}"), n).otherwise(F.lit(0))), F.lit(0)).cast("bigint")
                    .alias(f"{step} {kind}") for step, n in steps.items() for kind in self.KINDS]
        return df.withColumns(flags).observe(seen, *counters).drop(*flags)

    def rows(self) -> list[tuple]:
        """(table_name, step, n_rows, n_any_null, n_all_null, n_colon) in the order of the steps."""
        return [(self.table, step, *[seen.get[f"{step} {kind}"] for kind in self.KINDS]) for step, seen in self.steps]


STEP_COUNTS = "table_name string, step string, n_rows long, n_any_null long, n_all_null long, n_colon long"


def counted_clean(df: DataFrame, table: str, how: str = "all", finish=None) -> tuple[DataFrame, StepCounts]:
    """Dedupe -> drop missing rows -> ``finish`` (label cleanup), every step counted on the way.

    The raw rows are counted as copies of the deduplicated ones, so no row is tested before the shuffle.
    """
    counts, cols = StepCounts(table), df.columns
    out = counts.mark(dedupe(df, "_copies"), {
        "raw": F.col("_copies"), "deduped": F.lit(1), "complete": F.when(complete(cols, how), 1).otherwise(0)}, cols)
    out = drop_null_rows(out.drop("_copies"), how)
    if finish is not None:
        out = finish(out)
        out = counts.mark(out, {"cleaned": F.lit(1)}, out.columns)
    return out, counts


def counted_tables(movies: DataFrame, ratings: DataFrame, tags: DataFrame,
                   how: str = "all") -> dict[str, tuple[DataFrame, StepCounts]]:
    """``clean_tables`` with counters in every plan: table name -> (frame, counts)."""
    return {"movies": counted_clean(movies, "movies", how, clean_movie_labels),
            "ratings": counted_clean(ratings, "ratings", how, clean_rating_labels),
            "tags": counted_clean(tags, "tags", how)}


def attr_repair(movies: DataFrame) -> DataFrame:
    """Move starring lists out of the writer column and mark truncated lists.

    A writer value containing the starring word is copied to
    ``movie_starring`` and replaced by the not-provided placeholder; both
    columns then get their ``...`` tails rewritten.  One projection, so the
    starring column reads the original writer value.
    """
    moved = F.col("movie_writer").contains(STARRING_WORD)
    starring = F.when(moved, F.col("movie_writer")).otherwise(F.col("movie_starring"))
    writer = F.when(moved, F.lit(NOT_PROVIDED)).otherwise(F.col("movie_writer"))
    out = []
    for c in movies.columns:
        if c == "movie_starring":
            out.append(mark_truncated(starring).alias(c))
        elif c == "movie_writer":
            out.append(mark_truncated(writer).alias(c))
        else:
            out.append(F.col(c))
    return movies.select(*out)


def typed_ratings(ratings: DataFrame, require_all: bool = False,
                  rating_is_label: bool = True) -> DataFrame:
    """Typed rating rows: user_id int, movie_id int, user_rating double, time_stamp bigint.

    Malformed values become null instead of failing the job.  With
    ``require_all`` rows with any null typed value are dropped (a model input
    needs all four).
    """
    rating = (rating_from_label("user_rating") if rating_is_label
              else F.col("user_rating").try_cast("double"))
    out = ratings.select(
        F.col("user_id").try_cast("int").alias("user_id"),
        F.col("movie_id").try_cast("int").alias("movie_id"),
        rating.alias("user_rating"),
        F.col("time_stamp").try_cast("bigint").alias("time_stamp"),
    )
    if require_all:
        out = out.where(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()
                        & F.col("user_rating").isNotNull())
    return out


def rejected_ratings(ratings: DataFrame, rating_is_label: bool = True) -> DataFrame:
    """Rows whose ids or rating do not parse (the rows a strict cast would throw on)."""
    rating = (rating_from_label("user_rating") if rating_is_label
              else F.col("user_rating").try_cast("double"))
    bad = (F.col("user_id").try_cast("int").isNull() | F.col("movie_id").try_cast("int").isNull()
           | rating.isNull())
    return ratings.where(bad)
