"""Distinct counts from mergeable sketches (HyperLogLog).

Sketches are kept per month and merged when a count over several months is asked
for: a new month costs its own rows only.  A sketch has a fixed size (a few KB for
``lg_k`` = 12, whose relative standard error is below 2 %), whatever it counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.functions.scalars import epoch_to_year_month

LG_K = 12


def monthly_sketches(rows: DataFrame, cols: list[str], ts_col: str = "time_stamp", lg_k: int = LG_K) -> DataFrame:
    """(year_month, n_rows, one sketch per column): map-side combined, one row a month."""
    return (rows.groupBy(epoch_to_year_month(ts_col).alias("year_month"))
            .agg(F.count(F.lit(1)).alias("n_rows"), *[F.hll_sketch_agg(c, lg_k).alias(c) for c in cols]))


def merged(sketches: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Sketches of several rows as one (per group)."""
    return sketches.groupBy(*(by or [])).agg(F.sum("n_rows").cast("bigint").alias("n_rows"),
                                             *[F.hll_union_agg(c).alias(c) for c in cols])


def estimates(sketches: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """(kept columns, metric, estimate) in long form."""
    wide = sketches.select(*(keep or []), *[F.hll_sketch_estimate(c).alias(c) for c in cols])
    return wide.unpivot(keep or [], cols, "metric", "estimate")


def row_sketch(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(n_rows, n_distinct): rows, and distinct whole rows by a sketch of row hashes; nothing is shuffled but sketches."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_estimate(F.hll_sketch_agg(row, lg_k)).alias("n_distinct"))
