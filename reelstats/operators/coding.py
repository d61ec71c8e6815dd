"""Dense id coding and reproducible train/test/check splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.operators.skew import split_join
from reelstats.session import materialize

SPLIT_NAMES = ("train", "test", "check")


def dense_code(df: DataFrame, col: str, code_col: str = "code",
               num_partitions: int | None = None) -> DataFrame:
    """Map each distinct non-null value of ``col`` to 1..n in sorted order.

    Same result as sorting the distinct values and numbering them, without a
    single-partition window (see ``number_rows``).
    """
    n = num_partitions
    ids = df.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
    return number_rows(ids, [F.col(col)], code_col, n).withColumn(code_col, F.col(code_col).cast("int"))


def number_rows(df: DataFrame, order: list, number_col: str = "position", num_partitions: int | None = None) -> DataFrame:
    """Add the position 1..n of every row in a total order, without a single-partition window.

    Range bounds are sampled, so two evaluations of the ranges can differ: the
    sorted ranges are written once, and positions and range sizes are read from
    that copy.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # monotonically_increasing_id() keeps the record number within a partition in
    # its lower 33 bits, so inside a sorted range partition it is the position.
    rows = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()), "ranges")
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # one row per range partition: bounded by the partition count
    place = F.col("_mid") - F.shiftleft(F.col("_part").cast("long"), 33) + 1
    return (rows.join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_offset") + place).alias(number_col)))


def apply_code(df: DataFrame, codes: DataFrame, col: str, code_col: str) -> DataFrame:
    """Attach the code of ``col`` (inner join on the distinct code table; frequent items dealt over tasks)."""
    return split_join(df, codes, col).select(*df.columns, code_col)


def hash_bucket(user_col: str = "user_id", item_col: str = "movie_id") -> F.Column:
    """Stable bucket 0..9 of a (user, item) pair: the first 32 bits of md5(user:item), modulo 10."""
    pair = F.concat_ws(":", F.col(user_col).cast("string"), F.col(item_col).cast("string"))
    return F.conv(F.substring(F.md5(pair), 1, 8), 16, 10).cast("bigint") % 10


def hash_split(df: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
               col: str = "split") -> DataFrame:
    """80/10/10 split that does not depend on partitioning or recomputation.

    All ratings of one (user, item) pair fall in the same part.
    """
    h = hash_bucket(user_col, item_col)
    return df.withColumn(col, F.when(h < 8, "train").when(h == 8, "test").otherwise("check"))


def random_split(df: DataFrame, weights=(0.8, 0.1, 0.1), seed: int = 123,
                 col: str = "split") -> DataFrame:
    """A seeded random split: one draw per row, cut at the cumulated weights.

    Every row is in exactly one part.  The draw depends on the input
    partitioning; use ``hash_split`` for a split that is stable everywhere, and
    write this one once before reading its parts.
    """
    total, below = float(sum(weights)), 0.0
    label = F.lit(SPLIT_NAMES[-1])
    cuts = []
    for name, weight in zip(SPLIT_NAMES[:-1], weights):
        below += weight / total
        cuts.append((name, below))
    for name, cut in reversed(cuts):
        label = F.when(F.col("_draw") < cut, F.lit(name)).otherwise(label)
    return df.withColumn("_draw", F.rand(seed)).withColumn(col, label).drop("_draw")
