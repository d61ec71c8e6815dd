"""Sets of integer keys as bitmaps in buckets of 32,768 keys.

A bucket of a set is one bitmap of 4 KB, however many rows named its keys; sets
are united, intersected and counted bucket by bucket.  Repeated keys are combined
map-side and the distinct keys of a bucket, 32,768 at most, make its bitmap in one
task, so a group with a third of all rows is spread by its buckets.  Meant for dense codes (``coding.dense_code``) or ids close to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """(by..., bucket, bitmap) of the distinct keys, per group of ``by``; null keys are in no set."""
    known = df.where(F.col(key).isNotNull())
    cols = [*(by or []), "bucket"]
    # keys are small and meet first: a bitmap is never sorted, and none is shuffled to be built
    places = known.select(*(by or []), F.bitmap_bucket_number(key).alias("bucket"),
                          F.bitmap_bit_position(key).alias("_bit")).distinct().repartition(*cols)
    return places.groupBy(*cols).agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def union(a: DataFrame, b: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Keys of either set."""
    return a.unionByName(b).groupBy(*(by or []), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def intersect(a: DataFrame, b: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Keys of both sets (each side has one bitmap per group and bucket)."""
    both = a.unionByName(b).groupBy(*(by or []), "bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.bitmap_and_agg("bitmap").alias("bitmap"))
    return both.where("_n = 2 and bitmap_count(bitmap) > 0").drop("_n")


def sizes(bitmaps: DataFrame, by: list[str] | None = None, name: str = "n") -> DataFrame:
    """Number of keys, per group of ``by``."""
    return bitmaps.groupBy(*(by or [])).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias(name))


def members(bitmaps: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """(by..., key): the keys back as rows."""
    by = by or []
    octet = F.conv(F.hex(F.substring("bitmap", F.col("_i") + 1, F.lit(1))), 16, 10).cast("int")
    rows = bitmaps.select(*by, "bucket", "bitmap", F.explode(F.sequence(F.lit(0), F.octet_length("bitmap") - 1)).alias("_i"))
    bits = rows.select(*by, "bucket", "_i", octet.alias("_octet")).where("_octet <> 0").select(
        *by, "bucket", "_i", "_octet", F.explode(F.array(*[F.lit(b) for b in range(8)])).alias("_b"))
    found = bits.where(F.expr("shiftright(_octet, _b) & 1") == 1)
    place = F.col("_i") * 8 + F.col("_b")
    # buckets from 1 hold the positive keys upwards, the others zero and the negative keys downwards
    value = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * 32768 + place + 1).otherwise(
        F.col("bucket") * 32768 - place)
    return found.select(*by, value.alias(key))


def unseen_counts(rated: DataFrame, user_col: str, item_col: str, name: str = "n_unseen") -> DataFrame:
    """Per user the number of rated items of the whole catalogue that the user has not rated."""
    catalogue = sizes(key_bitmaps(rated, item_col), name="all").scalar()
    seen = sizes(key_bitmaps(rated, item_col, [user_col]), [user_col], "seen")
    return seen.select(user_col, (catalogue - F.col("seen")).alias(name))


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys that both tables hold."""
    return members(intersect(key_bitmaps(a, key), key_bitmaps(b, key)), key)
