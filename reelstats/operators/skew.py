"""Joins with keys that may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

# Frequent items a sketch follows at most; a key above 1/TRACKED of the rows is certain to be among them.
TRACKED = 1 << 15


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_hash(like: DataFrame, keys: list[str]) -> F.Column:
    """Hash of the key columns in the types that they have in ``like``: equal keys have equal hashes."""
    return F.xxhash64(*[F.col(f"`{k}`").try_cast(like.schema[k].dataType) for k in keys])


def hot_keys(df: DataFrame, key: str | list[str], parts: int | None = None) -> list[tuple[int, int]]:
    """(hash of the key, tasks) of every key with more rows than two mean tasks of a shuffle into ``parts``.

    One pass over the key columns: a mergeable sketch of frequent items per task, so
    the keys themselves are not shuffled and at most ``parts / 2`` hashes come back.
    Counts are estimates; they decide how rows are dealt, not the result.
    """
    keys = [key] if isinstance(key, str) else key
    parts = parts or partitions(df.sparkSession)
    known = df.select(*[F.col(f"`{k}`") for k in keys]).dropna().select(key_hash(df, keys).alias("h"))
    row = known.agg(F.count(F.lit(1)).alias("n"),
                    F.expr(f"approx_top_k(h, {min(parts, TRACKED // 2)}, {TRACKED})").alias("top")).first()
    return [(t["item"], min(parts, -(-t["count"] * parts // row["n"]))) for t in row["top"] or []
            if t["count"] * parts > 2 * row["n"]]


def split_join(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner",
               hot: list[tuple[int, int]] | None = None, parts: int | None = None) -> DataFrame:
    """Join on ``key`` with the left rows of each hot key dealt over as many tasks as its share asks for.

    The right rows of just those keys are repeated as often: at most two per
    partition of the shuffle in all if the right keys are unique.  ``how`` may be inner,
    left, left_semi or left_anti.  ``hot`` passes keys counted before (by
    ``hot_keys``), so that one count serves several joins on equal keys; without hot
    keys the plan is the plain join.  ``left`` is read for the count and for the
    join: pass a scan or a written table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hot = hot_keys(left, keys, parts) if hot is None else hot
    if not hot:
        return left.join(right, keys, how)
    table = F.broadcast(left.sparkSession.createDataFrame(hot, "_hash long, _tasks int"))
    tasks = F.coalesce("_tasks", F.lit(1))

    def marked(df):
        return df.withColumn("_hash", key_hash(left, keys)).join(table, "_hash", "left").drop("_hash")

    plain = [F.col(f"`{f.name}`") for f in left.schema
             if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    # rows that are equal throughout differ by the task that reads them
    salt = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), tasks).cast("int")
    dealt = marked(left).withColumn("_salt", salt).drop("_tasks")
    spread = marked(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1))).drop("_tasks")
    return dealt.join(spread, [*keys, "_salt"], how).drop("_salt")
