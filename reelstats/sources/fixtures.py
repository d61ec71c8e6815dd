"""Views that give the rating schemas real rows from the driver tables.

User = customer, item = part, rating label from the line quantity, genres from
the two words of the part name.  Every view is a lazy DataFrame over the
parquet tables, so its size grows with the scale factor.  The definitions
(and their deliberate duplicates, nulls and label noise) are the ones written
down in FIXTURES.md section 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import TimestampType

from reelstats.functions.scalars import timestamp_to_epoch
from reelstats.sources.io import spread_if_narrow

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _order_lines(spark, sf_dir) -> DataFrame:
    li = spread_if_narrow(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _epoch(df: DataFrame, col: str) -> F.Column:
    zone_aware = isinstance(df.schema[col].dataType, TimestampType)
    return timestamp_to_epoch(F.col(col), zone_aware)


def _label() -> F.Column:
    stars = (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("string")
    return F.concat(F.lit("allstar"), stars, F.lit("0 rating"))


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, movie_id, user_rating (label text), time_stamp (epoch text)."""
    lines = _order_lines(spark, sf_dir)
    null = F.lit(None).cast("string")
    label = F.when(F.col("l_orderkey") % 89 == 0, null).otherwise(_label())
    # every line gives one row; lines matching the duplicate rule give a second,
    # always labelled copy (one scan instead of a union of two)
    dup = (F.col("l_orderkey") % 97 == 0) & (F.col("l_orderkey") % 89 != 0)
    ratings = F.when(dup, F.array(label, _label())).otherwise(F.array(label))
    main = lines.select(_str("o_custkey").alias("user_id"), _str("l_partkey").alias("movie_id"),
                        F.explode(ratings).alias("user_rating"),
                        _str(_epoch(lines, "o_orderdate")).alias("time_stamp"))
    empty = table(spark, sf_dir, "region").select(
        null.alias("user_id"), null.alias("movie_id"), null.alias("user_rating"),
        null.alias("time_stamp"))
    return main.unionByName(empty)


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread_if_narrow(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    key = F.col("p_partkey")
    writer = (F.when(key % 4 == 0, F.concat(F.lit("编剧:"), "p_brand"))
              .when(key % 4 == 1, F.concat(F.lit("主演: "), "p_brand", F.lit("...")))
              .when(key % 4 == 2, F.concat("p_brand", F.lit(" / 更多..."))))
    starring = (F.when(key % 3 == 0, F.concat(F.lit("主演:"), "p_type"))
                .otherwise(F.concat("p_type", F.lit("更多..."))))
    rating = F.concat(_str(F.lit(1) + F.col("p_size") % 9), F.lit("."), _str(key % 10))
    release = F.concat(_str(F.lit(2019) + key % 5), F.lit("-"),
                       F.lpad(_str(F.lit(1) + key % 12), 2, "0"), F.lit("-"),
                       F.lpad(_str(F.lit(1) + key % 28), 2, "0"))
    return p.select(
        _str(key).alias("movie_id"),
        F.col("p_name").alias("movie_name"),
        F.when(key % 41 == 0, F.lit(None).cast("string"))
         .otherwise(F.replace("p_name", F.lit(" "), F.lit("/"))).alias("movie_type"),
        writer.alias("movie_writer"),
        starring.alias("movie_starring"),
        rating.alias("movie_rating"),
        _str(key * 37 % 100003).alias("rating_people_num"),
        release.alias("movie_release_date"),
    )


def tags_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _order_lines(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lp = lines.join(p, F.col("p_partkey") == F.col("l_partkey"))
    first = F.when(F.col("l_orderkey") % 89 == 0, F.lit(None).cast("string")) \
        .otherwise(F.split_part("p_name", F.lit(" "), F.lit(1)))
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    # one tag row per word of the part name, from a single scan
    return lp.select(_str("o_custkey").alias("user_id"), _str("l_partkey").alias("movie_id"),
                     F.explode(F.array(first, second)).alias("user_tag"))


def posters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = _str("p_partkey")
    return (p.where(F.col("p_partkey") % 7 != 0)
            .select(key.alias("movie_id"),
                    F.concat(F.lit("http://img/"), key, F.lit(".jpg")).alias("poster_url"),
                    F.concat(F.lit("http://m/"), key).alias("movie_url")))


def code_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuple text lines ``(id,code)`` as a one-column ``value`` table."""
    p = table(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("("), _str("p_partkey"), F.lit(","),
                             _str(F.col("p_partkey") + 1), F.lit(")")).alias("value"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean typed ratings: user_id int, movie_id int, user_rating double, time_stamp bigint."""
    from reelstats.operators.clean import dedupe, typed_ratings
    raw = dedupe(ratings_raw(spark, sf_dir))
    return typed_ratings(raw, require_all=True)


def split_part_of(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name).drop("split")
