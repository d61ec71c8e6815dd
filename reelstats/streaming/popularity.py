"""Monthly and all-time popularity kept up to date as rating files arrive.

The batch statistics (``operators.stats``) recount everything; here the same
aggregates are maintained by Structured Streaming over a directory that
receives new rating files.  State is one count per (month, item) and per
item, so it is bounded by the catalogue size times the number of months, not
by the number of ratings.  Each micro-batch rewrites the (small) result
table; the checkpoint lives in the shared checkpoint folder, so a restarted
query resumes where it stopped.  There is no watermark: a rating that arrives
late still counts in its month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.functions.scalars import epoch_to_year_month
from reelstats.session import scratch_path

RATING_SCHEMA = "user_id string, movie_id string, user_rating string, time_stamp string"


def rating_stream(spark: SparkSession, source_dir: str, schema: str = RATING_SCHEMA,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def monthly_counts(ratings: DataFrame, item_col: str = "movie_id",
                   ts_col: str = "time_stamp") -> DataFrame:
    """Streaming (year_month, item, count); same definition as the batch query."""
    return (ratings.withColumn("year_month", epoch_to_year_month(ts_col))
            .groupBy("year_month", item_col).agg(F.count(item_col).alias("count"))
            .select(item_col, "count", "year_month"))


def item_counts(ratings: DataFrame, item_col: str = "movie_id") -> DataFrame:
    return ratings.groupBy(item_col).agg(F.count(item_col).alias("count"))


def run_to_table(counts: DataFrame, target: str, checkpoint: str | None = None,
                 available_now: bool = True, processing_time: str | None = None):
    """Maintain ``counts`` as a parquet table at ``target``.

    ``complete`` mode hands every micro-batch the full (bounded) result,
    which replaces the table.  Returns the started query.
    """
    spark = counts.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "popularity-checkpoint")

    def replace(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    writer = (counts.writeStream.outputMode("complete").foreachBatch(replace)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
