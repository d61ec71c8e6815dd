"""The streaming popularity equals the batch statistics over the same files."""

from reelstats.operators import stats
from reelstats.session import scratch_path
from reelstats.sources import fixtures
from reelstats.streaming import popularity
from tests.conftest import SF001
from tests.helpers import rows_of


def test_stream_matches_batch_and_resumes(spark):
    raw = fixtures.ratings_raw(spark, SF001).where("movie_id is not null")
    src = scratch_path(spark, "rating-files")
    first, second = raw.randomSplit([0.5, 0.5], 7)
    first.write.parquet(f"{src}/part1")
    target = scratch_path(spark, "monthly")
    ckpt = scratch_path(spark, "ckpt")

    def run():
        stream = popularity.rating_stream(spark, f"{src}/*", max_files_per_trigger=2)
        q = popularity.run_to_table(popularity.monthly_counts(stream), target, ckpt)
        q.awaitTermination()

    run()
    assert rows_of(spark.read.parquet(target)) == rows_of(
        stats.popular_items_by_month(spark.read.parquet(f"{src}/part1")))
    second.write.parquet(f"{src}/part2")   # new files arrive; the query resumes
    run()
    assert rows_of(spark.read.parquet(target)) == rows_of(
        stats.popular_items_by_month(spark.read.parquet(f"{src}/*")))


def test_late_ratings_count_in_their_month(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("events", "months", "months-ckpt"))
    jan, may = 1704067200, 1714521600   # first days of 2024-01 and 2024-05

    def run(rows, name):
        spark.createDataFrame(rows, popularity.RATING_SCHEMA).coalesce(1).write.parquet(f"{src}/{name}")
        stream = popularity.rating_stream(spark, f"{src}/*", max_files_per_trigger=1)
        popularity.run_to_table(popularity.monthly_counts(stream), out, ckpt).awaitTermination()
        return sorted((r.year_month, r.movie_id, r["count"]) for r in spark.read.parquet(out).collect())

    assert run([("1", "a", "x", str(jan + 10)), ("4", "a", "x", str(may + 1))], "p1") == [
        (202401, "a", 1), (202405, "a", 1)]
    assert run([("5", "a", "x", str(jan + 30))], "p2") == [(202401, "a", 2), (202405, "a", 1)]
