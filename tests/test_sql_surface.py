"""SQL functions and SQL-text statistics equal the DataFrame forms; small sinks."""

import json

from reelstats.functions.scalars import epoch_to_year_month, rating_from_label
from reelstats.functions.sql import register_sql_functions
from reelstats.operators import dashboard, serve, stats
from reelstats.plans import sql_text
from reelstats.session import scratch_path
from reelstats.sources import io
from tests.helpers import rows_of


def test_sql_functions_equal_column_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([("1700000000", "allstar40 rating"), ("junk", "x"), (None, None),
                                ("-86401", "allstar10 rating")], "t string, l string")
    a = df.selectExpr("change_date(t) as m", "rating_value(l) as r")
    b = df.select(epoch_to_year_month("t").alias("m"), rating_from_label("l").alias("r"))
    assert rows_of(a) == rows_of(b)


def test_sql_text_statistics_equal_dataframe_ones(spark):
    r = spark.createDataFrame([("1", "a", 4.0, "1700000000"), ("2", "a", 2.0, "1600000000"),
                               ("3", "b", 5.0, "1700000000"), ("4", None, 1.0, "5")],
                              "user_id string, movie_id string, user_rating double, time_stamp string")
    assert rows_of(sql_text.popular_items_sql(r)) == rows_of(stats.popular_items(r))
    assert rows_of(sql_text.popular_items_by_month_sql(r)) == rows_of(stats.popular_items_by_month(r))
    assert rows_of(sql_text.avg_rating_sql(r)) == rows_of(stats.avg_rating(r))


def test_dashboard_json_sink(spark):
    r = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "user_rating double")
    path = scratch_path(spark, "hist-json")
    io.write_json(dashboard.rating_histogram(r).select("name", "y"), path)
    lines = [json.loads(x.value) for x in spark.read.text(path).collect()]
    assert sorted((d["name"], d["y"]) for d in lines) == [(1.0, 1), (2.0, 2)]


def test_for_users_and_excluded_tags(spark):
    recs = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "user_id int, movie_id int")
    assert {r.user_id for r in serve.for_users(recs, [1, 3]).collect()} == {1, 3}
    tags = spark.createDataFrame([("[x]",), ("y",), (None,)], "user_tag string")
    assert {r.genre for r in stats.distinct_tags(tags, exclude=["y"]).collect()} == {"x"}
