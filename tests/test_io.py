"""Sources and sinks round trips."""

import json

import pytest

from reelstats.operators import itemcf
from reelstats.sources import io
from reelstats.session import scratch_path


def test_delimited_round_trip_with_nulls(spark):
    df = spark.createDataFrame([("1", "a,b", None), (None, "x$y?", "z")], "a string, b string, c string")
    path = scratch_path(spark, "delim")
    io.write_delimited(df.select("a", "c"), path)
    back = io.read_delimited(spark, path)
    assert back.columns == ["a", "c"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("1", None), (None, "z")], key=str)


def test_tuple_text(spark):
    lines = spark.createDataFrame([("(7,8,2.5)",), ("(x,9,bad)",)], "value string")
    got = io.parse_tuple_text(lines, ["int", "int", "double"], ["u", "i", "r"]).collect()
    assert tuple(got[0]) == (7, 8, 2.5) and tuple(got[1]) == (None, 9, None)


def test_tuple_text_from_file(spark):
    path = scratch_path(spark, "tuples")
    spark.createDataFrame([("(a,1)",), ("(b,2)",)], "value string").write.text(path)
    got = sorted(map(tuple, io.read_tuple_text(spark, path, ["string", "int"], ["id", "code"]).collect()))
    assert got == [("a", 1), ("b", 2)]


def test_table_round_trip_drops_id(spark):
    df = spark.createDataFrame([(1, "x")], "_id int, v string")
    path = scratch_path(spark, "coll")
    io.write_table(df, path)
    assert io.read_table(spark, path).columns == ["v"]


def test_item_lists_round_trip(spark):
    recs = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (2, 1, 9)], "user_id int, rank int, movie_id int")
    path = scratch_path(spark, "lists")
    io.save_item_lists(itemcf.to_item_lists(recs), path)
    back = {r.user_id: list(r["items"]) for r in io.load_item_lists(spark, path).collect()}
    assert back == {1: [5, 3], 2: [9]}


def test_text_lines_of_any_size(spark):
    path = scratch_path(spark, "lines")
    io.write_text(spark.range(0, 50_000).selectExpr("cast(id as string) as value"), path)
    assert spark.read.text(path).count() == 50_000
    path = scratch_path(spark, "small")
    io.write_text(spark.createDataFrame([(10, 0.5)], "k int, p double"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["10,0.5"]


def test_json_array_is_one_document_in_order(spark):
    path = scratch_path(spark, "array")
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None)], "k int, v string").repartition(3)
    io.write_json_array(df, path, ["k"])
    (line,) = [r.value for r in spark.read.text(path).collect()]
    assert [d["k"] for d in json.loads(line)] == [1, 2, 3]
    assert sorted(map(tuple, io.read_json_array(spark, path, "k int, v string").collect()), key=lambda r: r[0]) == [
        (1, "a"), (2, None), (3, "c")]


def test_jdbc_reader_passes_options(spark):
    # No database exists here: an unknown JDBC scheme fails inside Spark's JDBC
    # source while resolving the schema, which shows the options reach it.
    with pytest.raises(Exception) as err:
        io.read_jdbc(spark, "jdbc:nosuchdb://nowhere/db", "meal_list", "u", "p", fetchsize="10")
    assert "driver" in str(err.value).lower() or "jdbc" in str(err.value).lower()
