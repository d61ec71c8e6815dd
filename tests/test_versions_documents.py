"""Tables replaced in one step, reject tables, documents of differing shapes, bucketed tables."""

import pytest
from pyspark.sql import functions as F

from reelstats.session import local_path, scratch_path
from reelstats.sources import bucketed, documents, io, versions


def rows(spark, n, v):
    return spark.range(n).select("id", F.lit(v).alias("v"))


def values(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_readers_keep_the_copy_they_opened(spark):
    path = scratch_path(spark, "versions")
    assert versions.current(spark, path) is None
    io.write_table(rows(spark, 3, "a"), path)
    first = io.read_table(spark, path)
    io.write_table(rows(spark, 5, "b"), path)
    second = io.read_table(spark, path)
    assert values(first) == [(i, "a") for i in range(3)] and values(second) == [(i, "b") for i in range(5)]
    io.write_table(rows(spark, 1, "c"), path, partition_by=["v"])
    assert values(second) == [(i, "b") for i in range(5)]  # the copy before stays
    assert values(io.read_table(spark, path)) == [(0, "c")]
    assert [n for n, _ in versions.entries(spark, path)] == [2, 3]
    with pytest.raises(Exception):  # two replacements later the first copy is gone
        first.count()


def test_a_table_can_be_replaced_by_what_it_holds(spark):
    path = scratch_path(spark, "versions")
    io.write_table(rows(spark, 4, "a"), path)
    io.write_table(io.read_table(spark, path).where("id > 1"), path)
    assert values(io.read_table(spark, path)) == [(2, "a"), (3, "a")]


def test_a_failed_write_leaves_the_old_table(spark):
    path = scratch_path(spark, "versions")
    io.write_table(rows(spark, 3, "a"), path)
    bad = spark.range(2).select("id", F.raise_error(F.lit("broken row")).cast("string").alias("v"))
    with pytest.raises(Exception, match="broken row"):
        io.write_table(bad, path)
    assert values(io.read_table(spark, path)) == [(i, "a") for i in range(3)]
    folder = versions.Folder(spark, path)
    assert len([n for n in folder.names() if n.startswith("data-")]) == 1  # nothing half-written stays


def test_writers_at_the_same_time_take_different_numbers(spark):
    path = scratch_path(spark, "versions")
    versions.replace(rows(spark, 1, "a"), path)
    folder = versions.Folder(spark, path)
    assert folder.create("data-x\n", versions.LOG, f"{2:012d}") and not folder.create("y\n", versions.LOG, f"{2:012d}")
    assert versions.replace(rows(spark, 2, "b"), path) == 3
    assert values(io.read_table(spark, path)) == [(0, "b"), (1, "b")]


def test_an_entry_that_is_being_written_does_not_count(spark):
    path = scratch_path(spark, "versions")
    io.write_table(rows(spark, 2, "a"), path)
    versions.Folder(spark, path).create("", versions.LOG, f"{2:012d}")
    assert values(io.read_table(spark, path)) == [(0, "a"), (1, "a")]
    io.write_table(rows(spark, 1, "b"), path)
    assert values(io.read_table(spark, path)) == [(0, "b")]


def test_plain_folders_are_read_as_they_are(spark):
    path = scratch_path(spark, "plain")
    rows(spark, 2, "p").write.parquet(path)
    assert values(io.read_table(spark, path)) == [(0, "p"), (1, "p")]


def test_every_line_is_good_or_rejected(spark):
    path = scratch_path(spark, "lines")
    lines = ["a$b$n", "x$1$2", "only$1", "y$2$3$4", "z$notint$5", "w$$6", "$$", "q$7$8"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, rejected = io.scan_delimited(spark, path, "a string, b int, n int")
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [("x", 1, 2), ("w", None, 6), (None, None, None), ("q", 7, 8)], key=str)
    assert sorted(r.line for r in rejected.collect()) == ["only$1", "y$2$3$4", "z$notint$5"]
    assert rejected.where(F.col("file").contains("lines")).count() == 3
    good, rejected = io.scan_delimited(spark, path)  # names from the header, all text
    assert good.columns == ["a", "b", "n"] and good.count() == 5 and rejected.count() == 2


def test_documents_of_differing_shapes(spark):
    path = scratch_path(spark, "docs")
    lines = ['{"id":"1","n":3}', '{"id":"2","n":"x","more":{"deep":[1,2]}}', '{"id":null}', '{"n":4', "", "[1]", '{"id":7}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    docs = documents.read_documents(spark, path)
    fields = {"id": ("$.id", "string"), "n": ("$.n", "int"), "second": ("$.more.deep[1]", "int")}
    got = sorted(map(tuple, documents.typed_fields(docs, fields).collect()), key=str)
    assert got == sorted([("1", 3, None), ("2", None, 2), (None, None, None), (None, None, None), ("7", None, None)], key=str)
    assert {r.line for r in documents.rejected_lines(docs).collect()} == {'{"n":4', ""}
    report = {r.field: (r.n_missing, r.n_mistyped) for r in documents.field_report(docs, fields).collect()}
    assert report == {"id": (2, 0), "n": (3, 1), "second": (4, 0)}
    objects = docs.where(F.col("line").startswith('{"id":"'))
    assert documents.inferred_schema(objects).first().schema == (
        "OBJECT<id: STRING, more: OBJECT<deep: ARRAY<BIGINT>>, n: VARIANT>")


def test_bucketed_tables_join_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    names = [bucketed.scratch_name(spark, n) for n in ("left", "right")]
    left = bucketed.save_bucketed(rows(spark, 100, "l"), names[0], "id", 4)
    right = bucketed.save_bucketed(spark.range(0, 100, 3).withColumn("w", F.col("id") * 2), names[1], "id", 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        both = left.join(right, "id", "left")
        assert both.where("w is not null").count() == 34 and both.count() == 100
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = rows(spark, 100, "l").join(right, "id")
        assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in names:
            spark.sql(f"drop table if exists {n}")
    assert local_path(scratch_path(spark, "x"))
