"""Table scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelstats.sources import versions


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   sep: str = "$", header: bool = True) -> DataFrame:
    """Header + delimiter text files; every column is text unless a schema says otherwise.

    Fields that do not parse are null; ``scan_delimited`` tells malformed lines apart.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def scan_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = "$",
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of delimited files: every line that is not blank is in exactly one of the two.

    A line is malformed if it has more or fewer fields than the schema or a field
    that does not parse; ``rejected`` holds (file, line).  With ``header`` the first
    line of a file is none of the two; without a schema it names the columns, all text.
    """
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file")).where("value <> ''")
    if schema is None:
        schema = StructType([StructField(c, StringType()) for c in read_delimited(spark, path, sep=sep).columns])
    if header:
        first = spark.read.text(path).first()
        lines = lines.where(F.col("value") != F.lit(first["value"] if first else ""))
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*kind.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_csv("value", fields, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select("file", "value", parsed.alias("row"))
    good = rows.where(F.col(f"row.{CORRUPT}").isNull()).select("row.*").drop(CORRUPT)
    return good, rows.where(F.col(f"row.{CORRUPT}").isNotNull()).select("file", F.col("value").alias("line"))


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer input splits than the cluster has cores.

    A large table arrives as many files and is left alone (no extra
    shuffle); a table stored as one unsplittable file would otherwise put
    all per-row work after the scan into a single task.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (Spark Connect): leave the scan as is
        return df
    return df.repartition(cores) if splits < cores else df


def write_delimited(df: DataFrame, path: str, sep: str = "$", header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A stored collection: a path in the given format or a catalog table name.

    A path written by ``write_table`` is read as its current copy, any other as it
    is.  A document-store ``_id`` column is dropped when present.
    """
    if fmt == "table":
        df = spark.table(source)
    else:
        df = spark.read.format(fmt).load(versions.current(spark, source) or source)
    return df.drop("_id") if "_id" in df.columns else df


def write_table(df: DataFrame, target: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Replace a stored collection in one step (see ``sources.versions``); a catalog table is overwritten."""
    if fmt != "table":
        versions.replace(df, target, fmt, partition_by)
        return
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target)


def parse_tuple_text(lines: DataFrame, types: list[str], names: list[str],
                     col: str = "value", sep: str = ",") -> DataFrame:
    """``(a,b,c)`` lines -> typed columns: drop the first and last character,
    split on ``sep``, cast each field (malformed fields become null)."""
    body = F.expr(f"substring({col}, 2, length({col}) - 2)")
    parts = F.split(body, sep)
    return lines.select(*[parts.getItem(i).try_cast(t).alias(n)
                          for i, (t, n) in enumerate(zip(types, names))])


def read_tuple_text(spark: SparkSession, path: str, types: list[str], names: list[str]) -> DataFrame:
    return parse_tuple_text(spark.read.text(path), types, names)


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None,
              password: str | None = None, partition: tuple[str, object, object, int] | None = None,
              **options) -> DataFrame:
    """A table from a JDBC database (driver jar must be on the classpath).

    ``partition`` = (numeric or date column, lower, upper, number): the range is
    read by that many tasks, each with its own connection; rows outside the
    bounds belong to the first and last task.  Without it one task reads all.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition is not None:
        column, lower, upper, number = partition
        reader = (reader.option("partitionColumn", column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", number))
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def save_item_lists(lists: DataFrame, path: str) -> None:
    """(user, items array<int>) model rows as parquet."""
    lists.write.mode("overwrite").parquet(path)


def load_item_lists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_text(df: DataFrame, path: str, sep: str = ",") -> None:
    """Text lines, the columns joined by ``sep``: as many files as the result has partitions.

    Aggregated results (metrics, parameters) have one partition and so one file.
    """
    if len(df.columns) != 1:
        df = df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    df.write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines (one object per row)."""
    df.write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str, order: list | None = None) -> None:
    """One text file with an array of objects, as a dashboard loads it.

    For aggregated datasets whose size does not grow with the ratings (levels,
    months, top lists).
    """
    rows = df.orderBy(*order) if order else df
    numbered = rows.select(F.struct(F.monotonically_increasing_id().alias("_i"), F.struct("*").alias("row")).alias("r"))
    text = F.to_json(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]))
    numbered.agg(text.alias("value")).write.mode("overwrite").text(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)
