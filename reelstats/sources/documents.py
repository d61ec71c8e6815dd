"""Collections whose documents differ: JSON lines as VARIANT values.

Every line becomes one VARIANT (null if it is no JSON); fields are taken out by
path and type, and a missing or mistyped field is null instead of an error, so
one scan serves documents of any shape.  ``inferred_schema`` says what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(line, doc) of JSON-lines files."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.try_parse_json("value").alias("doc"))


def typed_fields(docs: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """One column per field: name -> (path, type).  Lines without a document are left out."""
    return docs.where(F.col("doc").isNotNull()).select(
        *[F.try_variant_get("doc", path, kind).alias(name) for name, (path, kind) in fields.items()])


def field_report(docs: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """(field, n_missing, n_mistyped): documents without the field, and those whose value is of another type.

    A JSON null counts as missing.
    """
    def count(cond): return F.count_if(F.coalesce(cond, F.lit(False)))

    def present(path):
        value = F.try_variant_get("doc", path, "variant")
        return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))

    counts = []
    for path, kind in fields.values():
        there = present(path)
        counts += [count(~there), count(there & F.try_variant_get("doc", path, kind).isNull())]
    row = docs.where(F.col("doc").isNotNull()).agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)])
    report = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"c{2 * i}").alias("n_missing"),
                                          F.col(f"c{2 * i + 1}").alias("n_mistyped")) for i, name in enumerate(fields)]))
    return row.select(report.alias("r")).select("r.*")


def rejected_lines(docs: DataFrame) -> DataFrame:
    """Lines that are no JSON document."""
    return docs.where(F.col("doc").isNull() & F.col("line").isNotNull()).select("line")


def inferred_schema(docs: DataFrame) -> DataFrame:
    """One row ``schema``: the type that holds every document."""
    return docs.agg(F.schema_of_variant_agg("doc").alias("schema"))
