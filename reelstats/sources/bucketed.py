"""Tables stored bucketed by a key, so that joins on it need no shuffle of them.

Meant for tables with unique keys (codes, names, means): a bucket then holds its
share of the keys and nothing can be hot.  The number of buckets is fixed when a
table is written; tables that are joined should have the same.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelstats.session import parts_for, scratch_path


def buckets_for(df: DataFrame, most: int = 4096) -> int:
    """A power of two near the table's size over 64 MB, at least the configured shuffle width's."""
    return min(most, 1 << (max(parts_for(df), 1) - 1).bit_length())


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of the session's catalog, bucketed and sorted by ``key``; returns the table."""
    path = path or scratch_path(df.sparkSession, name)
    (df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def scratch_name(spark: SparkSession, name: str) -> str:
    """A table name that no other query of the session uses."""
    return f"{name}_{uuid.uuid4().hex[:12]}"
