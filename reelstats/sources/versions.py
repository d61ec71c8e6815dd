"""Tables that are replaced in one step.

A table is a folder of complete copies (``data-...``) and a log of numbered
entries, each naming one of them; the table is what the highest entry names.  A
replacement writes its copy first and then creates the next entry, which fails if
another writer has taken the number, so nobody ever sees a missing or half-written
table, a failed write leaves the old table, and a reader keeps the copy that it
opened.  The copies of the last ``keep`` entries stay for such readers; older ones
go with the next replacement (or with ``expire``).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

LOG = "_log"
KEEP = 2


class Folder:
    """A folder of the file system that the session's Hadoop settings give to its path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path().getFileSystem(conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def names(self, *parts: str) -> list[str]:
        where = self.path(*parts)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def text(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> bool:
        """Create a new file; False if there is one already."""
        try:
            stream = self.fs.create(self.path(*parts), False)
        except Py4JJavaError as err:
            if "AlreadyExists" in err.java_exception.getClass().getName() or self.fs.exists(self.path(*parts)):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


def entries(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, copy) of every complete log entry, ascending."""
    folder = Folder(spark, root)
    out = []
    for name in sorted(n for n in folder.names(LOG) if n.isdigit()):
        text = folder.text(LOG, name)
        if text.endswith("\n"):  # an entry that is still being written does not count
            out.append((int(name), text.strip()))
    return out


def current(spark: SparkSession, root: str) -> str | None:
    """Path of the copy that the table is now; None if nothing was ever put there."""
    found = entries(spark, root)
    return f"{root.rstrip('/')}/{found[-1][1]}" if found else None


def replace(df: DataFrame, root: str, fmt: str = "parquet", partition_by: list[str] | None = None,
            keep: int = KEEP) -> int:
    """Replace the table by ``df``; returns the number of the new entry."""
    spark = df.sparkSession
    folder, copy = Folder(spark, root), f"data-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(f"{folder.root}/{copy}")
    except BaseException:
        folder.remove(copy)
        raise
    number = max([n for n, _ in entries(spark, root)], default=0) + 1
    while not folder.create(copy + "\n", LOG, f"{number:012d}"):
        number += 1
    expire(spark, root, keep)
    return number


def expire(spark: SparkSession, root: str, keep: int = KEEP) -> None:
    """Delete the copies of all but the last ``keep`` entries."""
    folder = Folder(spark, root)
    for number, copy in entries(spark, root)[:-keep] if keep > 0 else []:
        folder.remove(copy)
        folder.remove(LOG, f"{number:012d}")
