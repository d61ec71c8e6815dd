"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after replacing each run of ASCII white space
by one space; null counts as empty.  Misra-Gries summaries of bounded size find
the digests that may be frequent; their exact counts and smallest document are
verified and broadcast (at most ``counters`` rows, whatever the corpus), so the
copies of a frequent text are decided map-side.  All other digests go through
one ordinary shuffle of one row per digest and task; a digest left to it is on at
most about 2/counters of the rows.

Defined results: documents without an id sort after those with one; of repeated
rows of one id exactly one is kept; texts of any length are hashed whole; an empty
table gives an empty table; input
columns other than the id and the text never matter, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.session import materialize

WHITE = r"[\x20\x09-\x0D]+"


def text_digest(text_col: str = "text") -> F.Column:
    """SHA-256 (lowercase hex) of the text with white-space runs as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE, " "), 256)


def add_counts(counts: dict, new: dict, counters: int) -> dict:
    """One Misra-Gries step: add, then subtract the (counters+1)-th largest count."""
    total = Counter(counts)
    total.update(new)
    if len(total) > counters:
        cut = sorted(total.values(), reverse=True)[counters]
        total = {k: v - cut for k, v in total.items() if v > cut}
    return dict(total)


def summarise(counters: int):
    def run(batches):
        counts: dict = {}
        for batch in batches:
            seen = pc.value_counts(batch.column("digest"))
            counts = add_counts(counts, dict(zip(seen.field(0).to_pylist(), seen.field(1).to_pylist())), counters)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["digest", "n"])
    return run


def heavy_candidates(digests: DataFrame, counters: int = 512) -> DataFrame:
    """At most ``counters`` digests, with every one on more than 2/(counters+1) of the rows.

    Every task's summary undercounts a digest by at most its rows/(counters+1);
    the sums therefore exceed rows/(counters+1) for each such digest, and fewer
    than counters+1 digests can have so large a sum.
    """
    parts = digests.select("digest").mapInArrow(summarise(counters), "digest string, n long")
    return (parts.groupBy("digest").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "digest").limit(counters).select("digest"))


def first_row() -> F.Column:
    """The row that stays: smallest id (missing ids last), then first stored."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = 512) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = materialize(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"))
        .withColumn("rid", F.monotonically_increasing_id()), "digests")
    maybe = heavy_candidates(digests, counters)
    winners = materialize(
        digests.join(F.broadcast(maybe), "digest").groupBy("digest")
        .agg(first_row().alias("first"), F.count(F.lit(1)).alias("group_size")), "winners")
    # at most ``counters`` rows: a bound that does not depend on the corpus
    heavy = (digests.join(F.broadcast(winners), "digest")
             .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                     (F.col("rid") == F.col("first.rid")).alias("kept"), "digest"))
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # combined map-side, so that no group is ever gathered in a task
    groups = rest.groupBy("digest").agg(first_row().alias("first"), F.count(F.lit(1)).alias("group_size"))
    rest = (rest.join(groups, "digest")
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("first.rid")).alias("kept"), "digest"))
    return heavy.unionByName(rest).withColumnRenamed("digest", "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               counters: int = 512) -> DataFrame:
    """The documents that stay, with all their columns.

    Copies of frequent texts leave before the shuffle; only the verified first
    document of each passes on with the rest, which one shuffle decides.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                         F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"))
    slim = materialize(packed.select("doc_id", "digest").withColumn("rid", F.lit(0).cast("long")), "digests")
    winners = materialize(
        slim.join(F.broadcast(heavy_candidates(slim, counters)), "digest")
        .groupBy("digest").agg(first_row().alias("first")), "winners")
    joined = packed.join(F.broadcast(winners), "digest", "left")
    alive = joined.where(F.col("first").isNull() | F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64(F.to_json("row")))
    return (alive.withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*"))


SQL_EXACT = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
