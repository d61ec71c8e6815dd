"""Connected components of an edge table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.operators.skew import split_join
from reelstats.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (u, v), root the component's smallest node.

    Each round replaces a node's smaller neighbour by that neighbour's own
    smallest one and then hangs all smaller neighbours below the smallest; the
    rounds grow with the logarithm of the longest path.  Every round's edges are
    written to the shared folder, so lineage stays short and survives lost
    executors.  Only the smaller end of an edge can be hot; the edges of such nodes
    are dealt over tasks.  Roots themselves are included.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    state = _state(e)
    while state[0]:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        hop = (split_join(e, least.withColumnRenamed("u", "v"), "v", "left")
               .select("u", F.coalesce("m", "v").alias("v")))
        least = hop.groupBy("u").agg(F.min("v").alias("m"))
        joined = hop.join(least, "u")
        e = materialize(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
