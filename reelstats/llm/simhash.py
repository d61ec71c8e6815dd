"""SimHash near duplicates with BK-trees.

The words of a text (ASCII lower case, runs of anything but ASCII white space)
make 3-word shingles, repeats included; a shorter text is one shingle.  A
fingerprint bit is set where over half of the shingles' XXH64 values have it; a
text without words has fingerprint zero.  Fingerprints link at ``radius`` or
fewer differing bits, and a component is what links connect.

Only distinct fingerprints are searched.  Two of them within the radius agree on
one whole block of bits when the bits are cut into radius + 1 blocks, so each
fingerprint goes to the shard of each of its blocks.  A shard of more than
``SHARD`` fingerprints is cut again by the bits that its members do not share;
the bits left shrink until a shard cannot be larger.  No link is lost and no cap
is needed: the shards are bounded because the bits are.

Every shard becomes a BK-tree: a node's children are keyed by their integer
Hamming distance to it, so a query at distance d from a node need only follow
edges in d - radius .. d + radius.  A shard's queries (its members) are dealt in
blocks, and its tree (at most ``SHARD`` nodes, packed) is joined to each of them:
Spark broadcasts the trees while their measured size is below its broadcast
threshold, and shuffles trees and blocks by shard otherwise, as all trees
together grow with the corpus.  A block reports one edge per link that ties two
parts not yet tied in it, never all pairs.

Defined results: null and blank texts have fingerprint zero and are linked like
any other; documents without an id take part, and a component of such documents
alone has a null id; repeated rows are rows of one fingerprint; texts of any
length are hashed whole, in slices of shingles; an empty table gives no rows;
other columns never matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.llm.graph import components
from reelstats.llm.stream import sorted_groups
from reelstats.llm.words import slices, texts_of
from reelstats.operators.skew import split_join
from reelstats.session import materialize

SHINGLE, RADIUS, SEED = 3, 2, 42
SHARD, BLOCK = 4096, 512
SHINGLES_AT_ONCE = 1 << 18
ALL_BITS = (1 << 64) - 1


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str, size: int = SHINGLE) -> int:
    """SimHash of one whole text."""
    from xxhash import xxh64_intdigest
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    size = min(size, len(words))
    starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        h = np.fromiter((xxh64_intdigest(joined[a:b], SEED)
                         for a, b in zip(starts[part].tolist(), ends[part].tolist())), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(starts)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint_stream(batches):
    for batch in slices(batches):
        values = np.fromiter((fingerprint(t) for t in texts_of(batch).to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))],
                                         names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as the signed long with the same 64 bits."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        fingerprint_stream, f"doc_id {kind}, fp long")


# ---------------------------------------------------------------- shards
def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def cuts(free: int, parts: int) -> list[int]:
    """Cut the free bits into masks of nearly equal numbers of bits."""
    at = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in at[len(at) * p // parts:len(at) * (p + 1) // parts]) for p in range(parts)]


def shards(distinct: DataFrame, radius: int = RADIUS, most: int = SHARD) -> DataFrame:
    """(mask, value, fp): members of a shard share the bits ``value`` under ``mask``; no shard has over ``most``.

    A shard whose free bits can hold no more than ``most`` fingerprints ends the
    cutting, so it takes a fixed number of rounds at the very most; a round reads
    only the shards that are still too large.
    """
    if most < 1 << radius:
        raise ValueError("a shard must hold all fingerprints of the radius' free bits")
    spark = distinct.sparkSession
    masks, entries, done = [0], distinct.select(F.lit(0).cast("long").alias("mask"), "fp"), None
    while masks:
        # every member of a cut shard goes to radius + 1 shards that share one more block
        routes = [(signed(m), signed(m | c)) for m in masks for c in cuts(ALL_BITS & ~m, radius + 1)]
        table = F.broadcast(spark.createDataFrame(routes, "mask long, to long"))  # as many rows as masks, times three
        entries = entries.join(table, "mask").select(F.col("to").alias("mask"), F.col("to").bitwiseAND(F.col("fp"))
                                                     .alias("value"), "fp")
        if len(masks) > 1:  # other blocks in another order can come to the same mask
            entries = entries.distinct()
        entries = materialize(entries, "shards")
        sizes = entries.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        # shards of one member have no links
        small = entries.join(sizes.where((F.col("n") > 1) & (F.col("n") <= most)), ["mask", "value"], "left_semi")
        done = small if done is None else done.unionByName(small)
        large = materialize(entries.join(sizes.where(F.col("n") > most), ["mask", "value"], "left_semi"), "shards")
        masks = sorted(r["mask"] & ALL_BITS for r in large.select("mask").distinct().collect())
        entries = large.select("mask", "fp")
    return done


# ---------------------------------------------------------------- trees
def build_tree(values: np.ndarray) -> np.ndarray:
    """BK-tree of distinct fingerprints as rows (fingerprint, first child, next sibling, distance to the parent).

    Node 0 is the root; -1 ends a list.  At most one child of a node has a given distance.
    """
    n = len(values)
    child, sibling, edge = [-1] * n, [-1] * n, [0] * n
    ints = values.tolist()
    edges: list[dict] = [{} for _ in range(n)]
    for i in range(1, n):
        at = 0
        while True:
            d = (ints[i] ^ ints[at]).bit_count()
            nxt = edges[at].get(d)
            if nxt is None:
                edges[at][d] = i
                sibling[i], child[at], edge[i] = child[at], i, d
                break
            at = nxt
    links = np.array([child, sibling, edge], np.int64).view(np.uint64)
    return np.concatenate([values[None, :].astype(np.uint64), links]).T.copy()


def unpack_tree(packed: bytes) -> tuple[list, list]:
    """Fingerprints, and each node's children as (distance, node)."""
    rows = np.frombuffer(packed, np.uint64).reshape(-1, 4)
    child, sibling, edge = (rows[:, c].astype(np.int64).tolist() for c in (1, 2, 3))
    children = []
    for first in child:
        kids, at = [], first
        while at >= 0:
            kids.append((edge[at], at))
            at = sibling[at]
        children.append(kids)
    return rows[:, 0].tolist(), children


def search(values: list, children: list, query: int, radius: int = RADIUS):
    """Nodes within the radius of the query, following only edges within it."""
    open_nodes = [0]
    while open_nodes:
        at = open_nodes.pop()
        d = (values[at] ^ query).bit_count()
        if d <= radius:
            yield at
        open_nodes += [node for edge, node in children[at] if d - radius <= edge <= d + radius]


def tree_stream(batches):
    """Stream sorted by shard -> (mask, value, tree) for each shard."""
    for table, starts in sorted_groups(batches, ["mask", "value"]):
        fp = table.column("fp").to_numpy().view(np.uint64)
        first = pa.array(starts[:-1])
        trees = [build_tree(fp[a:b]).tobytes() for a, b in zip(starts[:-1], starts[1:])]
        for at in range(0, len(trees), 1024):
            yield pa.RecordBatch.from_arrays(
                [table.column(c).take(first[at:at + 1024]).combine_chunks() for c in ("mask", "value")]
                + [pa.array(trees[at:at + 1024], pa.binary())], names=["mask", "value", "tree"])


def block_stream(block: int):
    """Trees -> (mask, value, at): one row per block of queries, members at .. at + block of the tree."""
    def run(batches):
        for batch in batches:
            sizes = np.array([len(t) // 32 for t in batch.column("tree").to_pylist()], np.int64)
            blocks = -(-sizes // block)
            rows = np.repeat(np.arange(len(sizes)), blocks)
            at = (np.arange(len(rows)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * block
            yield pa.RecordBatch.from_arrays(
                [batch.column("mask").take(pa.array(rows)), batch.column("value").take(pa.array(rows)),
                 pa.array(at, pa.int64())], names=["mask", "value", "at"])
    return run


def link_stream(radius: int, block: int):
    """(tree, at) rows -> edges (u, v) that tie the links of each block's members."""
    def run(batches):
        for batch in batches:
            u, v = [], []
            for packed, at in zip(batch.column("tree").to_pylist(), batch.column("at").to_pylist()):
                values, children = unpack_tree(packed)
                parent = list(range(len(values)))

                def root(x):
                    while parent[x] != x:
                        parent[x] = parent[parent[x]]
                        x = parent[x]
                    return x

                for q in range(at, min(at + block, len(values))):
                    for hit in search(values, children, values[q], radius):
                        a, b = root(q), root(hit)
                        if a != b:
                            parent[a] = b
                            u.append(values[q])
                            v.append(values[hit])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (u, v)],
                                             names=["u", "v"])
    return run


def links(distinct: DataFrame, radius: int = RADIUS, most: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(u, v) edges whose components are those of all links between distinct fingerprints."""
    members = shards(distinct, radius, most)
    trees = materialize(members.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
                        .mapInArrow(tree_stream, "mask long, value long, tree binary"), "trees")
    queries = trees.mapInArrow(block_stream(block), "mask long, value long, at long")
    return (queries.join(trees, ["mask", "value"]).select("tree", "at")
            .mapInArrow(link_stream(radius, block), "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    most: int = SHARD) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    firsts = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    tied = components(links(firsts.select("fp"), radius, most))
    roots = firsts.join(tied.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    roots = materialize(roots, "fingerprint-roots")
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(split_join(roots, least, "root").select("fp", "component_id"), "components")
    return split_join(prints, named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
