"""N-gram Jaccard join with a MinHash LSH forest.

Documents are sets of word 5-grams (whole texts; a text of fewer words is one
gram; an empty text is the empty set).  Documents with equal sets are one class.
Each class gets ``trees`` labels of ``digits`` MinHash digits (one byte each); a
label is a path in that tree's prefix trie, kept as a sorted table.  Two classes
meet where their labels share a prefix.

The forest is descended from the leaves up.  At first only classes with a whole
label in common meet and are tied where they are alike.  Then the matched prefix
is shortened digit by digit, but only where the data ask for it: a run of classes
that longer prefixes have already tied into one component is settled and is not
looked at again, and in the other runs only classes of different components are
compared.  The shortening ends at the longest prefix at which a pair at the
threshold meets in some tree with the target probability; a class that has met
nobody goes down to that depth.

Pairs are never expanded.  Inside a run the digits of all trees estimate the
similarity; classes above a cut far below the threshold (over five standard
deviations) are tied by at most one edge each, and the components of these edges
are the candidate groups.  Each group's sets are gathered once, in blocks of
bounded size when it is large, and every pair inside is verified exactly.  The
result counts the verified links of each class and names its group, which is the
component of verified links: one row a document, however large the groups are.

Defined results: repeated rows share a class; empty texts form one class without
links; documents without an id take part, and a group of such documents alone
has a null id; equal similarities need no order, as every link at the threshold or
above counts; texts of any length are read whole; an empty table gives no rows;
other columns never matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.llm.graph import components
from reelstats.llm.stream import meeting_rows, sorted_groups
from reelstats.llm.words import Words, binary_column, grams, mix, slices, texts_of
from reelstats.operators.bitmaps import key_bitmaps
from reelstats.operators.skew import split_join
from reelstats.session import materialize, parts_for

GRAM, THRESHOLD, RECALL = 5, 0.8, 0.9999
TREES, DIGITS = 40, 8
BLOCK_CLASSES, BLOCK_GRAMS = 512, 1 << 20
RUN_BLOCK = 1024
MARGIN = 0.14  # of the estimate below the threshold: over five standard deviations with 320 digits

SETS = "doc_id long, tie long, grams long, set_hash string, digits binary"
EDGES = "u long, v long"
FOUND = "kind int, a long, b long"


def matched_digits(threshold: float = THRESHOLD, trees: int = TREES, digits: int = DIGITS,
                   recall: float = RECALL) -> int:
    """Longest prefix at which a pair at the threshold meets in some tree with the target probability."""
    for depth in range(digits, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= recall:
            return depth
    raise ValueError("no prefix reaches the target recall; use more trees")


def gram_sets(texts: pa.Array, k: int = GRAM) -> list[np.ndarray]:
    """Sorted distinct gram hashes of every text."""
    words = Words(texts)
    h = words.hashes()
    all_grams = grams(h, k)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(all_grams[a:b - k + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                out.append(mix(grams(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhash_digits(sets: list[np.ndarray], n: int, chunk: int = 1 << 15) -> np.ndarray:
    """(sets, n) digits: one byte of each of n MinHash values; empty sets have zeros."""
    rng = np.random.default_rng(2024)
    flip = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    times = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(sets), n), np.uint8)
    rows = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    with np.errstate(over="ignore"):
        while at < len(rows):
            end, size = at, 0
            while end < len(rows) and (end == at or size + len(sets[rows[end]]) <= chunk):
                size += len(sets[rows[end]])
                end += 1
            part = rows[at:end]
            flat = np.concatenate([sets[i] for i in part])
            starts = np.cumsum([0] + [len(sets[i]) for i in part[:-1]])
            low = np.empty((len(part), n), np.uint64)
            for j in range(n):
                low[:, j] = np.minimum.reduceat((flat ^ flip[j]) * times[j], starts)
            out[part] = (mix(low) >> np.uint64(56)).astype(np.uint8)
            at = end
    return out


def describe(k: int, n: int):
    """Per document: number of grams, digest of the set and all MinHash digits."""
    def run(batches):
        for batch in slices(batches):
            sets = gram_sets(texts_of(batch), k)
            digits = minhash_digits(sets, n)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests), binary_column(digits.reshape(-1), np.arange(len(sets) + 1) * n).cast(pa.binary())],
                names=["doc_id", "tie", "grams", "set_hash", "digits"])
    return run


def tree_labels(trees: int, digits: int):
    """One row per tree: the label, its digits from the top byte down, as an unsigned number."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            raw = np.frombuffer(b"".join(batch.column("digits").to_pylist()), np.uint8).reshape(n, trees, digits)
            label = np.zeros((n, trees), np.uint64)
            for d in range(digits):
                label = (label << np.uint64(8)) | raw[:, :, d]
            label <<= np.uint64(8 * (8 - digits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), pa.array(label.reshape(-1).view(np.int64)),
                 pa.array(np.repeat(batch.column("node").to_numpy(), trees))], names=["tree", "label", "node"])
    return run


def low_labels(tied: np.ndarray) -> np.ndarray:
    """Smallest member index of each member's component, for a symmetric matrix of ties."""
    label = np.arange(len(tied))
    while True:
        low = np.minimum(label, np.where(tied, label[None, :], len(tied)).min(axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def like_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal digits of every row of a and of b."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for j in range(a.shape[1]):
        out += a[:, j][:, None] == b[:, j][None, :]
    return out


def tied_members(digits: np.ndarray, root: np.ndarray, need: float, first: np.ndarray | None) -> np.ndarray:
    """Symmetric matrix: members of one component, or alike by their digits.

    Members of the largest component are not compared with each other.  With
    ``first``, only members of the first block meet members of the second.
    """
    tied = root[:, None] == root[None, :]
    names, count = np.unique(root, return_counts=True)
    few = root != names[count.argmax()]
    everyone = np.ones(len(root), bool)
    sides = ((few, everyone),) if first is None else ((few & first, ~first), (few & ~first, first))
    for rows, cols in sides:
        if rows.any():
            like = like_matrix(digits[rows], digits[cols]) >= need
            tied[np.ix_(rows, cols)] |= like
            tied[np.ix_(cols, rows)] |= like.T
    return tied


def tie_runs(cut: float, n: int):
    """At most one edge a member: estimated components of every run (or pair of blocks of a run)."""
    need = n * (cut + (1 - cut) / 256)

    def run(batches):
        for table, starts in sorted_groups(batches, ["run", "low", "high"]):
            node, root = table.column("node").to_numpy(), table.column("root").to_numpy()
            digits = np.frombuffer(b"".join(table.column("digits").to_pylist()), np.uint8).reshape(-1, n)
            block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
            size = np.diff(starts)
            two = starts[:-1][size == 2]
            near = ((digits[two] == digits[two + 1]).sum(axis=1) >= need) & (root[two] != root[two + 1])
            u, v = [node[two[near]]], [node[two[near] + 1]]
            for a, b in zip(starts[:-1][size > 2].tolist(), starts[1:][size > 2].tolist()):
                first = None if low[a] == high[a] else block[a:b] == low[a]
                label = low_labels(tied_members(digits[a:b], root[a:b], need, first))
                other = root[a:b] != root[a:b][label]
                u.append(node[a:b][other])
                v.append(node[a:b][label[other]])
            u, v = np.concatenate(u), np.concatenate(v)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
    return run


def descend(meeting: DataFrame, digits_of: DataFrame, parts: int, threshold: float, trees: int, digits: int,
            floor: int) -> tuple[DataFrame, DataFrame]:
    """(node, root) of the estimated groups, and (node, depth): the prefix at which each tied class was first tied.

    ``meeting`` holds the labels (tree, label, node) that share a prefix of ``floor`` digits.
    """
    n, ties, groups = trees * digits, None, None
    for depth in range(digits, floor - 1, -1):
        rows = meeting.select("tree", F.shiftrightunsigned("label", 64 - 8 * depth).alias("prefix"), "node")
        if groups is None:
            rows = rows.withColumn("root", F.col("node"))
        else:
            rows = materialize(rows.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")),
                               "trie")
        # a run of one component is settled; runs of the same classes in several trees are one run
        stats = (rows.groupBy("tree", "prefix").agg(
            F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("run"), F.min("root").alias("_low"),
            F.max("root").alias("_high")).where("_low <> _high").drop("_low", "_high"))
        members = split_join(rows, stats, ["tree", "prefix"]).select("run", "size", "node", "root").dropDuplicates(
            ["run", "node"])
        runs = (block_pairs(members.join(digits_of, "node"), F.ceil(F.col("size") / RUN_BLOCK))
                .repartition(parts, "run", "low", "high").sortWithinPartitions("run", "low", "high", "node"))
        new = materialize(runs.mapInArrow(tie_runs(threshold - MARGIN, n), EDGES).withColumn("depth", F.lit(depth)),
                          "ties")
        ties = new if ties is None else ties.unionByName(new)
        known = new.select("u", "v")
        if groups is not None:
            known = known.unionByName(groups.select(F.col("node").alias("u"), F.col("root").alias("v")))
        groups = components(known)
    ends = ties.select(F.explode(F.array("u", "v")).alias("node"), "depth")
    return groups, ends.groupBy("node").agg(F.max("depth").alias("depth"))


def block_pairs(rows: DataFrame, blocks: F.Column) -> DataFrame:
    """Deal the members of a group over blocks and give each row to all pairs of its block.

    A group of one block, the ordinary case, is one row a member.
    """
    dealt = (rows.withColumn("_n", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("_n")))
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))))
    return (dealt.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
            .drop("_n", "_other"))


def attach_sets(k: int):
    """Replace the text by the sorted gram hashes."""
    def run(batches):
        last = None
        for batch in slices(batches):
            node = batch.column("node").to_numpy()
            new = np.append(node[0] != last, node[1:] != node[:-1])  # repeated rows follow each other
            last = node[-1]
            batch = batch.filter(pa.array(new))
            if not batch.num_rows:
                continue
            sets = gram_sets(texts_of(batch), k)
            offsets = np.cumsum([0] + [len(s) for s in sets])
            raw = binary_column(np.concatenate(sets).astype("<u8"), offsets).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("root"), batch.column("blocks"), raw],
                                             names=["node", "root", "blocks", "grams"])
    return run


def shared_grams(sets: list[np.ndarray], first: np.ndarray | None, width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over a bounded number of grams at once.

    With ``first``, rows of the first block meet columns of the second only.
    """
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[code] > 1  # a gram of one set is in no intersection
    renamed = np.cumsum(count > 1) - 1
    code, owner = renamed[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    common = np.zeros((n, n), np.float32)
    total = int(code[-1]) + 1 if len(code) else 0
    for at in range(0, total, width):
        a, b = np.searchsorted(code, [at, at + width])
        has = np.zeros((n, width), np.float32)
        has[owner[a:b], code[a:b] - at] = 1
        if first is None:
            common += has @ has.T
        else:
            common[np.ix_(first, ~first)] += has[first] @ has[~first].T
    if first is not None:
        common[np.ix_(~first, first)] = common[np.ix_(first, ~first)].T
    return common


def verify(threshold: float):
    """Exact links of every group (or pair of its blocks): counts (kind 0: node, links) and edges (kind 1)."""
    def run(batches):
        for table, starts in sorted_groups(batches, ["root", "low", "high"]):
            node = table.column("node").to_numpy()
            raw = table.column("grams")
            block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
            kinds, a_col, b_col = [], [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                rows = np.arange(a, b)
                rows = rows[np.append(True, node[a + 1:b] != node[a:b - 1])]  # repeated rows of one class
                if len(rows) < 2:
                    continue
                names = node[rows]
                sets = [np.frombuffer(raw[i].as_buffer(), "<u8") for i in rows.tolist()]
                first = None if low[a] == high[a] else block[rows] == low[a]
                common = shared_grams(sets, first)
                size = np.array([len(s) for s in sets], np.float64)
                union = size[:, None] + size[None, :] - common
                tied = (common > 0) & (common / union >= threshold)
                np.fill_diagonal(tied, False)
                links = tied.sum(axis=1)
                label = low_labels(tied)
                other = np.flatnonzero(label != np.arange(len(rows)))
                has = np.flatnonzero(links)
                kinds += [0] * len(has) + [1] * len(other)
                a_col += [names[has], names[other]]
                b_col += [links[has], names[label[other]]]
            if kinds:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.int32()), pa.array(np.concatenate(a_col), pa.int64()),
                     pa.array(np.concatenate(b_col), pa.int64())], names=["kind", "a", "b"])
    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, a hash of the text that tells rows of one id apart, and the text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"),
                       F.col(text_col).alias("text"))


def only_wanted(texts: DataFrame, wanted: DataFrame, most_bits: int = 1 << 28) -> DataFrame:
    """The rows of ``texts`` whose (doc_id, tie) may be among ``wanted``: all that are, and few others.

    Whole texts are then shuffled only where they are needed.  The filter is one bit per
    hash value, eight for each wanted row but ``most_bits`` (32 MB) at most, and broadcast.
    """
    bits = min(most_bits, 1 << max(20, (8 * wanted.count()).bit_length()))
    place = (F.pmod(F.xxhash64("doc_id", "tie"), F.lit(bits)) + 1).alias("place")
    marks = key_bitmaps(wanted.select(place), "place")
    octet = F.conv(F.hex(F.substring("bitmap", F.floor(F.bitmap_bit_position("place") / 8).cast("int") + 1, F.lit(1))),
                   16, 10).cast("int")
    is_set = octet.bitwiseAND(F.expr("cast(shiftleft(1, cast(bitmap_bit_position(place) % 8 as int)) as int)")) != 0
    marked = texts.withColumn("place", place).withColumn("bucket", F.bitmap_bucket_number("place"))
    return marked.join(F.broadcast(marks), "bucket").where(is_set).select(*texts.columns)


def forest(docs: DataFrame, id_col: str, text_col: str, gram: int, threshold: float, recall: float, trees: int,
           digits: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents with their sets, classes, estimated groups (node, root) and depths (node, depth)."""
    parts = parts_for(docs)
    n = trees * digits
    floor = matched_digits(threshold, trees, digits, recall)
    rows = materialize(keyed(docs, id_col, text_col).mapInArrow(describe(gram, n), SETS)
                       .withColumn("rid", F.monotonically_increasing_id()), "gram-sets")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    classes = materialize(
        rows.groupBy("set_hash").agg(head.alias("head"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.col("head.rid")), "classes")

    labels = (rows.join(classes.select(F.col("node").alias("rid")), "rid", "left_semi").where("grams > 0")
              .select(F.col("rid").alias("node"), "digits")
              .mapInArrow(tree_labels(trees, digits), "tree int, label long, node long"))
    trie = (labels.withColumn("prefix", F.shiftrightunsigned("label", 64 - 8 * floor))
            .repartition(parts, "tree", "prefix").sortWithinPartitions("tree", "prefix", "label", "node"))
    meeting = materialize(trie.mapInArrow(meeting_rows(["tree", "prefix"], ["tree", "label", "node"]),
                                           "tree int, label long, node long"), "meeting")
    groups, depths = descend(meeting, rows.select(F.col("rid").alias("node"), "digits"), parts, threshold, trees,
                             digits, floor)
    return rows, classes, groups, depths


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES,
                digits: int = DIGITS) -> DataFrame:
    """One row a document: doc_id, tie, class_id, copy_id, n_links, class_docs, first.

    ``class_id`` is the smallest id of the document's group, ``copy_id`` that of
    its class of equal sets, ``n_links`` the number of other classes with a
    similarity of ``threshold`` or more, ``class_docs`` the group's documents;
    ``first`` marks the one row of the group that stays in a dedup.
    """
    parts = parts_for(docs)
    rows, classes, groups, _ = forest(docs, id_col, text_col, gram, threshold, recall, trees, digits)
    known = rows.select(F.col("rid").alias("node"), "doc_id", "tie", "grams")
    placed = materialize(groups.join(known, "node"), "group-members")
    sizes = (placed.groupBy("root").agg(F.count(F.lit(1)).alias("classes"), F.sum("grams").alias("total"))
             .select("root", F.greatest(F.ceil(F.col("classes") / BLOCK_CLASSES),
                                        F.ceil(F.col("total") / BLOCK_GRAMS)).alias("blocks")))
    wanted = materialize(split_join(placed, sizes, "root").select("node", "root", "blocks", "doc_id", "tie"), "wanted")
    texts = only_wanted(keyed(docs, id_col, text_col), wanted).withColumnsRenamed({"doc_id": "_id", "tie": "_tie"})
    joined = wanted.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")))
    one_each = joined.select("node", "root", "blocks", "text")
    sets = one_each.mapInArrow(attach_sets(gram), "node long, root long, blocks long, grams binary")
    found = materialize(
        block_pairs(sets, F.col("blocks")).repartition(parts, "root", "low", "high")
        .sortWithinPartitions("root", "low", "high", "node").mapInArrow(verify(threshold), FOUND), "links")
    links = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("n_links"))
    final = components(found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")))

    info = materialize(
        classes.join(final, "node", "left").join(links, "node", "left")
        .select("set_hash", "node", "head", "copies", F.coalesce("root", "node").alias("root"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "class-links")
    groups = info.groupBy("root").agg(F.min("head").alias("group_head"), F.sum("copies").alias("class_docs"))
    info = split_join(info, groups, "root")
    out = split_join(rows.select("set_hash", "doc_id", "tie", "rid"), info, "set_hash")
    return out.select("doc_id", "tie", F.col("group_head.doc_id").alias("class_id"),
                      F.col("head.doc_id").alias("copy_id"), "n_links", "class_docs",
                      (F.col("rid") == F.col("group_head.rid")).alias("first"))


def depths_reached(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                   threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES,
                   digits: int = DIGITS) -> DataFrame:
    """(copy_id, depth) of every class: the prefix at which it was first tied, the last one tried if it never was."""
    floor = matched_digits(threshold, trees, digits, recall)
    _, classes, _, depths = forest(docs, id_col, text_col, gram, threshold, recall, trees, digits)
    return classes.join(depths, "node", "left").select(
        F.col("head.doc_id").alias("copy_id"), F.coalesce("depth", F.lit(floor)).alias("depth"))


def near_join(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, class_id, copy_id, n_links, class_docs."""
    return near_groups(docs, **options).select("doc_id", "class_id", "copy_id", "n_links", "class_docs")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay: of each group the one with the smallest id, with all columns."""
    names = docs.columns
    stays = (near_groups(docs, id_col, text_col, **options).where("first")
             .select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                         F.col(id_col).cast("long").alias("_doc"), F.xxhash64(text_col).alias("_text"))
    joined = packed.join(stays, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_tie")))
    order = Window.partitionBy("_doc", "_text").orderBy(F.xxhash64(F.to_json("row")))
    return joined.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("row.*")


SQL_NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
sets AS (SELECT doc_id, md5(string_agg(gram, chr(10) ORDER BY gram)) AS s, count(*) AS n FROM g GROUP BY doc_id),
docs AS (SELECT w.doc_id, coalesce(s, '') AS s, coalesce(n, 0) AS n FROM w LEFT JOIN sets USING (doc_id)),
classes AS (SELECT s, min(doc_id) AS node, min(n) AS n, count(*) AS copies FROM docs GROUP BY s),
reps AS (SELECT g.doc_id AS node, g.gram, c.n FROM g JOIN classes c ON g.doc_id = c.node),
pairs AS (
  SELECT a.node AS u, b.node AS v FROM reps a JOIN reps b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.8),
reach AS (
  SELECT node, node AS root FROM classes
  UNION SELECT p.u, r.root FROM reach r JOIN pairs p ON p.v = r.node WHERE r.root < p.u),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
groups AS (SELECT root, sum(copies)::BIGINT AS class_docs FROM roots JOIN classes USING (node) GROUP BY root),
links AS (SELECT u AS node, count(*) AS n_links FROM pairs GROUP BY u)
SELECT d.doc_id, r.root AS class_id, c.node AS copy_id, coalesce(l.n_links, 0) AS n_links, g.class_docs
FROM docs d JOIN classes c USING (s) JOIN roots r ON r.node = c.node JOIN groups g ON g.root = r.root
LEFT JOIN links l ON l.node = c.node
"""
