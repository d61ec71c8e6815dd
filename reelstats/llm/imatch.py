"""I-Match fingerprints over randomised lexicon subsets.

Terms are words in lower case without marks at their ends.  The lexicon holds
the terms inside a band of inverse document frequency, counted over all
documents: neither on more than ``most`` of the documents nor on less than
``least`` of them.  A fingerprint hashes, for each of ``SUBSETS`` random subsets
of the lexicon, the document's sorted distinct terms in that subset.

A subset that leaves a document about one term changes only when that very term
does, one that leaves many changes with any of them.  Subsets are therefore
nested: subset i at level j holds a lexicon term with chance 2**-j, and a
document with n lexicon terms is hashed at levels floor(log2 n) and one above,
which it names.  The likeness of two fingerprints is the share of equal hashes
at their common levels among the subsets that leave either a term.

The lexicon has at most (mean distinct terms per document) / ``least`` terms,
whatever the number of documents, and is what tasks receive.

Defined results: null is empty text; texts without lexicon terms are hashed by
all their terms, texts without terms share one fingerprint; equal texts have
equal fingerprints and likeness 1; the order is by id, documents without an id
below all others, rows of one id by a hash of their texts; a single document is
its own neighbour; documents without an id form the lowest range, which one task
reads in slices; texts of any length are read whole; an empty table gives no rows;
other columns never matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm.words import Words, mix, slices, texts_of
from reelstats.session import materialize, parts_for

LEAST, MOST = 1e-3, 0.1
SUBSETS, HEX = 32, 6
COUNTS = "term long, df long, docs long"
PACKED = "bucket int, after boolean, doc_id long, tie long, raw binary"
PRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
EDGE_MARKS = r"^[^\pL\pN]+|[^\pL\pN]+$"


def term_hashes(vocab: pa.Array) -> np.ndarray:
    """Hash of the term of every word; 0 for words without letters or digits."""
    terms = pc.replace_substring_regex(pc.utf8_lower(vocab), EDGE_MARKS, "")
    if not len(terms):
        return np.zeros(0, np.uint64)
    values = terms.to_numpy(zero_copy_only=False)
    h = pd.util.hash_array(values, hash_key="reel-stats-terms", categorize=False)
    return np.where(values == "", np.uint64(0), h | np.uint64(1))


def doc_terms(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct term hashes of every text."""
    words = Words(texts)
    h = term_hashes(words.vocab)[words.codes]
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        terms = np.unique(h[a:b])
        out.append(terms[1:] if len(terms) and terms[0] == 0 else terms)
    return out


def count_terms(batches, limit: int = 1 << 21):
    """Document frequencies of a task's documents, merged in a table of bounded size."""
    def merged(parts):
        terms, inverse = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
        return terms, np.bincount(inverse, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def rows(terms, df, docs):
        return pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(df), pa.array(np.zeros(len(terms), np.int64) + docs)],
            names=["term", "df", "docs"])

    held, docs = [], 0
    for batch in slices(batches):
        docs += batch.num_rows
        terms, n = np.unique(np.concatenate(doc_terms(texts_of(batch))), return_counts=True)
        held.append((terms, n))
        if len(held) > 1:
            held = [merged(held)]
        if len(held[0][0]) > limit:
            yield rows(*held[0], 0)
            held = []
    if held and len(held[0][0]):
        yield rows(*held[0], 0)
    if docs:  # term 0: the number of documents
        yield rows(np.zeros(1, np.uint64), np.zeros(1, np.int64), docs)


def lexicon(docs: DataFrame, text_col: str = "text", least: float = LEAST, most: float = MOST) -> np.ndarray:
    """Sorted term hashes inside the band, counted over all documents."""
    counts = materialize(
        docs.select(F.col(text_col).alias("text")).mapInArrow(count_terms, COUNTS)
        .groupBy("term").agg(F.sum("df").alias("df"), F.sum("docs").alias("docs")), "term-counts")
    n = counts.where("term = 0").agg(F.sum("docs")).first()[0] or 0
    # at most (mean distinct terms of a document) / least rows
    band = counts.where((F.col("term") != 0) & (F.col("df") >= least * n) & (F.col("df") <= max(most * n, 1)))
    terms = band.select("term").toPandas()["term"].to_numpy(np.int64)
    return np.sort(terms.view(np.uint64))


def subset_hashes(terms: np.ndarray, seeds: np.ndarray, levels: list[int]) -> list[str]:
    """Per level and subset the hash of the sorted distinct terms in it, '' when it has none."""
    mixed = mix(terms[None, :] ^ seeds[:, None])
    out = []
    for level in levels:
        chosen = mixed >> np.uint64(64 - level) == 0 if level else np.ones(mixed.shape, bool)
        for i in np.arange(len(seeds)):
            part = terms[chosen[i]]
            out.append(hashlib.blake2b(part.tobytes(), digest_size=HEX // 2).hexdigest() if len(part) else "")
    return out


class Printer:
    """Fingerprints of texts for a given lexicon."""

    def __init__(self, lex: np.ndarray, subsets: int = SUBSETS):
        self.lex = lex
        self.seeds = np.random.default_rng(99).integers(0, 1 << 63, subsets, dtype=np.uint64)

    def prints(self, texts: list[str]) -> list[str]:
        return [self.one(t) for t in doc_terms(pa.array(texts, pa.string()))]

    def one(self, terms: np.ndarray) -> str:
        if len(self.lex):
            at = np.minimum(np.searchsorted(self.lex, terms), len(self.lex) - 1)
            inside = terms[self.lex[at] == terms]
        else:
            inside = terms[:0]
        if not len(inside):
            inside = terms
        if not len(inside):
            return "-"
        level = int(len(inside)).bit_length() - 1
        return f"{level}:" + ",".join(subset_hashes(inside, self.seeds, [level, level + 1]))


def likeness(a: str, b: str) -> float:
    """Share of equal subset hashes at the common levels, among those that are not empty in both."""
    if a == b:
        return 1.0
    if "-" in (a, b):
        return 0.0
    (la, ha), (lb, hb) = ((int(x.split(":")[0]), x.split(":")[1].split(",")) for x in (a, b))
    if abs(la - lb) > 1:
        return 0.0
    n = len(ha) // 2
    if la < lb:
        ha, hb = ha[n:], hb[:n]
    elif la > lb:
        ha, hb = ha[:n], hb[n:]
    some = [(x, y) for x, y in zip(ha, hb) if x or y]
    return sum(x == y for x, y in some) / len(some) if some else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def packed_texts(level: int = 3):
    """Compress each text: whole texts travel to their neighbours."""
    def run(batches):
        codec = pa.Codec("zstd", compression_level=level)
        for batch in slices(batches):
            raw = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True)
                   for t in (t.encode() for t in texts_of(batch).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), batch.column("after"), batch.column("doc_id"), batch.column("tie"),
                 pa.array(raw, pa.binary())], names=["bucket", "after", "doc_id", "tie", "raw"])
    return run


def neighbours(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Documents dealt to ranges of ids, each range followed by the document after its last one.

    The ranges come from quantiles of the ids; the largest document of each range
    (one row per range) is also given to the next higher range, and that of the
    highest to the lowest, so that every document finds its successor in
    descending order in its own range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"),
                       F.col(text_col).alias("text"))
    share = [i / parts for i in range(1, parts)]
    cuts = sorted(set(rows.where("doc_id is not null").approxQuantile("doc_id", share, 0.2 / parts))) if share else []
    # a binary search in the ranges, missing ids below all others; equal ids share a range
    ranges = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="place", outputCol="range")
    rows = rows.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf)))
    rows = ((ranges.transform(rows) if cuts else rows.withColumn("range", F.lit(0.0)))
            .withColumn("bucket", F.col("range").cast("int")).drop("place", "range"))
    # one row per range: bounded by the number of ranges
    tops = rows.groupBy("bucket").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "tie"))
                                      .alias("top")).orderBy("bucket").collect()
    if not tops:
        return rows.withColumn("after", F.lit(False))
    moved = [(t.top.doc_id, t.top.tie, tops[(i + 1) % len(tops)].bucket) for i, t in enumerate(tops)]
    copies = docs.sparkSession.createDataFrame(moved, "_id long, _tie long, target int")
    after = (rows.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")))
             .select("doc_id", "tie", "text", F.col("target").alias("bucket"), F.lit(True).alias("after")))
    return rows.withColumn("after", F.lit(False)).unionByName(after)


def print_pairs(lex: np.ndarray):
    """Fingerprint each document of a sorted range, its edited text, and its successor."""
    def run(batches):
        printer = Printer(lex)

        def emit(held):
            """Rows of (bucket, after, id, text) with their successors at the next place."""
            texts = [h[3] for h in held]
            use = [i for i in range(len(held) - 1) if not held[i][1]]
            # a range ends with its successor; only a whole pair of one range is a result
            new = [edited(texts[i], texts[i + 1]) for i in use]
            prints = printer.prints(texts + new)
            rows = []
            for text_new, i, p_new in zip(new, use, prints[len(texts):]):
                rows.append((held[i][2], len(texts[i]), hashlib.sha256(text_new.encode()).hexdigest(), prints[i], p_new,
                             likeness(prints[i], p_new), likeness(prints[i], prints[i + 1])))
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                       "near_next"])

        codec, held, size = pa.Codec("zstd"), [], 0
        for batch in batches:
            for bucket, after, doc, raw in zip(*(batch.column(c).to_pylist()
                                                 for c in ("bucket", "after", "doc_id", "raw"))):
                n = int.from_bytes(raw[:8], "little")
                text = codec.decompress(raw[8:], n, asbytes=True).decode() if n else ""
                if held and held[-1][1] and held[-1][0] == bucket:
                    continue  # a repeated row of the successor
                held.append((bucket, after, doc, text))
                size += n
                if size > 4 << 20:
                    yield emit(held)
                    held, size = held[-1:], 0
        if len(held) > 1:
            yield emit(held)
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
                 most: float = MOST, parts: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and the likenesses to it and to the next document."""
    parts = parts or parts_for(docs)
    lex = lexicon(docs, text_col, least, most)
    ranged = neighbours(docs, id_col, text_col, parts).select("bucket", "after", "doc_id", "tie", "text")
    return (ranged.mapInArrow(packed_texts(), PACKED).repartitionById(parts, F.col("bucket"))
            .sortWithinPartitions("bucket", "after", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
            .mapInArrow(print_pairs(lex), PRINTS))
