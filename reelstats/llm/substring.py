"""Substring dedup with difference-cover anchors.

A window is ``window`` consecutive words of one document; a word goes when it
lies in a window whose word sequence starts anywhere else as well.  Only the
windows of ``anchor`` words that start at cover positions modulo a period are
hashed.  The cover's differences hit every residue, so two equal windows,
wherever they start, contain an aligned pair of equal anchors: no match is lost.

1. Anchors meet by hash.  A task first compares its own anchors and sends one row
   for each distinct one, so a passage of a third of all documents costs a row per
   slice, not one per document.
2. A window can only repeat when one of its anchors meets another; the windows that
   extend such anchors are hashed whole (128 bits) and meet the same way, which
   settles them.
3. Each document drops the words that its repeated windows cover.

All meeting is a sort by hash with one row of look-behind: no pairs, no limit on
occurrences.

Defined results: null and empty texts have no words; repeated rows repeat each
other's windows; rows of one id are told apart by their texts; documents without
an id take part; texts of any length are read whole; an empty table gives no rows;
other columns never matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm.stream import meeting_rows
from reelstats.llm.words import Words, mix, prefix_sums, slices, texts_of, window_hash
from reelstats.session import materialize, parts_for

WINDOW = 35
# Perfect difference set: every residue modulo 21 is a difference of two members.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)

# rows that meet: 64 or 128 bits of key; alone 0 for a row to be compared, 1 for n starts known to repeat
MEET = "k1 long, k2 long, alone int, doc_id long, tie long, at int, n int"
STARTS = "doc_id long, tie long, at int, n int"
JOINED = "doc_id long, tie long, text string, n_words long, digest string, at array<int>"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def is_difference_cover(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, a hash of the text that tells rows of one id apart, and the text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"),
                       F.col(text_col).alias("text"))


class Slice:
    """Hashes of the windows of a slice of documents."""

    def __init__(self, texts: pa.Array):
        self.words = Words(texts)
        self.sums = [prefix_sums(self.words.hashes(which)) for which in (0, 1)]

    def hash(self, at: np.ndarray, k: int, which: int = 0) -> np.ndarray:
        return window_hash(*self.sums[which], at, k).view(np.int64)


def cover_positions(counts: np.ndarray, offsets: np.ndarray, period: int, cover, anchor: int, least: int):
    """Document and place of every anchor of the documents with at least ``least`` words."""
    n = np.where(counts >= least, counts - anchor + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    member = np.zeros(period, bool)
    member[list(cover)] = True
    keep = member[place % period]
    return doc[keep], place[keep]


def meet_batch(batch, k1, k2, doc, place) -> pa.RecordBatch:
    """One row per distinct key of a slice; places of keys met twice in it are known to repeat, in runs."""
    order = np.lexsort((k2, k1))
    first = np.ones(len(order), bool)
    first[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
    again = np.zeros(len(order), bool)
    twice = ~first
    again[order[twice]] = True
    again[order[np.append(twice[1:], False)]] = True
    probe = np.sort(order[first])
    known = np.flatnonzero(again)
    # known places of a document that follow each other are one row
    run = np.ones(len(known), bool)
    run[1:] = (doc[known][1:] != doc[known][:-1]) | (place[known][1:] != place[known][:-1] + 1)
    start = known[run]
    length = np.diff(np.append(np.flatnonzero(run), len(known)))
    rows = np.concatenate([probe, start])
    alone = np.repeat([0, 1], [len(probe), len(start)])
    spread = mix(k1[start].view(np.uint64) ^ doc[start].astype(np.uint64)).view(np.int64)
    n = np.concatenate([np.ones(len(probe), np.int64), length])
    ids, ties = batch.column("doc_id"), batch.column("tie")
    who = pa.array(doc[rows])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([k1[probe], spread])), pa.array(np.concatenate([k2[probe], spread])),
         pa.array(alone.astype(np.int32)), ids.take(who), ties.take(who),
         pa.array(place[rows].astype(np.int32)), pa.array(n.astype(np.int32))],
        names=["k1", "k2", "alone", "doc_id", "tie", "at", "n"])


def anchor_rows(window: int, period: int, cover):
    anchor = window - period + 1

    def run(batches):
        for batch in slices(batches):
            s = Slice(texts_of(batch))
            doc, place = cover_positions(s.words.counts, s.words.offsets, period, cover, anchor, window)
            if len(doc):
                key = s.hash(s.words.offsets[doc] + place, anchor)
                yield meet_batch(batch, key, np.zeros_like(key), doc, place)
    return run


def repeated(rows: DataFrame, parts: int) -> DataFrame:
    """Starts that occur more than once: met in the sort, or known before."""
    return (rows.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "alone")
            .mapInArrow(meeting_rows(["k1", "k2", "alone"], ["doc_id", "tie", "at", "n"], always="alone"), STARTS))


def words_kept(text: str, drop: np.ndarray | None) -> tuple[int, int, bytes]:
    words = (text or "").encode().split()  # bytes.split cuts at ASCII white space
    kept = words if drop is None else [w for w, d in zip(words, drop) if not d]
    return len(words), len(words) - len(kept), b" ".join(kept)


def covered(at: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places the stretches that start at ``at`` cover."""
    mark = np.zeros(size + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + length, -1)
    return np.cumsum(mark)[:size] > 0


def candidates(window: int, period: int):
    """Documents whose anchors allow a repeated window keep their text and the starts; others are settled."""
    def starts_of(at: np.ndarray, run: np.ndarray, n_words: int) -> np.ndarray:
        n = n_words - window + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        sums = np.concatenate([[0], np.cumsum(covered(at, run, n_words))])
        # a window's anchors start at its first ``period`` words; one met at least
        return np.flatnonzero(sums[period:period + n] > sums[:n])

    def run(batches):
        for batch in slices(batches):
            rows = []
            for doc, tie, text, at, n in zip(*(batch.column(c).to_pylist()
                                               for c in ("doc_id", "tie", "text", "at", "n"))):
                n_words, _, kept = words_kept(text, None)
                starts = starts_of(np.array(at), np.array(n), n_words) if at else np.zeros(0, np.int64)
                if len(starts):
                    rows.append((doc, tie, text, n_words, None, starts.tolist()))
                else:
                    rows.append((doc, tie, None, n_words, hashlib.sha256(kept).hexdigest(), None))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.list_(pa.int32()))],
                names=["doc_id", "tie", "text", "n_words", "digest", "at"])
    return run


def window_rows(window: int):
    def run(batches):
        for batch in slices(batches, max_bytes=4 << 20):
            s = Slice(texts_of(batch))
            lists = batch.column("at")
            place = lists.flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = s.words.offsets[doc] + place
            yield meet_batch(batch, s.hash(at, window), s.hash(at, window, 1), doc, place)
    return run


def remove_words(window: int, with_text: bool):
    """Drop the words that the repeated windows (starts ``at`` with runs ``n``) cover."""
    def run(batches):
        for batch in slices(batches):
            rows = []
            for doc, text, at, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "at", "n"))):
                drop = None
                if at:
                    drop = covered(np.array(at), np.array(n) - 1 + window, len(text.encode().split()))
                n_words, n_removed, kept = words_kept(text, drop)
                rows.append((doc, n_words, n_removed, hashlib.sha256(kept).hexdigest(),
                             kept.decode() if with_text else None))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def per_document(starts: DataFrame) -> DataFrame:
    """The starts of each document, each once however often the row is repeated: lists no longer than its words."""
    runs = starts.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("at", "n")).alias("runs"))
    return runs.select("doc_id", "tie", F.col("runs.at").alias("at"), F.col("runs.n").alias("n"))


def on_document(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the id (missing ids match) and the text's hash."""
    other = right.withColumnsRenamed({"doc_id": "_id", "tie": "_tie"})
    return (left.join(other, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
            .drop("_id", "_tie"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    period: int = PERIOD, cover: tuple[int, ...] = COVER, with_text: bool = True) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256, and the kept words joined by spaces."""
    if not is_difference_cover(period, cover) or window < period:
        raise ValueError("the cover must hit every difference and the window hold a whole period")
    parts = parts_for(docs, 2.0)
    texts = keyed(docs, id_col, text_col)
    # every step is written, which frees the shuffle files of the one before
    anchors = materialize(per_document(repeated(
        texts.mapInArrow(anchor_rows(window, period, cover), MEET), parts)), "repeated-anchors")
    joined = materialize(on_document(texts, anchors).select("doc_id", "tie", "text", "at", "n")
                         .mapInArrow(candidates(window, period), JOINED), "candidates")
    open_docs = joined.where("text is not null")
    starts = materialize(per_document(repeated(
        open_docs.select("doc_id", "tie", "text", "at").mapInArrow(window_rows(window), MEET), parts)),
        "repeated-windows")
    changed = (on_document(open_docs.select("doc_id", "tie", "text"), starts)
               .mapInArrow(remove_words(window, with_text), RESULT))
    if with_text:
        # settled documents lose nothing: their words come from the table again
        settled = on_document(texts, joined.where("text is null").select("doc_id", "tie", "digest").distinct())
        settled = (settled.where("digest is not null")
                   .select("doc_id", "text", F.lit(None).cast("array<int>").alias("at"),
                           F.lit(None).cast("array<int>").alias("n"))
                   .mapInArrow(remove_words(window, True), RESULT))
        return changed.unionByName(settled)
    settled = joined.where("text is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"))
    return changed.drop("kept").unionByName(settled)


SQL_SUBSTRING = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT rid, i + o AS p FROM (SELECT rid, i, unnest(range(0, 35)) AS o FROM win JOIN again USING (h))),
word AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM word ANTI JOIN covered USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)
"""
