"""Packing along a space-filling curve.

Every document's hashed bag of token ids is projected by a fixed random matrix
to three coordinates, whose Hilbert index is the sort key: documents of like
content lie near each other on the curve.  The curve is range-partitioned; each
task packs its stretch into sequences of ``seq_len`` tokens, cutting documents
where a sequence is full.  A stretch's rest is cut into sequences whose lengths
are powers of two, so there is no padding at all.

Defined results: null texts are empty (the end id alone); documents with one
key follow each other by id, without an id first, so a large group of copies
spreads over tasks; repeated rows are packed as often as they are there; texts of
any length are cut over as many sequences as they need; an empty table gives no
pieces; other columns never matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm.tokens import END_ID, TOKEN_SLICE, TokenEncoder, file_text, id_kind, vocab_size
from reelstats.llm.words import binary_column, slices, texts_of
from reelstats.session import materialize, parts_for

BINS, DIMS, BITS = 1024, 3, 20
TOKENS = "doc_id long, curve long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells (rows of coordinates in [0, 2**bits)), vectorised.

    Gray-code form: undo the excess rotations from the top bit down, take the
    Gray code over the axes, then interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, offsets: np.ndarray, seed: int = 7, block: int = 512) -> np.ndarray:
    """Hilbert key of each document's hashed, square-root weighted and normalised bag of ids."""
    project = np.random.default_rng(seed).standard_normal((BINS, DIMS)).astype(np.float32)
    bins = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64)
    keys = np.zeros(len(offsets) - 1, np.int64)
    for at in range(0, len(keys), block):
        end = min(at + block, len(keys))
        span = slice(offsets[at], offsets[end])
        row = np.repeat(np.arange(end - at), np.diff(offsets[at:end + 1]))
        bag = np.sqrt(np.bincount(row * BINS + bins[span], minlength=(end - at) * BINS)
                      .reshape(end - at, BINS).astype(np.float32))
        bag /= np.linalg.norm(bag, axis=1, keepdims=True)
        place = 1 / (1 + np.exp(-1.702 * (bag @ project)))  # near the normal distribution function
        keys[at:end] = hilbert_index((place * ((1 << BITS) - 1)).astype(np.int64), BITS)
    return keys


def encode_docs(tokenizer: str, end_id: int):
    def run(batches):
        encoder = TokenEncoder(tokenizer)
        kind = id_kind(encoder.vocab_size)
        for batch in slices(batches, max_bytes=TOKEN_SLICE):
            ids, offsets = encoder.encode(texts_of(batch), end_id)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(curve_keys(ids, offsets)),
                 binary_column(ids.astype(kind), offsets).cast(pa.binary())], names=["doc_id", "curve", "ids"])
    return run


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_part(seq_len: int, kind: str):
    """Cut a sorted stretch into sequences; rows of the unfinished sequence wait for its end."""
    def run(batches):
        part = TaskContext.get().partitionId()
        sequence, filled, open_pieces = 0, 0, []

        def close(rows, closed):
            for doc, start, ids, doc_tokens, offset in closed:
                rows.append((doc, start, len(ids), zlib.crc32(ids), doc_tokens, (part << 40) + sequence, offset))

        def emit(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            rows: list = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(raw.as_buffer(), kind).astype("<u4")
                at = 0
                while at < len(ids):
                    take = min(len(ids) - at, seq_len - filled)
                    open_pieces.append((doc, at, ids[at:at + take], len(ids), filled))
                    at, filled = at + take, filled + take
                    if filled == seq_len:
                        close(rows, open_pieces)
                        sequence, filled, open_pieces = sequence + 1, 0, []
            if rows:
                yield emit(rows)
        rows = []
        for size in powers_of_two(filled):
            room, taken = size, []
            while room:
                doc, start, ids, doc_tokens, _ = open_pieces.pop(0)
                if len(ids) > room:
                    open_pieces.insert(0, (doc, start + room, ids[room:], doc_tokens, 0))
                    ids = ids[:room]
                taken.append((doc, start, ids, doc_tokens, size - room))
                room -= len(ids)
            close(rows, taken)
            sequence += 1
        if rows:
            yield emit(rows)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         seq_len: int = 2048, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Pieces of documents: which ids of a document lie where in which sequence."""
    parts = parts or parts_for(docs)
    tokenizer = file_text(tokenizer)
    coded = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(encode_docs(tokenizer, end_id), TOKENS), "tokens")
    return (coded.repartitionByRange(parts, "curve", "doc_id").sortWithinPartitions("curve", "doc_id", "ids")
            .mapInArrow(pack_part(seq_len, id_kind(vocab_size(tokenizer))), PIECES))
