"""Word splitting and hashing over Arrow batches, shared by the text operators.

Words are maximal runs of anything but ASCII white space, whole texts, null
texts counting as empty.  All helpers work on bounded slices of a batch, so a
task's memory does not depend on how Spark cut the batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
# Odd 64-bit multiplier of the rolling polynomial and its inverse modulo 2**64.
MULT = 0x9E3779B97F4A7C15
INV = pow(MULT, -1, 1 << 64)
HASH_KEYS = ("reel-stats-words", "second-word-hash")


def texts_of(batch: pa.RecordBatch, col: str = "text") -> pa.Array:
    """The text column as strings, null as empty."""
    return pc.fill_null(batch.column(col).cast(pa.string()), "")


def slices(batches, col: str = "text", max_bytes: int = SLICE_BYTES):
    """Cut batches so that each slice holds about ``max_bytes`` of text, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.cumsum(pc.binary_length(texts_of(batch, col)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + max_bytes, side="right")))
            yield batch.slice(at, end - at)
            at = end


class Words:
    """Words of a slice: ``codes`` into ``vocab``; row r holds codes[offsets[r]:offsets[r+1]]."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        vocab = coded.dictionary
        empty = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
        offsets = offsets - offsets[0]
        if empty >= 0:  # white space at the ends of a text leaves empty strings
            keep = codes != empty
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            codes = codes[keep]
        self.codes, self.offsets, self.vocab = codes, offsets, vocab

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self, which: int = 0) -> np.ndarray:
        """64-bit hash of every word in sequence."""
        if len(self.vocab) == 0:
            return np.zeros(0, np.uint64)
        values = self.vocab.to_numpy(zero_copy_only=False)
        return pd.util.hash_array(values, hash_key=HASH_KEYS[which], categorize=False)[self.codes]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values of ``h`` (short k: direct polynomial)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out *= np.uint64(MULT)
            out += h[j:j + n]
    return mix(out)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def prefix_sums(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of h[i] * MULT**i and the powers of the inverse, for window_hash."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(len(h), MULT), dtype=np.uint64)])
    return sums, powers(len(h) + 1, INV)


def window_hash(sums: np.ndarray, inv: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values that start at each position of ``at``."""
    with np.errstate(over="ignore"):
        return mix((sums[at + k] - sums[at]) * inv[at])


def binary_column(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes: row r is flat[offsets[r]:offsets[r+1]] (any fixed-width dtype)."""
    width = flat.dtype.itemsize
    ends = pa.array((offsets * width).astype(np.int64), pa.int64())
    data = pa.py_buffer(np.ascontiguousarray(flat).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, ends.buffers()[1], data])
