"""The best neighbours of every item from the lists that its task was sent, summed in numpy.

A task reads the rows (item, rating, weight, mean and the same of every entry of a list)
of its items, sorted by item, sums the co-ratings of a few items at a time and keeps
the ``k`` best similarities of each.  What it holds is bounded by a batch and one item's
neighbours, however long the lists.

Null ratings (and NaN) add nothing to a pair, as in the SQL sums: the other one is
the smaller, and a pair without any has no similarity and comes last.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ByteType, DoubleType, IntegerType, LongType, ShortType

# the functions that run in tasks travel by value, executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT_ONCE = 1 << 20  # list entries that are summed at a time


#: Whole numbers of Spark and their names in Arrow.
WHOLE = {ByteType: "int8", ShortType: "int16", IntegerType: "int32", LongType: "int64"}


def whole(df: DataFrame, col: str) -> str | None:
    """Arrow's name of the column's type if it holds whole numbers."""
    return WHOLE.get(type(df.schema[col].dataType))


def summable(train: DataFrame, item_col: str, rating_col: str) -> bool:
    """Whether items are whole numbers and ratings doubles; others are summed by Spark."""
    return whole(train, item_col) is not None and isinstance(train.schema[rating_col].dataType, DoubleType)


def numbers(column: pa.Array, kind) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(kind, copy=False)


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(item, item's mean, other, sum, other's mean) of every list entry of a batch but the item itself."""
    lists = batch.column("l_i")
    row = np.repeat(np.arange(batch.num_rows), np.diff(numbers(lists.offsets, np.int64)))
    flat = {c: numbers(batch.column(f"l_{c}").flatten(), t) for c, t in
            (("i", np.int64), ("r", np.float64), ("w", np.float64), ("mean", np.float64))}
    item = numbers(batch.column("m_i"), np.int64)[row]
    least = np.fmin(numbers(batch.column("m_r"), np.float64)[row], flat["r"])
    sums = least * (numbers(batch.column("m_w"), np.float64)[row] * flat["w"])
    met = flat["i"] != item
    return item[met], numbers(batch.column("m_mean"), np.float64)[row][met], flat["i"][met], sums[met], flat["mean"][met]


def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """``entries`` with one row for every pair, sorted by item and other."""
    item, mean, other, sums, other_mean = (np.concatenate(x) for x in zip(*parts))
    if not len(item):
        return item, mean, other, sums, other_mean
    place = np.concatenate([[0], np.cumsum(item[1:] != item[:-1])])  # rows come sorted by item
    low, high = int(other.min()), int(other.max())
    if (int(place[-1]) + 1) * (high - low + 1) < 1 << 62:
        key = place * (high - low + 1) + (other - low)
    else:
        names, found = np.unique(other, return_inverse=True)
        key = place * len(names) + found
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sums, first = sums[order], order[starts]
    unknown = np.isnan(sums)
    if unknown.any():
        total = np.add.reduceat(np.where(unknown, 0.0, sums), starts)
        total[np.logical_and.reduceat(unknown, starts)] = np.nan
    else:
        total = np.add.reduceat(sums, starts)
    return item[first], mean[first], other[first], total, other_mean[first]


def best(pairs: tuple[np.ndarray, ...], k: int, ansi: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, other, similarity) of the ``k`` best of every item, by falling similarity, then other."""
    item, mean, other, total, other_mean = pairs
    means = mean + other_mean
    if ansi and (means == 0).any():
        raise ZeroDivisionError("the means of two co-rated items add up to zero")
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = np.where(means == 0, np.nan, total / means)
    by = np.where(np.isnan(sim), -np.inf, sim)
    edges = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]])) if len(item) else [0]
    keep = np.ones(len(item), bool)
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a > k:  # ties with the k-th stay until they are sorted
            keep[a:b] = by[a:b] >= np.partition(by[a:b], b - a - k)[b - a - k]
    item, other, sim, by = item[keep], other[keep], sim[keep], by[keep]
    order = np.lexsort((other, -by, item))
    item, other, sim = item[order], other[order], sim[order]
    inside = np.arange(len(item)) - np.searchsorted(item, item) < k
    return item[inside], other[inside], sim[inside]


def nearest_lists_of(k: int, ansi: bool):
    """Task function: rows (m_i, m_r, m_w, m_mean, l_i, l_r, l_w, l_mean) sorted by m_i -> (seed, names, sims)."""
    def lists(pairs, kind) -> pa.RecordBatch:
        item, other, sim = best(pairs, k, ansi)
        starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.empty(0, np.int64)
        ends = pa.array(np.concatenate([starts, [len(item)]]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(item[starts]).cast(kind), pa.ListArray.from_arrays(ends, pa.array(other).cast(kind)),
             pa.ListArray.from_arrays(ends, pa.array(sim, mask=np.isnan(sim)))], names=["seed", "names", "sims"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, kind = [], 0, None
        for batch in batches:
            kind = batch.column("m_i").type
            parts.append(entries(batch))
            held += len(parts[-1][0])
            if held >= AT_ONCE:
                pairs = summed(parts)
                last = np.searchsorted(pairs[0], pairs[0][-1])  # the last item may go on in the next batch
                if last:
                    yield lists([x[:last] for x in pairs], kind)
                parts, held = [tuple(x[last:] for x in pairs)], 0
        if kind is not None:
            yield lists(summed(parts), kind)
    return run


def user_blocks(cell: list[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(user, candidate, rows, seeds, best) of a cell's users and neighbours, some users at a time.

    A row of the cell holds a seed's raters (us, ws) and its neighbours (names, sims).
    """
    def flat(name, kind):
        return np.concatenate([numbers(b.column(name).flatten(), kind) for b in cell])

    def lengths(name):
        return np.concatenate([np.diff(numbers(b.column(name).offsets, np.int64)) for b in cell])

    users, weights, names, sims = flat("us", np.int64), flat("ws", np.int64), flat("names", np.int64), flat("sims", np.float64)
    raters, near = lengths("us"), lengths("names")
    seed = np.repeat(np.arange(len(raters)), raters)
    order = np.argsort(users, kind="stable")
    users, weights, seed = users[order], weights[order], seed[order]
    starts, counts = (np.cumsum(near) - near)[seed], near[seed]
    edges = np.flatnonzero(np.concatenate([[True], users[1:] != users[:-1]])) if len(users) else np.empty(0, np.int64)
    ends, made = np.concatenate([edges[1:], [len(users)]]), np.concatenate([[0], np.cumsum(counts)])
    at = 0
    while at < len(edges):
        # whole users, as many as make about AT_ONCE rows
        upto = max(at + 1, int(np.searchsorted(made[ends], made[edges[at]] + AT_ONCE, side="right")))
        a, b = edges[at], ends[upto - 1]
        at = upto
        size = counts[a:b]
        row = np.repeat(np.arange(a, b), size)
        if not len(row):
            continue
        entry = starts[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        _, user = np.unique(users[a:b], return_inverse=True)
        known, name = np.unique(names[entry], return_inverse=True)
        key = user[row - a] * len(known) + name
        by = np.argsort(key, kind="stable")
        key, row, entry = key[by], row[by], entry[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield (users[row[first]], names[entry[first]], np.add.reduceat(weights[row], first),
               np.diff(np.concatenate([first, [len(key)]])), np.fmax.reduceat(sims[entry], first))


def totals_of(user_kind: str, item_kind: str, columns: list[str]):
    """Task function: rows (p, q, us, ws, names, sims) sorted by cell (p, q) -> the totals of its candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def totals(cell):
            for user, item, rows, seeds, sim in user_blocks(cell):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(user).cast(user_kind), pa.array(item).cast(item_kind), pa.array(rows), pa.array(seeds),
                     pa.array(sim, mask=np.isnan(sim))], names=[*columns, "n_rows", "n_seeds", "best_sim"])

        cell, last = [], None
        for batch in batches:
            p, q = numbers(batch.column("p"), np.int64), numbers(batch.column("q"), np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1]), [True]]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if cell and (p[a], q[a]) != last:
                    yield from totals(cell)
                    cell = []
                last = (p[a], q[a])
                cell.append(batch.slice(a, b - a))
        if cell:
            yield from totals(cell)
    return run
