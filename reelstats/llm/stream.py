"""Helpers over sorted Arrow streams inside tasks; memory stays at a batch or one group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def boundaries(table: pa.Table, keys: list[str]) -> np.ndarray:
    """For each row after the first: does it differ from its predecessor in ``keys``?"""
    new = np.zeros(max(table.num_rows - 1, 0), bool)
    for key in keys:
        col = table.column(key).to_numpy()
        new |= col[1:] != col[:-1]
    return new


def sorted_groups(batches, keys: list[str]):
    """Cut a stream sorted by ``keys`` into tables of whole groups; starts[-1] is the table's end."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        starts = np.append(0, np.flatnonzero(boundaries(held, keys)) + 1)
        if len(starts) < 2:
            continue
        yield held.slice(0, int(starts[-1])), starts
        held = held.slice(int(starts[-1]))
    if held is not None and held.num_rows:
        starts = np.append(0, np.flatnonzero(boundaries(held, keys)) + 1)
        yield held, np.append(starts, held.num_rows)


def meeting_rows(keys: list[str], keep: list[str], always: str | None = None):
    """Task function on a stream sorted by ``keys``: rows whose keys a neighbouring row shares.

    Rows with a true (non-zero) value in the key column ``always`` pass in any case.
    Only one row is held over from batch to batch, so a key may have any number of rows.
    """
    def passing(table: pa.Table, meets: np.ndarray) -> pa.Array:
        return pa.array(meets if always is None else meets | (table.column(always).to_numpy() != 0))

    def run(batches):
        held, tied = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).select(list(dict.fromkeys([*keys, *keep])))
            if held is not None:
                table = pa.concat_tables([held, table])
            same = ~boundaries(table, keys)
            meets = np.append(tied, same)  # with the row before; the held row's own is known
            tied = bool(meets[-1])
            meets[:-1] |= same
            held = table.slice(table.num_rows - 1)
            done = table.slice(0, table.num_rows - 1)
            yield from done.filter(passing(done, meets[:-1])).select(keep).combine_chunks().to_batches()
        if held is not None:
            yield from held.filter(passing(held, np.array([tied]))).select(keep).combine_chunks().to_batches()
    return run
