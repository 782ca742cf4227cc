"""Groups of a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def complete_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that end where a group of equal whole-number ``keys`` ends, and the ``n + 1`` cuts between groups.

    The rows must be sorted by the keys. Only the last, unfinished group is carried on.
    """
    carried: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if carried is not None:
            table = pa.concat_tables([carried, table])
        cuts = _cuts(table, keys)
        last = int(cuts[-2])
        if last:
            yield table.slice(0, last), cuts[:-1]
        carried = table.slice(last)
    if carried is not None:
        yield carried, np.array([0, carried.num_rows])


def _cuts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows - 1, dtype=bool)
    for key in keys:
        column = table.column(key).to_numpy()
        changed |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [table.num_rows]])
