"""Greedy choice of days that lie far enough apart, in one pass over sorted rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it; nulls are alike."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(a, b), True)
    return pc.and_not(differ, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def chosen(group: np.ndarray, day: np.ndarray, apart: int, last: int | None) -> np.ndarray:
    """Of rows sorted by group (from 0) and day: those at least apart days after the last one chosen in their group.

    last: the day chosen last in group 0 before these rows. Each row points to the first one far enough behind it; what the
    first rows of groups reach is found by doubling the pointers.
    """
    n = len(day)
    place = group * (1 << 34) + day
    follow = np.searchsorted(place, place + apart)
    inside = follow < n
    inside[inside] = group[follow[inside]] == group[inside]
    follow = np.append(np.where(inside, follow, n), n)
    reached = np.zeros(n + 1, dtype=bool)
    reached[np.flatnonzero(np.diff(group, prepend=-1))] = True
    if last is not None:
        reached[0] = False
        begin = int(np.searchsorted(place, last + apart))
        if begin < n and group[begin] == 0:
            reached[begin] = True
    for _ in range(max(1, n).bit_length()):
        reached[follow[np.flatnonzero(reached)]] = True
        follow = follow[follow]
    return reached[:n]


def apart_by(by: list[str], date: str, apart: int):
    """For mapInArrow over rows sorted by the columns by and date, each (by, date) once: the rows chosen. Only the last day chosen is carried on."""

    def run(batches):
        key, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = np.zeros(batch.num_rows, dtype=bool)
            for c in by:
                changed[1:] |= _changes(batch.column(c))
            group = np.cumsum(changed)
            day = batch.column(date).cast(pa.int32()).to_numpy(zero_copy_only=False).astype(np.int64)
            first = tuple(batch.column(c)[0].as_py() for c in by)
            taken = chosen(group, day, apart, last if first == key else None)
            if first != key or group[-1] > 0:
                last = None
            some = day[taken & (group == group[-1])]
            key, last = tuple(batch.column(c)[-1].as_py() for c in by), int(some[-1]) if len(some) else last
            yield batch.filter(pa.array(taken))

    return run
