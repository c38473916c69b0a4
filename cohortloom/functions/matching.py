"""Nearest-first matching of a stretch of sorted scores whose surroundings are known only by their nearest points."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import pyarrow as pa


def outsides(ends: list) -> dict[int, tuple]:
    """For each segment that has a point: the nearest control and treated score to its left, then to its right (None: none)."""
    found = {}
    for side, rows in (("most", ends), ("least", ends[::-1])):
        near = [None, None]
        for r in rows:
            found.setdefault(r["segment"], []).extend(near)
            for k in (0, 1):
                value = r[f"{side}{k}"]
                if value is not None:
                    near[k] = value
    return {segment: tuple(near) for segment, near in found.items()}


def gap(a: float, b: float) -> tuple[float, float]:
    """|a - b| as a rounded difference and what rounding lost, so that tuples compare as the exact distances do."""
    if a < b:
        a, b = b, a
    d = a - b
    back = d + b
    return d, (a - back) + (b - (back - d))


class Points:
    """Distinct scores of one arm, each with its ids in order; those used up are skipped in constant time."""

    def __init__(self, rows: list[tuple], most: int):
        self.scores, self.ids = [], []
        for s, i in rows:
            if not self.scores or self.scores[-1] != s:
                self.scores.append(s)
                self.ids.append([])
            # no more of one score can match than the other arm has
            if len(self.ids[-1]) < most:
                self.ids[-1].append(i)
        n = len(self.scores)
        self.used, self.frozen = [0] * n, [False] * n
        self.skip = {1: list(range(n + 1)), -1: list(range(n + 1))}

    def head(self, k: int):
        return self.ids[k][self.used[k]]

    def free(self, k: int) -> bool:
        return self.used[k] < len(self.ids[k])

    def next(self, k: int, step: int) -> int | None:
        """The first point from k on, going by step, that is not used up."""
        skip, path = self.skip[step], []
        while 0 <= k < len(self.scores):
            if skip[k] == k:
                if self.free(k):
                    break
                skip[k] = k + step
            path.append(k)
            k = skip[k]
        for p in path:
            skip[p] = k
        return k if 0 <= k < len(self.scores) else None


def match(treated: list[tuple], controls: list[tuple], outside: tuple, caliper: float, counts: dict[int, int]):
    """(matches, treated left, controls left) of sorted (score, id) lists.

    Pairs come nearest first from a heap. outside: nearest control and treated scores to the left, then to the
    right. A point that someone outside may be as near to as its next partner here is frozen, and so is every partner that a frozen point may
    take; frozen points are left. What is neither matched nor left has no partner anywhere.
    """
    arms = {1: Points(treated, counts[0]), 0: Points(controls, counts[1])}
    t, c = arms[1], arms[0]
    matches, heap = [], []

    def offer(i, k, step):
        """The pair of the treated point i and the first control point from k on by step."""
        k = c.next(k, step)
        if k is not None and t.free(i) and (d := gap(t.scores[i], c.scores[k]))[0] <= caliper:
            push((*d, 1, t.head(i), c.head(k), i, k, step))

    push = heap.append
    for arm, points in arms.items():
        left, right = outside[1 - arm], outside[3 - arm]
        for k, s in enumerate(points.scores):
            near = [gap(s, o) for o in (left, right) if o is not None]
            if near and min(near)[0] <= caliper:
                push((*min(near), 0, arm, k))
    for i, s in enumerate(t.scores):
        k = bisect_left(c.scores, s)
        offer(i, k, 1)
        offer(i, k - 1, -1)
    heapify(heap)
    push = lambda event: heappush(heap, event)

    while heap:
        event = heappop(heap)
        if event[2] == 0:
            _, _, _, arm, k = event
            arms[arm].frozen[k] = True
            continue
        _, _, _, a, b, i, k, step = event
        if not t.free(i):
            continue
        if not c.free(k):
            offer(i, k, step)
        elif (a, b) != (t.head(i), c.head(k)):
            offer(i, k, step)  # ids have gone since: its turn among ties may be another
        elif t.frozen[i] or c.frozen[k]:
            t.frozen[i] = c.frozen[k] = True
            offer(i, k + step, step)  # either may be gone, so the next one counts too
        else:
            matches.append((a, b, event[0]))
            t.used[i] += 1
            c.used[k] += 1
            offer(i, k, step)
    left = [[(p.scores[k], i) for k in range(len(p.scores)) if p.frozen[k] for i in p.ids[k][p.used[k] :]] for p in (t, c)]
    return matches, *left


def solver(outside: dict[int, tuple], caliper: float, counts: dict[int, int]) -> Callable[[pa.Table], pa.Table]:
    """For applyInArrow by segment (segment, id, s, arm): rows of matches, then rows of points left."""

    def solve(group: pa.Table) -> pa.Table:
        columns = {c: group.column(c).to_pylist() for c in ("id", "s", "arm")}
        rows = sorted(zip(columns["s"], columns["id"], columns["arm"]))
        given = {arm: [(s, i) for s, i, a in rows if a == arm] for arm in (1, 0)}
        matches, *left = match(given[1], given[0], outside[group.column("segment")[0].as_py()], caliper, counts)
        a, b, d = zip(*matches) if matches else ((), (), ())
        more = [(i, s, arm) for arm, points in ((1, left[0]), (0, left[1])) for s, i in points]
        i, s, arm = zip(*more) if more else ((), (), ())
        none, kind = [None] * len(matches), group.schema.field("id").type
        fill = [None] * len(more)
        return pa.table({
            "treated": pa.array([*a, *fill], kind), "control": pa.array([*b, *fill], kind), "distance": pa.array([*d, *fill], pa.float64()),
            "id": pa.array([*none, *i], kind), "s": pa.array([*none, *s], pa.float64()), "arm": pa.array([*none, *arm], pa.int32()),
        })

    return solve
