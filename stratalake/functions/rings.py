"""Joining directed edges of one feature into rings: the small per-feature step Spark SQL cannot say.

Edges carry the interior on their left.  Finding, splitting and selecting edges is done by Spark;
this helper only walks the edges of one feature inside a task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd


def _next_edge(candidates, back, edges):
    """Of the edges leaving a vertex, the first one clockwise from where the walk came from."""
    if len(candidates) == 1:
        return candidates[0]

    def turn(e):
        ax, ay, bx, by = edges[e]
        return (back - math.atan2(by - ay, bx - ax)) % (2 * math.pi) or 2 * math.pi
    return min(candidates, key=turn)


def _loops(walk):
    """Split a closed walk at repeated vertices, so that every loop visits a vertex once."""
    stack, seen, loops = [], {}, []
    for vertex, removable in walk:
        if vertex in seen:
            start = seen[vertex]
            loops.append(stack[start:])
            for v, _ in stack[start:]:
                del seen[v]
            del stack[start:]
        seen[vertex] = len(stack)
        stack.append((vertex, removable))
    loops.append(stack)
    return loops


def _straight(a, v, b):
    """Is v just a stop on the way from a to b?"""
    ux, uy, wx, wy = v[0] - a[0], v[1] - a[1], b[0] - v[0], b[1] - v[1]
    return (abs(ux * wy - uy * wx) <= 1e-9 * math.hypot(ux, uy) * math.hypot(wx, wy)
            and ux * wx + uy * wy > 0)


def _area(ring):
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1])) / 2


def _contains(ring, x, y):
    x1, y1, x2, y2 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    hit = (y1 > y) != (y2 > y)
    at = (x2[hit] - x1[hit]) * (y - y1[hit]) / (y2[hit] - y1[hit]) + x1[hit]
    return bool(np.count_nonzero(x < at) % 2)


def polygon_parts(ax, ay, bx, by, removable) -> list[list[np.ndarray]]:
    """Parts ``[shell, hole, ...]`` from directed edges.  ``removable`` marks edges whose start only
    exists because a straight edge was cut there."""
    edges = list(zip(ax, ay, bx, by))
    leaving = defaultdict(list)
    for e, (x, y, _, _) in enumerate(edges):
        leaving[(x, y)].append(e)
    free = set(range(len(edges)))
    shells, holes = [], []
    for first in range(len(edges)):
        if first not in free:
            continue
        walk, e = [], first
        while True:
            free.discard(e)
            x0, y0, x1, y1 = edges[e]
            walk.append(((x0, y0), bool(removable[e]) and len(leaving[(x0, y0)]) == 1))
            ways = [k for k in leaving[(x1, y1)] if k in free or k == first]
            if not ways:
                break
            e = _next_edge(ways, math.atan2(y0 - y1, x0 - x1), edges)
            if e == first:
                break
        for loop in _loops(walk):
            ring = [v for k, (v, cut) in enumerate(loop)
                    if not (cut and _straight(loop[k - 1][0], v, loop[(k + 1) % len(loop)][0]))]
            if len(ring) < 3:
                continue
            ring = np.array(ring + ring[:1], dtype=float)
            area = _area(ring)
            if area > 0:
                shells.append((area, ring))
            elif area < 0:
                holes.append(ring)
    parts = [[ring] for _, ring in shells]
    for hole in holes:
        x, y = (hole[0] + hole[1]) / 2
        owners = [(area, k) for k, (area, ring) in enumerate(shells) if _contains(ring, x, y)]
        if owners:
            parts[min(owners)[1]].append(hole)
    return parts


def stitch_batches(key: str):
    """``mapInPandas`` function: rows ``key, ax, ay, bx, by, cut`` (arrays) to ``key, xs, ys``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            xs, ys = [], []
            for row in zip(batch["ax"], batch["ay"], batch["bx"], batch["by"], batch["cut"]):
                parts = polygon_parts(*row)
                xs.append([[ring[:, 0].tolist() for ring in part] for part in parts])
                ys.append([[ring[:, 1].tolist() for ring in part] for part in parts])
            yield pd.DataFrame({key: batch[key].to_numpy(), "xs": xs, "ys": ys})
    return run
