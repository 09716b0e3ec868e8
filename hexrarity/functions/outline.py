"""Outlines of sets of polygons that share edges: a column of boundary edges becomes
rings. The module travels with the UDF; executors need pyarrow only."""

from __future__ import annotations

import math
import sys
from collections import defaultdict

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RINGS = "array<array<struct<x:long,y:long>>>"


def rings_of(edges: list[tuple[int, int, int, int]]) -> list[list[tuple[int, int]]]:
    """Closed rings of directed edges (x, y, to x, to y) of which as many leave a point as
    reach it. Where several leave, a ring takes the sharpest turn to the side of the
    area, so that parts that touch in a point become rings of their own. Rings begin with
    their smallest point; smaller ones come first."""
    leaving = defaultdict(list)
    twice_area = 0
    for x, y, to_x, to_y in sorted(edges):
        leaving[x, y].append((to_x, to_y))
        twice_area += x * to_y - to_x * y
    side = 1 if twice_area >= 0 else -1

    def turn(before, at, after):
        ax, ay = at[0] - before[0], at[1] - before[1]
        bx, by = after[0] - at[0], after[1] - at[1]
        return side * math.atan2(ax * by - ay * bx, ax * bx + ay * by)

    rings = []
    while leaving:
        start = min(leaving)
        path, seen = [start], {start: 0}
        while leaving.get(path[-1]):
            at, ways = path[-1], leaving[path[-1]]
            way = 0
            if len(ways) > 1 and len(path) > 1:
                way = max(range(len(ways)), key=lambda k: turn(path[-2], at, ways[k]))
            after = ways.pop(way)
            if not ways:
                del leaving[at]
            path.append(after)
            if after in seen:  # a ring is closed; what led to it goes on
                first = seen[after]
                ring = path[first:-1]
                for point in ring[1:]:
                    del seen[point]
                low = ring.index(min(ring))
                rings.append([*ring[low:], *ring[: low + 1]])
                del path[first + 1 :]
            else:
                seen[after] = len(path) - 1
    return sorted(rings)


_POINTS = pa.list_(pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64())])))


def outline(edges: Column) -> Column:
    """``array<struct<ax,ay,bx,by>>`` of longs to rings of points (``x``, ``y``)."""
    def rings(edges: pa.Array) -> pa.Array:
        found = (
            rings_of([(e["ax"], e["ay"], e["bx"], e["by"]) for e in own or ()])
            for own in edges.to_pylist()
        )
        return pa.array(
            [[[{"x": x, "y": y} for x, y in ring] for ring in own] for own in found], _POINTS)

    return F.arrow_udf(rings, returnType=RINGS)(edges)
