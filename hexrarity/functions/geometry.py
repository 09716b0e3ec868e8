"""Ring functions on ``array<struct<lng,lat>>`` columns, all built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(lng: Column, lat: Column) -> Column:
    return F.struct(
        lng.cast("double").alias("lng"), lat.cast("double").alias("lat")
    )


def unwrap_dateline(ring: Column) -> Column:
    """Shift longitudes by one turn wherever a step from the previous, already
    shifted, vertex is longer than half a turn."""
    def step(done: Column, p: Column) -> Column:
        jump = p["lng"] - F.element_at(done, -1)["lng"]
        shift = F.when(jump > 180, -360.0).when(jump < -180, 360.0).otherwise(0.0)
        return F.concat(done, F.array(point(p["lng"] + shift, p["lat"])))

    first = F.transform(F.slice(ring, 1, 1), lambda p: point(p["lng"], p["lat"]))
    return F.aggregate(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), first, step)


def close_ring(ring: Column) -> Column:
    return F.concat(ring, F.slice(ring, 1, 1))


def closed_ring(ring: Column) -> Column:
    """The ring, closed if it is not."""
    return F.when(F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1), ring).otherwise(close_ring(ring))


def ring_coordinates(ring: Column) -> Column:
    """Ring as GeoJSON positions ``[[lng, lat], ...]``."""
    return F.transform(ring, lambda p: F.array(p["lng"], p["lat"]))


def ring_bbox(ring: Column) -> dict[str, Column]:
    """South, west, north, east of a ring."""
    lats = F.transform(ring, lambda p: p["lat"])
    lngs = F.transform(ring, lambda p: p["lng"])
    return {
        "swlat": F.array_min(lats), "swlng": F.array_min(lngs),
        "nelat": F.array_max(lats), "nelng": F.array_max(lngs),
    }


def cut_ring(ring: Column, low: tuple[Column, Column], high: tuple[Column, Column]) -> Column:
    """The part of a closed ``x, y`` ring of a convex polygon within a box, closed again;
    empty if there is none. The box's four half-planes are taken one after the other."""
    def plane(axis: int, bound: Column, side: float) -> Column:
        return F.struct(
            F.lit(axis).alias("axis"), bound.cast("double").alias("bound"), F.lit(side).alias("side"))

    planes = F.array(*(
        plane(axis, bound[axis], side) for axis in (0, 1) for bound, side in ((low, 1.0), (high, -1.0))))

    def cut(done: Column, half: Column) -> Column:
        def along(p: Column) -> Column:
            return F.when(half["axis"] == 0, p["x"]).otherwise(p["y"])

        def inside(p: Column) -> Column:
            return half["side"] * (along(p) - half["bound"]) >= 0

        def step(i: Column) -> Column:
            p, q = F.get(done, i - 1), F.get(done, i)
            way = (half["bound"] - along(p)) / (along(q) - along(p))
            met = F.array(F.struct(
                F.when(half["axis"] == 0, half["bound"]).otherwise(p["x"] + way * (q["x"] - p["x"])).alias("x"),
                F.when(half["axis"] == 1, half["bound"]).otherwise(p["y"] + way * (q["y"] - p["y"])).alias("y")))
            return (
                F.when(inside(q) & inside(p), F.array(q)).when(inside(q), F.concat(met, F.array(q)))
                .when(inside(p), met).otherwise(F.slice(done, 1, 0))
            )

        points = F.flatten(F.transform(F.sequence(F.lit(1), F.size(done) - 1), step))
        closed = F.transform(F.array(points), close_ring)[0]
        return F.when(F.size(done) > 1, closed).otherwise(F.slice(done, 1, 0))

    return F.aggregate(planes, ring, cut)


def ring_area(ring: Column, x: str = "x", y: str = "y") -> Column:
    """Area of a closed ring, negative if it turns clockwise."""
    steps = F.transform(ring, lambda p, i: F.coalesce(
        F.get(ring, i - 1)[x] * p[y] - p[x] * F.get(ring, i - 1)[y], F.lit(0)))
    return F.aggregate(steps, F.lit(0.0), lambda total, a: total + a) / 2
