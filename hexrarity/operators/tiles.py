"""Features indexed by map tile.

Tiles are the usual Web Mercator z/x/y squares. A feature is indexed under every tile
that its bounding box touches, for the zooms its resolution serves. It can be cut to the
tile and a margin around it, which leaves out tiles that only the box touches. Features
of a tile with equal attributes can be dissolved into their outline.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexrarity.config import DEFAULT_LAYER, RESOLUTIONS, ZOOM_RANGES
from hexrarity.functions.geometry import closed_ring, cut_ring
from hexrarity.functions.outline import outline
from hexrarity.schemas import SCORE_COLUMNS

EXTENT = 4096  # tile units per side
MARGIN = 80  # tile units around a tile that its features are cut at
MAX_LATITUDE = 85.0511287798066  # where the square map ends
TILE = ["resolution", "z", "x", "y"]
CURVE_BITS = 16  # of longitude and of latitude, along the curve
RANKED = 65_536  # cells that a task ranks along the curve, about
RINGS_PER_ROW = 65_536  # of a coalesced row, on average at most


@dataclass(frozen=True)
class ZoomPlan:
    """Which zooms each resolution serves."""

    resolutions: Sequence[int] = RESOLUTIONS
    zoom_ranges: Sequence[tuple[int, int]] = ZOOM_RANGES

    def __post_init__(self) -> None:
        if len(self.resolutions) != len(self.zoom_ranges):
            raise ValueError("each resolution needs one zoom range")
        for low, high in self.zoom_ranges:
            if low < 0 or high < low:
                raise ValueError("a zoom range must satisfy 0 <= first <= last")

    def _lookup(self, resolution: Column, end: int) -> Column:
        pairs = zip(self.resolutions, self.zoom_ranges, strict=True)
        table = F.create_map(*(F.lit(x) for r, zooms in pairs for x in (r, zooms[end])))
        return F.try_element_at(table, resolution)

    def min_zoom(self, resolution: Column) -> Column:
        return self._lookup(resolution, 0)

    def max_zoom(self, resolution: Column) -> Column:
        return self._lookup(resolution, 1)


def zoom_to_resolution(zoom: Column, plan: ZoomPlan = ZoomPlan()) -> Column:
    """The finest resolution whose range has begun; below all of them the first."""
    rungs = sorted(
        zip(plan.zoom_ranges, plan.resolutions, strict=True), key=lambda rung: rung[0][0]
    )
    column = F.lit(rungs[0][1])
    for (low, _), resolution in rungs[1:]:
        column = F.when(zoom >= low, F.lit(resolution)).otherwise(column)
    return column


def to_world(ring: Column) -> Column:
    """Ring in map units: 0 to 1 eastwards and southwards, whatever the zoom.
    Unwrapped longitudes may leave that range."""
    def project(p: Column) -> Column:
        lat = F.least(F.greatest(p["lat"], F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE))
        sine = F.sin(F.radians(lat))
        return F.struct(
            ((p["lng"] + 180.0) / 360.0).alias("x"),
            (0.5 - F.ln((1 + sine) / (1 - sine)) / (4 * F.pi())).alias("y"),
        )

    return F.transform(ring, project)


def tile_index(features: DataFrame, plan: ZoomPlan = ZoomPlan()) -> DataFrame:
    """One row per feature and tile: adds ``z, x, y``, ``world`` (the ring in map
    units, projected once per feature), ``box`` (its bounds) and ``wrap``, the unwrapped tile column (a
    ring may reach beyond +-180; ``x`` is taken around the globe).
    """
    resolution, z = F.col("resolution"), F.col("z")
    side = F.pow(F.lit(2.0), z).cast("int")

    def tile(name: str) -> Column:
        return F.floor(F.col(name) * F.pow(F.lit(2.0), z)).cast("int")

    def row(name: str) -> Column:
        return F.least(F.greatest(tile(name), F.lit(0)), side - 1)

    boxed = features.withColumn("world", to_world(F.col("ring"))).select(
        "*",
        F.array_min(F.col("world.x")).alias("_west"),
        F.array_max(F.col("world.x")).alias("_east"),
        F.array_min(F.col("world.y")).alias("_top"),
        F.array_max(F.col("world.y")).alias("_bottom"),
        F.explode(F.sequence(plan.min_zoom(resolution), plan.max_zoom(resolution))).alias("z"),
    )
    once_round = F.least(tile("_east"), tile("_west") + side - 1)
    return (
        boxed.withColumn("wrap", F.explode(F.sequence(tile("_west"), once_round)))
        .withColumn("y", F.explode(F.sequence(row("_top"), row("_bottom"))))
        .withColumn("x", F.pmod(F.col("wrap"), side))
        .withColumn("box", F.struct(*(
            F.col(f"_{end}").alias(end) for end in ("west", "east", "top", "bottom"))))
        .drop("_west", "_east", "_top", "_bottom")
    )


def clip_tiles(indexed: DataFrame, margin: int = MARGIN) -> DataFrame:
    """``world`` cut to the tile and its margin (in tile units); rows of which nothing is left vanish. Rings of convex polygons, as cells are.
    What lies within stays as it is."""
    side, share = F.pow(F.lit(2.0), F.col("z")), margin / EXTENT
    low = tuple((F.col(name) - share) / side for name in ("wrap", "y"))
    high = tuple((F.col(name) + 1 + share) / side for name in ("wrap", "y"))
    box = F.col("box")
    within = (
        (box["west"] >= low[0]) & (box["east"] <= high[0])
        & (box["top"] >= low[1]) & (box["bottom"] <= high[1]))
    cut = F.when(within, F.col("world")).otherwise(cut_ring(closed_ring(F.col("world")), low, high))
    return indexed.withColumn("world", cut).filter(F.size("world") > 2)


def thinning_keeps(
    cell: Column, z: Column, max_zoom: Column, drop_rate: float | None
) -> Column:
    """Whether a feature stays at zoom ``z``: all do at ``max_zoom``, and a share
    of ``drop_rate ** -(max_zoom - z)`` below. Decided by a hash of the cell, so a
    feature kept at one zoom is kept at all finer ones. Rates up to 1 keep all."""
    if drop_rate is None or drop_rate <= 1:
        return F.lit(True)
    share = F.pow(F.lit(float(drop_rate)), z - max_zoom)
    return ((cell % 1000003) * 7919 % 1000003) / F.lit(1000003.0) < share


def check_drop_rate(drop_rate: float | None) -> None:
    if drop_rate is not None and not drop_rate > 0:
        raise ValueError(f"drop_rate is a positive number or None, not {drop_rate}")


def thin_tiles(
    indexed: DataFrame, drop_rate: float | None, plan: ZoomPlan = ZoomPlan()
) -> DataFrame:
    check_drop_rate(drop_rate)
    last = plan.max_zoom(F.col("resolution"))
    return indexed.filter(thinning_keeps(F.col("cell"), F.col("z"), last, drop_rate))


def curve_place(ring: Column) -> Column:
    """Place of a ring's centre on a Z-shaped curve through squares of longitude and
    latitude, ``CURVE_BITS`` bits each: what lies in a square of any size is together."""
    def bits(axis: str, low: float, turn: float) -> Column:
        values = F.transform(ring, lambda p: p[axis])
        middle = (F.array_min(values) + F.array_max(values)) / 2
        cell = F.floor((middle - low) / turn * (1 << CURVE_BITS))
        return F.pmod(cell, F.lit(1 << CURVE_BITS)) if axis == "lng" else F.least(
            F.greatest(cell, F.lit(0)), F.lit((1 << CURVE_BITS) - 1))

    place = F.lit(0).cast("long")
    for shift, number in ((0, bits("lng", -180.0, 360.0)), (1, bits("lat", -90.0, 180.0))):
        for k in range(CURVE_BITS):
            place = place + F.shiftleft(number.bitwiseAND(F.lit(1 << k).cast("long")), k + shift)
    return place


def rank_by_place(features: DataFrame) -> DataFrame:
    """Adds ``place_rank``, each feature's number along the curve within its resolution.

    None of a resolution is ranked in one task: features are numbered within squares that
    hold at most about ``RANKED`` cells, and a square starts where those before it end.
    """
    cells = F.pow(F.lit(7.0), F.col("resolution")) * 120
    depth = F.least(F.greatest(F.ceil(F.log(4.0, cells / RANKED)), F.lit(0)), F.lit(CURVE_BITS)).cast("int")
    placed = features.withColumn("_place", curve_place(F.col("ring"))).withColumn(
        "_square", F.call_function("shiftright", F.col("_place"), 2 * (CURVE_BITS - depth)))
    counts = placed.groupBy("resolution", "_square").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("resolution").orderBy("_square")
    starts = counts.select("resolution", "_square", (F.sum("_n").over(before) - F.col("_n")).alias("_start"))
    inside = Window.partitionBy("resolution", "_square").orderBy("_place", "cell")
    return (
        placed.withColumn("_number", F.row_number().over(inside) - 1)
        .join(starts, ["resolution", "_square"])
        .withColumn("place_rank", F.col("_start") + F.col("_number"))
        .drop("_place", "_square", "_number", "_start")
    )


def thin_by_place(
    indexed: DataFrame, drop_rate: float | None, plan: ZoomPlan = ZoomPlan()
) -> DataFrame:
    """Of every ``drop_rate`` features along the curve (``place_rank``) one stays, for each
    zoom below the last, and of these again; so a feature kept at one zoom is kept at all
    finer ones, and any square keeps its share but for a feature or two. Rates up to 1
    keep all."""
    check_drop_rate(drop_rate)
    if drop_rate is None or drop_rate <= 1:
        return indexed.drop("place_rank")
    rate = F.lit(float(drop_rate))

    def step(state: Column, _: Column) -> Column:
        """Every rate-th is kept; its number among the kept follows from its own."""
        number = F.floor(state["number"] / rate)
        kept = state["kept"] & (F.floor((state["number"] + 1) / rate) > number)
        return F.struct(number.alias("number"), kept.alias("kept"))

    steps = plan.max_zoom(F.col("resolution")) - F.col("z")
    zooms = F.slice(F.array(*map(F.lit, range(1, 31))), F.lit(1), steps)
    start = F.struct(F.col("place_rank").cast("long").alias("number"), F.lit(True).alias("kept"))
    return indexed.filter(F.aggregate(zooms, start, step)["kept"]).drop("place_rank")


def snap_tiles(indexed: DataFrame) -> DataFrame:
    """Replace lng/lat rings by rings in whole tile units (0..4096 inside the
    tile), without repeats of the previous vertex."""
    side, ring = F.pow(F.lit(2.0), F.col("z")), F.col("ring")
    snapped = F.transform("world", lambda p: F.struct(
        F.round((p["x"] * side - F.col("wrap")) * EXTENT).cast("int").alias("x"),
        F.round((p["y"] * side - F.col("y")) * EXTENT).cast("int").alias("y"),
    ))
    return indexed.withColumn("ring", snapped).withColumn(
        "ring", F.filter(ring, lambda p, i: ~p.eqNullSafe(F.get(ring, i - 1)))
    )


def coalesce_tiles(indexed: DataFrame, attributes: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Merge features of a tile whose attributes are all equal: ``rings`` holds
    their polygons, in a fixed order, and cell ids are not kept.

    Where a tile of the zoom can hold more than ``RINGS_PER_ROW`` cells of the
    resolution, its features are dealt over so many rows by a hash of the cell that a
    row stays bounded; with the usual zoom plan that is one row.
    """
    # There are about 120 * 7^resolution cells, and 4^z tiles; the squares of the map
    # are not equal in area, hence the factor.
    cells = F.pow(F.lit(7.0), F.col("resolution")) * 120 / F.pow(F.lit(4.0), F.col("z"))
    parts = F.greatest(F.ceil(cells / RINGS_PER_ROW), F.lit(1))
    merged = indexed.withColumn("_part", F.pmod(F.xxhash64("cell"), parts)).groupBy(
        *TILE, *attributes, "_part"
    ).agg(
        F.array_sort(F.collect_list("ring")).alias("rings"),
        F.count("*").alias("n_features"),
    )
    return merged.drop("_part")


def dissolve_tiles(indexed: DataFrame, attributes: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Features of a tile whose attributes are all equal as one: ``rings`` is the outline of
    what they cover together, holes turning the other way, smallest point first; cell ids
    are not kept.

    Edges are directed, so an edge between two of the features is there in both
    directions, and both go; counts of directions are combined before they are
    shuffled, whatever the number of features. What is left is the outline, which is
    stitched together for the one row that holds it. Features without equals keep their
    ring. Rings in degrees are matched, and given, to the billionth.
    """
    names = indexed.schema["ring"].dataType.elementType.names
    kinds = [f.dataType for f in indexed.schema["ring"].dataType.elementType]
    scale = 1 if names == ["x", "y"] else 10**9
    key = [*TILE, *attributes]
    groups = indexed.groupBy(*key).agg(
        F.count("*").alias("n_features"), F.first("ring").alias("ring"))
    alone = groups.filter("n_features = 1").select(*key, F.array("ring").alias("rings"), "n_features")
    several = groups.filter("n_features > 1").drop("ring")

    def equal(left: DataFrame, right: DataFrame) -> list[Column]:
        return [left[c] == right[c] if c in TILE else left[c].eqNullSafe(right[c]) for c in key]

    members = indexed.join(several, equal(indexed, several), "left_semi")
    whole = F.transform(closed_ring(F.col("ring")), lambda p: F.struct(*(
        F.round(p[n] * scale).cast("long").alias(a) for n, a in zip(names, "xy", strict=True))))
    steps = F.transform(whole, lambda p, i: F.struct(F.get(whole, i - 1).alias("a"), p.alias("b")))
    edges = members.select(*key, F.inline(steps)).filter("a <> b")
    forward = F.col("a") < F.col("b")
    left = (
        edges.groupBy(*key, F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .agg(F.sum(F.when(forward, 1).otherwise(-1)).alias("turns")).filter("turns <> 0")
    )
    ahead, (low, high) = F.col("turns") > 0, (F.col("low"), F.col("high"))
    edge = F.struct(
        F.when(ahead, low["x"]).otherwise(high["x"]).alias("ax"), F.when(ahead, low["y"]).otherwise(high["y"]).alias("ay"),
        F.when(ahead, high["x"]).otherwise(low["x"]).alias("bx"), F.when(ahead, high["y"]).otherwise(low["y"]).alias("by"))
    drawn = left.select(*key, F.explode(F.array_repeat(edge, F.abs("turns").cast("int"))).alias("edge")).groupBy(
        *key).agg(F.collect_list("edge").alias("edges"))
    drawn = drawn.withColumn("rings", outline(F.col("edges")))
    back = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct(*(
        (p[a] / F.lit(scale) if scale > 1 else p[a]).cast(kind).alias(n)
        for n, a, kind in zip(names, "xy", kinds, strict=True)))))
    drawn = drawn.select(*key, back.alias("rings"))
    # (Nothing is left of features that snapping has collapsed into lines.)
    merged = several.join(drawn, equal(several, drawn), "left").select(
        *(several[c] for c in key), F.coalesce("rings", F.slice(F.array(F.slice(F.array(F.struct(*(
            F.lit(0).cast(kind).alias(n) for n, kind in zip(names, kinds, strict=True)))), 1, 0)), 1, 0)).alias("rings"),
        "n_features")
    return alone.unionByName(merged)


def tile_features(
    features: DataFrame,
    plan: ZoomPlan = ZoomPlan(),
    drop_rate: float | None = None,
    coalesce: bool = False,
    simplification: bool = True,
    layer: str = DEFAULT_LAYER,
    margin: int | None = None,
) -> DataFrame:
    """Tile-indexed feature table with constant column ``layer``. With a ``margin``, features
    are cut that far outside their tile (``clip_tiles``); else tiles list whole features.

    Cutting and snapping are row-wise on the index; thinning ranks the features by place
    first, and coalescing shuffles tiles. Rings in degrees (without simplification) are
    not cut.
    """
    check_drop_rate(drop_rate)
    thins = drop_rate is not None and drop_rate > 1
    indexed = tile_index(rank_by_place(features) if thins else features, plan)
    tiles = thin_by_place(indexed, drop_rate, plan)
    if margin is not None:
        tiles = clip_tiles(tiles, margin)
    if simplification:
        tiles = snap_tiles(tiles)
    if coalesce:
        tiles = dissolve_tiles(tiles)
    else:
        tiles = tiles.select(
            *TILE, "h3", *SCORE_COLUMNS, F.array("ring").alias("rings"),
            F.lit(1).cast("long").alias("n_features"),
        )
    return tiles.withColumn("layer", F.lit(layer))


def feature_counts(features: DataFrame) -> DataFrame:
    return features.groupBy("resolution").agg(F.count("*").alias("n_features"))
