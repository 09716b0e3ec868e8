"""Dissolved and clipped tile features."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hexrarity.functions.geometry import ring_area
from hexrarity.functions.outline import rings_of
from hexrarity.operators import tiles
from hexrarity.operators.tiles import (
    EXTENT, MARGIN, ZoomPlan, clip_tiles, dissolve_tiles, snap_tiles, tile_features, tile_index,
)
from tests.test_features_tiles import features_of

PLAN = ZoomPlan((5,), ((6, 6),))


def square(x, y, size=0.25):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def edges_of(cells):
    found = {}
    for x, y in cells:
        ring = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
        for a, b in zip(ring, ring[1:], strict=False):
            if found.pop((b, a), None) is None:
                found[a, b] = True
    return [(*a, *b) for a, b in found]


@pytest.mark.parametrize("flip", [False, True])
def test_rings(flip):
    """Touching corners part, holes turn the other way, areas add up, no edge is lost."""
    turned = lambda es: [(x, -y, u, -v) for x, y, u, v in es] if flip else es
    assert [len(r) for r in rings_of(turned(edges_of([(0, 0), (1, 1)])))] == [5, 5]
    frame = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    rings = rings_of(turned(edges_of(frame)))
    assert sorted(area(r) * (-1 if flip else 1) for r in rings) == [-1, 9]
    draw = random.Random(3)
    for _ in range(30):
        cells = {(draw.randrange(8), draw.randrange(8)) for _ in range(draw.randrange(1, 50))}
        edges = turned(edges_of(cells))
        rings = rings_of(edges)
        assert sum(map(area, rings)) == len(cells) * (-1 if flip else 1)
        assert sorted((*a, *b) for r in rings for a, b in zip(r, r[1:], strict=False)) == sorted(edges)
        assert all(r[0] == r[-1] == min(r) and len(set(r)) == len(r) - 1 for r in rings)
    assert rings_of([]) == []


def test_dissolve(spark):
    """A frame of eight squares with a hole, a square elsewhere with the same attributes, and
    one with others."""
    frame = [square(1 + 0.25 * i, 1 + 0.25 * j) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    features = features_of(spark, [*frame, square(3, 3), square(1.25, 1.25)])
    features = features.withColumn("count_species", F.when(F.col("cell") == 10, 9).otherwise(1).cast("long"))
    for simplification in (True, False):
        rows = {r["count_species"]: r for r in tile_features(features, PLAN, coalesce=True, simplification=simplification)
                .collect() if r["n_features"]}
        names = ("x", "y") if simplification else ("lng", "lat")
        rings = [[(p[names[0]], p[names[1]]) for p in ring] for ring in rows[1]["rings"]]
        assert rows[1]["n_features"] == 9 and rows[9]["n_features"] == 1
        assert sorted(map(len, rings)) == [5, 5, 13]
        parts = tile_features(features.where("count_species = 1"), PLAN, simplification=simplification).collect()
        whole = sum(area([(p[names[0]], p[names[1]]) for p in r["rings"][0]]) for r in parts)
        assert sum(map(area, rings)) == pytest.approx(whole, rel=1e-12)


def test_dissolve_null_attributes_and_repeats(spark):
    features = features_of(spark, [square(1, 1), square(1.25, 1), square(1, 1)])
    features = features.withColumn("confidence_scores", F.lit(None).cast("double"))
    (row,) = dissolve_tiles(snap_tiles(tile_index(features, PLAN))).collect()
    assert row["n_features"] == 3 and row["confidence_scores"] is None
    assert sorted(len(r) for r in row["rings"]) in ([5, 5, 5], [5, 7])
    assert dissolve_tiles(snap_tiles(tile_index(features.limit(0), PLAN))).count() == 0


def hexagon(x, y, size):
    ring = [(x + size * math.cos(k * math.pi / 3), y + size * math.sin(k * math.pi / 3)) for k in range(6)]
    return [*ring, ring[0]]


def test_clip(spark):
    """Parts of a feature in its tiles have its area together; what lies within a tile is
    untouched; nothing leaves the margin."""
    rings = [hexagon(5.625, 3.1, 1.7), hexagon(2.1, 2.2, 0.2), hexagon(0, 0, 4), hexagon(179.9, 10, 2)]
    indexed = tile_index(features_of(spark, rings), PLAN)
    parts = clip_tiles(indexed, 0).select("cell", "x", "y", ring_area(F.col("world")).alias("area"))
    whole = indexed.select("cell", ring_area(F.col("world")).alias("whole")).distinct()
    for r in parts.groupBy("cell").agg(F.sum("area").alias("area")).join(whole, "cell").collect():
        assert r["area"] == pytest.approx(r["whole"], rel=1e-9)
    same = clip_tiles(indexed).where("cell = 2").select("world").first()
    assert same == indexed.where("cell = 2").select("world").first()
    for r in tile_features(features_of(spark, rings), PLAN, margin=MARGIN).collect():
        assert all(-MARGIN <= p[a] <= EXTENT + MARGIN for p in r["rings"][0] for a in ("x", "y"))


def test_corner_tiles_vanish(spark):
    """A small triangle near the corner of four tiles touches three of them."""
    ring = [(5.0, 4.0), (6.5, 4.0), (5.0, 6.5), (5.0, 4.0)]
    indexed = tile_index(features_of(spark, [ring]), PLAN)
    assert indexed.count() == 4 and clip_tiles(indexed, 0).count() == 3


@pytest.mark.parametrize("rate", [2.0, 2.5])
def test_thinning_by_place(spark, rate, monkeypatch):
    """Every coarse square keeps its share of features but for two, zoom by zoom, and what is
    kept is kept at finer zooms; ranks have no gaps, whatever is ranked together."""
    draw = random.Random(8)
    places = [(draw.uniform(-170, 170) if k % 3 else 10 + draw.random(), draw.uniform(-80, 80) if k % 3 else 45 + draw.random())
              for k in range(900)]
    features = features_of(spark, [square(x, y, 0.01) for x, y in places])
    plan = ZoomPlan((5,), ((3, 6),))
    ranks = {}
    for ranked in (tiles.RANKED, 500):
        monkeypatch.setattr(tiles, "RANKED", ranked)
        ranks[ranked] = {r["cell"]: r["place_rank"] for r in tiles.rank_by_place(features).collect()}
    assert len({tuple(sorted(r.items())) for r in ranks.values()}) == 1
    assert sorted(ranks[500].values()) == list(range(900))
    rows = tiles.thin_by_place(tile_index(tiles.rank_by_place(features), plan), rate, plan).collect()
    kept = {z: {r["cell"] for r in rows if r["z"] == z} for z in range(3, 7)}
    assert len(kept[6]) == 900
    squares = {}
    for cell, (x, y) in enumerate(places, 1):
        squares.setdefault((int((x + 180) // 22.5), int((y + 90) // 11.25)), set()).add(cell)
    for z in range(3, 6):
        assert kept[z] <= kept[z + 1]
        for cells in squares.values():
            assert abs(len(cells & kept[z]) - len(cells) / rate ** (6 - z)) <= 2
    assert tile_features(features, plan, drop_rate=rate).count() == len(
        [r for r in rows])
