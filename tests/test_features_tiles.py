from __future__ import annotations

import math
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from hexrarity.config import RESOLUTIONS, ZOOM_RANGES
from hexrarity.functions.geometry import close_ring, unwrap_dateline
from hexrarity.operators.features import cell_bbox, cell_features, cell_links, find_cells
from hexrarity.operators.tiles import (
    ZoomPlan, coalesce_tiles, feature_counts, snap_tiles, thin_tiles, tile_features,
    tile_index, zoom_to_resolution,
)
from hexrarity.schemas import SCORES

RINGS = {
    "plain": [(10, 1), (11, 1), (11, 2)],
    "east to west": [(179, 0), (-179, 0), (-179, 1), (179, 1)],
    "west to east": [(-179, 0), (179, 0), (179, 1), (-179, 1)],
    "twice": [(170, 0), (-170, 0), (10, 0), (-170, 0), (170, 0)],
}


def unwrapped(ring):
    """The shift rule, by hand."""
    done = [ring[0]]
    for lng, lat in ring[1:]:
        jump = lng - done[-1][0]
        done.append((lng - 360 if jump > 180 else lng + 360 if jump < -180 else lng, lat))
    return done


@pytest.mark.parametrize("name", RINGS)
def test_dateline(spark, name):
    ring = [(float(x), float(y)) for x, y in RINGS[name]]
    df = spark.createDataFrame([(ring,)], "ring array<struct<lng:double,lat:double>>")
    row = df.select(
        unwrap_dateline(F.col("ring")).alias("u"), close_ring(F.col("ring")).alias("c")
    ).first()
    assert [tuple(p) for p in row["u"]] == unwrapped(ring)
    assert [tuple(p) for p in row["c"]] == [*ring, ring[0]]


def test_bbox_and_link(spark):
    scores = spark.createDataFrame([(5, 0x85283473FFFFFFF, 0.1, 1, 1, 1, 0.1)], SCORES)
    row = cell_links(cell_bbox(cell_features(scores))).first()
    assert row["swlat"] == pytest.approx(37.263197975)
    assert row["nelng"] == pytest.approx(-121.862223289)
    query = parse_qs(urlsplit(row["url"]).query)
    assert float(query["nelat"][0]) == row["nelat"] and query["subview"] == ["map"]
    assert query["quality_grade"] == ["research"] and row["url"].startswith("https://")
    assert find_cells(scores, "85283473fffffff").count() == 1
    assert find_cells(scores, "85283473ffffff").count() == 0
    assert find_cells(scores, "no id", "", "85283473FFFFFFF").count() == 0


def test_plan_arguments():
    with pytest.raises(ValueError):
        ZoomPlan((3, 4), ((0, 1),))
    for zooms in [(3, 2), (-1, 2)]:
        with pytest.raises(ValueError):
            ZoomPlan((3,), (zooms,))
    plan = ZoomPlan()
    assert tuple(plan.resolutions) == RESOLUTIONS and tuple(plan.zoom_ranges) == ZOOM_RANGES


def test_zoom_to_resolution(spark):
    zooms = spark.range(0, 14).select(F.col("id").cast("int").alias("z"))
    got = [r[0] for r in zooms.select(zoom_to_resolution(F.col("z"))).collect()]
    assert got == [3, 3, 3, 3, 4, 5, 5, 6, 7, 7, 7, 7, 7, 7]


def features_of(spark, rings, resolution=5):
    rows = [
        (resolution, i, 0.5, 1, 2, 3, 0.25, f"{i:x}", [(float(x), float(y)) for x, y in ring])
        for i, ring in enumerate(rings, 1)
    ]
    return spark.createDataFrame(
        rows,
        "resolution int, cell long, rarity_zscore double, count_species long, "
        "count_observations long, count_observers long, confidence_scores double, h3 string, "
        "ring array<struct<lng:double,lat:double>>",
    )


def tile_of(lng, lat, z):
    n = 2**z
    y = (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n
    return int((lng + 180) / 360 * n) % n, min(max(int(y), 0), n - 1)


def test_tile_index(spark):
    rings = [[(10, 45), (10.5, 45), (10.5, 45.4)], [(179, -3), (181, -3), (181, -1)]]
    plan = ZoomPlan((5,), ((0, 6),))
    rows = tile_index(features_of(spark, rings), plan).collect()
    for i, ring in enumerate(rings, 1):
        for z in range(7):
            got = {(r["x"], r["y"]) for r in rows if r["cell"] == i and r["z"] == z}
            xs, ys = [p[0] for p in ring], [p[1] for p in ring]
            corners = {tile_of(x, y, z) for x in (min(xs), max(xs)) for y in (min(ys), max(ys))}
            assert corners <= got and len(got) == len(corners)
    assert len(rows) == len({(r["cell"], r["z"], r["x"], r["y"]) for r in rows})


def test_poles_and_whole_turn(spark):
    rings = [[(-180, 80), (180, 80), (0, 90)], [(0, -90), (1, -90), (1, -89)]]
    rows = tile_index(features_of(spark, rings), ZoomPlan((5,), ((2, 2),))).collect()
    assert {(r["x"], r["y"]) for r in rows if r["cell"] == 1} == {(x, 0) for x in range(4)}
    assert {r["y"] for r in rows if r["cell"] == 2} == {3}


def test_thinning(spark):
    rings = [[(0.1, 0.1), (0.2, 0.1), (0.2, 0.2)]] * 400
    indexed = tile_index(features_of(spark, rings), ZoomPlan((5,), ((3, 7),))).cache()
    plan = ZoomPlan((5,), ((3, 7),))
    kept = {
        z: {r["cell"] for r in thin_tiles(indexed, 2.0, plan).filter(f"z = {z}").collect()}
        for z in range(3, 8)
    }
    assert len(kept[7]) == 400
    for z in range(3, 7):
        assert kept[z] <= kept[z + 1]
        assert len(kept[z]) == pytest.approx(400 / 2 ** (7 - z), rel=0.5)
    assert thin_tiles(indexed, None, plan).count() == thin_tiles(indexed, 0.5, plan).count() == 2000
    with pytest.raises(ValueError):
        thin_tiles(indexed, 0.0, plan)


def test_snap(spark):
    rings = [[(0, 0), (90, 0), (90, 0.000001), (90, 45), (0, 0)]]
    indexed = tile_index(features_of(spark, rings), ZoomPlan((5,), ((1, 1),)))
    by_tile = {(r["x"], r["y"]): [tuple(p) for p in r["ring"]] for r in snap_tiles(indexed).collect()}
    ring = by_tile[1, 0]
    assert ring[:2] == [(0, 4096), (2048, 4096)] and ring[-1] == ring[0] and len(ring) == 4
    assert ring[2][0] == 2048 and 0 < ring[2][1] < 4096


def test_coalesce_and_layer(spark):
    rings = [[(1, 1), (1.2, 1), (1.2, 1.2)], [(1.3, 1), (1.5, 1), (1.5, 1.2)]]
    plan = ZoomPlan((5,), ((5, 5),))
    features = features_of(spark, rings)
    (row,) = tile_features(features, plan, coalesce=True, layer="cells").collect()
    assert row["n_features"] == 2 and len(row["rings"]) == 2 and row["layer"] == "cells"
    changed = features.withColumn("count_species", F.col("cell"))
    assert tile_features(changed, plan, coalesce=True).count() == 2
    assert coalesce_tiles(tile_index(changed, plan), ["count_observers"]).count() == 1
    plain = tile_features(features, plan, simplification=False).collect()
    assert [r["h3"] for r in sorted(plain, key=lambda r: r["h3"])] == ["1", "2"]
    assert plain[0]["rings"][0][0]["lng"] in (1.0, 1.3)
    assert feature_counts(features).first()["n_features"] == 2
