from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hexrarity.operators.style import RAMPS, fill_opacity, piecewise, style_cells
from hexrarity.schemas import SCORES

SUMMARY = (
    "resolution int, rarity_quantiles array<double>, count_observations_quantiles array<double>, "
    "count_species_quantiles array<double>, count_observers_quantiles array<double>"
)


def mixed(ramp, x, q):
    """Colour between stops, by hand."""
    stops = [s * q for s in ramp.stops]
    levels = [[int(c[i:i + 2], 16) for i in (1, 3, 5)] for c in ramp.colours]
    x = min(max(x, stops[0]), stops[-1])
    i = max(k for k in range(len(stops) - 1) if stops[k] <= x)
    share = (x - stops[i]) / (stops[i + 1] - stops[i])
    rgb = [int(a + share * (b - a) + 0.5) for a, b in zip(levels[i], levels[i + 1])]
    return "#" + "".join(f"{v:02x}" for v in rgb)


def cells(spark, metric, values, resolution=3):
    column = RAMPS[metric].column
    rows = [(resolution, i, 0.0, 1, 1, 1, 0.5) for i in range(len(values))]
    kind = dict((f.name, f.dataType) for f in SCORES)[column]
    by_id = spark.createDataFrame(list(enumerate(values)), f"cell long, v {kind.simpleString()}")
    return spark.createDataFrame(rows, SCORES).join(by_id, "cell").withColumn(
        column, F.col("v")
    ).drop("v")


@pytest.mark.parametrize("metric", RAMPS)
def test_stops_and_between(spark, metric):
    ramp, q = RAMPS[metric], 1000.0
    values = sorted({s * q for s in ramp.stops} | {-2 * q, -0.5 * q, 0.1 * q, 0.9 * q, 2 * q})
    if metric != "rarity_zscore":
        values = [int(v) for v in values]
    summary = spark.createDataFrame([(3, [0.0, 0.0, 0.0, q], *[[0.0, 0.0, q]] * 3)], SUMMARY)
    styled = style_cells(cells(spark, metric, values), summary, metric)
    got = {r["cell"]: r["fill_color"] for r in styled.collect()}
    assert got == {i: mixed(ramp, v, q) for i, v in enumerate(values)}
    for stop, colour in zip(ramp.stops, ramp.colours):
        assert mixed(ramp, stop * q, q) == colour


def test_defaults(spark):
    empty = spark.createDataFrame([], SUMMARY)
    styled = style_cells(cells(spark, "count_species", [0, 250, None]), empty, "count_species")
    got = {r["cell"]: r["fill_color"] for r in styled.collect()}
    assert got == {0: "#f1ffcf", 1: "#7dde46", 2: "#f1ffcf"}
    # without a summary the rarity domain has no width
    styled = style_cells(cells(spark, "rarity_zscore", [-1.0, 1.0]), empty)
    assert {r["fill_color"] for r in styled.collect()} == {"#f7f7f7"}
    flat = spark.createDataFrame([(3, [0.0] * 4, *[[0.0] * 3] * 3)], SUMMARY)
    styled = style_cells(cells(spark, "rarity_zscore", [-1.0, 1.0]), flat)
    assert {r["fill_color"] for r in styled.collect()} == {"#f7f7f7"}


def test_opacity(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (2.0,), (None,)], "c double")
    got = [r[0] for r in df.select(fill_opacity(F.col("c"), 80)).collect()]
    assert got == pytest.approx([0, 0, 0.4, 0.8, 0.8, 0])


def test_piecewise(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 1, 2, 3, 9)], "x double")
    stops = [(F.lit(0.0), 10.0), (F.lit(2.0), 20.0), (F.lit(3.0), 0.0)]
    got = [r[0] for r in df.select(piecewise(F.col("x"), stops)).collect()]
    assert got == [10, 10, 15, 20, 0, 0]
