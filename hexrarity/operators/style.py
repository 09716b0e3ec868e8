"""Fill colour and opacity of cells, as on a map.

Colours run linearly between fixed stops over a domain taken from the summary
quantiles of the cell's resolution.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ramp:
    column: str
    summary: str
    quantile: int  # place in the summary list
    default: float  # domain end where a resolution has no summary
    stops: Sequence[float]  # in units of the domain end
    colours: Sequence[str]
    middle: str  # colour of a domain of no width


# Ramp stops and colours.
RAMPS = {
    "rarity_zscore": Ramp(
        "rarity_zscore", "rarity_quantiles", 3, 0.0,
        (-1, -0.67, -0.33, 0, 0.33, 0.67, 1),
        ("#053061", "#4575b4", "#abd9e9", "#f7f7f7", "#fdae61", "#d73027", "#67001f"),
        "#f7f7f7",
    ),
    "count_observations": Ramp(
        "count_observations", "count_observations_quantiles", 2, 500.0,
        (0, 0.2, 0.4, 0.6, 0.8, 1),
        ("#e8f3ea", "#b8d9c3", "#6fb0a4", "#397996", "#24476f", "#171d3f"),
        "#e8f3ea",
    ),
    "count_species": Ramp(
        "count_species", "count_species_quantiles", 2, 500.0,
        (0, 0.25, 0.5, 0.75, 1),
        ("#f1ffcf", "#c6f76a", "#7dde46", "#3caa52", "#245726"),
        "#f1ffcf",
    ),
    "count_observers": Ramp(
        "count_observers", "count_observers_quantiles", 2, 500.0,
        (0, 0.25, 0.5, 0.75, 1),
        ("#fff1cf", "#f7c66a", "#de7d46", "#aa3c52", "#572461"),
        "#fff1cf",
    ),
}


def piecewise(x: Column, stops: Sequence[tuple[Column, float]]) -> Column:
    """Linear between (position, value) stops in rising order, constant outside."""
    (first, first_value), *rest = stops
    column = F.when(x <= first, F.lit(float(first_value)))
    before, value = first, float(first_value)
    for position, next_value in rest:
        share = (x - before) / (position - before)
        column = column.when(x < position, value + share * (float(next_value) - value))
        before, value = position, float(next_value)
    return column.otherwise(F.lit(value))


def ramp_colour(x: Column, domain: Column, ramp: Ramp) -> Column:
    """``#rrggbb`` of a value; each channel is interpolated and rounded."""
    def channel(at: int) -> Column:
        levels = [int(c[at:at + 2], 16) for c in ramp.colours]
        level = piecewise(x, [
            (domain * F.lit(float(s)), v) for s, v in zip(ramp.stops, levels, strict=True)
        ])
        return F.lpad(F.hex(F.round(level).cast("long")), 2, "0")

    colour = F.lower(F.concat(F.lit("#"), channel(1), channel(3), channel(5)))
    return F.when(domain > 0, colour).otherwise(F.lit(ramp.middle))


def fill_opacity(confidence: Column, opacity_percent: float = 75) -> Column:
    share = F.least(F.greatest(F.coalesce(confidence, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return share * (opacity_percent / 100)


def style_cells(
    scores: DataFrame,
    summary: DataFrame,
    metric: str = "rarity_zscore",
    opacity_percent: float = 75,
) -> DataFrame:
    """Add ``fill_color`` and ``fill_opacity``. The summary has one row per
    resolution (at most 16), hence the broadcast."""
    ramp = RAMPS[metric]
    domains = summary.select(
        "resolution", F.try_element_at(ramp.summary, F.lit(ramp.quantile + 1)).alias("_domain")
    )
    value = F.coalesce(F.col(ramp.column).cast("double"), F.lit(0.0))
    domain = F.coalesce("_domain", F.lit(ramp.default))
    return (
        scores.join(F.broadcast(domains), "resolution", "left")
        .withColumn("fill_color", ramp_colour(value, domain, ramp))
        .withColumn("fill_opacity", fill_opacity(F.col("confidence_scores"), opacity_percent))
        .drop("_domain")
    )
