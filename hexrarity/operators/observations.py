"""Cleaning of raw occurrences and assignment to grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexrarity.config import RESOLUTIONS, cell_column
from hexrarity.functions.grid import latlng_to_cells
from hexrarity.schemas import OBSERVATION_COLUMNS


def normalise_country(country: str | None) -> str | None:
    """Stripped upper-case code, or None where no filter is wanted."""
    code = (country or "").strip().upper()
    return code or None


def filter_observations(raw: DataFrame, country: str | None = None) -> DataFrame:
    """Keep species-rank records with a species, an observer and a valid place."""
    keep: Column = (
        F.col("speciesKey").isNotNull()
        & F.col("recordedBy").isNotNull()
        & (F.col("taxonRank") == "SPECIES")
        & F.col("decimalLatitude").between(-90, 90)
        & F.col("decimalLongitude").between(-180, 180)
    )
    code = normalise_country(country)
    if code is not None:
        keep = keep & (F.col("countryCode") == F.lit(code))
    return raw.filter(keep).select(*OBSERVATION_COLUMNS)


def assign_cells(
    observations: DataFrame, resolutions: Sequence[int] = RESOLUTIONS
) -> DataFrame:
    """Add one ``h3_res{r}`` column per resolution, each from the coordinates.

    All resolutions come from one Arrow batch call; a coarser cell is never
    taken as the parent of a finer one, since children overlap their parents'
    edges.
    """
    cells = latlng_to_cells(
        F.col("decimalLatitude"), F.col("decimalLongitude"), tuple(resolutions)
    )
    return observations.withColumn("_cells", cells).select(
        *observations.columns, *(F.col(f"_cells.{cell_column(r)}") for r in resolutions)
    )


def to_long(
    observations: DataFrame,
    resolutions: Sequence[int] = RESOLUTIONS,
    wanted: str | None = None,
) -> DataFrame:
    """Unpivot the cell columns to rows (``resolution``, ``cell``).

    ``wanted`` names an integer column whose bit r says whether the row counts at
    resolution r; it is consumed. Only the resolution numbers are exploded and the
    cell is picked afterwards, which builds no row objects.
    """
    cells = {cell_column(r) for r in resolutions}
    kept = [c for c in observations.columns if c not in cells and c != wanted]
    numbers = ", ".join(map(str, resolutions))
    long = observations.select("*", F.expr(f"explode(array({numbers})) AS resolution"))
    if wanted is not None:
        long = long.filter(f"({wanted} & shiftleft(1, resolution)) != 0")
    arms = " ".join(f"WHEN {r} THEN {cell_column(r)}" for r in resolutions)
    return long.selectExpr(
        *(f"`{c}`" for c in kept), "resolution", f"CASE resolution {arms} END AS cell"
    )


def observation_stats(observations: DataFrame) -> DataFrame:
    """Number of observations and of species, one row.

    Counting per species first keeps the distinct count hash-based and leaves
    the last task only (species, count) pairs already summed per map task.
    """
    return (
        observations.groupBy("speciesKey")
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_observations"),
            F.count("speciesKey").alias("n_species"),
        )
    )
