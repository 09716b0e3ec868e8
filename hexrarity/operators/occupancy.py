"""How widely each species occurs, and the rarity that follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexrarity.config import OCCUPANCY_RESOLUTION, cell_column


def species_occupancy(
    observations: DataFrame, resolution: int = OCCUPANCY_RESOLUTION
) -> DataFrame:
    """One row per species: observations, distinct cells, ``1 / sqrt(cells)``.

    Observations are grouped by species and cell, which spreads a species that holds
    many rows, and then by species alone. Names have an aggregate of their own, over the
    few pairs of species and name: a string minimum would make the bulk sort.
    """
    cell = cell_column(resolution)
    located = observations.where(F.col("speciesKey").isNotNull() & F.col(cell).isNotNull())
    counts = (
        located.groupBy("speciesKey", cell).agg(F.count("*").alias("n"))
        .groupBy("speciesKey")
        .agg(F.sum("n").alias("n_observations"), F.count("*").alias("occupancy"))
    )
    names = (
        located.select("speciesKey", "species").distinct()
        .groupBy("speciesKey").agg(F.min("species").alias("species"))
    )
    return counts.join(names, "speciesKey").select(
        "speciesKey", "species", "n_observations", "occupancy",
        (1.0 / F.sqrt(F.col("occupancy").cast("double"))).alias("rarity"),
    )


def occupancy_stats(occupancy: DataFrame) -> DataFrame:
    """Species count and the range and mean of occupancy and rarity, one row."""
    return occupancy.agg(
        F.count("*").alias("n_species"),
        F.min("occupancy").alias("min_occupancy"),
        F.avg("occupancy").alias("avg_occupancy"),
        F.max("occupancy").alias("max_occupancy"),
        F.min("rarity").alias("min_rarity"),
        F.avg("rarity").alias("avg_rarity"),
        F.max("rarity").alias("max_rarity"),
    )
