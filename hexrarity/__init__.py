"""Rarity of species observations on a hexagon grid, on Spark."""

from hexrarity.operators.features import cell_features, find_cells
from hexrarity.operators.observations import assign_cells, filter_observations
from hexrarity.operators.occupancy import species_occupancy
from hexrarity.operators.scores import score_cells
from hexrarity.operators.style import style_cells
from hexrarity.operators.summary import summarize
from hexrarity.operators.tiles import ZoomPlan, tile_features
from hexrarity.sources.occurrences import read_occurrences

__all__ = [
    "ZoomPlan", "assign_cells", "cell_features", "filter_observations", "find_cells",
    "read_occurrences", "score_cells", "species_occupancy", "style_cells", "summarize",
    "tile_features",
]
