"""Settings shared by all stages."""

from __future__ import annotations

# The resolution of occupancy, and those that are scored.
OCCUPANCY_RESOLUTION = 5
RESOLUTIONS = (3, 4, 5, 6, 7)

# Map zoom range (first, last) served by each resolution, in the
# order of RESOLUTIONS. The ends overlap; a reader takes the finer cell.
ZOOM_RANGES = ((0, 4), (4, 5), (5, 7), (7, 8), (8, 12))

# Average hexagon edge length per resolution, in metres.
EDGE_LENGTH_M = {
    0: 1281256.011, 1: 483056.8391, 2: 182512.9565, 3: 68979.22179,
    4: 26071.75968, 5: 9854.090990, 6: 3724.532667, 7: 1406.475763,
    8: 531.414010, 9: 200.786148, 10: 75.863783, 11: 28.663897,
    12: 10.830188, 13: 4.092010, 14: 1.546100, 15: 0.584169,
}

DEFAULT_LAYER = "rarity_cells"
ROW_GROUP_ROWS = 100_000


def cell_column(resolution: int) -> str:
    return f"h3_res{resolution}"
