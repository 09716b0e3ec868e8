"""Cells as polygon features."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexrarity.functions.geometry import (
    close_ring, ring_bbox, ring_coordinates, unwrap_dateline,
)
from hexrarity.functions.grid import cell_hex, cell_to_boundary
from hexrarity.schemas import SCORE_COLUMNS

OBSERVATIONS_URL = "https://www.inaturalist.org/observations"


def complete_scores(scores: DataFrame) -> DataFrame:
    """Rows with a cell and all five score columns."""
    # One condition per column: Parquet can skip row groups by these.
    complete = F.lit(True)
    for name in ("cell", *SCORE_COLUMNS):
        complete = complete & F.col(name).isNotNull()
    return scores.where(complete)


def cell_features(scores: DataFrame) -> DataFrame:
    """Complete scores with ``h3`` (hex id) and ``ring``: the closed boundary,
    continuous across the date line."""
    drawn = complete_scores(scores).select(
        "*",
        cell_hex(F.col("cell")).alias("h3"),
        cell_to_boundary(F.col("cell")).alias("ring"),
    )
    # a step of its own each: the expressions refer to the ring more than once
    return drawn.withColumn("ring", unwrap_dateline(F.col("ring"))).withColumn(
        "ring", close_ring(F.col("ring"))
    )


def feature_json(ring: Column | None = None) -> Column:
    """GeoJSON feature text of a ``cell_features`` row."""
    ring = F.col("ring") if ring is None else ring
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Polygon").alias("type"),
            F.array(ring_coordinates(ring)).alias("coordinates"),
        ).alias("geometry"),
        F.struct("h3", *SCORE_COLUMNS).alias("properties"),
    ))


def cell_bbox(features: DataFrame) -> DataFrame:
    return features.withColumns(ring_bbox(F.col("ring")))


def cell_links(boxed: DataFrame) -> DataFrame:
    """Add ``url``: the public observations inside each cell's bounding box."""
    def degrees(name: str) -> Column:
        # whole degrees are written without a decimal point, small ones without exponent
        text = F.col(name).cast("string")
        plain = F.regexp_replace(F.col(name).cast("decimal(38,20)").cast("string"), r"0+$", "")
        return F.when(text.contains("E"), plain).otherwise(F.regexp_replace(text, r"\.0$", ""))

    query = F.concat_ws("&", *(
        F.concat(F.lit(f"{name}="), F.url_encode(degrees(name)))
        for name in ("nelat", "nelng", "swlat", "swlng")
    ), F.lit("subview=map"), F.lit("quality_grade=research"))
    return boxed.withColumn("url", F.concat(F.lit(f"{OBSERVATIONS_URL}?"), query))


def find_cells(scores: DataFrame, *h3: str) -> DataFrame:
    """Features of the cells with these hex ids. A cell's id holds its resolution, so the
    scan reads only partitions and row groups that can have it, and only what is found
    is drawn. A text that is no id of 64 bits finds nothing."""
    ids = [int(h, 16) for h in h3 if re.fullmatch("[0-9a-f]{1,16}", h)]
    ids = [i for i in ids if i < 2**63 and f"{i:x}" in h3]
    wanted = scores.where(
        F.col("resolution").isin(*{i >> 52 & 15 for i in ids})
        & F.col("cell").isin(*map(F.lit, ids))
    )
    return cell_features(wanted)
