"""Grid functions as Columns.

Cell assignment and cell boundaries run as Arrow-batched UDFs; everything else
is built in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexrarity.config import EDGE_LENGTH_M, cell_column
from hexrarity.functions import hexgrid

# Executors need not have this package installed: the grid code travels with the
# UDF instead of being imported by name.
cloudpickle.register_pickle_by_value(hexgrid)

RING_TYPE = T.ArrayType(T.StructType([
    T.StructField("lng", T.DoubleType(), False),
    T.StructField("lat", T.DoubleType(), False),
]), False)


def _once(udf):
    """Keep the optimizer from copying the call into filters on its result, which
    would run it twice. (The functions are deterministic.)"""
    return udf.asNondeterministic()


def latlng_to_cells(lat: Column, lng: Column, resolutions: Sequence[int]) -> Column:
    """Struct with one cell id (long) per resolution; NULL fields where a
    coordinate is NULL or not finite."""
    resolutions = tuple(resolutions)
    names = [cell_column(r) for r in resolutions]
    encode = hexgrid.encode

    def cells(lat: pa.Array, lng: pa.Array) -> pa.Array:
        y = lat.to_numpy(zero_copy_only=False)
        x = lng.to_numpy(zero_copy_only=False)
        bad = ~(np.isfinite(y) & np.isfinite(x))
        ids = encode(np.where(bad, 0.0, y), np.where(bad, 0.0, x), resolutions)
        return pa.StructArray.from_arrays(
            [pa.array(i, type=pa.int64(), mask=bad) for i in ids], names=names
        )

    schema = T.StructType([T.StructField(name, T.LongType()) for name in names])
    return _once(F.arrow_udf(cells, returnType=schema))(lat.cast("double"), lng.cast("double"))


def cell_to_boundary(cell: Column) -> Column:
    """Unclosed ring of a cell, counter-clockwise, as ``array<struct<lng,lat>>``
    in degrees, longitudes within +-180."""
    outline = hexgrid.boundary

    def rings(cell: pa.Array) -> pa.Array:
        missing = cell.is_null().to_numpy(zero_copy_only=False)
        ids = cell.fill_null(0x8001FFFFFFFFFFF).to_numpy(zero_copy_only=False)
        lat, lng, keep = outline(ids)
        keep = keep & ~missing[:, None]
        points = pa.StructArray.from_arrays(
            [pa.array(lng[keep]), pa.array(lat[keep])],
            fields=[pa.field("lng", pa.float64(), False), pa.field("lat", pa.float64(), False)],
        )
        offsets = np.concatenate([[0], keep.sum(1).cumsum()]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), points, mask=pa.array(missing),
            type=pa.list_(pa.field("element", points.type, False)),
        )

    return _once(F.arrow_udf(rings, returnType=RING_TYPE))(cell.cast("long"))


def cell_hex(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def hex_cell(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def edge_length(
    resolution: Column, edge_m: Mapping[int, float] = EDGE_LENGTH_M
) -> Column:
    """Average hexagon edge length in metres; NULL for an unknown resolution."""
    table = F.create_map(*(F.lit(x) for pair in edge_m.items() for x in pair))
    return F.try_element_at(table, resolution)
