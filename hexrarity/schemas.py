"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from hexrarity.config import RESOLUTIONS, cell_column

# The 50 columns of a raw occurrence download, in file order.
RAW_FIELDS = (
    ("gbifID", "long"),
    ("datasetKey", "string"),
    ("occurrenceID", "string"),
    ("kingdom", "string"),
    ("phylum", "string"),
    ("class", "string"),
    ("order", "string"),
    ("family", "string"),
    ("genus", "string"),
    ("species", "string"),
    ("infraspecificEpithet", "string"),
    ("taxonRank", "string"),
    ("scientificName", "string"),
    ("verbatimScientificName", "string"),
    ("verbatimScientificNameAuthorship", "string"),
    ("countryCode", "string"),
    ("locality", "string"),
    ("stateProvince", "string"),
    ("occurrenceStatus", "string"),
    ("individualCount", "long"),
    ("publishingOrgKey", "string"),
    ("decimalLatitude", "double"),
    ("decimalLongitude", "double"),
    ("coordinateUncertaintyInMeters", "double"),
    ("coordinatePrecision", "double"),
    ("elevation", "double"),
    ("elevationAccuracy", "double"),
    ("depth", "double"),
    ("depthAccuracy", "double"),
    ("eventDate", "string"),
    ("day", "long"),
    ("month", "long"),
    ("year", "long"),
    ("taxonKey", "long"),
    ("speciesKey", "long"),
    ("basisOfRecord", "string"),
    ("institutionCode", "string"),
    ("collectionCode", "string"),
    ("catalogNumber", "string"),
    ("recordNumber", "string"),
    ("identifiedBy", "string"),
    ("dateIdentified", "string"),
    ("license", "string"),
    ("rightsHolder", "string"),
    ("recordedBy", "string"),
    ("typeStatus", "string"),
    ("establishmentMeans", "string"),
    ("lastInterpreted", "string"),
    ("mediaType", "string"),
    ("issue", "string"),
)
RAW_COLUMNS = [name for name, _ in RAW_FIELDS]
RAW = T.StructType()
for _name, _kind in RAW_FIELDS:
    RAW.add(_name, _kind)

OBSERVATION_COLUMNS = (
    "gbifID", "speciesKey", "species", "decimalLatitude", "decimalLongitude",
    "coordinateUncertaintyInMeters", "taxonRank", "recordedBy",
)

SCORE_COLUMNS = (
    "rarity_zscore", "count_species", "count_observations", "count_observers",
    "confidence_scores",
)


def observations_schema(resolutions: tuple[int, ...] = RESOLUTIONS) -> T.StructType:
    fields = [T.StructField(name, RAW[name].dataType) for name in OBSERVATION_COLUMNS]
    fields += [T.StructField(cell_column(r), T.LongType()) for r in resolutions]
    return T.StructType(fields)


OCCUPANCY = T.StructType([
    T.StructField("speciesKey", T.LongType()),
    T.StructField("species", T.StringType()),
    T.StructField("n_observations", T.LongType()),
    T.StructField("occupancy", T.LongType()),
    T.StructField("rarity", T.DoubleType()),
])

SCORES = T.StructType([
    T.StructField("resolution", T.IntegerType()),
    T.StructField("cell", T.LongType()),
    T.StructField("rarity_zscore", T.DoubleType()),
    T.StructField("count_species", T.LongType()),
    T.StructField("count_observations", T.LongType()),
    T.StructField("count_observers", T.LongType()),
    T.StructField("confidence_scores", T.DoubleType()),
])

FEATURES = T.StructType([
    *SCORES.fields,
    T.StructField("h3", T.StringType()),
    T.StructField("ring", T.ArrayType(T.StructType([
        T.StructField("lng", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ]))),
])
