"""Observation tables derived from the driver's tables.

The driver's tables hold no coordinates. ``RAW_SQL`` makes occurrence-like rows
of every order line; Spark and DuckDB run the same text. Lattice cells (squares
of a power-of-two size in degrees) stand in for hexagons where a query is
compared with SQL, since scoring does not depend on what a cell is.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexrarity.config import RESOLUTIONS, cell_column
from hexrarity.functions.geometry import close_ring, point, unwrap_dateline
from hexrarity.functions.grid import cell_hex
from hexrarity.operators.features import complete_scores
from hexrarity.operators.observations import assign_cells, filter_observations
from hexrarity.operators.occupancy import species_occupancy
from hexrarity.operators.scores import score_cells
from hexrarity.operators.skew import estimated_bytes
from hexrarity.plans.stages import (
    Store, clean, count_species, draw, run, score, tile,
)
from hexrarity.schemas import RAW_COLUMNS, SCORE_COLUMNS
from hexrarity.sources.occurrences import read_occurrences
from hexrarity.sources.tables import write_table

RAW_SQL = """
WITH b AS (
 SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_returnflag,
  o.o_custkey, p.p_name, s.s_nationkey,
  l.l_orderkey % 41 = 0 AS solo,
  CASE WHEN l.l_orderkey % 41 = 0 THEN l.l_orderkey % 1000
       ELSE (o.o_custkey % 40)*25 + l.l_suppkey % 25 END AS site
 FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
 JOIN part p ON l.l_partkey=p.p_partkey JOIN supplier s ON l.l_suppkey=s.s_suppkey)
SELECT
 l_orderkey*10 + l_linenumber AS gbifID,
 CASE WHEN l_orderkey % 97 = 0 THEN NULL
      ELSE l_partkey % 150 + (l_partkey % 7)*(l_partkey % 13) END AS speciesKey,
 p_name AS species,
 CAST((site*7919 + (l_linenumber % 3)*4) % 1900 AS DOUBLE)/CAST(10 AS DOUBLE)
   - CAST(95 AS DOUBLE) AS decimalLatitude,
 CAST((site*104729 + (l_linenumber % 2)*9) % 3600 AS DOUBLE)/CAST(10 AS DOUBLE)
   - CAST(180 AS DOUBLE) AS decimalLongitude,
 CASE WHEN l_linenumber = 7 THEN NULL
      WHEN l_linenumber % 2 = 0 THEN l_quantity * CAST(1500 AS DOUBLE)
      ELSE l_quantity * CAST(60 AS DOUBLE) END AS coordinateUncertaintyInMeters,
 CASE WHEN l_returnflag = 'R' AND l_linenumber > 2 THEN 'SUBSPECIES' ELSE 'SPECIES' END
   AS taxonRank,
 CASE WHEN o_custkey % 53 = 0 THEN NULL
      WHEN solo THEN concat('solo-', CAST(l_orderkey AS VARCHAR(20)))
      ELSE concat('obs-', CAST(o_custkey % 300 AS VARCHAR(20))) END AS recordedBy,
 CASE WHEN s_nationkey % 5 = 0 THEN 'IT'
      ELSE concat('N', CAST(s_nationkey AS VARCHAR(10))) END AS countryCode
FROM b
"""

LATTICE_DEGREES = {3: 8, 4: 4, 5: 2, 6: 1, 7: 0.5}


def raw_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("lineitem", "orders", "part", "supplier")
    }
    text = reduce(
        lambda sql, name: sql.replace(f"{name} {name[0]} ", f"{{{name}}} {name[0]} "),
        tables, RAW_SQL,
    )
    return spark.sql(text, **tables)


def lattice_cells(observations: DataFrame) -> DataFrame:
    """Add ``h3_res{r}`` columns holding lattice cells."""
    def cell(size: float):
        row = F.floor((F.col("decimalLatitude") + F.lit(90.0)) / F.lit(float(size)))
        col = F.floor((F.col("decimalLongitude") + F.lit(180.0)) / F.lit(float(size)))
        return row.cast("long") * 10000 + col.cast("long")

    return observations.withColumns(
        {cell_column(r): cell(LATTICE_DEGREES[r]) for r in RESOLUTIONS}
    )


def filtered(spark: SparkSession, sf_dir: str, country: str | None = None) -> DataFrame:
    return filter_observations(raw_occurrences(spark, sf_dir), country)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_cells(filtered(spark, sf_dir))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hexrarity-"))
        folder = context.getCheckpointDir()
    return folder


_stored: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A stage's table, written once per application to the shared folder, as the
    stages of a run exchange them. Readers then see its true size."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        write_table(build(), path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def stored_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return _stored[(spark.sparkContext.applicationId, sf_dir, name)]


def observation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "observations", lambda: observations(spark, sf_dir))


def occupancy_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "occupancy",
        lambda: species_occupancy(observation_table(spark, sf_dir)),
    )


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "scores",
        lambda: score_cells(
            observation_table(spark, sf_dir), occupancy_table(spark, sf_dir)
        ),
    )


def hexagon_observation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "hexagon_observations",
        lambda: assign_cells(filtered(spark, sf_dir)),
    )


def hexagon_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        table = hexagon_observation_table(spark, sf_dir)
        species = stored(spark, sf_dir, "hexagon_occupancy", lambda: species_occupancy(table))
        return score_cells(table, species)

    return stored(spark, sf_dir, "hexagon_scores", build)


def lattice_ring(scores: DataFrame) -> DataFrame:
    """Add ``ring``, the unclosed square of a lattice cell, moved half a cell east
    so that some squares straddle the date line; longitudes within +-180."""
    sizes = F.create_map(*(F.lit(float(x)) for p in LATTICE_DEGREES.items() for x in p))
    size = sizes[F.col("resolution").cast("double")]
    south = F.floor(F.col("cell") / 10000) * size - 90.0
    west = (F.col("cell") % 10000) * size - 180.0 + size / 2

    def corner(east: int, north: int):
        lng = F.col("_west") + F.col("_size") * east
        lat = F.least(F.col("_south") + F.col("_size") * north, F.lit(90.0))
        return point(F.when(lng > 180, lng - 360.0).otherwise(lng), lat)

    return scores.withColumns({"_size": size, "_south": south, "_west": west}).withColumn(
        "ring", F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))
    ).drop("_size", "_south", "_west")


def lattice_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features like ``cell_features``, of lattice squares."""
    return lattice_ring(complete_scores(score_table(spark, sf_dir))).select(
        "resolution", "cell", *SCORE_COLUMNS,
        cell_hex(F.col("cell")).alias("h3"),
        close_ring(unwrap_dateline(F.col("ring"))).alias("ring"),
    )


#: Beyond so many rows a raw file of two bytes a character is packed, in files of so many
#: that a task reads whole: most of its 50 columns are empty, so plain it is many times its
#: tables' size.
PLAIN_ROWS, PACKED_ROWS = 2_000_000, 250_000


def raw_file(spark: SparkSession, sf_dir: str, encoding: str = "UTF-8", faulty: bool = False) -> str:
    """The raw rows as a download: 50 tab-separated columns, a header per file. With
    ``faulty`` some rows are too long, too short, have no number or a quoted tab. Of large
    tables, those in UTF-16 are gzip files."""
    key = (spark.sparkContext.applicationId, sf_dir, f"raw-{encoding}-{faulty}")
    if key in _stored:
        return _stored[key]
    raw = raw_occurrences(spark, sf_dir)
    fields = [
        F.coalesce(F.col(name).cast("string"), F.lit("")) if name in raw.columns else F.lit("")
        for name in RAW_COLUMNS
    ]
    line = F.concat_ws("\t", *fields)
    if faulty:
        fault = F.col("gbifID") % 50
        north = list(fields)
        north[RAW_COLUMNS.index("decimalLatitude")] = F.lit("north")
        quoted = list(fields)
        quoted[RAW_COLUMNS.index("locality")] = F.lit('"a\tb ""c"""')
        line = (
            F.when(fault == 1, F.concat(line, F.lit("\tone\tmore")))
            .when(fault == 2, F.concat_ws("\t", *fields[:40]))
            .when(fault == 3, F.concat_ws("\t", *north))
            .when(fault == 4, F.concat_ws("\t", *quoted))
            .otherwise(line)
        )
    packed = {}
    if encoding != "UTF-8" and spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() > PLAIN_ROWS:
        packed = {"compression": "gzip", "maxRecordsPerFile": PACKED_ROWS}
    path = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    (
        raw.select(line.alias("\t".join(RAW_COLUMNS)))
        .write.options(**packed).option("header", True).option("sep", "\u0001").option("quote", "\u0000")
        .option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False)
        .option("encoding", encoding).csv(path)
    )
    _stored[key] = path
    return path


BREAKS = '"a\nb ""c""\n\t\nd"'
#: Rows of a file with breaks, and bytes of its splits, about: small, so that small tables
#: have many of them. Larger tables have larger ones instead of more than so many.
FILE_ROWS, SPLIT_BYTES = 50_000, 1 << 18
FILES, SPLITS = 96, 1_000


def raw_file_with_breaks(spark: SparkSession, sf_dir: str) -> str:
    """The raw rows as a download in which every seventh row has line breaks within quotes."""
    key = (spark.sparkContext.applicationId, sf_dir, "raw-breaks")
    if key not in _stored:
        raw = raw_occurrences(spark, sf_dir)
        broken = F.when(F.col("gbifID") % 7 == 0, F.lit(BREAKS)).otherwise(F.lit(""))
        fields = [
            F.coalesce(F.col(name).cast("string"), F.lit("")) if name in raw.columns
            else broken if name == "locality" else F.lit("")
            for name in RAW_COLUMNS
        ]
        files = min(raw.count() // FILE_ROWS + 1, FILES)
        rows = raw.select(
            F.pmod(F.xxhash64("gbifID"), F.lit(files)).alias("file"), F.lit(1).alias("place"),
            F.concat_ws("\t", *fields).alias("value"))
        heads = spark.range(files).select(
            F.col("id").alias("file"), F.lit(0).alias("place"), F.lit("\t".join(RAW_COLUMNS)).alias("value"))
        path = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
        (
            heads.unionByName(rows).repartition("file").sortWithinPartitions("file", "place")
            .select("file", "value").write.partitionBy("file").text(path)
        )
        _stored[key] = path
    return _stored[key]


def multiline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That file as it is read in many splits; stored, so that the size of a split holds."""
    path = raw_file_with_breaks(spark, sf_dir)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(SPLIT_BYTES, estimated_bytes(spark.read.text(path)) // SPLITS)))
    try:
        return stored(spark, sf_dir, "multiline", lambda: read_occurrences(spark, path))
    finally:
        spark.conf.set(key, before)


def whole_run(spark: SparkSession, sf_dir: str) -> Store:
    """A run of all stages from a faulty raw file, in a folder of its own."""
    key = (spark.sparkContext.applicationId, sf_dir, "run")
    if key not in _stored:
        _stored[key] = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
        store = Store(spark, _stored[key])
        run(store, [tile(), draw(), score(), count_species(), clean(raw_file(spark, sf_dir))])
    return Store(spark, _stored[key])
