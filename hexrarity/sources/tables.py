"""Parquet, GeoJSON-lines and summary readers and writers.

All writers run on the executors; nothing passes through the driver but counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hexrarity.config import ROW_GROUP_ROWS, cell_column
from hexrarity.operators.features import feature_json
from hexrarity.schemas import SCORE_COLUMNS, SCORES


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write Parquet (ZSTD, row groups of at most 100 000 rows); returns the
    number of rows, counted during the write."""
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", str(ROW_GROUP_ROWS))
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return written.get["rows"]


def write_scores(scores: DataFrame, path: str) -> int:
    """Score table, one directory per resolution, clustered and sorted by cell."""
    clustered = scores.repartitionByRange("resolution", "cell").sortWithinPartitions(
        "resolution", "cell"
    )
    return write_table(clustered, path, ["resolution"])


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORES).parquet(path).select(*SCORES.fieldNames())


def scores_for(scores: DataFrame, resolution: int) -> DataFrame:
    """One resolution's scores, its cell column named ``h3_res{r}``."""
    return scores.filter(F.col("resolution") == resolution).select(
        F.col("cell").alias(cell_column(resolution)), *SCORE_COLUMNS
    )


def scores_from(table: DataFrame, resolution: int) -> DataFrame:
    """Inverse of ``scores_for``. Unsigned 64-bit columns, which Spark reads as
    decimals, become longs."""
    longs = {"count_species", "count_observations", "count_observers"}
    return table.select(
        F.lit(resolution).alias("resolution"),
        F.col(cell_column(resolution)).cast("long").alias("cell"),
        *(F.col(c).cast("long" if c in longs else "double").alias(c) for c in SCORE_COLUMNS),
    )


def write_geojsonseq(
    features: DataFrame,
    path: str,
    resolutions: Sequence[int],
    batch_size: int | None = None,
) -> dict[int, int]:
    """One GeoJSON feature per line, one directory per resolution, files of at
    most ``batch_size`` lines. Returns the features written per resolution."""
    counts = Observation()
    per_resolution = [
        F.count(F.when(F.col("resolution") == r, 1)).alias(str(r)) for r in resolutions
    ]
    writer = (
        features.filter(F.col("resolution").isin(*resolutions))
        .observe(counts, *per_resolution)
        .select("resolution", feature_json().alias("value"))
        .write.mode("overwrite").partitionBy("resolution")
    )
    if batch_size is not None:
        writer = writer.option("maxRecordsPerFile", batch_size)
    writer.text(path)
    return {int(r): n for r, n in counts.get.items()}


def summary_json(summary: DataFrame) -> DataFrame:
    """The whole summary as one JSON object keyed by resolution, in one row. The
    summary has at most 16 rows."""
    lists = [c for c in summary.columns if c != "resolution"]
    entries = F.array_sort(F.collect_list(F.struct("resolution", F.struct(*lists).alias("s"))))
    keyed = F.map_from_entries(F.transform(
        entries, lambda e: F.struct(e["resolution"].cast("string"), e["s"])
    ))
    return summary.agg(F.to_json(keyed).alias("value"))


def write_summary(summary: DataFrame, path: str) -> None:
    summary_json(summary).coalesce(1).write.mode("overwrite").text(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Summary table back from ``write_summary``'s JSON."""
    shape = (
        "map<string, struct<rarity_quantiles: array<double>, "
        "count_observations_quantiles: array<double>, "
        "count_species_quantiles: array<double>, "
        "count_observers_quantiles: array<double>, "
        "confidence_scores_quantiles: array<double>>>"
    )
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", shape)).alias("resolution", "s"))
        .select(F.col("resolution").cast("int").alias("resolution"), "s.*")
    )
