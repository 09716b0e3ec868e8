"""Headline timings: one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_DUCKDB=1 adds DuckDB's seconds on the same stored tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from checks import fixture, queries
from hexrarity.operators import occupancy, scores
from hexrarity.operators.features import cell_features
from hexrarity.operators.summary import summarize
from hexrarity.operators.tiles import tile_features

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, repeats: int = 5) -> float:
    """Best of a few runs; the first also warms the JVM up."""
    best = float("inf")
    for _ in range(repeats):
        start = time.monotonic()
        action()
        best = min(best, time.monotonic() - start)
    return round(best, 3)


def headline(spark: SparkSession):
    observations = fixture.observation_table(spark, SF_DIR)
    species = fixture.occupancy_table(spark, SF_DIR)
    score_table = fixture.score_table(spark, SF_DIR)
    hexagons = fixture.hexagon_score_table(spark, SF_DIR)
    return {
        "filter_observations": lambda: fixture.filtered(spark, SF_DIR),
        "assign_cells": lambda: queries.assign_cells(spark, SF_DIR),
        "species_occupancy": lambda: occupancy.species_occupancy(observations),
        "valid_observers": lambda: scores.valid_observers(observations),
        "cell_scores": lambda: scores.score_cells(observations, species),
        "score_summary": lambda: summarize(score_table),
        "hexagon_features": lambda: cell_features(hexagons),
        "hexagon_tiles": lambda: tile_features(cell_features(hexagons)),
        "tile_index": lambda: queries.tile_index(spark, SF_DIR),
        "style_rarity": lambda: queries.style_rarity(spark, SF_DIR),
    }


def duckdb_seconds(spark: SparkSession) -> dict[str, float]:
    """The definitions' SQL on the stored observation table."""
    import duckdb

    from checks import oracle

    connection = duckdb.connect()
    connection.execute(f"SET threads = {CPUS}")
    fixture.observation_table(spark, SF_DIR)
    folder = fixture.stored_path(spark, SF_DIR, "observations")
    with_obs = (
        f"WITH obs AS (SELECT * FROM read_parquet('{folder.removeprefix('file:')}/*.parquet')),"
        f"{oracle.SCORING}"
    )
    sql = {
        "species_occupancy": f"{with_obs} SELECT * FROM occupancy",
        "valid_observers": f"{with_obs} SELECT * FROM valid",
        "cell_scores": f"{with_obs} SELECT * FROM scores",
    }
    for table in ("lineitem", "orders", "part", "supplier"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
        )
    sql["filter_observations"] = oracle.ORACLE["filter_observations"]
    sql["assign_cells"] = oracle.ORACLE["assign_cells"]
    sql["score_summary"] = oracle.ORACLE["score_summary"]
    sql["tile_index"] = oracle.ORACLE["tile_index"]
    sql["style_rarity"] = oracle.ORACLE["style_rarity"]
    return {name: timed(lambda: connection.execute(text).to_arrow_table())
            for name, text in sql.items()}


def main() -> None:
    spark = session()
    start = time.monotonic()
    plans = headline(spark)
    stored = round(time.monotonic() - start, 3)
    seconds = {name: timed(lambda: run(build())) for name, build in plans.items()}
    result = {
        "metric": "headline queries, total of best runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": CPUS,
        "stage_tables_sec": stored,
    }
    if os.environ.get("BENCH_DUCKDB"):
        result["duckdb"] = duckdb_seconds(spark)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
