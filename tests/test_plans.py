"""Shape of physical plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks import fixture
from hexrarity.operators.features import cell_features, find_cells
from hexrarity.operators.observations import assign_cells
from hexrarity.operators.occupancy import species_occupancy
from hexrarity.operators.scores import residuals, score_cells, valid_observers
from hexrarity.operators.skew import estimated_bytes, join_dimension, tasks_for
from hexrarity.operators.tiles import tile_features
from hexrarity.sources.tables import read_scores, write_scores

SF = "/root/testdata/sf0.001"


def plan(df, run=False) -> str:
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module", autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def observations(spark):
    return fixture.observation_table(spark, SF)


@pytest.fixture(scope="module")
def occupancy(spark):
    return fixture.occupancy_table(spark, SF)


def shuffles(text: str) -> list[str]:
    return re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning\(([^)]*)\)", text)


def test_small_scores(observations, occupancy):
    text = plan(score_cells(observations, occupancy), run=True)
    # the shuffle of observations serves two branches, that of observer means two
    assert text.count("ReusedExchange") == 2
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert len(scans) == 3  # validity, precise observations, occupancy
    assert not any("gbifID" in s or "decimalLatitude" in s for s in scans)
    assert "LessThanOrEqual(coordinateUncertaintyInMeters,68979.22179)" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SortAggregate" not in text and "Python" not in text
    # observations are shuffled wide: unpivoting comes after, counting needs no shuffle
    wide = text.index("Exchange hashpartitioning(recordedBy")
    assert text.index("Generate explode([3,4,5,6,7])") < wide
    assert not any("cell#" in k and "speciesKey" in k and "recordedBy" in k for k in shuffles(text))


def test_large_scores(spark, observations, occupancy):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = score_cells(observations, occupancy, limit_bytes=0, rows_per_salt=1000)
        text = plan(df)
        final = plan(df, run=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # observers and species are joined on salted keys; only hot keys are broadcast
    keys = shuffles(text)
    assert sum(k.startswith("recordedBy") and "_salt" in k for k in keys) >= 2
    assert sum(k.startswith("speciesKey") and "_salt" in k for k in keys) >= 2
    for line in text.splitlines():
        if "BroadcastHashJoin" in line:
            assert re.search(
                r"BroadcastHashJoin \[(resolution#\d+, )?(recordedBy|speciesKey)#\d+L?\],", line)
    assert "SortAggregate" not in text
    # species are counted within the partitioning of the join with observers
    assert not any("cell#" in k and "speciesKey" in k and "recordedBy" in k for k in keys)
    # both branches read the joined sides from one shuffle each
    assert final.count("ReusedExchange") >= 3


def test_occupancy_hashes_its_bulk(observations):
    text = plan(species_occupancy(observations))
    scan_up = text[: text.index("FileScan")].splitlines()
    aggregates = [line for line in scan_up if "Aggregate(" in line]
    assert "HashAggregate" in aggregates[-1] and "HashAggregate" in aggregates[-2]


def test_observers_are_not_unpivoted_before_grouping(observations):
    text = plan(valid_observers(observations))
    assert text.index("Generate") < text.index("HashAggregate")


def test_cells_are_assigned_once_and_after_the_filter(spark):
    cells = assign_cells(fixture.filtered(spark, SF))
    text = plan(cells.filter(F.col("h3_res3") != F.col("h3_res7")))
    assert text.count("ArrowEvalPython") == 1
    above, below = text.split("ArrowEvalPython")
    assert "SUBSPECIES" not in above and "SUBSPECIES" in below


def test_boundaries_are_drawn_once(spark):
    scores = fixture.hexagon_score_table(spark, SF)
    text = plan(tile_features(cell_features(scores)))
    assert text.count("ArrowEvalPython") == 1 and "pythonUDF1" not in text
    assert "Exchange" not in text


def test_scores_are_pruned_before_they_are_drawn(spark, tmp_path):
    path = str(tmp_path / "scores")
    write_scores(fixture.hexagon_score_table(spark, SF), path)
    stored = read_scores(spark, path)
    wanted = stored.groupBy("resolution").agg(F.max(F.hex("cell")).alias("h3")).where("resolution = 5").first()
    text = find_cells(stored, wanted["h3"].lower())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(resolution" in text and "(resolution#" in text
    assert "EqualTo(cell," in text and "IsNotNull(rarity_zscore)" in text


def test_hot_observer_is_split(spark):
    """One observer with two thirds of the cells: no task of the residual join gets much
    more than its share."""
    rows = spark.range(30_000).selectExpr(
        "5 AS resolution", "id AS cell", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('o', id % 500) END AS recordedBy",
        "1L AS n", "CAST(id % 7 AS DOUBLE) AS mean_rarity")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        joined = residuals(rows, limit_bytes=0, rows_per_salt=500)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 8


def test_size_estimate(spark):
    assert estimated_bytes(spark.range(1000)) == 8000


def test_facts_stay_dealt_by_key(spark):
    """A join that turns into a broadcast as it runs leaves its result partitioned by key,
    so that what follows needs no shuffle of more rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", 1 << 20)
    try:
        fact = spark.range(20_000).selectExpr("id % 50 AS k", "id")
        dimension = spark.range(50).selectExpr("id AS k", "1 AS w", "id * 2 AS v")
        joined = join_dimension(fact, dimension, "k", "w", ["id"], limit_bytes=0, partition=True, tasks=11)
        assert joined.rdd.getNumPartitions() == 11
        found = joined.groupBy("k", "_salt", "id").count()
        assert found.count() == 20_000
        assert not any("id" in keys for keys in shuffles(plan(found, run=True)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_list_shares_the_baselines_shuffles(spark):
    """What finds hot observers asks for the columns that their baselines ask for."""
    rows = spark.range(1000).selectExpr(
        "7 AS resolution", "id AS cell", "concat('o', id % 9) AS recordedBy", "1L AS n", "id * 0.1D AS mean_rarity")
    text = residuals(rows, limit_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("AS observer_cells") == text.count("AS baseline") == 2


def test_number_of_tasks(spark):
    small, large = spark.range(10), spark.range(10**9)
    assert tasks_for(small) is None
    assert tasks_for(large) == -(-8 * 10**9 // (8 << 20))
    assert tasks_for(spark.range(10**12)) == 8  # of unknown size: as many as a shuffle has
