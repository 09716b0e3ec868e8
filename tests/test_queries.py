"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_contract(spark):
    queries, oracle = driver.queries(), driver.oracle_sql()
    assert set(oracle) <= set(queries)
    df = driver.entry(spark)
    assert df.columns == [
        "resolution", "cell", "rarity_zscore", "count_species", "count_observations",
        "count_observers", "confidence_scores",
    ]
    per_resolution = {r["resolution"]: r["count"] for r in df.groupBy("resolution").count().collect()}
    assert per_resolution == {3: 395, 4: 520, 5: 588, 6: 695, 7: 565}


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, connection, name):
    queries, oracle = driver.queries(), driver.oracle_sql()
    assert differences(spark, connection, SF, name, queries, oracle) == ""
