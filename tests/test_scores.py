"""Scores against figures worked by hand and a plain-Python definition."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hexrarity.operators import scores
from hexrarity.operators.occupancy import occupancy_stats, species_occupancy
from hexrarity.operators.skew import join_dimension

SCHEMA = (
    "speciesKey long, species string, recordedBy string, "
    "coordinateUncertaintyInMeters double, h3_res3 long, h3_res5 long"
)
RESOLUTIONS = (3, 5)
EDGE = {3: 100.0, 5: 10.0}


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def occupancy_of(spark, rarity: dict[int, float]):
    rows = [(k, str(k), 1, 1, r) for k, r in rarity.items()]
    return spark.createDataFrame(
        rows, "speciesKey long, species string, n_observations long, occupancy long, rarity double"
    )


def scored(spark, rows, occupancy=None, **options):
    observations = table(spark, rows)
    occupancy = species_occupancy(observations) if occupancy is None else occupancy
    result = scores.score_cells(observations, occupancy, RESOLUTIONS, EDGE, **options)
    return {(r["resolution"], r["cell"]): r.asDict() for r in result.collect()}


def by_definition(rows, rarity):
    """The scores stated one resolution at a time, in plain Python."""
    result = {}
    for place, resolution in enumerate(RESOLUTIONS):
        seen = defaultdict(set)
        for row in rows:
            if row[2] is not None and row[4 + place] is not None:
                seen[row[2]].add(row[4 + place])
        valid = {who for who, cells in seen.items() if len(cells) > 1}
        kept = [
            (row[4 + place], row[2], row[0]) for row in rows
            if row[2] in valid and row[3] is not None and row[3] <= EDGE[resolution]
        ]
        means, found = {}, defaultdict(set)
        for cell, who, key in kept:
            if key in rarity:
                found[cell, who].add(key)
        for pair, keys in found.items():
            means[pair] = sum(rarity[k] for k in keys) / len(keys)
        base = defaultdict(list)
        for (_, who), mean in means.items():
            base[who].append(mean)
        residual = defaultdict(list)
        for (cell, who), mean in means.items():
            residual[cell].append(mean - sum(base[who]) / len(base[who]))
        for cell, values in residual.items():
            if cell is None:
                continue
            here = [row for row in kept if row[0] == cell]
            shares = defaultdict(int)
            for _, who, _ in here:
                shares[who] += 1
            entropy = -sum(n / len(here) * math.log(n / len(here)) for n in shares.values())
            result[resolution, cell] = {
                "rarity_zscore": sum(values) / len(values),
                "count_species": len({k for *_, k in here if k is not None}),
                "count_observations": len(here),
                "count_observers": len(shares),
                "confidence_scores": (1 - math.exp(-math.exp(entropy) / 4))
                * (1 - math.exp(-len(here) / 40)),
            }
    return result


def assert_same(got, expected):
    assert set(got) == set(expected)
    for key, values in expected.items():
        for name, value in values.items():
            assert got[key][name] == pytest.approx(value, abs=1e-12), (key, name)


def random_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        who = rng.choice(["a", "b", "c", "d", f"once-{rng.randrange(40)}", None])
        cell = rng.choice([1, 2, 3, 4, None])
        key = rng.choice([None, *range(8)])
        uncertainty = rng.choice([None, 5.0, 10.0, 50.0, 100.0, 500.0])
        fine = None if cell is None else cell * 10 + rng.randrange(3)
        rows.append((key, f"name {key}", who, uncertainty, cell, fine))
    return rows


def golden_rows():
    # observer, species, cell (both resolutions), all precise
    seen = [
        ("ann", 1, 1), ("ann", 1, 1), ("ann", 2, 1), ("ann", 3, 2),
        ("bob", 2, 1), ("bob", 2, 2), ("bob", 4, 2), ("bob", 4, 2),
        ("cid", 1, 2), ("cid", 3, 3), ("cid", 3, 3), ("cid", 4, 3),
    ]
    return [(key, f"s{key}", who, 1.0, cell, cell) for who, key, cell in seen]


def test_worked_by_hand(spark):
    rarity = {1: 1.0, 2: 0.5, 3: 0.2, 4: 0.4}
    got = scored(spark, golden_rows(), occupancy_of(spark, rarity))
    # means: ann 0.75 / 0.2, bob 0.5 / 0.45, cid 1.0 / 0.3
    # baselines: ann 0.475, bob 0.475, cid 0.65
    one, two, three = got[3, 1], got[3, 2], got[3, 3]
    assert one["rarity_zscore"] == pytest.approx(((0.75 - 0.475) + (0.5 - 0.475)) / 2)
    assert two["rarity_zscore"] == pytest.approx(
        ((0.2 - 0.475) + (0.45 - 0.475) + (1.0 - 0.65)) / 3
    )
    assert three["rarity_zscore"] == pytest.approx(0.3 - 0.65)
    assert (one["count_observations"], one["count_species"], one["count_observers"]) == (4, 2, 2)
    assert (two["count_observations"], two["count_species"], two["count_observers"]) == (5, 4, 3)
    neff = math.exp(-(0.75 * math.log(0.75) + 0.25 * math.log(0.25)))
    assert one["confidence_scores"] == pytest.approx(
        (1 - math.exp(-neff / 4)) * (1 - math.exp(-4 / 40))
    )
    assert {k[0] for k in got} == {3, 5}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_definition(spark, seed):
    rows = random_rows(seed)
    rarity = {k: 1 / (k + 1) for k in range(6)}  # species 6 and 7 have no occupancy
    expected = by_definition(rows, rarity)
    assert expected
    assert_same(scored(spark, rows, occupancy_of(spark, rarity)), expected)


@pytest.mark.parametrize("rows_per_salt", [1, 7])
def test_split_hot_keys_give_the_same(spark, rows_per_salt):
    # one observer and one species hold most rows; no side may be broadcast
    rows = random_rows(4) + [
        (1, "name 1", "hot", 5.0, i % 5, i % 5 * 10) for i in range(600)
    ]
    rarity = {k: 1 / (k + 1) for k in range(6)}
    occupancy = occupancy_of(spark, rarity).withColumn(
        "n_observations", F.when(F.col("speciesKey") == 1, 700).otherwise(50).cast("long")
    )
    got = scored(spark, rows, occupancy, limit_bytes=0, rows_per_salt=rows_per_salt)
    assert_same(got, by_definition(rows, rarity))


def test_hot_key_join_spreads_rows(spark):
    fact = spark.range(1000).selectExpr("0L AS k", "id")
    dimension = spark.createDataFrame([(0, 1000, "x"), (1, 1, "y")], "k long, w long, v string")
    joined = join_dimension(fact, dimension, "k", "w", ["id"], limit_bytes=0, rows_per_salt=100)
    assert joined.count() == 1000 and joined.columns == ["k", "id", "v"]
    plan = joined._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_single_observer_cell(spark):
    rows = [(k, "s", "ann", 1.0, 1, 1) for k in (1, 2, 1)] + [
        (1, "s", "ann", 1.0, 2, 2), (3, "s", "eve", 1.0, 1, 1),
    ]
    got = scored(spark, rows)
    # eve was seen in one cell only: neither counted nor scored
    assert got[3, 1]["count_observers"] == 1 and got[3, 1]["count_species"] == 2
    assert got[3, 1]["confidence_scores"] == pytest.approx(
        (1 - math.exp(-1 / 4)) * (1 - math.exp(-3 / 40))
    )


def test_valid_observer_left_with_one_precise_cell(spark):
    rows = [(1, "a", "ann", 1.0, 1, 1), (2, "b", "ann", 1.0, 1, 1), (3, "c", "ann", 999.0, 2, 2)]
    got = scored(spark, rows)
    assert set(got) == {(3, 1), (5, 1)}
    assert got[3, 1]["rarity_zscore"] == 0


def test_missing_uncertainty_and_species(spark):
    rows = [
        (1, "a", "ann", None, 1, 1), (2, "b", "ann", 1.0, 2, 2), (2, "b", "ann", 1.0, 1, 1),
        (9, "z", "bob", 1.0, 1, 1), (9, "z", "bob", 1.0, 3, 3),
    ]
    got = scored(spark, rows, occupancy_of(spark, {1: 1.0, 2: 0.5}))
    assert (3, 3) not in got  # none of its species has an occupancy
    # bob counts in cell 1 though none of their species is rated
    assert got[3, 1]["count_observers"] == 2 and got[3, 1]["count_observations"] == 2
    assert got[3, 1]["rarity_zscore"] == 0


def test_duplicating_observations(spark):
    rows = random_rows(5)
    once, twice = scored(spark, rows), scored(spark, rows + rows)
    assert set(once) == set(twice)
    for key, row in once.items():
        assert twice[key]["rarity_zscore"] == pytest.approx(row["rarity_zscore"], abs=1e-12)
        assert twice[key]["count_observations"] == 2 * row["count_observations"]
        assert twice[key]["count_observers"] == row["count_observers"]


def test_ranges(spark):
    rows = random_rows(6)
    occupancy = species_occupancy(table(spark, rows))
    assert all(0 < r["rarity"] <= 1 for r in occupancy.collect())
    rarity = scores.observer_rarity(scores.species_counts(
        scores.scored_observations(table(spark, rows), occupancy, RESOLUTIONS, EDGE)
    ))
    for row in scores.cell_diversity(rarity).collect():
        assert 1 <= row["neff_observers"] <= row["count_observers"] + 1e-9
    total = scores.residuals(rarity).groupBy("resolution", "recordedBy").agg(
        F.sum("residual").alias("s")
    )
    assert all(abs(r["s"] or 0) < 1e-9 for r in total.collect())


def test_occupancy(spark):
    rows = [
        (1, "b", "x", None, 1, 10), (1, "a", "x", None, 1, 10), (1, "b", "y", None, 2, 20),
        (2, None, "x", None, 1, 10), (3, "c", "x", None, 1, None), (None, "d", "x", None, 1, 10),
    ]
    got = {r["speciesKey"]: r for r in species_occupancy(table(spark, rows)).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["species"], got[1]["n_observations"], got[1]["occupancy"]) == ("a", 3, 2)
    assert got[1]["rarity"] == pytest.approx(1 / math.sqrt(2))
    assert got[2]["species"] is None and got[2]["rarity"] == 1
    stats = occupancy_stats(species_occupancy(table(spark, rows))).first()
    assert (stats["n_species"], stats["min_occupancy"], stats["max_occupancy"]) == (2, 1, 2)
    assert stats["avg_occupancy"] == 1.5
