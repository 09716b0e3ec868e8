from __future__ import annotations

import json

import numpy as np
import pytest

from hexrarity.operators.summary import QUANTILES, radix_quantiles, ranked_quantiles, summarize
from hexrarity.sources.tables import read_summary, write_summary

SCHEMA = (
    "resolution int, cell long, rarity_zscore double, count_species long, "
    "count_observations long, count_observers long, confidence_scores double"
)


def score_rows(sizes, seed=3):
    rng = np.random.default_rng(seed)
    for resolution, n in sizes.items():
        rarity = rng.normal(size=n)
        counts = rng.geometric(0.3, size=(3, n))
        share = rng.random(n)
        for i in range(n):
            yield (resolution, i, float(rarity[i]), *(int(c) for c in counts[:, i]), float(share[i]))


@pytest.mark.parametrize("sizes", [{3: 1, 4: 2, 5: 3, 6: 10}, {3: 41, 7: 60_000}])
@pytest.mark.parametrize("quantiles", [ranked_quantiles, radix_quantiles])
def test_exact_interpolated_quantiles(spark, sizes, quantiles):
    rows = list(score_rows(sizes))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["resolution"]: r for r in summarize(df, quantiles).collect()}
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    assert set(got) == set(sizes)
    for resolution in sizes:
        for column, (name, probabilities) in QUANTILES.items():
            values = [row[names.index(column)] for row in rows if row[0] == resolution]
            expected = np.quantile(np.array(values, dtype=float), probabilities)
            assert got[resolution][name] == pytest.approx(list(expected), rel=1e-12)


def test_columns_without_values(spark):
    """A column that is NULL throughout has no list, at any size of the table; a
    resolution without any value still has a row."""
    for sizes in ({3: 5, 4: 5, 5: 5}, {3: 20_000, 4: 20_000, 5: 20_000}):
        rows = [
            (r[0], r[1], None if r[0] == 3 else r[2], *((None,) * 4 if r[0] == 5 else r[3:]))
            if r[0] != 5 else (r[0], r[1], *(None,) * 5)
            for r in score_rows(sizes)
        ]
        got = {r["resolution"]: r for r in summarize(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert set(got) == {3, 4, 5}
        assert got[3]["rarity_quantiles"] is None and len(got[3]["count_species_quantiles"]) == 3
        assert len(got[4]["rarity_quantiles"]) == 4
        assert all(got[5][name] is None for name, _ in QUANTILES.values())


def test_written_summary(spark, tmp_path):
    summary = summarize(spark.createDataFrame(list(score_rows({5: 4, 3: 5})), SCHEMA))
    write_summary(summary, str(tmp_path / "summary"))
    (part,) = (tmp_path / "summary").glob("part-*")
    written = json.loads(part.read_text())
    assert list(written) == ["3", "5"]
    assert [len(v) for v in written["5"].values()] == [4, 3, 3, 3, 3]
    back = read_summary(spark, str(tmp_path / "summary"))
    assert sorted(back.collect()) == sorted(summary.select(*back.columns).collect())


def test_radix_of_odd_values(spark):
    """Zeros, the smallest and largest doubles, infinities, and ranks among equal values."""
    values = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 1.0, 1.0, 2.0**-1022, -2.0, 2.0 - 2**-52] * 3
    rows = [(5, k, v, 1, 1, 1, float("inf") if k else 0.5) for k, v in enumerate(values)]
    row = summarize(spark.createDataFrame(rows, SCHEMA), radix_quantiles).first()
    probabilities = QUANTILES["rarity_zscore"][1]
    assert row["rarity_quantiles"] == pytest.approx(list(np.quantile(np.array(values), probabilities)), rel=1e-12)
    assert row["count_species_quantiles"] == [1.0, 1.0, 1.0]
