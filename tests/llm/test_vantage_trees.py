"""Vantage-point trees against brute force: exact with factor 1, recall with others."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexrarity.llm import vantage_trees
from hexrarity.llm.queries import op13_vantage_point_search
from tests.llm.conftest import SF


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def by_brute_force(rows, asked, k):
    found = {}
    for query, q in asked:
        scored = [(-product(q, v), i) for i, v in rows if i != query and len(v) == len(q)]
        found[query] = [(i, -s) for s, i in sorted(scored)[:k]]
    return found


def answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = found.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return found


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def test_exact_with_factor_one(spark):
    """Lengths differ, so that the largest product is often no nearest direction; a third
    of the rows are copies of one vector, another third near copies."""
    draw = np.random.default_rng(3)
    vectors = draw.standard_normal((300, 12)) * draw.uniform(0.1, 5, (300, 1))
    copies = [vectors[0]] * 300
    near = list(vectors[1] + 1e-3 * draw.standard_normal((300, 12)))
    rows = list(enumerate([*map(list, vectors), *map(list, copies), *map(list, near)]))
    df = frame(spark, rows).repartition(5)
    asked = [rows[k] for k in (0, 1, 2, 250, 299, 300, 601, 777)]
    found = answers(vantage_trees.nearest(df, frame(spark, asked), 20, factor=1, shard=200))
    assert found == by_brute_force(rows, asked, 20)


def test_recall_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = by_brute_force(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = answers(op13_vantage_point_search(spark, SF))
    assert found.keys() == expected.keys()
    hits = sum(len(set(found[q]) & set(expected[q])) for q in expected)
    assert hits >= 0.95 * sum(map(len, expected.values()))


def test_deep_trees_and_factor():
    """Trees of many levels: factor 1 is exact, larger ones only leave points out."""
    draw = np.random.default_rng(5)
    points = draw.standard_normal((4000, 16))
    ids = np.arange(4000)
    tree = vantage_trees.Tree(ids, points, float(np.sqrt((points**2).sum(1)).max()) * (1 + 1e-9))
    queries, own = points[::100], ids[::100]
    scores = queries @ points.T
    scores[np.arange(len(own)), own] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :10]
    recall = {}
    for factor in (1, 2, 50):
        query, point, score = tree.search(queries, own, 10, factor)
        assert np.allclose(score, scores[query, point], rtol=0, atol=1e-12)
        found = [set(point[query == n]) for n in range(len(own))]
        recall[factor] = np.mean([len(f & set(b)) / 10 for f, b in zip(found, best, strict=True)])
    assert recall[1] == 1 >= recall[2] >= 0.9 > recall[50]


def test_odd_rows(spark, clash):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (None, [9.0, 9.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [2.0, 2.0, 2.0])]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = answers(vantage_trees.nearest(df, df, 20))
    assert found == {1: [(9, 1.0), (9, 1.0), (2, 0.5)], 2: [(1, 0.5), (9, 0.5), (9, 0.5)], 9: [(1, 1.0), (2, 0.5)]}
    assert vantage_trees.nearest(df, df.limit(0), 20).count() == 0
    assert vantage_trees.nearest(df.limit(0), df, 20).count() == 0


@pytest.mark.parametrize("kind", ["array<float>", "array<int>"])
def test_other_numbers(spark, kind):
    rows = [(k, [k, -k, 1]) for k in range(1, 30)]
    df = frame(spark, rows).withColumn("embedding", F.col("embedding").cast(kind))
    assert answers(vantage_trees.nearest(df, df, 3)) == by_brute_force(rows, rows, 3)
