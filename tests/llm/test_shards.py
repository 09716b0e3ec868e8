"""Sharding: the law, the tree, slots."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from hexrarity.llm import shards
from tests.llm.conftest import SF


def moved(spark, before, after, rows=20_000):
    df = spark.range(rows).withColumnRenamed("id", "doc_id")
    both = shards.descend(shards.descend(df, before, "doc_id", "old"), after, "doc_id", "new")
    return [(r["old"], r["new"]) for r in both.select("old", "new").collect()]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for count in (40, 41, 43):
        tree = shards.tree(40)
        while len(tree) < count:
            tree = shards.grown(tree)
        steps = moved(spark, tree, shards.grown(tree))
        assert {b for a, b in steps if a != b} == {count}
        share = sum(a != b for a, b in steps) / len(steps)
        assert 0.5 / count < share < 1.6 / count


def test_weights_and_confined_movement(spark):
    tree = shards.tree(16)
    heavy = [shards.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 0 else 1.0) for s in tree]
    steps = moved(spark, tree, heavy)
    counts = Counter(b for _, b in steps)
    assert abs(counts[0] / len(steps) - 3 / 18) < 0.02 and abs(counts[9] / len(steps) - 1 / 18) < 0.01
    region = {s.shard: s.region for s in tree}
    # Rows that move end in the region whose weight grew, none elsewhere.
    assert {region[b] for a, b in steps if a != b} == {region[0]}


def test_rows(spark, documents, clash):
    tree = shards.tree(40)
    for df in (clash(documents), spark.read.parquet(f"{SF}/documents.parquet")):
        texts = sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
        found = shards.sharded(df, tree)
        assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
        rows = found.collect()
        assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sorted(
            (k, len(t.encode()) + 16, zlib.crc32(t.encode())) for k, t in texts)
        slots: dict[int, list] = {}
        for r in rows:
            assert r["law"] == "key" and 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.sharded(documents.limit(0), tree).count() == 0
    lost = spark.createDataFrame([(None, None), (None, "x")], "doc_id long, text string")
    assert shards.sharded(lost, tree).count() == 2
