"""The Merkle manifest against a tree built leaf by leaf."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hexrarity.llm import merkle
from hexrarity.llm.queries import op12_merkle_manifest
from tests.llm.conftest import SF

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(bottom):
    found = [bottom]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][k : k + 16])) for k in range(0, len(found[-1]), 16)])
    return found


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0], leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    for number, group in enumerate(order):
        for place, row in enumerate(groups[group]):
            digest = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                digest = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            siblings = ""
            for tree, at in ((trees[group], place), (top, number)):
                for level in tree[:-1]:
                    run, own = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    siblings += "".join(run[:own] + run[own + 1 :])
                    digest = sha("".join([*run[:own], digest, *run[own + 1 :]]))
                    at //= 16
            root = top[-1][0]
            yield row[0], leaf(row), trees[group][-1][0], root, sha(siblings), digest, digest == root


def same(df, rows):
    found = [tuple(r) for r in merkle.verified(df, COLUMNS).collect()]
    expected = list(by_hand(rows))
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    found = [tuple(r) for r in op12_merkle_manifest(spark, SF).collect()]
    assert sorted(found) == sorted(by_hand(rows))
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_hot_and_small_groups(spark, monkeypatch, broadcast):
    """One group with a third of all rows, 20 with one row, NULL, empty and odd names."""
    monkeypatch.setattr(merkle, "BLOCK", 40)  # nodes above more leaves are repeated
    monkeypatch.setattr(merkle, "BROADCAST_NODES", broadcast)
    rows = [(k, "hot", "en", k, f"Text {k}") for k in range(300)]
    rows += [(1000 + k, f"one{k}", None, None, "ONE") for k in range(20)]
    rows += [(2000 + k, None, "de", 1, None if k % 2 else "") for k in range(17)]
    rows += [(3000 + k, name, "es", 2, "É x" * 2000) for k, name in enumerate(["", "é", "Z", "😀", "ｚ"] * 40)]
    same(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


def test_nulls_ties_and_repeats(spark, clash):
    same(clash(spark.createDataFrame([(5, "a", "x", 1, "Ab")], SCHEMA)), [(5, "a", "x", 1, "Ab")])
    rows = [(None, "a", None, None, "X"), (None, "a", None, None, "Y"), (7, "a", "l", 1, "A"), (7, "a", "l", 1, "B")]
    rows += [(9, "b", "l", 1, "Same")] * 40
    same(clash(spark.createDataFrame(rows, SCHEMA)).repartition(5), rows)


def test_empty_table(spark):
    assert merkle.verified(spark.createDataFrame([], SCHEMA), COLUMNS).count() == 0


@pytest.mark.parametrize("limit", ["1000000", "123"])
def test_row_limit_is_restored(spark, limit):
    spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    rows = [(k, "a", "l", 1, "T") for k in range(200)]
    same(spark.createDataFrame(rows, SCHEMA), rows)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == limit
    spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_another_manifest_after_a_change(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    build = [merkle.build(d, COLUMNS, "source", "doc_id", "text").root for d in (
        docs, docs.repartition(9, "lang"), docs.withColumn("text", F.upper("text")))]
    assert build[0] == build[1] != build[2]
