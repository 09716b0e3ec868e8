"""Ranked search by signatures against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from hexrarity.llm import signatures
from hexrarity.llm.queries import op11_ranked_search
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return Counter(WORD.findall(low))


def by_hand(docs, items, k):
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    number, length = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * number + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text))
    for item, terms in asked.items():
        scores = []
        for doc, bag in bags:
            m = 50 + 50 * bag.total() * number // length
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m)) for t in terms if bag[t])
            if score > 0:
                scores.append((-score, doc is not None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores)[:k], 1):
            yield item, rank, doc, -score


def searched(spark, docs, items, k, parts=4, add=lambda df: df):
    docs = add(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts))
    items = add(spark.createDataFrame(items, "item_id long, text string"))
    found = signatures.ranked(signatures.build(docs), items, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = sorted((tuple(r) for r in op11_ranked_search(spark, SF).collect()), key=str)
    assert found == sorted(by_hand(docs, items, 50), key=str)


def test_small_signatures_and_groups(spark, monkeypatch):
    """So few bits that most of them collide, blocks of some documents, many groups of
    queries: bounds are loose, results are the same."""
    monkeypatch.setattr(signatures, "BITS_PER_KEY", 1)
    monkeypatch.setattr(signatures, "BLOCK_BITS", 512)
    monkeypatch.setattr(signatures, "COUNTED", 50)
    monkeypatch.setattr(signatures, "GROUP_PAIRS", 20)
    draw = random.Random(6)
    vocabulary = [f"w{k}" for k in range(200)]
    some = [" ".join(draw.choices(vocabulary, k=draw.randint(1, 60))) for _ in range(150)]
    docs = list(enumerate([*some, *[some[0]] * 100, "w7 " * 5000 + "w8", "W9 " * 30]))
    items = [(k, " ".join(draw.sample(vocabulary, 6))) for k in range(12)] + [(50, some[0]), (51, "w7 w9 none")]
    assert searched(spark, docs, items, 7) == sorted(by_hand(docs, items, 7), key=str)


def test_odd_rows(spark, clash):
    docs = [(1, None), (2, ""), (3, " \n,.;"), (4, "Alpha beta"), (4, "Alpha beta"), (5, "alpha, ALPHA; alpha"),
            (None, "alpha beta"), (6, "É 漢字 beta"), (7, "é 漢字"), (8, "x" * 200_000 + " beta"), (9, "alpha beta"),
            (10, "gamma " * 90_000)]
    items = [(1, "Alpha!"), (1, "beta?"), (2, None), (3, ""), (4, "é"), (5, "É 漢字"), (None, "alpha"), (6, "absent"),
             (7, "gamma Alpha X")]
    assert searched(spark, docs, items, 4, add=clash) == sorted(by_hand(docs, items, 4), key=str)
    assert searched(spark, docs[:0], items, 4) == searched(spark, docs, items[:0], 4) == []


@pytest.mark.parametrize("bits", [1, 10])
def test_bounds(bits, monkeypatch):
    """No bound falls short of a score; with wide signatures most are close to it."""
    monkeypatch.setattr(signatures, "BITS_PER_KEY", bits)
    draw = random.Random(bits)
    vocabulary = [f"t{k}" for k in range(400)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(1, 300))).encode() for _ in range(100)]
    bags = [Counter(signatures.terms(t)) for t in texts]
    length = sum(b.total() for b in bags)
    rows = [{"item": i, "term": t.encode(), "weight": draw.randint(1, 9000)}
            for i in range(5) for t in draw.sample(vocabulary, 20)]
    queries = signatures.Queries(rows, len(bags), length)
    block = signatures._Block(2048 * bits)
    for n, bag in enumerate(bags):
        levels = np.searchsorted(signatures.LEVELS, list(bag.values()), side="right")
        block.add(n, bag.total(), signatures.hashes(bag), levels)
    row = block.row()
    bounds = queries.bounds(row["width"], np.array(row["lengths"]), row["slices"])
    scores = np.array([[queries.score(i, b, b.total()) for b in bags] for i in queries.items])
    assert (bounds >= scores).all()
    assert bits == 1 or (bounds == scores).mean() > 0.9
