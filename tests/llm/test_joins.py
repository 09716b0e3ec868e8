"""Shingle join, near vectors and top-k search against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexrarity.llm import common, near_vectors, shingle_join, topk_codes
from tests.llm.conftest import SF


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 300)]
    star = [(500, k) for k in range(501, 800)]
    mixed = [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(300)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star + mixed]
    rng.shuffle(links)
    df = spark.createDataFrame(links + [(7, 7), (None, 3)], "a long, b long").repartition(16)
    expected = smallest_reachable({n for link in links for n in link}, links)
    found = {r["node"]: r["root"] for r in common.components(df, "a", "b").collect()}
    assert found == {n: r for n, r in expected.items() if n != r}
    assert common.components(df.limit(0), "a", "b").count() == 0


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def joined_by_brute_force(rows):
    sets = {}
    for key, text in rows:
        sets.setdefault(key, []).append(shingles(text))
    flat = [(k, s) for k, own in sets.items() for s in own]
    links = [
        (a, b) for i, (a, x) in enumerate(flat) for b, y in flat[:i]
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    roots = smallest_reachable(sets, links)
    return sorted((k, len(s), roots[k]) for k, s in flat)


def near_copies(seed, groups=12):
    """Groups of edited copies, around the threshold, with shared passages."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(30)]
    rows = []
    for _ in range(groups):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(text)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.5:
                copy[5:5] = passage
            rows.append((len(rows) * 3, " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shingle_join(spark, documents, clash, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(map(tuple, shingle_join.joined(clash(df)).collect()))
    assert found == joined_by_brute_force(rows)


def test_shingle_join_rounds(spark, monkeypatch):
    """Few sightings make lists long, and small groups must still end exactly."""
    monkeypatch.setattr(shingle_join, "SIGHTINGS", 2)
    monkeypatch.setattr(shingle_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(shingle_join, "BUCKET", 50)
    monkeypatch.setattr(shingle_join, "BLOCK", 7)
    monkeypatch.setattr(shingle_join, "GROUP", 20)
    monkeypatch.setattr(shingle_join, "LIST", 3)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(60)]
    text = [rng.choice(words) for _ in range(80)]
    rows = []
    for k in range(60):  # a chain of small edits: far ends do not link directly
        text = list(text)
        text[rng.randrange(80)] = rng.choice(words)
        rows.append((k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, shingle_join.joined(df).collect())) == joined_by_brute_force(rows)


@pytest.mark.parametrize("longest", [1, 64])
def test_shingle_join_nested(spark, monkeypatch, longest):
    """Texts that grow by tails: the smallest and the largest are no pair, and whichever
    heads the lists, the links between are found."""
    monkeypatch.setattr(shingle_join, "LIST", longest)
    rows = []
    for k in range(60):
        words = [f"n{k}x{j}" for j in range(200)]
        for many in (100, 115, 140):
            rows.append((len(rows), " ".join(words[: many + 4])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = joined_by_brute_force(rows)
    assert {root for _, _, root in expected} == set(range(0, 180, 3))
    assert sorted(map(tuple, shingle_join.joined(df).collect())) == expected


def test_shingle_join_id_of_many_texts(spark):
    """Texts of one id, each with a near copy under an id of its own."""
    rows = []
    for k in range(8):
        words = [f"m{k}x{j}" for j in range(60)]
        rows += [(5, " ".join(words)), (100 + k, " ".join([*words, "tail"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, shingle_join.joined(df).collect())) == joined_by_brute_force(rows)


@pytest.mark.parametrize("longest", [2, 64])
def test_shingle_join_hot_group(spark, monkeypatch, longest):
    """A third of all rows are near copies of one text, another third share most of a
    passage with others they do not link with."""
    monkeypatch.setattr(shingle_join, "LIST", longest)
    rng = random.Random(12)
    text = [f"h{k}" for k in range(90)]
    passages = [[f"p{n}x{k}" for k in range(40)] for n in range(5)]
    rows = []
    for _ in range(80):
        copy = list(text)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(90)] = f"e{rng.randrange(50)}"
        rows.append(" ".join(copy))
        rows.append(" ".join(sum(rng.sample(passages, 2), [])[: rng.randint(44, 80)]))
        rows.append(" ".join(f"s{rng.randrange(40)}" for _ in range(60)))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, shingle_join.joined(df).collect())) == joined_by_brute_force(list(enumerate(rows)))


def test_shingle_join_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, text), (None, None), (3, None), (3, "a b"), (3, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, shingle_join.joined(df).collect()), key=str)
    assert found == sorted([(1, 26, 1)] * 2 + [(2, 26, 1), (3, 0, 3), (3, 1, 3), (3, 1, 3)]
                           + [(None, 26, None)] * 2 + [(None, 0, None)], key=str)
    kept = [tuple(r) for r in shingle_join.representatives(df).collect()]
    assert sorted(k for k, _ in kept if k) == [1, 3] and kept.count((1, text)) == 1
    assert sorted((t for k, t in kept if k is None), key=str) == [None, text, text]


def test_shingle_join_odd_rows(spark, documents, clash):
    rows = [tuple(r) for r in documents.collect()]
    assert sorted(map(tuple, shingle_join.joined(clash(documents)).collect())) == joined_by_brute_force(rows)
    assert shingle_join.joined(documents.limit(0)).count() == 0
    kept = shingle_join.representatives(clash(documents))
    assert kept.columns == clash(documents).columns
    first = {k for k, _, root in joined_by_brute_force(rows) if k == root}
    assert {r["doc_id"] for r in kept.collect()} == first


def test_shingle_join_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, shingle_join.joined(df).collect())) == joined_by_brute_force(rows)


def vectors_by_brute_force(rows, cosine=0.93):
    usable = [
        (k, np.array(v, float) / max(map(abs, v)), label) for k, v, label in rows
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links, count = [], {k: 0 for k, _, _ in rows}
    for i, (a, x, p) in enumerate(usable):
        for b, y, q in usable[:i]:
            if p == q and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    roots = smallest_reachable(count, links)
    return sorted((k, count[k], roots[k], k == roots[k]) for k in count)


def test_near_vectors(spark, clash, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    rng = np.random.default_rng(6)
    rows = []
    for label in (0, 1, None):
        for _ in range(6):
            center = rng.standard_normal(24)
            for spread in (0.0, 0.0, 0.05, 0.1, 0.15, 0.3):
                rows.append((len(rows), (center + spread * rng.standard_normal(24)).tolist(), label))
    hot = rng.standard_normal(24)
    rows += [(1000 + k, (hot + 0.05 * rng.standard_normal(24)).tolist(), 1) for k in range(90)]
    rows += [(2000 + k, hot.tolist(), 1) for k in range(40)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 24, 1), (3003, [float("nan")] * 24, 1),
             (3004, [None] * 24, 1), (3005, [float("inf")] + [1.0] * 23, 1), (3006, [1.0] * 3, 1),
             (3007, [2.0] * 3, 1), (3008, [1e300] * 3, 1), (3009, [1e-300] * 3, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    found = near_vectors.linked(clash(df))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    expected = vectors_by_brute_force(rows)
    got = sorted(map(tuple, found.collect()))
    missing = sum(e[1] for e in expected) - sum(g[1] for g in got)
    assert 0 <= missing <= 0.01 * sum(e[1] for e in expected)
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))
    assert [g[2:] for g in got] == [e[2:] for e in expected]
    assert {g[0]: g[2] for g in got if g[0] > 3005} == dict.fromkeys(range(3006, 3010), 3006)
    assert near_vectors.linked(df.limit(0)).count() == 0


def test_near_vectors_tight_cluster(spark, monkeypatch):
    """A task's rows stay few where a cluster of different vectors has many blocks."""
    monkeypatch.setattr(near_vectors, "BLOCK", 8)
    monkeypatch.setattr(near_vectors, "GROUP", 400)
    make = near_vectors._pairs_of_blocks

    def bounded(cosine):
        run = make(cosine)

        def check(table):
            assert table.num_rows <= 1200
            return run(table)

        return check

    monkeypatch.setattr(near_vectors, "_pairs_of_blocks", bounded)
    rng = np.random.default_rng(8)
    center = rng.standard_normal(24)
    rows = [(k, (center + 1e-3 * rng.standard_normal(24)).tolist(), 1) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {tuple(r)[1:3] for r in near_vectors.linked(df).collect()} == {(119, 0)}


def test_near_vectors_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    by_label: dict = {}
    for r in rows:
        by_label.setdefault(r[2], []).append(r)
    expected = {}
    for label, own in by_label.items():
        x = np.array([v for _, v, _ in own], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = (x @ x.T >= 0.93) & (label is not None)
        expected |= {k[0]: int(n) - bool(label is not None) for k, n in zip(own, near.sum(axis=1), strict=True)}
    found = {r["vec_id"]: r["n_links"] for r in near_vectors.linked(df).collect()}
    assert sum(found.values()) >= 0.99 * sum(expected.values())
    assert all(found[k] <= expected[k] for k in expected)


def nearest_by_brute_force(rows, queries, k):
    return sorted(
        (q, rank + 1, key, d)
        for q, code in queries if code is not None
        for rank, (d, key) in enumerate(sorted(
            (((code ^ other) & (2**64 - 1)).bit_count(), key) for key, other in rows
            if other is not None and key != q)[:k]))


@pytest.mark.parametrize("many", [3, 40, 900])
def test_topk(spark, clash, many, monkeypatch):
    monkeypatch.setattr(topk_codes, "CODES", 300)
    monkeypatch.setattr(topk_codes, "QUERIES", 20)
    monkeypatch.setattr(topk_codes, "LOOKUP", 1 if many > 40 else 256)
    rng = random.Random(many)
    centers = [rng.getrandbits(64) for _ in range(12)]
    rows = [(0, None)]
    for key in range(1, many):
        code = rng.choice(centers) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 0, 0, 1, 2, 5, 9])):
            code ^= 1 << rng.randrange(64)
        rows.append((key, code - 2**64 if code >= 2**63 else code))
    df = spark.createDataFrame(rows, "vec_id long, code long").repartition(3)
    asked = df.where("vec_id % 5 = 0")
    found = topk_codes.nearest(clash(df), clash(asked), 7, "vec_id", "code")
    assert sorted(map(tuple, found.collect())) == nearest_by_brute_force(rows, [r for r in rows if r[0] % 5 == 0], 7)
    assert topk_codes.nearest(df.limit(0), asked.limit(0), 7, "vec_id", "code").count() == 0


def test_topk_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", topk_codes.sign_code(F.col("embedding")).alias("code"))
    rows = [tuple(r) for r in df.collect()]
    found = topk_codes.nearest(df, df.where("vec_id % 20 = 0"), 10, "vec_id", "code")
    assert sorted(map(tuple, found.collect())) == nearest_by_brute_force(
        rows, [r for r in rows if r[0] % 20 == 0], 10)


def near_codes(many, seed):
    """Rows of codes around a few centers, some of them equal."""
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(12)]
    rows = []
    for key in range(many):
        code = rng.choice(centers) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
            code ^= 1 << rng.randrange(64)
        rows.append((key, code - 2**64 if code >= 2**63 else code))
    return rows


def test_topk_broadcasts_no_lookups(spark, monkeypatch):
    """A query has hundreds of lookups: no plan makes them, or copies of queries for blocks, on
    the side of a join that goes to the driver."""
    monkeypatch.setattr(topk_codes, "LOOKUP", 1)
    plans = []

    def stored(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.stored(df)

    monkeypatch.setattr(topk_codes, "stored", stored)
    df = spark.createDataFrame(near_codes(600, 5), "vec_id long, code long")
    found = topk_codes.nearest(df, df.where("vec_id % 5 = 0"), 7, "vec_id", "code")
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        above = None
        for line in plan.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            if above is not None and depth <= above:
                above = None
            assert above is None or "Generate" not in line, plan
            if above is None and "BroadcastExchange" in line:
                above = depth


@pytest.mark.parametrize("lookup", [0.01, 1, 32])
def test_topk_in_blocks(spark, monkeypatch, lookup):
    """Several groups of queries and blocks of codes, ids that come twice, queries asked twice."""
    for name, value in (("CODES", 60), ("BLOCK", 150), ("PACKED", 32), ("QUERIES", 20), ("GROUPS", 5),
                        ("LARGEST", 30), ("TILE", (8, 40)), ("LOOKUP", lookup)):
        monkeypatch.setattr(topk_codes, name, value)
    looked_up = spark.sparkContext.accumulator(0)
    rounds = topk_codes._Best.look_up

    def counted(self, *block):
        rest = rounds(self, *block)
        looked_up.add(len(self.queries) - len(rest))
        return rest

    monkeypatch.setattr(topk_codes._Best, "look_up", counted)
    rows = near_codes(700, 9)
    asked = [r for r in rows if r[0] % 4 == 0]
    everything = rows + [(key + 1, code) for key, code in rows[:40]]
    df = spark.createDataFrame(everything, "vec_id long, code long")
    found = topk_codes.nearest(df, spark.createDataFrame(asked + asked[:3], df.schema), 7, "vec_id", "code")
    expected = []
    for q, code in asked + asked[:3]:
        near = sorted((((code ^ other) & (2**64 - 1)).bit_count(), key) for key, other in everything)[:8]
        itself = next((at for at, (_, key) in enumerate(near) if key == q), 7)
        near.pop(itself)
        expected += [(q, rank + 1, key, d) for rank, (d, key) in enumerate(near)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert looked_up.value > 0 or lookup == 32


def test_sign_code(spark):
    rows = [([1.0] * 64,), ([-1.0] * 64,), ([1.0] + [-1.0] * 63,), (None,), ([1.0] * 63,), ([None] * 64,),
            ([float("nan")] * 64,)]
    df = spark.createDataFrame(rows, "v array<double>").select(topk_codes.sign_code(F.col("v")))
    assert [r[0] for r in df.collect()] == [-1, 0, -(2**63), None, None, None, None]


def test_marks_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(3)
    for n in (1, 5, 300, 3000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for kept in (0, n // 2, n):
            other = np.unique(np.concatenate([base[:kept], rng.integers(0, 2**63, n // 3 + 1).astype(np.uint64)]))
            differ = len(np.setxor1d(base, other))
            x, y = shingle_join.marks(base), shingle_join.marks(other)
            bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert bits <= differ and (differ - bits) % 2 == 0
            assert len(x) * 64 == shingle_join.MARKS
