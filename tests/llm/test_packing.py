"""Packing against the tokenizer, and the plan against one document at a time."""

from __future__ import annotations

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hexrarity.llm import packing
from tests.llm.conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best fit, longest first, document by document: number of sequences."""
    free = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, length)
        room = free.pop(at) if at < len(free) else capacity
        bisect.insort(free, room - length)
    return len(free)


def laid(counts, capacity):
    rows = packing.plan(counts, capacity)
    used: dict[int, list] = {}
    for length in counts:
        own = sorted(r for r in rows.tolist() if r[0] == length)
        for k, (_, first, sequence, each, offset) in enumerate(own):
            end = own[k + 1][1] if k + 1 < len(own) else counts[length]
            for rank in range(first, end):
                used.setdefault(sequence + (rank - first) // each, []).append(
                    (offset + (rank - first) % each * length, length))
    return used


def test_plan_is_best_fit():
    rng = random.Random(2)
    for _ in range(150):
        counts = {rng.randint(1, 64): rng.randint(1, 30) for _ in range(rng.randint(1, 25))}
        used = laid(counts, 64)
        assert sorted(used) == list(range(len(used)))
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 64
        lengths = [n for n, many in counts.items() for _ in range(many)]
        assert len(used) == one_by_one(lengths, 64)
    assert packing.plan({}).shape == (0, 5)


def test_plan_size_does_not_follow_documents():
    few = packing.plan({n: 5 for n in range(1, 4097)})
    many = packing.plan({n: 5_000_000 for n in range(1, 4097)})
    assert len(many) < 3 * 4096 * 12 and len(few) < 3 * 4096 * 12


@pytest.mark.parametrize("capacity", [4096, 50])
def test_rows(spark, documents, clash, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    for df in (clash(documents), spark.read.parquet(f"{SF}/documents.parquet")):
        expected = []
        for row in df.select("doc_id", "text").collect():
            ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 1]
            for k in range(0, len(ids), capacity):
                cut = np.array(ids[k : k + capacity], "<u4").tobytes()
                expected.append((row["doc_id"], k // capacity, k, len(cut) // 4, zlib.crc32(cut)))
        found = packing.packed(df, PATH, capacity).collect()
        assert sorted(tuple(r)[:5] for r in found) == sorted(expected)
        places: dict[int, list] = {}
        for r in found:
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for own in places.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(places) == one_by_one([r["length"] for r in found], capacity)


def test_empty_table(spark, documents):
    assert packing.packed(documents.limit(0), PATH).count() == 0


def test_long_chunks_are_not_kept():
    from hexrarity.llm import common

    with open(PATH, encoding="utf-8") as file:
        chunks = packing.ChunkIds(file.read())
    texts = ["字" * 900 + str(k) for k in range(30)] + ["short words", "Ab" * 200 + "!" * 90]
    assert chunks.encode(texts) == chunks.encode(texts)
    assert max(map(len, chunks.ids)) <= common.LONGEST_WORD
    cache = common.WordCache(len, limit=3)
    assert [cache[w] for w in ("a", "b" * 65, "c" * 64)] == [1, 65, 64]
    assert set(cache) == {"a", "c" * 64}


def test_long_chunks_are_not_kept():
    """Whenever they come, and only chunks that were not known are looked at for it."""
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        chunks = packing.ChunkIds(file.read())
    long = "x" * (packing.LONGEST_WORD + 1)
    first = chunks.encode([f"a {long} b", "b a"])
    assert chunks.encode([f"a {long} b", "b a"]) == first
    assert long not in chunks.ids
    assert chunks.learn({"a", "b"}) == []


def test_kept_chunks_follow_the_limit(monkeypatch):
    """However many there are; the tokenizer gets few at a time, and the ids are the same."""
    with open(PATH, encoding="utf-8") as file:
        tokenizer = file.read()
    few, all_of_them = packing.ChunkIds(tokenizer, kept=300), packing.ChunkIds(tokenizer)
    monkeypatch.setattr(packing, "ENCODED", 30)

    class Watched:
        def __init__(self, own):
            self.own, self.most = own, 0

        def encode_batch_fast(self, some, **more):
            self.most = max(self.most, len(some))
            return self.own.encode_batch_fast(some, **more)

    few.tokenizer = Watched(few.tokenizer)
    for first in range(0, 2000, 100):
        texts = [f"The same, n{k} Word{k % 70}. wORD{k % 70}" for k in range(first, first + 100)]
        assert few.encode(texts) == all_of_them.encode(texts)
        assert len(few.ids) <= 300 + 200 and "The" in few.ids
    assert 0 < few.tokenizer.most <= 30 and len(all_of_them.ids) > 2000


def test_places_free_the_chunks():
    """The ids of chunks do not stay in a worker beyond the pieces."""
    import pyarrow as pa

    from hexrarity.llm import common

    held = type("Held", (), {"value": packing.plan({5: 3}, 10)})
    common.worker_cache(("chunks",), lambda: {"a": b""})
    found = packing._placing(held)(pa.array([5, 5, 5]), pa.array([0, 1, 2])).to_pylist()
    assert [(r["sequence_id"], r["offset"]) for r in found] == [(0, 0), (0, 5), (1, 0)]
    assert ("chunks",) not in common.worker_store()["held"]
