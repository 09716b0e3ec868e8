"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature has a few bits for each of its terms, and more for terms that occur
often: one key each for "at least 1, 2, 3, 4, 6, 8, ... times" (``LEVELS``). Documents
with about as many keys stand in one block, whose signatures are as wide as these need.
A block is stored by bits, not by documents: slice b is a bitmap of the documents whose
signature has bit b. The slices of a key, ANDed, are a bitmap of the documents that may
have it, and of all that do.

For a query, each level's bitmaps of its terms are summed by the weights of the terms, and
these sums, times what the level adds to a term's share of the score at the document's
length, are an upper bound of each score, as an integer: it takes a term to be there as
often as its highest level allows. The documents of the largest bounds are scored from
their texts; the kth best of them is a score that a result must reach. All documents whose
bound does not fall short of it are then scored from their texts too. Bits that
collide cost further texts, never results.

The index is built in one pass without a shuffle: a task fills blocks as documents come,
and counts the documents of each term. It does not depend on the queries, which are
searched in groups of bounded size.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexrarity.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms of a text in UTF-8: runs of ASCII letters and digits and all that is not ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Occurrences that have a key of their own.
LEVELS = np.array([1, 2, 3, 4] + [n for p in range(2, 40) for n in (6 << (p - 2), 8 << (p - 2))])
#: Bits of a signature for each of the most keys of its block; bits that a key sets.
BITS_PER_KEY, HASHES = 10, 5
#: Bits of a block, and its documents, at most (one document at least).
BLOCK_BITS, BLOCK_DOCS = 1 << 22, 8192
FEWEST_KEYS = 32
#: Terms that a task counts before it passes them on.
COUNTED = 200_000
#: Pairs of item and term of a group of queries, about.
GROUP_PAIRS = 50_000
#: Documents scored first, of the largest bounds, as a multiple of k.
FIRST = 2
#: Pairs of item and document whose texts are found by a broadcast.
BROADCAST_PAIRS = 500_000
#: Stands for a NULL id, so that one sorts and joins like any other.
NO_ID = -(1 << 63)


def terms(text: bytes | None) -> list[bytes]:
    """Only A-Z are lower-cased; NULL has none."""
    return TERM.findall(text.lower()) if text else []


def hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64)


def positions(hashed: np.ndarray, level, width: int) -> np.ndarray:
    """The bits of each term's key of a level."""
    mixed = (hashed + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    walk = mixed[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return ((walk >> np.uint64(11)) % np.uint64(width)).astype(np.int64)


class _Block:
    """Documents of a width, until there is no room for more."""

    def __init__(self, width: int):
        self.width = width
        self.room = max(1, min(BLOCK_DOCS, BLOCK_BITS // width))
        self.bits = np.zeros((width, self.room), bool)
        self.ids: list = []
        self.lengths: list = []

    def add(self, doc_id: int, length: int, hashed: np.ndarray, levels: np.ndarray) -> None:
        for level in range(int(levels.max())):
            self.bits[positions(hashed[levels > level], level, self.width), len(self.ids)] = True
        self.ids.append(doc_id)
        self.lengths.append(length)

    def row(self) -> dict:
        packed = np.packbits(self.bits[:, : len(self.ids)], axis=1, bitorder="little")
        return {"width": self.width, "ids": self.ids, "lengths": self.lengths, "slices": packed.tobytes()}


_BUILT = pa.schema([
    ("width", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("slices", pa.binary()),
    ("terms", pa.list_(pa.binary())), ("docs", pa.list_(pa.int64()))])


def _built(batches):
    """Blocks of signatures, and rows of terms with their numbers of documents."""
    open_blocks: dict = {}
    counted: Counter = Counter()

    def passed(**row):
        return pa.RecordBatch.from_pylist([row], schema=_BUILT)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
            found = Counter(terms(text.as_py()))
            if not found:
                continue
            counted.update(found.keys())
            times = np.fromiter(found.values(), np.int64)
            levels = np.searchsorted(LEVELS, times, side="right")
            most = max(FEWEST_KEYS, 1 << int(levels.sum() - 1).bit_length())
            block = open_blocks.get(most) or open_blocks.setdefault(most, _Block(most * BITS_PER_KEY))
            block.add(int(doc_id), int(times.sum()), hashes(found), levels)
            if len(block.ids) == block.room:
                yield passed(**open_blocks.pop(most).row())
            if len(counted) >= COUNTED:
                yield passed(terms=list(counted), docs=list(counted.values()))
                counted.clear()
    for block in open_blocks.values():
        yield passed(**block.row())
    if counted:
        yield passed(terms=list(counted), docs=list(counted.values()))


@dataclass(frozen=True)
class Index:
    """``blocks`` (``width``, ``ids``, ``lengths``, ``slices``), ``vocabulary`` (``term``,
    ``docs``), the texts (``id``, ``text``), the documents that have terms, and all terms
    of these with repeats."""

    blocks: DataFrame
    vocabulary: DataFrame
    texts: DataFrame
    documents: int
    length: int


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """The index of ``docs``. Rows without terms are not in it."""
    texts = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(text_column).cast("binary").alias("text"))
    built = stored(texts.mapInArrow(
        _built, "width long, ids array<long>, lengths array<long>, slices binary, terms array<binary>, docs array<long>"))
    blocks = built.where("width IS NOT NULL").select("width", "ids", "lengths", "slices")
    vocabulary = stored(
        built.where("width IS NULL").select(F.explode(F.arrays_zip("terms", "docs")).alias("t"))
        .groupBy("t.terms").agg(F.sum("t.docs").alias("docs")).withColumnRenamed("terms", "term"))
    number, length = blocks.agg(
        F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n))).first()
    return Index(blocks, vocabulary, texts, number or 0, length or 0)


class Queries:
    """A group of queries: items, their terms, and the weights of these."""

    def __init__(self, rows, documents: int, length: int):
        self.documents, self.length = documents, length
        self.items = sorted({r["item"] for r in rows})
        number = {item: n for n, item in enumerate(self.items)}
        rows = sorted(rows, key=lambda r: (number[r["item"]], r["term"]))
        words = sorted({bytes(r["term"]) for r in rows})
        at = {word: n for n, word in enumerate(words)}
        self.hashed = hashes(words)
        self.term = np.array([at[bytes(r["term"])] for r in rows], np.int64)
        self.weight = np.array([r["weight"] for r in rows], np.int64)
        self.starts = np.searchsorted([number[r["item"]] for r in rows], np.arange(len(self.items) + 1))
        self.weights: dict = {}
        for r in rows:
            self.weights.setdefault(r["item"], {})[bytes(r["term"])] = r["weight"]

    def share(self, times, lengths):
        """A term's share of the score, of a million, at so many occurrences."""
        m = 50 + (50 * lengths * self.documents) // self.length
        return (1_000_000_000 * times) // (1000 * times + 20 * m)

    def bounds(self, width: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
        """Upper bounds of the scores, items x documents of a block."""
        bits = np.frombuffer(slices, np.uint8).reshape(width, -1)
        bound = np.zeros((len(self.items), len(lengths)), np.int64)
        alive, before, shared = np.arange(len(self.hashed)), None, 0
        for level in range(np.searchsorted(LEVELS, lengths.max(), side="right")):
            at = positions(self.hashed[alive], level, width)
            mask = bits[at[:, 0]]
            for column in at.T[1:]:
                mask &= bits[column]
            if before is not None:
                mask &= before
            some = mask.any(axis=1)
            if not some.any():
                break
            alive, before = alive[some], mask[some]
            there = np.unpackbits(before, axis=1, count=len(lengths), bitorder="little")
            row = np.full(len(self.hashed), -1)
            row[alive] = np.arange(len(alive))
            # (No term occurs more often than a document has terms.)
            share = self.share(np.minimum(LEVELS[level + 1] - 1, lengths), lengths)
            for item in range(len(self.items)):
                own = slice(self.starts[item], self.starts[item + 1])
                rows = row[self.term[own]]
                kept = rows >= 0
                if kept.any():
                    # (Sums of weights are whole numbers far below 2**53.)
                    weights = self.weight[own][kept].astype(np.float64) @ there[rows[kept]].astype(np.float64)
                    bound[item] += (share - shared) * weights.astype(np.int64)
            shared = share
        return bound

    def score(self, item, found: Counter, length: int) -> int:
        weights = self.weights[item]
        return sum(weights[t] * int(self.share(found[t], length)) for t in weights.keys() & found.keys())


def _blocks(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            width, ids, lengths, slices = (batch.column(n)[row] for n in range(4))
            yield width.as_py(), ids.values.to_numpy(), lengths.values.to_numpy(), slices.as_buffer()


def _pairs(queries: Queries, item: np.ndarray, ids: np.ndarray, bound: np.ndarray):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(queries.items)[item]), pa.array(ids), pa.array(bound)], names=["item", "id", "bound"])


def _largest(queries: Queries, many: int):
    """Of each item, the documents of a task with the largest bounds."""

    def run(batches):
        best = np.zeros((len(queries.items), many), np.int64)
        who = np.zeros((len(queries.items), many), np.int64)
        for width, ids, lengths, slices in _blocks(batches):
            both = np.concatenate([best, queries.bounds(width, lengths, slices)], axis=1)
            names = np.concatenate([who, np.broadcast_to(ids, (len(best), len(ids)))], axis=1)
            top = np.argpartition(-both, many - 1, axis=1)[:, :many]
            best, who = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)
        item, at = np.nonzero(best)
        yield _pairs(queries, item, who[item, at], best[item, at])

    return run


def _not_excluded(queries: Queries, least: dict):
    """All documents that could be among an item's results: ``least`` has the score and id
    of the kth of the documents scored so far."""
    score = np.array([least.get(i, (1, 0))[0] for i in queries.items])[:, None]
    last = np.array([least[i][1] if i in least else (1 << 63) - 1 for i in queries.items])[:, None]

    def run(batches):
        for width, ids, lengths, slices in _blocks(batches):
            bound = queries.bounds(width, lengths, slices)
            item, at = np.nonzero((bound > score) | (bound == score) & (ids[None, :] <= last))
            yield _pairs(queries, item, ids[at], bound[item, at])

    return run


def _scored(queries: Queries):
    def run(batches):
        for batch in batches:
            out: list = [[], [], []]
            for doc_id, text, items in zip(*batch.columns, strict=True):
                found = Counter(terms(text.as_py()))
                length = found.total()
                for item in items.as_py() if found else ():
                    score = queries.score(item, found, length)
                    if score > 0:
                        for column, value in zip(out, (item, doc_id.as_py(), score), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["item", "id", "score"])

    return run


def _best(index: Index, pairs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """The ``k`` best of each item among (``item``, ``id``), scored from the texts."""
    pairs = stored(pairs.select("item", "id").distinct())
    wanted = pairs.groupBy("id").agg(F.collect_list("item").alias("items"))
    if pairs.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)
    scored = index.texts.join(wanted, "id").select("id", "text", "items").mapInArrow(
        _scored(queries), "item long, id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    return stored(scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


def _words(batches):
    for batch in batches:
        out: list = [[], []]
        for item, text in zip(*batch.columns, strict=True):
            for term in set(terms(text.as_py())):
                out[0].append(item.as_py())
                out[1].append(term)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["item", "term"])


def ranked(index: Index, items: DataFrame, k: int, item_column: str = "item_id", text_column: str = "text",
           id_column: str = "doc_id") -> DataFrame:
    """(item, ``rank``, id, ``score``): the ``k`` documents of the highest scores above 0
    for each item, ties by the smaller id, NULL first; all if they are fewer.

    Rows of an item that is repeated are one query of all their terms; an item without id
    or terms has no rows. Repeated documents have results of their own. Empty tables
    give an empty one. Other columns do not count.
    """
    weight = F.floor(1000 * F.ln((2 * F.lit(index.documents) + 2) / (2 * F.col("docs") + 1)))
    asked = items.where(F.col(item_column).isNotNull()).select(
        F.col(item_column).cast("long").alias("item"), F.col(text_column).cast("binary").alias("text"))
    words = stored(
        asked.mapInArrow(_words, "item long, term binary").distinct().join(index.vocabulary, "term")
        .select("item", "term", weight.cast("long").alias("weight")).where("weight > 0"))
    groups = words.count() // GROUP_PAIRS + 1
    spark = items.sparkSession
    results = spark.createDataFrame([], "item long, rank int, id long, score long")
    for group in range(groups):
        queries = Queries(
            words.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == group).collect(), index.documents, index.length)
        if not queries.items:
            continue
        pair = "item long, id long, bound long"
        by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "id")
        first = index.blocks.mapInArrow(_largest(queries, FIRST * k), pair).withColumn(
            "_nth", F.row_number().over(by_bound)).where(F.col("_nth") <= FIRST * k)
        least = {
            r["item"]: (r["score"], r["id"])
            for r in _best(index, first, queries, k).where(F.col("rank") == k).select("item", "score", "id").collect()}
        found = _best(index, index.blocks.mapInArrow(_not_excluded(queries, least), pair), queries, k)
        results = results.unionByName(found.select("item", "rank", "id", "score"))
    return results.select(
        F.col("item").alias(item_column), "rank", F.nullif("id", F.lit(NO_ID)).alias(id_column), "score")
