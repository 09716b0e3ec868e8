"""Exact top-k search among binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments of about log2(number of codes) bits, and indexed
under the value of each. In round a, a query looks up all segment values at distance a
from its own, in one segment after the other: after step s, which is round s // segments,
every code within s bits has been found, because one that is further in every segment, by
as much as has been looked up there, is further than s in all. A query stops when its kth
verified distance is within this proven radius; the others go on.
Equal codes are one entry; as answers are ordered by distance and id, an entry needs only
its k + 1 smallest ids.

Queries are dealt into groups, one per task. A group is sent all codes as they follow by
their smallest ids, packed into rows; it indexes them block by block, looks up within the
block in memory, and takes each query's kth distance so far along to the next one. So
neither lookups nor what they find are rows: only codes are shuffled, once for each group.

Where proving a query's kth distance takes more lookups than reading the block, the query
is compared with all codes of the block, which is exact too.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexrarity.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
#: Codes that can be compared in a block (about a nanosecond each) for the cost of one
#: lookup with what it finds.
LOOKUP = 32
#: Codes that are compared before any are indexed, so that queries have a distance to prove,
#: and those of an indexed block.
CODES = 16_384
BLOCK = 1 << 21
#: Codes of a row (some thousand rows are one Arrow batch).
PACKED = 512
#: Queries of a group, while there are no more than so many groups, and the most of a group.
QUERIES = 1024
GROUPS = 64
LARGEST = 65_536
#: Queries and codes that are compared at once: their distances stay in a core's cache.
TILE = (32, 4096)
#: Values that are looked up at once.
VALUES = 1 << 16
#: The distance of no code.
NONE = 255
#: Slices of the rows of one code, for its smallest ids.
SLICES = 1024


def sign_code(vector: Column) -> Column:
    """64-bit code of a vector: the signs of its first 64 components, as a long. NULL if
    the vector is NULL, has fewer components, or one of them is NULL or NaN."""
    head = F.slice(vector, 1, BITS)
    bits = F.aggregate(
        head, F.lit(0).cast("long"),
        lambda code, x: F.shiftleft(code, 1).bitwiseOR(F.when(x >= 0, 1).otherwise(0).cast("long")))
    usable = (F.size(vector) >= BITS) & F.forall(head, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.when(usable, bits)


def segments(codes: int) -> list[tuple[int, int]]:
    """(shift, bits) of the segments for so many codes."""
    many = max(2, min(16, round(BITS / max(4.0, math.log2(max(2, codes))))))
    ends = [round(k * BITS / many) for k in range(many + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _masks(bits: int, flips: int) -> list[int]:
    if flips == 0:
        return [0]
    return [(1 << top) | rest for top in range(flips - 1, bits) for rest in _masks(top, flips - 1)]


def _pack(batches):
    """Codes in their order, packed into rows, with the number of their ids."""
    for batch in batches:
        at, codes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        many = batch.column(2).to_numpy().astype(np.uint8)
        cuts = range(0, batch.num_rows, PACKED)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[::PACKED], pa.int64()),
             pa.array([codes[c : c + PACKED].tobytes() for c in cuts], pa.binary()),
             pa.array([many[c : c + PACKED].tobytes() for c in cuts], pa.binary())],
            names=["at", "codes", "many"])


class _Best:
    """The k nearest entries so far of some queries, by distance and place. Entries come in
    the order of their smallest ids, so that the first of equally distant ones is wanted: an
    entry with a row among the k best is itself among the k best by distance and smallest
    id. ``bound`` is a distance within which there are k rows, ``reach`` the first distance
    at which an entry that comes later is not wanted."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        shape = (len(queries), k)
        self.distance = np.full(shape, NONE, np.uint8)
        self.place, self.code = np.zeros(shape, np.int64), np.zeros(shape, np.uint64)
        self.many = np.zeros(shape, np.uint8)
        self.bound = np.full(len(queries), BITS, np.uint8)
        self.reach = np.full(len(queries), BITS + 1, np.uint8)

    def add(self, rows, distance, place, code, many) -> None:
        if not len(rows):
            return
        touched, rows = np.unique(rows, return_inverse=True)
        old = self.distance[touched] < NONE
        rows = np.concatenate([np.nonzero(old)[0], rows])
        distance, place, code, many = (
            np.concatenate([have[touched][old], more]) for have, more in (
                (self.distance, distance), (self.place, place), (self.code, code), (self.many, many)))
        order = np.lexsort((place, distance, rows))
        rows, place = rows[order], place[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (place[1:] != place[:-1])
        order, rows = order[new], rows[new]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        first = nth < self.k
        order, at = order[first], (touched[rows[first]], nth[first])
        self.distance[touched], self.many[touched] = NONE, 0
        self.distance[at], self.code[at], self.many[at] = distance[order], code[order], many[order]
        self.place[at] = place[new][first]
        distance, total = self.distance[touched], np.cumsum(self.many[touched], axis=1, dtype=np.int64)
        enough = total >= self.k
        bound = np.where(enough[:, -1], distance[np.arange(len(touched)), enough.argmax(axis=1)], BITS)
        last = distance[:, -1]
        self.bound[touched] = bound
        self.reach[touched] = np.minimum(np.where(last == NONE, BITS + 1, last), bound + 1)

    def compare(self, rows: np.ndarray, codes: np.ndarray, many: np.ndarray, start: int) -> None:
        """All codes of a block that begins at place ``start`` for the queries ``rows``."""
        few, some = TILE
        space = np.empty(few * some, np.uint64), np.empty(few * some, np.uint8), np.empty(few * some, bool)
        done = 0
        while done < len(codes):
            part = codes[done : done + min(max(start + done, 1024), 4 * some)]
            for first in range(0, len(rows), few):
                own = rows[first : first + few]
                queries, reach = self.queries[own][:, None], self.reach[own][:, None]
                hits = []
                for left in range(0, len(part), some):
                    shape = len(own), len(part[left : left + some])
                    differ, distance, near = (x[: shape[0] * shape[1]].reshape(shape) for x in space)
                    np.bitwise_xor(queries, part[None, left : left + some], out=differ)
                    np.bitwise_count(differ, out=distance)
                    np.less(distance, reach, out=near)
                    many_near = np.count_nonzero(near)
                    if many_near > 4 * self.k * len(own):
                        near &= _smallest(distance, self.k)
                    if many_near:
                        hit = np.flatnonzero(near)
                        row, place = np.divmod(hit, shape[1])
                        hits.append((own[row], distance.ravel()[hit], place + left + done))
                self._add_found(hits, codes, many, start)
            done += len(part)

    def _add_found(self, hits: list, codes: np.ndarray, many: np.ndarray, start: int) -> None:
        if hits:
            row, distance, place = map(np.concatenate, zip(*hits, strict=True))
            self.add(row, distance, place + np.int64(start), codes[place], many[place])

    def look_up(self, codes: np.ndarray, many: np.ndarray, start: int, lookup: int) -> np.ndarray:
        """Lookups in a block that begins at place ``start``, for the queries whose bound they
        prove at less cost than reading the block; returns the others."""
        parts = segments(len(codes))
        costs = np.cumsum([math.comb(parts[step % len(parts)][1], step // len(parts)) for step in range(BITS + 1)])
        cheap = costs[self.bound] * lookup <= len(codes)
        left = np.flatnonzero(cheap)
        index = {}
        step = 0
        while len(left):
            flips, part = divmod(step, len(parts))
            shift, bits = parts[part]
            mask = np.uint64((1 << bits) - 1)
            if part not in index:
                value = (codes >> np.uint64(shift) & mask).astype(np.uint32)
                ends = np.zeros((1 << bits) + 1, np.int32)
                np.cumsum(np.bincount(value, minlength=1 << bits), out=ends[1:])
                order = np.argsort(value).astype(np.int32)
                index[part] = order, codes[order], ends
            order, ordered, ends = index[part]
            masks = np.array(_masks(bits, flips) if flips <= bits else [], np.int64)
            value = (self.queries[left] >> np.uint64(shift) & mask).astype(np.int64)
            at_once = max(1, VALUES // max(1, len(masks)))
            hits, waiting = [], 0
            for first in range(0, len(left), at_once):
                own = left[first : first + at_once]
                for row, at in _entries(own, value[first : first + at_once, None] ^ masks, ends):
                    distance = np.bitwise_count(ordered[at] ^ self.queries[row])
                    near = np.flatnonzero(distance <= self.bound[row])
                    hits.append((row[near], distance[near], order[at[near]]))
                    waiting += len(near)
                    if waiting > VALUES:
                        self._add_found(hits, codes, many, start)
                        hits, waiting = [], 0
            self._add_found(hits, codes, many, start)
            left = left[self.bound[left] > step]
            step += 1
        return np.flatnonzero(~cheap)


def _smallest(distance: np.ndarray, k: int) -> np.ndarray:
    """Marks the k smallest of each row, of equal ones the first."""
    width = distance.shape[1]
    if width <= k:
        return np.ones(distance.shape, bool)
    order = distance.astype(np.int32) * width + np.arange(width, dtype=np.int32)
    return order <= np.partition(order, k - 1, axis=1)[:, k - 1 : k]


def _entries(own: np.ndarray, values: np.ndarray, ends: np.ndarray):
    """(queries, places in the index) of what is indexed under the values, which have a row
    for each of ``own``; not too many at once."""
    values = values.ravel()
    begin = ends[values]
    many = ends[values + 1] - begin
    full = np.flatnonzero(many)
    row = own[full // max(1, len(values) // len(own))]
    begin, many = begin[full], many[full]
    total = np.cumsum(many, dtype=np.int64)
    first = 0
    while first < len(many):
        before = total[first] - many[first]
        last = max(first + 1, int(np.searchsorted(total, before + VALUES, "right")))
        some = many[first:last]
        at = np.repeat(begin[first:last] - (total[first:last] - some - before), some) + np.arange(some.sum())
        yield np.repeat(row[first:last], some), at
        first = last


def _search(k: int, seed: int, lookup: int):
    """The k nearest entries of a group's queries: rows of queries, then rows of codes in
    the order of their smallest ids."""

    def run(batches):
        own, held, best, done = [], [], None, 0

        def block(codes, many):
            rest = best.look_up(codes, many, done, lookup) if done else np.arange(len(best.queries))
            best.compare(rest, codes, many, done)

        for batch in batches:
            own.append(batch.column(0).drop_null().to_numpy().view(np.uint64))
            held += [
                (np.frombuffer(c.as_buffer(), np.uint64), np.frombuffer(m.as_buffer(), np.uint8))
                for c, m in zip(batch.column(1).drop_null(), batch.column(2).drop_null(), strict=True)]
            while held and sum(len(c) for c, _ in held) >= (size := BLOCK if done else seed):
                best = best or _Best(np.concatenate(own), k)
                codes, many = (np.concatenate(x) for x in zip(*held, strict=True))
                block(codes[:size], many[:size])
                done += size
                held = [(codes[size:], many[size:])] if len(codes) > size else []
        best = best or _Best(np.concatenate([np.zeros(0, np.uint64), *own]), k)
        if held:
            block(*(np.concatenate(x) for x in zip(*held, strict=True)))
        row, nth = np.nonzero(best.distance < NONE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.queries[row].view(np.int64)), pa.array(best.code[row, nth].view(np.int64))],
            names=["query", "code"])

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_column: str, code: str) -> DataFrame:
    """(``query_id``, ``rank``, ``neighbor_id``, ``distance``): for each row of ``queries``
    the ``k`` rows of ``rows`` with the smallest Hamming distance, by distance and id,
    without the query itself (the row with its id).

    ``code`` is a long column of both. Rows whose code or id is NULL are neither indexed
    nor answered; repeated rows are rows of their own; fewer than ``k`` rows are all
    returned. An empty table gives an empty one.
    """
    entries = stored(_smallest_ids(rows, k, id_column, code))
    asked = queries.where(F.col(code).isNotNull() & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("query_id"), F.col(code).alias("query"))
    asked = stored(asked)
    # (One more than k: the query itself may be among them.)
    pairs = _pairs(stored(asked.select("query").distinct()), entries, k + 1)
    pairs = pairs.withColumn("distance", F.bit_count(F.col("query").bitwiseXOR(F.col("code"))))
    # Nearest entries per distinct query first: k + 1 rows at most each.
    by_distance = Window.partitionBy("query").orderBy("distance", "neighbor_id")
    best = (
        pairs.join(entries, "code")
        .select("query", "distance", F.explode("ids").alias("neighbor_id"))
        .withColumn("_nth", F.row_number().over(by_distance)).where(F.col("_nth") <= k + 1)
    )
    lists = stored(best.groupBy("query").agg(F.array_sort(F.collect_list(
        F.struct("distance", "neighbor_id"))).alias("near")))
    # One row of the query's own id goes, or else the last.
    near = F.col("near")
    itself = F.coalesce(F.array_position(F.transform(near, lambda x: x["neighbor_id"]), F.col("query_id")), F.lit(0))
    kept = F.slice(F.filter(near, lambda x, at: at != itself - 1), 1, k)
    return asked.join(lists, "query").select(
        "query_id", F.posexplode(kept).alias("rank", "_hit")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("_hit.neighbor_id").alias("neighbor_id"), F.col("_hit.distance").cast("int").alias("distance"))


def _smallest_ids(rows: DataFrame, k: int, id_column: str, code: str) -> DataFrame:
    """(``code``, ``ids``): each code's k + 1 smallest ids, combined before any shuffle of
    rows by code: first within slices of a code's rows, then over the slices."""
    window = Window.partitionBy("code", "_slice").orderBy("_id")
    few = (
        rows.where(F.col(code).isNotNull() & F.col(id_column).isNotNull())
        .select(F.col(code).alias("code"), F.col(id_column).alias("_id"),
                F.pmod(F.xxhash64(id_column), F.lit(SLICES)).alias("_slice"))
        .withColumn("_nth", F.row_number().over(window)).where(F.col("_nth") <= k + 1)
    )
    return few.groupBy("code").agg(F.slice(F.array_sort(F.collect_list("_id")), 1, k + 1).alias("ids"))


def _pairs(queries: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(``query``, ``code``): the k nearest entries of each of the distinct queries."""
    count = queries.count()
    groups = max(1, min(-(-count // QUERIES), max(GROUPS, -(-count // LARGEST))))
    # Ids in the order of the rows, as they grow along the sorted partitions.
    packed = stored(
        entries.select("code", F.least(F.size("ids"), F.lit(255)).alias("many"), F.col("ids")[0].alias("_id"))
        .orderBy("_id").select(F.monotonically_increasing_id().alias("at"), "code", "many")
        .mapInArrow(_pack, "at long, codes binary, many binary"))
    each = packed.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"), "at",
        F.lit(None).cast("long").alias("query"), "codes", "many")
    own = queries.select(
        F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("_group"), F.lit(-1).cast("long").alias("at"),
        "query", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("binary").alias("many"))
    return stored(
        own.unionByName(each).repartitionById(groups, F.col("_group")).sortWithinPartitions("at")
        .select("query", "codes", "many").mapInArrow(_search(k, CODES, LOOKUP), "query long, code long"))
