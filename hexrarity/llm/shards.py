"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each node it draws for every child an
exponential variate from a hash of its id and the child, divided by the child's weight,
and follows the smallest: a child gets rows in proportion to its weight. A changed
weight moves rows only between the subtree where it changed and its siblings, level by
level; a shard that joins as a region of its own takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.common import ranked_within, stored

#: Added to the bytes of a text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int, racks: int = 2, per_rack: int = 4) -> list[Shard]:
    """Full regions of ``racks * per_rack`` equal shards; those over are regions of one."""
    size = racks * per_rack
    full = shards // size * size
    return [
        Shard(f"r{n // size}", f"r{n // size}/k{n % size // per_rack}", n) if n < full
        else Shard(f"s{n}", f"s{n}/k0", n)
        for n in range(shards)
    ]


def grown(shards: Sequence[Shard]) -> list[Shard]:
    """One more shard, as a region of its own: rows move only into it."""
    n = max(s.shard for s in shards) + 1
    return [*shards, Shard(f"s{n}", f"s{n}/k0", n)]


def _draw(children: Column, key: Column) -> Column:
    """The child (struct of id and weight) with the smallest weighted variate."""

    def variate(child):
        bits = F.shiftrightunsigned(F.xxhash64(key, child["id"]), 11)
        uniform = (bits + F.lit(1)) / F.lit(float(2**53))
        return F.struct((-F.log(uniform) / child["weight"]).alias("draw"), child["id"].alias("id"))

    return F.array_min(F.transform(children, variate))["id"]


def _children(weights: dict[str, float]) -> Column:
    return F.array(*[
        F.struct(F.lit(name).alias("id"), F.lit(float(w)).alias("weight"))
        for name, w in sorted(weights.items())
    ])


def _by_parent(shards: Sequence[Shard], parent: str, child: str) -> Column:
    groups: dict[str, dict[str, float]] = {}
    for s in shards:
        own = groups.setdefault(getattr(s, parent), {})
        name = str(getattr(s, child))
        own[name] = own.get(name, 0.0) + s.weight
    return F.create_map(*[x for p, c in sorted(groups.items()) for x in (F.lit(p), _children(c))])


def descend(df: DataFrame, shards: Sequence[Shard], key: str, column: str) -> DataFrame:
    """Adds ``column``: the shard (int) of each row's ``key``. Rows with equal keys, and
    those whose key is NULL, share a shard."""
    regions: dict[str, float] = {}
    for s in shards:
        regions[s.region] = regions.get(s.region, 0.0) + s.weight
    at = f"_{column}"
    return (
        df.withColumn(at, _draw(_children(regions), F.col(key)))
        .withColumn(at, _draw(F.element_at(_by_parent(shards, "region", "rack"), F.col(at)), F.col(key)))
        .withColumn(column, _draw(
            F.element_at(_by_parent(shards, "rack", "shard"), F.col(at)), F.col(key)).cast("int"))
        .drop(at)
    )


def sharded(docs: DataFrame, shards: Sequence[Shard], id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """(id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``).

    The law is ``key``: id and tree alone decide. ``slot`` numbers a shard's rows from 0
    without gaps, by id. NULL text has no bytes; rows with equal ids share a shard and
    have slots of their own. An empty table gives an empty one. Other columns are not
    returned.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    sized = docs.select(
        F.col(id_column), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    placed = descend(sized, shards, id_column, "shard")
    placed = stored(descend(placed, grown(shards), id_column, "grown_shard"))
    return ranked_within(placed, "shard", [id_column, "text_crc32"], "slot").select(
        id_column, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard")
