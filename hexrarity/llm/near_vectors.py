"""Near duplicates among embeddings: random-hyperplane signs in several tables, exact
cosine, connected components.

Equal vectors of a label are one class. A class falls into one bucket per table, by the
signs of its products with that table's hyperplanes. Within a bucket all cosines are
computed in double precision; a pair that meets in several tables counts in the first
one only, which both sides' signs tell, so no pair is ever written: tasks give counts
per class and a spanning forest of the links. Large buckets are cut into blocks, and
tasks take pairs of blocks, so a hot label or a cluster of copies is never in one task.

``bits`` and ``tables`` follow from the number of classes: buckets of random vectors
hold about ``BUCKET`` of them, and a pair just at the threshold is missed in all tables
with a probability of ``MISS`` at most (closer pairs much less).
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.common import components, merge_links, stored, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.93
BUCKET = 64
MISS = 0.005
SEED = 7
#: Rows of a block of a bucket; rows that a task takes at a time, about.
BLOCK = 512
GROUP = 8192


def shape(classes: int, cosine: float = COSINE) -> tuple[int, int]:
    """(bits, tables) for so many classes."""
    bits = min(30, max(4, math.ceil(math.log2(max(2, classes) / BUCKET))))
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - together))


def hyperplanes(width: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).standard_normal((width, bits * tables))


def _signs(bits: int, tables: int):
    def run(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            widths = np.asarray(vectors.value_lengths().to_numpy())
            out = np.zeros((batch.num_rows, tables), np.int32)
            first = np.concatenate([[0], np.cumsum(widths)[:-1]])
            units: list = [None] * batch.num_rows
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                x = flat[first[at][:, None] + np.arange(width)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                planes = worker_cache(("planes", int(width), bits, tables),
                                      lambda w=int(width): hyperplanes(w, bits, tables))
                positive = (x @ planes >= 0).reshape(len(at), tables, bits)
                out[at] = positive @ (1 << np.arange(bits, dtype=np.int32))
                for row, unit in zip(at, x, strict=True):
                    units[row] = unit.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("class_id", "weight", "label")),
                 pa.array(widths.astype(np.int32)), pa.array(units, pa.binary()),
                 pa.array(out.tolist(), pa.list_(pa.int32()))],
                names=["class_id", "weight", "label", "width", "unit", "signs"])

    return run


def _pairs_of_blocks(cosine: float):
    """Links within each (bucket, block pair): counts per class, and links that span them."""

    def run(table: pa.Table) -> pa.Table:
        keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "low", "high")])
        order = np.lexsort(keys[::-1])
        keys = keys[:, order]
        ids = table.column("class_id").to_numpy()[order]
        weight = table.column("weight").to_numpy()[order]
        block = table.column("block").to_numpy()[order]
        number = table.column("number").to_numpy()[order]
        units = table.column("unit").combine_chunks().take(pa.array(order))
        signs = np.stack(table.column("signs").combine_chunks().take(pa.array(order))
                         .to_numpy(zero_copy_only=False))
        bounds = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        counted: list = [[], []]
        joined: list = [[], []]
        for rows in np.split(np.arange(len(ids)), bounds):
            if len(rows) < 2:
                continue
            x = np.frombuffer(b"".join(units[rows[0] : rows[-1] + 1].to_pylist())).reshape(len(rows), -1)
            low, high = keys[1, rows[0]], keys[2, rows[0]]
            left = rows if low == high else rows[block[rows] == low]
            right = rows if low == high else rows[block[rows] == high]
            a, b = np.nonzero(x[left - rows[0]] @ x[right - rows[0]].T >= cosine)
            a, b = left[a], right[b]
            once = ids[a] < ids[b] if low == high else np.ones(len(a), bool)
            a, b = a[once], b[once]
            t = number[rows[0]]
            new = ~(signs[a, :t] == signs[b, :t]).any(axis=1)
            a, b = a[new], b[new]
            if len(a):
                counted[0] += [ids[a], ids[b]]
                counted[1] += [weight[b], weight[a]]
                member, root = merge_links(ids[a], ids[b])
                joined[0].append(member)
                joined[1].append(root)
        if not counted[0]:
            return pa.table({"class_id": pa.nulls(0, pa.int64()), "links": pa.nulls(0, pa.int64()),
                             "root": pa.nulls(0, pa.int64())})
        names, at = np.unique(np.concatenate(counted[0]), return_inverse=True)
        links = np.bincount(at, np.concatenate(counted[1]).astype(np.float64)).astype(np.int64)
        member, root = np.concatenate(joined[0]), np.concatenate(joined[1])
        return pa.table({
            "class_id": np.concatenate([names, member]),
            "links": np.concatenate([links, np.zeros(len(member), np.int64)]),
            "root": pa.array(np.concatenate([names, root])),
        })

    return run


def linked(vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id",
           vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``) of every row of ``vectors``.

    Rows link if labels are equal and not NULL, both vectors have as many components,
    and their cosine reaches ``cosine``. A vector that is NULL, empty, zero, or holds
    NULL, NaN or infinity links with nothing: no links, its own component, kept. Equal
    vectors link. Ids are whole numbers; rows with equal ids are counted separately. An
    empty table gives an empty one. Other columns are not returned.
    """
    vector = F.col("_vector")
    usable = (
        F.col("_label").isNotNull() & vector.isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id_column).cast("long").alias("_id"), F.col(label_column).alias("_label"),
        F.col(vector_column).cast("array<double>").alias("_vector"))
    rows = rows.select("*", F.coalesce(usable, F.lit(False)).alias("_usable"))
    keyed = rows.where("_usable").select(
        "_id", F.col("_label").alias("label"), F.xxhash64("_vector").alias("h1"),
        F.xxhash64(F.lit(1), "_vector").alias("h2"), F.col("_vector").alias("vector"))
    classes = stored(keyed.groupBy("label", "h1", "h2").agg(
        F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("weight"),
        F.first("vector").alias("vector")))
    bits, tables = shape(classes.count(), cosine)
    signed = stored(classes.select("class_id", "weight", F.xxhash64("label").alias("label"), "vector")
                    .mapInArrow(_signs(bits, tables),
                                "class_id long, weight long, label long, width int, unit binary, signs array<int>"))
    bucketed = signed.select("*", F.posexplode("signs").alias("number", "sign")).withColumn(
        "bucket", F.xxhash64("label", "width", "number", "sign"))
    sizes = stored(
        bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .select("bucket", "_n", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks")))
    blocks = bucketed.join(sizes.drop("_n"), "bucket").withColumn(
        "block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    tiles = blocks.select(
        "class_id", "weight", "unit", "signs", "number", "bucket", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_other"),
    ).select("*", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"))
    # (A row is repeated for each block of its bucket.)
    repeated = sizes.agg(F.sum(F.col("_n") * F.col("blocks"))).first()[0] or 0
    groups = max(1, repeated // GROUP)
    found = stored(
        tiles.drop("_other")
        .withColumn("_group", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(groups)))
        .groupBy("_group").applyInArrow(_pairs_of_blocks(cosine), "class_id long, links long, root long"))
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = components(found, "class_id", "root")
    of_class = stored(
        classes.select("label", "h1", "h2", "class_id", "weight")
        .join(counts, "class_id", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("label", "h1", "h2",
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("root", "class_id").alias("component_id")))
    alone = rows.where("NOT _usable").select(
        "_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    every = keyed.drop("vector").join(of_class, ["label", "h1", "h2"]).select(
        "_id", "n_links", "component_id").unionByName(alone)
    return every.select(
        F.col("_id").alias(id_column), "n_links", "component_id",
        (F.col("_id").eqNullSafe(F.col("component_id"))).alias("kept"))
