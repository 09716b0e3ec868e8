"""What the operators share: stored intermediate tables, code that travels with a
task, caches of a worker process, ranks that no single task has to make, and
components of a link table."""

from __future__ import annotations

import hashlib
import sys
import tempfile
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a worker's word cache, which is emptied when full, and the characters of the
#: longest words that it keeps. (A text without spaces is one word, and unlikely to return.)
CACHE_WORDS = 200_000
LONGEST_WORD = 64


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``. A local session
    without that setting gets a folder of its own; a cluster must name one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there, and a
    lost executor costs no more than its running tasks. The table goes with the
    application."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def worker_store() -> dict:
    """A dictionary of this worker process. Module variables would not do: code that
    travels by value gets new ones with each task."""
    name = "_llm_worker_store"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__


class WordCache(dict):
    """Values by word, made on first use; emptied when it is full."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        value = self.make(word)
        if isinstance(word, str) and len(word) > LONGEST_WORD:
            return value
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value


def worker_cache(key: tuple, make_all):
    """``make_all()`` once per worker process and key. A worker keeps the latest key's
    value only: the stages of a pipeline follow each other, and their caches would add
    up."""
    store = worker_store().setdefault("held", {})
    if key not in store:
        store.clear()
        pa.default_memory_pool().release_unused()
        store[key] = make_all()
    return store[key]


def digest(*parts) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def texts(column: pa.Array) -> list[str]:
    """Python strings; NULL is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def ranked_within(df: DataFrame, key: str, order: list[str], rank: str) -> DataFrame:
    """Adds ``rank``, from 0 without gaps, of each row within ``key``, which has few
    values (lengths, shards) and no NULL; ``df`` is read twice.

    A key may hold most of the rows, so none is ranked in one task: a key of n rows is
    dealt by hash over about sqrt(n) buckets; ranks are made within buckets, and a
    bucket starts where the buckets before it end. ``order`` should tell rows apart;
    rows equal in it are ranked in any order.
    """
    sizes = df.groupBy(key).agg(F.ceil(F.sqrt(F.count(F.lit(1)))).alias("_buckets"))
    dealt = df.join(F.broadcast(sizes), key).withColumn(
        "_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.col("_buckets"))
    ).drop("_buckets")
    counts = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket")
    starts = counts.select(key, "_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_start"))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(rank, F.col("_inside") + F.col("_start"))
        .drop("_bucket", "_inside", "_start")
    )


def merge_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of the components of some links; the root is the smallest member.
    Minimum labels travel over the links and jump along themselves."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return names, names[label]
        label = new


def _local_roots(batches):
    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
    if a:
        member, root = merge_links(np.concatenate(a), np.concatenate(b))
        other = member != root
        yield pa.RecordBatch.from_arrays(
            [pa.array(member[other]), pa.array(root[other])], names=["a", "b"]
        )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(``node``, ``root``) of every node of the long-valued links other than the roots
    themselves; the root is the smallest node that the links reach.

    Each task first reduces its links to one per node. Then large and small stars take
    turns: every node links its larger neighbours to its smallest one, then all its
    smaller neighbours to the smallest, until nothing changes. Each round halves chains;
    stars are kept as (node, root) pairs, at most one per node and step. A node with very
    many neighbours costs a minimum by hash aggregation and a join, not a list in one
    task.
    """
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(edges.mapInArrow(_local_roots, "a long, b long"))
    while True:
        # Hook: the smallest root around each node, seen from its present root.
        # (Stored, so that the joins below are of plain shuffles, which AQE can split
        # where many nodes share a root.)
        least = stored(edges.groupBy(F.col("a").alias("node")).agg(
            F.min("b").alias("root"), F.max("b").alias("top")))
        split = least.where("root <> top").select("node", "root")
        more = edges.join(split.select(F.col("node").alias("a"), "root"), "a").where(
            "b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        stars = least.select(F.col("node").alias("a"), F.col("root").alias("b"))
        # Jump: a root that has a smaller root itself.
        up = least.select(F.col("node").alias("b"), F.col("root").alias("_up"))
        jumped = stars.join(up, "b", "left").select(
            "a", F.coalesce("_up", "b").alias("b"), F.col("_up").isNotNull().alias("moved"))
        new = stored(
            jumped.unionByName(more.select("a", "b", F.lit(True).alias("moved")))
            .groupBy("a", "b").agg(F.max("moved").alias("moved"))
        )
        edges = new.select("a", "b")
        if not new.where("moved").take(1):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
