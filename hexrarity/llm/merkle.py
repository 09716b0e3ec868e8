"""Merkle manifest of a table: a tree per group, a tree over the groups, and proofs that
a recursive query folds.

A row's leaf is the digest of its columns. Within a group, leaves stand in the order of
their ids; every ``FANOUT`` consecutive nodes become one of the next level, until one is
left, the group's subroot. The subroots, in the order of the groups, become the root the
same way. Built levels are stored as node rows that name their parent and hold their
children's digests.

The proofs come from one ``WITH RECURSIVE`` query: every leaf starts with its digest, or
that of a tampered row, and climbs from parent to parent. A step appends the siblings
met there and folds the digest with them; what a leaf has met, in the order of its steps,
is its proof. Spark shuffles the rows of every step, so only the leaf at the head of a run
takes along what is met above the run, which is the same for all of it.

Nothing is ranked, folded or joined in one task. Ranks come from a range-sorted table:
where a partition's rows of a group start is a sum over partitions. The lowest nodes,
of ``FANOUT`` leaves at most, are joined by a shuffle. Those above are broadcast while
they are few; beyond, a node above many leaves is repeated under ``ceil(leaves / BLOCK)``
salts, of which a climbing leaf picks one, so that no more than about ``BLOCK`` leaves
meet one node row.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexrarity.llm.common import stored

FANOUT = 16
#: Leaves that meet one copy of a node, about.
BLOCK = 4096
#: Nodes above the lowest (about one per 240 leaves, a kilobyte each) that are broadcast.
BROADCAST_NODES = 60_000
#: The tree over the subroots; the groups' own are numbered from 0.
TOP = -1
#: A node's place in its tree: its level above these bits, its number below.
LEVEL_BIT = 56
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for NULL, else the number of UTF-8
    bytes, a colon and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (``row``, ``part``, ``tree``, ``place``, ``many``, ``id``, ``leaf``,
    ``tampered``), ``nodes`` (a row per node above the leaves and salt), ``subroots``
    (``part``, ``tree``, ``subroot``) and the root, None for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _numbered(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` stored in the order of ``group`` and ``order`` with ``row``, a number in this
    order (with gaps), and ``part``, its partition; and (``part``, group, ``first``,
    ``before``, ``many``): the row that a partition's part of the group starts with, the
    rows of the group in earlier partitions, and all its rows."""
    # Rows equal in all columns may be very many: they are told apart by where they are
    # read, else one partition would get them all.
    by = [*group, *order, "_read"]
    ranged = df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*by)
    rows = stored(
        ranged.sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("row", 33)).drop("_read"))
    counts = rows.groupBy("part", *group).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("part")
    every = Window.partitionBy(*group)
    starts = counts.select(
        "part", *group, "first", (F.sum("_n").over(earlier) - F.col("_n")).alias("before"),
        F.sum("_n").over(every).alias("many"))
    return rows, stored(starts)


def _spot(level: int, number: Column) -> Column:
    return F.lit(level << LEVEL_BIT).cast("long") + number


def _levels(bottom: DataFrame) -> list[DataFrame]:
    """The levels above ``bottom`` (``tree``, ``place``, ``many``, ``digest``,
    ``leaves``), each with the same columns and ``children``, the digests below a node in
    their order. A tree ends with the level at which it has one node."""
    levels = []
    below, most = bottom, bottom.agg(F.max("many")).first()[0] or 0
    while most > 1:
        pairs = F.array_sort(F.collect_list(F.struct("place", "digest")))
        joined = (
            below.where("many > 1")
            .groupBy("tree", "many", F.expr(f"place div {FANOUT}").alias("_number"))
            .agg(F.transform(pairs, lambda x: x["digest"]).alias("children"), F.sum("leaves").alias("leaves"))
        )
        below = stored(joined.select(
            "tree", F.col("_number").alias("place"),
            F.expr(f"(many + {FANOUT - 1}) div {FANOUT}").alias("many"),
            F.sha2(F.concat_ws("", "children"), 256).alias("digest"), "leaves", "children"))
        levels.append(below)
        most = -(-most // FANOUT)
    return levels


def _with_parents(levels: list[DataFrame]) -> DataFrame:
    """Node rows: where they stand, their children, how many leaves they cover, and the
    place of their parent. Where a group's tree ends, the tree over the subroots goes on."""
    rows = []
    for level, nodes in enumerate(levels, 1):
        ends = F.col("many") == 1
        rows.append(nodes.select(
            "tree", _spot(level, F.col("place")).alias("spot"), "children", "leaves", "digest", "place", "many",
            F.when(~ends, F.col("tree")).alias("up_tree"),
            F.when(~ends, _spot(level + 1, F.expr(f"place div {FANOUT}"))).alias("up_spot"),
            F.when(~ends, F.expr(f"place % {FANOUT}")).cast("int").alias("up_place")))
    return reduce(DataFrame.unionByName, rows)


def build(rows: DataFrame, columns: Sequence[str], group_column: str, id_column: str,
          text_column: str) -> Manifest:
    """The manifest of ``rows``, whose leaves are digests of ``columns``.

    Rows of a group ascend by id, NULL ids first; equal ids by their leaf, so that a
    table has one manifest whatever its partitions. Groups ascend by the bytes of
    their names, NULL first. Repeated rows are leaves of their own. A tampered row has the
    ASCII capitals of ``text_column`` in lower case; rows are tampered with where 5
    divides the CRC-32 of the decimal id (never for a NULL id). An empty table has no
    root. Other columns do not count.
    """
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == text_column else F.col(c) for c in columns]
    chosen = F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0
    leaf = digest(*(F.col(c) for c in columns))
    hashed = rows.select(
        F.col(group_column).alias("group"), F.col(id_column).alias("id"), leaf.alias("leaf"),
        F.when(chosen, digest(*changed)).alias("tampered"))
    placed, starts = _numbered(hashed, ["group"], ["id", "leaf"])
    names, name_starts = _numbered(starts.select("group").distinct(), [], ["group"])
    trees = names.join(name_starts.drop("many"), "part").select(
        F.col("group").alias("_group"), (F.col("row") - F.col("first") + F.col("before")).alias("tree"))
    starts = stored(starts.join(trees, F.col("group").eqNullSafe(F.col("_group"))).drop("_group"))
    at = [F.col("at.part") == F.col("rows.part"), F.col("at.group").eqNullSafe(F.col("rows.group"))]
    leaves = stored(
        placed.alias("rows").join(starts.alias("at"), at).select(
            "row", "rows.part", "tree", (F.col("row") - F.col("first") + F.col("before")).alias("place"),
            "many", "id", "leaf", "tampered"))

    one = F.lit(1).cast("long").alias("leaves")
    own = _levels(leaves.select("tree", "place", "many", F.col("leaf").alias("digest"), one))
    ends = [leaves.where("many = 1").select("tree", F.col("leaf").alias("digest"), one)]
    ends += [level.where("many = 1").select("tree", "digest", "leaves") for level in own]
    subroots = stored(reduce(DataFrame.unionByName, ends))
    groups = subroots.count()
    top = _levels(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"),
        F.lit(groups).cast("long").alias("many"), "digest", "leaves"))
    last = top[-1] if top else subroots
    root = last.select("digest").first()

    nodes = None
    if own or top:
        above = [_with_parents(levels) for levels in (own, top) if levels]
        nodes = reduce(DataFrame.unionByName, above)
        if top:
            ended = (F.col("many") == 1) & (F.col("tree") != TOP)
            nodes = nodes.withColumns({
                "up_tree": F.when(ended, F.lit(TOP).cast("long")).otherwise(F.col("up_tree")),
                "up_spot": F.when(ended, _spot(1, F.expr(f"tree div {FANOUT}"))).otherwise(F.col("up_spot")),
                "up_place": F.when(ended, F.expr(f"tree % {FANOUT}").cast("int")).otherwise(F.col("up_place"))})
        salts = F.ceil(F.col("leaves") / BLOCK).cast("int")
        nodes = stored(nodes.select(
            "tree", "spot", "children", "up_tree", "up_spot", "up_place", salts.alias("salts")))
    return Manifest(
        leaves, nodes,
        stored(starts.select("part", "tree").join(
            subroots.select("tree", F.col("digest").alias("subroot")), "tree")),
        root[0] if root else None)


_LEFT, _RIGHT = "slice(n.children, 1, c.up_place)", f"slice(n.children, c.up_place + 2, {FANOUT})"
_FOLDED = f"unhex(sha2(concat_ws('', {_LEFT}, lower(hex(c.folded)), {_RIGHT}), 256)) AS folded"

FIRST = f"""
SELECT c.row, c.part, c.tree, c.id, c.leaf, c.up_spot AS run, c.up_place AS own, c.up_place = 0 AS lead,
 n.up_tree, n.up_spot, n.up_place, n.up_salts, {_FOLDED}
FROM {{start}} c JOIN {{nodes}} n ON n.tree = c.up_tree AND n.spot = c.up_spot
UNION ALL
SELECT c.row, c.part, c.tree, c.id, c.leaf, 0, NULL, TRUE, c.up_tree, c.up_spot, c.up_place, c.up_salts, c.folded
FROM {{lone}} c
"""
CLIMB = f"""
WITH RECURSIVE climb AS (
 SELECT row, lead, up_tree, up_spot, up_place, up_salts, folded, CAST('' AS BINARY) AS siblings FROM {{first}}
 UNION ALL
 SELECT c.row, c.lead, n.up_tree, n.up_spot, n.up_place, n.up_salts, {_FOLDED},
  CASE WHEN c.lead THEN concat(c.siblings, unhex(concat_ws('', {_LEFT}, {_RIGHT}))) ELSE c.siblings END
 FROM climb c JOIN {{nodes}} n
  ON n.tree = c.up_tree AND n.spot = c.up_spot AND n.salt = pmod(xxhash64(c.row), c.up_salts))
SELECT row, folded AS folded_root, CASE WHEN lead THEN siblings END AS siblings FROM climb WHERE up_tree IS NULL
"""


@contextmanager
def _no_row_limit(spark: SparkSession):
    """Recursive queries stop at a million rows by default; a table has more leaves."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def climbed(manifest: Manifest, digests: Column) -> DataFrame:
    """(``row``, ``part``, ``tree``, ``id``, ``leaf``, ``folded_root``, ``proof_sha256``) of
    every leaf: ``digests``, a column of the manifest's leaves, folded with the siblings on
    the way to the root, and the digest of those siblings, level by level and from left
    to right."""
    leaves, spark = manifest.leaves, manifest.leaves.sparkSession
    lone = F.col("many") == 1
    # A lone leaf is its group's subroot, so it stands in the tree over these.
    start = leaves.select(
        "row", "part", "tree", "id", "leaf", F.unhex(digests).alias("folded"), lone.alias("_lone"),
        F.when(lone, F.lit(TOP).cast("long")).otherwise(F.col("tree")).alias("up_tree"),
        F.when(lone, F.col("tree")).otherwise(F.col("place")).alias("_place")).select(
        "*", _spot(1, F.expr(f"_place div {FANOUT}")).alias("up_spot"),
        F.expr(f"CAST(_place % {FANOUT} AS INT)").alias("up_place")).drop("_place")
    if manifest.nodes is None:  # one leaf in all
        return start.select(
            "row", "part", "tree", "id", "leaf", F.lower(F.hex("folded")).alias("folded_root"),
            F.sha2(F.lit(""), 256).alias("proof_sha256"))
    salts = manifest.nodes.select(
        F.col("tree").alias("up_tree"), F.col("spot").alias("up_spot"), F.col("salts").alias("up_salts"))
    nodes = stored(manifest.nodes.join(salts, ["up_tree", "up_spot"], "left"))
    lowest = (F.col("tree") != TOP) & (F.col("spot") < _spot(2, F.lit(0)))
    runs = nodes.where(lowest)
    first = stored(spark.sql(
        FIRST, start=start.where("NOT _lone"), nodes=runs,
        lone=start.where("_lone").join(salts, ["up_tree", "up_spot"], "left")))
    upper = stored(nodes.where(~lowest).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    with _no_row_limit(spark):
        few = upper.count() <= BROADCAST_NODES
        tops = stored(spark.sql(CLIMB, first=first, nodes=F.broadcast(upper) if few else upper))
    # What the leaf at the head of a run has met above is met by all leaves of the run.
    met = first.where("lead").select("row", "tree", "run").join(tops, "row").select("tree", "run", "siblings")
    met = met.join(runs.select("tree", F.col("spot").alias("run"), "children"), ["tree", "run"], "left")
    beside = F.expr(f"concat_ws('', slice(children, 1, own), slice(children, own + 2, {FANOUT}))")
    return (
        first.select("row", "part", "tree", "id", "leaf", "run", "own").join(tops.drop("siblings"), "row")
        .join(met, ["tree", "run"]).select(
            "row", "part", "tree", "id", "leaf", F.lower(F.hex("folded_root")).alias("folded_root"),
            F.sha2(F.concat(beside, F.lower(F.hex("siblings"))), 256).alias("proof_sha256"))
    )


def verified(rows: DataFrame, columns: Sequence[str], group_column: str = "source", id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """(id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``,
    ``verified``) of every row: whether its digest, tampered with or not, folds to the
    root. An empty table gives an empty one; see ``build`` for NULLs and repeated rows."""
    manifest = build(rows, columns, group_column, id_column, text_column)
    proofs = climbed(manifest, F.coalesce("tampered", "leaf"))
    root = F.lit(manifest.root).cast("string")
    return proofs.join(manifest.subroots, ["part", "tree"]).select(
        F.col("id").alias(id_column), "leaf", "subroot", root.alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == root).alias("verified"))
