"""Jaccard self-join of documents on word shingles by T-occurrence search (DivideSkip).

A document with n shingles can only link to one that shares T = ceil(0.8 n) of them. Of
its inverted lists, T - c may go unmerged, the longest ones: every partner still stands
in at least c of the others, the short ones. Lists are long if their shingle is frequent
(repeated passages), and otherwise taken in the order of hashes; the order is the same
for all documents, so both sides of a pair agree on it. c is a tenth of n.

The short lists are merged in buckets of shingles. A document that meets any others in
fewer than c of its short lists has no partner and is done with; nearly all texts that
are no copies end here. The lists of the others propose pairs, which are settled by
probing the whole sorted shingle sets, long lists included, with binary search, and kept
if the overlap reaches the required one.

Documents with equal sets are one class. Only components are asked for, so a list
proposes the pairs of its first member with the others, and those that are proposed by c
lists are probed, unless the bits of their marks (``marks``) differ too much. What these
links leave apart is settled in two ways, and classes that are joined already need no look
at each other. Lists of up to ``LIST`` classes are merged: they count, for each pair of
classes with different roots and fitting sizes, the short lists they share, and pairs that
share c of them are probed likewise. Classes that share a longer list are compared in blocks with their whole sets.
A group of thousands of near copies so costs a pair per member and what its first member
did not reach.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.common import components, free_name, merge_links, stored, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
#: Linked at 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles counted as frequent at most (their hashes are broadcast: 8 bytes each), and
#: from how many sightings on. Any choice gives the same links; it only moves work.
FREQUENT = 500_000
SIGHTINGS = 16
#: Shingles a task counts at a time; postings in a bucket, about.
COUNTED = 1_500_000
BUCKET = 60_000
#: Class ids broadcast at most (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000
#: Bits of a class's marks, a power of two.
MARKS = 1024
#: Classes of a list whose pairs are counted; it has at most half its square of them.
LIST = 64
#: Classes of a block that is compared with others at a time.
BLOCK = 512
#: Rows that a task of such comparisons takes at a time, about.
GROUP = 2048

POSTING = np.dtype([("shingle", "<u8"), ("cls", "<u8")])
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    import xxhash

    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(ids))
    mixed = np.full(len(ids) - width + 1, width, np.uint64) * ODD[7]
    for k in range(width):
        # (A turn of the position and an odd factor: every order of words differs.)
        mixed = (mixed ^ ids[k : len(ids) - width + 1 + k]) * ODD[k % 7]
        mixed ^= mixed >> np.uint64(31)
    mixed ^= mixed >> np.uint64(32)
    mixed *= ODD[2]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_key(shingles: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def required(n, percent: int = PERCENT):
    """Shared shingles that a document of ``n`` needs with any partner."""
    return -(-percent * n // 100)


def short_lists(n, percent: int = PERCENT):
    """(lists to merge, lists with others that a document with a partner has) for ``n``."""
    least = max(1, -(-n // 10))
    return min(n, n - required(n, percent) + least), least


def marks(shingles: np.ndarray) -> np.ndarray:
    """``MARKS`` bits in 64-bit words; every shingle turns its own over. Two sets differ by
    at least as many shingles as their marks differ by bits."""
    turned = np.bincount((shingles >> np.uint64(20)) & np.uint64(MARKS - 1), minlength=MARKS) & 1
    return np.packbits(turned.astype(np.uint8)).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity: the shorter one's shingles are
    looked up in the longer one."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b) or not len(a):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _signed(x) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def _summaries(words: int):
    """Per document its set's size and key; per shingle seen twice in a stretch of a
    task's documents (equal sets once), how often, as a negative number."""

    def run(batches):
        worker_cache(("shingles",), dict)  # frees what an earlier stage has cached here
        held, many, seen = [], 0, set()

        def frequent():
            shingle, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            return pa.RecordBatch.from_arrays(
                [pa.nulls(int(often.sum()), kind), pa.array(-count[often].astype(np.int64)),
                 _signed(shingle[often])], names=["_id", "n", "key"])

        for batch in batches:
            kind = batch.column(0).type
            sizes, keys = [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), words)
                sizes.append(len(shingles))
                keys.append(set_key(shingles))
                if keys[-1] not in seen:
                    seen.add(keys[-1])
                    held.append(shingles)
                    many += len(shingles)
                if many > COUNTED:
                    yield frequent()
                    held, many, seen = [], 0, set()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 _signed(np.array(keys, np.uint64))], names=["_id", "n", "key"])
        if held:
            yield frequent()

    return run


def _short_lists(frequent, buckets: int, words: int, percent: int):
    """Postings of each document's short lists, a blob per bucket and batch."""

    def run(batches):
        long_lists = frequent.value
        for batch in batches:
            shingles, classes, seen = [], [], set()
            for text in batch.column(0):
                own = shingle_set(text.as_py(), words)
                key = set_key(own)
                if not len(own) or key in seen:
                    continue
                seen.add(key)
                keep, _ = short_lists(len(own), percent)
                if len(long_lists):
                    at = np.searchsorted(long_lists, own)
                    at[at == len(long_lists)] = 0
                    own = own[np.argsort(long_lists[at] == own, kind="stable")]
                shingles.append(own[:keep])
                classes.append(key)
            if not classes:
                continue
            lengths = [len(s) for s in shingles]
            rows = np.empty(sum(lengths), POSTING)
            rows["shingle"] = np.concatenate(shingles)
            rows["cls"] = np.repeat(np.array(classes, np.uint64), lengths)
            bucket = (rows["shingle"] >> np.uint64(17)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            ids, starts = np.unique(bucket, return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)),
                 pa.array([r.tobytes() for r in np.split(rows, starts[1:])], pa.binary())],
                names=["bucket", "postings"])

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """(shingle, class) of the lists of a bucket with more than one class."""
    rows = np.frombuffer(b"".join(table.column("postings").to_pylist()), POSTING)
    rows = rows[np.lexsort((rows["cls"], rows["shingle"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["shingle"][1:] != rows["shingle"][:-1]) | (rows["cls"][1:] != rows["cls"][:-1])
    rows = rows[new]
    same = rows["shingle"][1:] == rows["shingle"][:-1]
    shared = np.zeros(len(rows), bool)
    shared[1:] |= same
    shared[:-1] |= same
    rows = rows[shared]
    return pa.table({"shingle": _signed(rows["shingle"]), "cls": _signed(rows["cls"])})


def overlaps(left: list[np.ndarray], right: list[np.ndarray]):
    """(i, number of shingles that left i shares with each of right), for each i. The
    shingles of ``right`` are numbered once; a set of ``left`` is marked among them by
    binary search and counted set by set."""
    names, codes = np.unique(np.concatenate(right), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in right])[:-1]])
    marked = np.zeros(len(names), np.int32)
    for i, own in enumerate(left):
        at = np.searchsorted(names, own)
        at[at == len(names)] = 0
        at = at[names[at] == own]
        marked[at] = 1
        yield i, np.add.reduceat(marked[codes], starts)
        marked[at] = 0


def _links_between(percent: int):
    """Spanning links of the similar pairs between two blocks (or within one) of classes
    with different roots."""

    def run(table: pa.Table) -> pa.Table:
        tile = table.column("tile").to_numpy()
        order = np.argsort(tile, kind="stable")
        cls, root, side = (table.column(c).to_numpy()[order] for c in ("cls", "root", "side"))
        blobs = table.column("shingles").combine_chunks().take(pa.array(order))
        bounds = np.flatnonzero(np.diff(tile[order])) + 1
        found: list = []
        for rows in np.split(np.arange(len(order)), bounds):
            sets = [np.frombuffer(blobs[k].as_buffer(), np.uint64) for k in rows.tolist()]
            sizes = np.array([len(x) for x in sets])
            within = (side[rows] == 2).all()
            left = np.flatnonzero(side[rows] != 1)
            right = np.flatnonzero(side[rows] != 0)
            if not len(left) or not len(right):
                continue
            for i, shared in overlaps([sets[k] for k in left], [sets[k] for k in right]):
                k = left[i]
                near = (100 * shared >= percent * (sizes[k] + sizes[right] - shared)) & (
                    root[rows[right]] != root[rows[k]])
                if within:
                    near &= right > k
                if near.any():
                    other = cls[rows[right[near]]]
                    found.append(np.stack([np.full(len(other), cls[rows[k]]), other]))
        if not found:
            return pa.table({"a": pa.nulls(0, pa.int64()), "b": pa.nulls(0, pa.int64())})
        a, b = np.concatenate(found, axis=1)
        member, top = merge_links(a, b)
        other = member != top
        return pa.table({"a": member[other], "b": top[other]})

    return run


def _sets(words: int):
    """Class keys, sizes, marks and shingle sets of texts; those of a slice once."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                own = (shingle_set(t.as_py(), words) for t in batch.column(0).slice(first, 1000))
                found = {set_key(x): x for x in own if len(x)}
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.array(list(found), np.uint64)),
                     pa.array([len(x) for x in found.values()], pa.int64()),
                     pa.array([marks(x) for x in found.values()], pa.list_(pa.int64())),
                     pa.array([x.tobytes() for x in found.values()], pa.binary())],
                    names=["cls", "n", "marks", "shingles"])

    return run


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            keep = [
                linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _roots(links: DataFrame, name: str) -> DataFrame:
    return components(links, "a", "b").withColumnRenamed("node", name)


def _met_often(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes with different roots and fitting sizes that share as many of their
    short lists as the smaller one's ``short_lists`` asks for."""
    left = lists.select("shingle", F.col("cls").alias("a"), F.col("n").alias("_na"), F.col("root").alias("_ra"))
    right = lists.select("shingle", F.col("cls").alias("b"), F.col("n").alias("_nb"), F.col("root").alias("_rb"))
    smaller = F.least("_na", "_nb")
    met = left.join(right, "shingle").where(
        (F.col("a") < F.col("b")) & (F.col("_ra") != F.col("_rb"))
        & (100 * smaller >= percent * F.greatest("_na", "_nb")))
    return _shared_enough(met.select("a", "b", smaller.alias("_n")))


def _shared_enough(met: DataFrame) -> DataFrame:
    """Pairs that stand in ``met`` as often as short lists are asked for with ``_n`` shingles."""
    enough = F.greatest(F.lit(1), F.ceil(F.col("_n") / 10))
    return met.groupBy("a", "b", enough.alias("_enough")).agg(F.count(F.lit(1)).alias("_shared")).where(
        "_shared >= _enough").select("a", "b")


def _between_roots(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of a family that have different roots so far.

    A root with a block's worth of classes has blocks of its own, which need not be
    compared with each other; the classes of smaller roots share blocks. Tasks take
    pairs of blocks with the whole sets, so no pair is written and no family is in one
    task.
    """
    sizes = members.groupBy("family", "root").agg(F.count(F.lit(1)).alias("_n"))
    mixed = sizes.groupBy("family").agg(
        F.count(F.lit(1)).alias("_roots"),
        F.sum(F.when(F.col("_n") < BLOCK, F.col("_n")).otherwise(0)).alias("_small"))
    mixed = mixed.where("_roots > 1")
    # own: the root whose blocks these are, or NULL for the shared ones.
    plan = stored(sizes.join(mixed, "family").select(
        "family", "root", F.when(F.col("_n") >= BLOCK, F.col("root")).alias("own"),
        F.greatest(F.ceil(F.when(F.col("_n") >= BLOCK, F.col("_n")).otherwise(F.col("_small")) / BLOCK),
                   F.lit(1)).cast("int").alias("blocks")))
    name = F.xxhash64(F.coalesce(F.col("own"), F.lit(0)), F.col("own").isNull(), F.col("block"))
    placed = members.join(plan, ["family", "root"]).withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    placed = placed.select("cls", "family", "root", "own", name.alias("name"))
    others = stored(
        plan.select("family", "own", "blocks").distinct()
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("family", F.col("own").alias("_own"), name.alias("_name")))
    tiles = placed.join(others, "family").where(
        F.col("own").isNull() | F.col("_own").isNull() | (F.col("own") != F.col("_own")))
    tiles = tiles.select(
        "cls", "root",
        F.xxhash64("family", F.least("name", "_name"), F.greatest("name", "_name")).alias("tile"),
        F.when(F.col("name") == F.col("_name"), 2).when(F.col("name") < F.col("_name"), 0)
        .otherwise(1).alias("side"))
    tiles = stored(tiles)
    groups = max(1, tiles.count() // GROUP)
    return (
        tiles.join(sets.select("cls", "shingles"), "cls").withColumn("_group", F.pmod(F.col("tile"), F.lit(groups)))
        .groupBy("_group").applyInArrow(_links_between(percent), "a long, b long"))


def joined(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``n_shingles``, ``component_id``) of every row of ``docs``.

    Ids are whole numbers. A row without one has nothing to be named by: it links with
    nothing, and its component is NULL. Texts that are NULL, empty or white space have no
    shingles and link with nothing; fewer than ``words`` words are one shingle. Equal
    texts, and rows with equal ids, are linked. Long texts are read whole. An empty table
    gives an empty one. Other columns are not returned.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    seen = stored(chosen.mapInArrow(_summaries(words), "_id long, n long, key long"))
    own = seen.where("n >= 0")
    classes = stored(
        own.where("n > 0 AND _id IS NOT NULL").groupBy("key", "_id").agg(
            F.max("n").alias("n"), F.count(F.lit(1)).alias("_rows"))
        .groupBy("key").agg(F.min(F.struct("_id", "_rows")).alias("_first"), F.max("n").alias("n"))
        .select("key", F.col("_first._id").alias("rep"), "n", (F.col("_first._rows") > 1).alias("several")))
    frequent = (
        seen.where("n < 0").groupBy("key").agg(F.sum(-F.col("n")).alias("sum"))
        .where(F.col("sum") >= SIGHTINGS).orderBy(F.desc("sum"), "key").limit(FREQUENT)
        .select("key").toArrow()
    )
    held = spark.sparkContext.broadcast(
        np.sort(frequent.column(0).to_numpy().astype(np.int64).view(np.uint64)))
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(total * (100 - percent) / 100 / BUCKET))
    postings = chosen.select("_text").mapInArrow(
        _short_lists(held, buckets, words, percent), "bucket long, postings binary")
    shared = stored(postings.groupBy("bucket").applyInArrow(_repeated, "shingle long, cls long"))
    met = shared.groupBy("cls").agg(F.count(F.lit(1)).alias("_met"))
    candidates = stored(
        met.join(classes.withColumnRenamed("key", "cls"), "cls")
        .where(F.col("_met") >= F.greatest(F.lit(1), F.ceil(F.col("n") / 10)))
        .select("cls", F.col("rep").alias("_id"), "n", "several"))
    few = candidates.count() <= BROADCAST_IDS
    wanted = F.broadcast(candidates) if few else candidates
    lists = stored(shared.join(wanted.select("cls", "n"), "cls"))
    # (Rows with a representative's id may have other texts, of other classes.)
    ids = candidates.select("_id").distinct()
    found = stored(
        chosen.join(F.broadcast(ids) if few else ids, "_id", "left_semi").select("_text")
        .mapInArrow(_sets(words), "cls long, n long, marks array<long>, shingles binary")
        .join(wanted.select("cls", "several"), "cls"))
    # (Only a row that is repeated can have given its set twice.)
    sets = found.where("NOT several").drop("several")
    sets = sets.unionByName(stored(found.where("several").drop("several").dropDuplicates(["cls"])))

    def sets_of(classes: DataFrame) -> DataFrame:
        # (The others need not be shuffled.)
        return sets.join(F.broadcast(classes) if few else classes, "cls", "left_semi")

    def possible(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("cls").alias("a"), F.col("n").alias("_na"), F.col("marks").alias("_ma"))
        right = sets.select(F.col("cls").alias("b"), F.col("n").alias("_nb"), F.col("marks").alias("_mb"))
        apart = F.aggregate(
            F.zip_with("_ma", "_mb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        both = F.col("_na") + F.col("_nb")
        # (At most half of what the sets have beyond their difference is shared.)
        return pairs.join(left, "a").join(right, "b").where(
            (100 + percent) * (both - apart) >= 2 * percent * both).select("a", "b")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stored(possible(pairs))
        left = sets_of(pairs.select(F.col("a").alias("cls")).distinct()).select(
            F.col("cls").alias("a"), F.col("shingles").alias("_x"))
        right = sets_of(pairs.select(F.col("b").alias("cls")).distinct()).select(
            F.col("cls").alias("b"), F.col("shingles").alias("_y"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b")
        return both.select("a", "b", "_x", "_y").mapInArrow(_verified(percent), "a long, b long")

    # (Stored: AQE can split a join of plain shuffles where a list is very long.)
    first = stored(lists.groupBy("shingle").agg(F.min(F.struct("cls", "n")).alias("_first")))
    sizes = [F.col("n"), F.col("_first.n")]
    near = 100 * F.least(*sizes) >= percent * F.greatest(*sizes)
    # (Where other classes come first in lists that two share, these count too few; what is
    # left apart is counted in full below.)
    stars = _shared_enough(
        lists.join(first, "shingle").where((F.col("_first.cls") != F.col("cls")) & near)
        .select(F.col("_first.cls").alias("a"), F.col("cls").alias("b"), F.least(*sizes).alias("_n")))
    links = stored(verify(stars))
    root_of = stored(
        candidates.select("cls").join(_roots(links, "cls"), "cls", "left")
        .select("cls", F.coalesce("root", "cls").alias("root")))
    # Lists that hold classes of different roots still, by how many classes they have.
    # (Classes that share lists with their own root's only need no further look.)
    rooted = stored(lists.join(F.broadcast(root_of) if few else root_of, "cls"))
    mixed = rooted.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("_many"), F.min("root").alias("_least"), F.max("root").alias("_most"))
    mixed = stored(mixed.where("_least <> _most").select("shingle", "_many"))
    counted = rooted.join(mixed.where(F.col("_many") <= LIST).select("shingle"), "shingle")
    links = links.unionByName(stored(verify(_met_often(counted, percent))))
    # All classes that share a long list are of one family; whoever links there is, too. (A
    # first member that is too large or too small for two others still holds them together.)
    long = stored(mixed.where(F.col("_many") > LIST).select("shingle"))
    families = components(
        lists.join(long, "shingle").join(first, "shingle")
        .select(F.col("_first.cls").alias("a"), F.col("cls").alias("b")).where("a <> b").distinct(), "a", "b")
    members = stored(
        families.select(F.col("node").alias("cls"), F.col("root").alias("family"))
        .unionByName(families.select(F.col("root").alias("cls"), F.col("root").alias("family")).distinct())
        .join(root_of, "cls").select("cls", "family", "root"))
    links = links.unionByName(stored(_between_roots(members, sets_of(members.select("cls")), percent)))
    roots = components(
        links.join(classes.select(F.col("key").alias("a"), F.col("rep").alias("_ra")), "a")
        .join(classes.select(F.col("key").alias("b"), F.col("rep").alias("_rb")), "b"),
        "_ra", "_rb")
    of_class = stored(
        classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", F.coalesce("root", "rep").alias("root")))
    return own.join(of_class, "key", "left").select(
        F.col("_id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("_id").isNotNull(), F.coalesce("root", "_id")).alias("component_id"))


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, and one
    of its rows if it has several. Rows without id stay."""
    groups = joined(docs, words, percent, id_column, text_column)
    own = F.col(id_column).cast("long")
    rows, name, gone = (free_name(docs, wish) for wish in ("_rows", "_rows_id", "_rows_gone"))
    # Ids that go or are repeated; most are neither, so most texts are not shuffled for them.
    special = stored(
        groups.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias(name)).agg(
            F.count(F.lit(1)).alias(rows), F.max(F.col(id_column) != F.col("component_id")).alias(gone))
        .where(F.col(gone) | (F.col(rows) > 1)))
    known = F.broadcast(special) if special.count() <= BROADCAST_IDS else special
    kept = docs.join(known, own == F.col(name), "left").where(~F.coalesce(gone, F.lit(False))).drop(name, gone)
    once = kept.where(F.col(rows).isNull()).drop(rows)
    several = kept.where(F.col(rows).isNotNull()).drop(rows).dropDuplicates([id_column])
    return once.unionByName(several)
