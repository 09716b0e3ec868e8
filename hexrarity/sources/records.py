"""Records of a delimited text file, of which quoted fields may hold line breaks, read in
splits like any text file.

Whether a line begins inside a quoted field depends on everything before it. So the file
is read in passes. The first notes for each split how it would leave the reader, inside
quotes or not, for either way of entering it: a map of two states, and such maps are
composed along the file, which gives every split the state that it is entered in. The
second pass then knows where records begin, and each split gives those that lie within it.
A record that goes on over the end of a split is put together from its parts, one of each
split; only these parts are shuffled.

The table of splits has a row for each of them: 800 thousand for 100 TB at 128 MB.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
SPLIT = ["file", "start"]


def stays_open(line: str, inside: bool, separator: str) -> bool:
    """Whether a line ends within a quoted field, if it begins within one or not. A quote
    opens a field only where the field begins; two of them within it stand for one; what
    follows the closing one belongs to the field as it is."""
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside = False
        elif line.startswith(QUOTE, at):
            inside = True
            at += 1
            continue
        at = line.find(separator, at) + 1
        if not at:
            return False


def _of_splits(batch: pa.RecordBatch):
    """((file, start), lines) of the parts of a batch; rows are in the order of the files."""
    files, starts = (batch.column(n).to_numpy() for n in (0, 1))
    first = 0
    for end in range(1, batch.num_rows + 1):
        if end == batch.num_rows or files[end] != files[first] or starts[end] != starts[first]:
            yield (int(files[first]), int(starts[first])), batch.slice(first, end - first)
            first = end


def _parts(batch: pa.RecordBatch):
    """As ``_of_splits``, at the cost of a comparison of arrays."""
    files, starts = (batch.column(n) for n in (0, 1))
    same = batch.num_rows > 0 and pc.all(pc.and_(
        pc.equal(files, files[0]), pc.equal(starts, starts[0]))).as_py()
    return [((files[0].as_py(), starts[0].as_py()), batch)] if same else _of_splits(batch)


def _maps(separator: str):
    """(file, start, left0, left1, ends, broken) of each split: the state it leaves, entered
    outside and inside quotes; whether a field that is open where it is entered ends in
    it; whether a line break lies within quotes."""

    def run(batches):
        split, state = None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*split, *map(int, state))],
                names=[*SPLIT, "left0", "left1", "ends", "broken"])

        for batch in batches:
            for key, lines in _parts(batch):
                if key != split:
                    if split is not None:
                        yield row()
                    split, state = key, [False, True, False, False]
                quoted = lines.column(2).drop_null()
                for line in quoted.to_pylist():
                    outside = stays_open(line, state[0], separator)
                    inside = outside if state[0] == state[1] else stays_open(line, state[1], separator)
                    state = [outside, inside, state[2] or not inside, state[3] or outside]
        if split is not None:
            yield row()

    return run


def entered(maps: DataFrame) -> DataFrame:
    """The splits with ``inside`` (the state that each is entered in), ``origin`` (the
    split in which the field open there began), ``closed`` (whether the field open at its
    end is ever closed) and ``plain``: all of it lies in a field that never is."""
    order = Window.partitionBy("file").orderBy("start")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    # A split either fixes the state or keeps or turns it: since the last that fixed it,
    # the number of turns counts.
    turns = F.sum(F.expr("CAST(left0 = 1 AND left1 = 0 AS INT)")).over(so_far) % 2
    fixed = F.last(F.when(F.col("left0") == F.col("left1"), F.col("left0").bitwiseXOR(F.col("_turns").cast("long"))),
                   ignorenulls=True).over(so_far)
    known = maps.withColumn("_turns", turns).withColumn(
        "_left", F.coalesce(fixed, F.lit(0)).bitwiseXOR(F.col("_turns").cast("long")))
    known = known.withColumn("inside", F.coalesce(F.lag("_left").over(order), F.lit(0)) == 1)
    ended = F.col("inside") & (F.col("ends") == 1)
    began = F.when((F.col("_left") == 1) & (~F.col("inside") | (F.col("ends") == 1)), F.col("start"))
    return known.withColumns({
        "origin": F.last(began, ignorenulls=True).over(before),
        "closed": F.coalesce(F.max(ended.cast("int")).over(after), F.lit(0)) == 1,
    }).select(
        *SPLIT, "inside", "origin", "closed",
        (F.col("inside") & (F.col("ends") == 0) & ~F.col("closed")).alias("plain"),
        ((F.col("_left") == 1) & F.col("closed") | F.col("inside")).alias("crossed"))


def _records(separator: str, header: bool, whole: bool):
    """Records within a split, without their header, if ``whole``; else the parts of those
    that go over an end of it. Columns of the splits follow the lines."""

    def run(batches):
        split, inside, open_lines, in_head, skip = None, False, [], False, False
        facts: dict = {}
        out: list = []

        def emit(chunk):
            nonlocal skip
            if whole and len(chunk):
                chunk = chunk[1:] if skip else chunk
                skip = False
                out.append(chunk)

        def part(origin):
            return [(pa.array(["\n".join(open_lines)], pa.string()), split[0], origin, split[1])] if not whole else []

        def batch_of(chunk, file=None, origin=None, start=None):
            n = len(chunk)
            return pa.RecordBatch.from_arrays(
                [chunk, *(pa.array([v] * n, pa.int64()) for v in (file, origin, start))],
                names=["value", "file", "origin", "part"])

        def closed_split():
            """What is left at the end of a split."""
            if not open_lines:
                return []
            if facts["closed"]:
                return part(facts["origin"] if in_head else split[1])
            emit(pa.array(open_lines, pa.string()))  # never closed: its lines are rows
            return []

        for batch in batches:
            parts: list = []
            out = []
            for key, lines in _parts(batch):
                if key != split:
                    if split is not None:
                        parts += closed_split()
                    split, open_lines = key, []
                    facts = {n: lines.column(n)[0].as_py() for n in ("inside", "origin", "closed", "plain")}
                    in_head = inside = facts["inside"] and not facts["plain"]
                    skip = header and key[1] == 0
                values = lines.column(2)
                if facts["plain"]:
                    emit(values)
                    continue
                first = 0
                quoted = pc.indices_nonzero(pc.match_substring(values, QUOTE)).to_pylist()
                for at in [*quoted, None]:
                    end = len(values) if at is None else at
                    if inside:
                        open_lines += values[first:end].to_pylist()
                    else:
                        emit(values[first:end])
                    if at is None:
                        break
                    first, line = at + 1, values[at].as_py()
                    was, inside = inside, stays_open(line, inside, separator)
                    if was or inside:
                        open_lines.append(line)
                    else:
                        emit(values[at : at + 1])
                    if was and not inside:
                        if in_head:
                            parts += part(facts["origin"])
                            in_head = False
                        else:
                            emit(pa.array(["\n".join(open_lines)], pa.string()))
                        open_lines = []
            if out:
                yield batch_of(pa.concat_arrays(out))
            yield from (batch_of(*p) for p in parts)
        out = []
        if split is not None:
            yield from (batch_of(*p) for p in closed_split())
            if out:
                yield batch_of(pa.concat_arrays(out))

    return run


def read_lines(spark: SparkSession, path: str, charset: str) -> DataFrame:
    """(``file``, ``start``, ``value``) of every line; files are named by a hash."""
    lines = spark.read.option("lineSep", "\n").option("encoding", charset).text(path)
    if charset.upper() in ("UTF-8", "UTF8"):
        text = F.make_valid_utf8("value")
    else:
        text = F.decode(F.col("value").cast("binary"), charset)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        text.alias("value"))


def find_breaks(lines: DataFrame, separator: str) -> DataFrame | None:
    """The splits as ``entered`` needs them, or None if no line break lies within quotes.
    Reads all lines; only those with quotes are looked at, if there are any."""
    if lines.where(F.instr("value", QUOTE) > 0).isEmpty():
        return None
    quoted = F.when(F.instr("value", QUOTE) > 0, F.col("value"))
    maps = lines.select(*SPLIT, quoted.alias("value")).mapInArrow(
        _maps(separator), "file long, start long, left0 long, left1 long, ends long, broken long").persist()
    if maps.where("broken = 1").isEmpty():
        maps.unpersist()
        return None
    return maps


def records(lines: DataFrame, maps: DataFrame, separator: str, header: bool = True) -> DataFrame:
    """(``value``): each record's text, line breaks within quotes as they are. A quote that
    is never closed opens nothing: from its line on, lines are records."""
    splits = entered(maps)
    schema = "value string, file long, origin long, part long"
    ordered = ["file", "start", "value", "inside", "origin", "closed", "plain"]
    within = lines.join(F.broadcast(splits), SPLIT).select(*ordered).mapInArrow(
        _records(separator, header, True), schema)
    over = lines.join(F.broadcast(splits.where("crossed")), SPLIT).select(*ordered).mapInArrow(
        _records(separator, header, False), schema)
    glued = over.groupBy("file", "origin").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "value"))), lambda p: p["value"]), "\n")
        .alias("value"))
    value = F.regexp_replace("value", "\r$", "")
    return within.select(value.alias("value")).unionByName(glued.select(value.alias("value")))
