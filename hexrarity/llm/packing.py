"""Best-fit packing planned on the histogram of lengths.

Documents become token ids (the public tokenizer's, then an end id) and are cut only
where longer than a sequence. The plan never sees a document: for each length, longest
first, its count goes best-fit into groups of equally filled sequences. Pieces then take
their planned slot by their rank within their length.

Size of the plan: a length ends by splitting at most one group and opens at most one,
and each time a group takes pieces its free space more than halves, so the plan has at
most about 3 * capacity * log2(capacity) rows whatever the number of documents (150,000
for 4096). It is made on the driver from at most ``capacity`` counts, and broadcast.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.common import LONGEST_WORD, ranked_within, stored, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
END_ID = 1
#: Chunks whose ids a worker keeps. (Fewer take less memory and more time.)
CACHE_CHUNKS = 900_000
#: Chunks that the tokenizer gets at once: what it returns is many times larger than ids.
ENCODED = 4000

#: A run of plain letters, then plain signs: the tokenizer's own pattern parts the two,
#: and neither has an apostrophe, a digit or a character that normalizing would change.
LETTERS_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?%&*$#|:;\"()]*)")


class ChunkIds:
    """Ids of the white-space free chunks of texts. The tokenizer drops white space and
    joins nothing across it, so the ids of a text are those of its chunks."""

    def __init__(self, tokenizer: str, kept: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.ids: dict[str, bytes] = {"": b""}
        self.kept = kept

    def learn(self, chunks: set[str]) -> list[str]:
        """Adds the ids of chunks; returns those that were not known."""
        new = list(chunks.difference(self.ids))
        if len(self.ids) + len(new) > self.kept:
            # (What these texts need stays, the words of most texts among it.)
            self.ids = {"": b""} | {c: self.ids[c] for c in chunks if c in self.ids}
        parts = [LETTERS_SIGNS.fullmatch(c) for c in new]
        roots = {
            x for c, m in zip(new, parts, strict=True)
            for x in ((m[1].lower(), m[2]) if m else (c,)) if x not in self.ids
        }
        order = list(roots)
        for at in range(0, len(order), ENCODED):
            some = order[at : at + ENCODED]
            for root, code in zip(
                some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True
            ):
                self.ids[root] = np.array(code.ids, "<u4").tobytes()
        for chunk, m in zip(new, parts, strict=True):
            if m:
                self.ids[chunk] = self.ids[m[1].lower()] + self.ids[m[2]]
        return new

    def encode(self, many: list[str]) -> list[bytes]:
        chunks = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in many]
        new = self.learn(set().union(*chunks))
        ids = [b"".join(map(self.ids.__getitem__, c)) for c in chunks]
        # (A text without spaces is one chunk, and unlikely to return. None is kept, so a long
        # chunk is always new.)
        for chunk in new:
            if len(chunk) > LONGEST_WORD:
                parts = LETTERS_SIGNS.fullmatch(chunk)
                for long in (chunk, *((parts[1].lower(), parts[2]) if parts else ())):
                    if len(long) > LONGEST_WORD:
                        self.ids.pop(long, None)
        return ids


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
           end_id: int = END_ID, id_column: str = "doc_id",
           text_column: str = "text", kept: int = CACHE_CHUNKS) -> DataFrame:
    """(id, ``piece``, ``start``, ``length``, ``ids_crc32``) of every piece."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)
    key = ("chunks", hashlib.sha256(tokenizer.encode()).hexdigest(), kept)
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches):
        chunks = worker_cache(key, lambda: ChunkIds(held.value, kept))
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                rows = []
                for row, ids in enumerate(chunks.encode(texts(part.column(1)))):
                    ids += end
                    rows += [
                        (row, at // width, at // 4, len(cut) // 4, zlib.crc32(cut))
                        for at in range(0, len(ids), width)
                        for cut in (ids[at : at + width],)
                    ]
                row, *columns = (pa.array(c) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), columns[0].cast(pa.int32()), *columns[1:]],
                    names=["_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return chosen.mapInArrow(
        run, f"_id {kind}, piece int, start long, length long, ids_crc32 long"
    ).withColumnRenamed("_id", id_column)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best fit, longest first, over counts of lengths.

    Rows (length, first rank, first sequence, pieces per sequence, offset): the ranks
    from the first one fill sequence after sequence, so many pieces each, from the
    offset on.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    filled = 0  # bit r: some sequences have r free places
    rows = []
    opened = 0

    def put(room: int, first: int, many: int) -> None:
        nonlocal filled
        if room and many:
            free.setdefault(room, []).append((first, many))
            filled |= 1 << room

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            fitting = filled >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                first, many = free[room].pop()
                if not free[room]:
                    filled &= ~(1 << room)
            else:
                room, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            each = room // length
            full = min(many, left // each)
            rest = left - full * each if full < many else 0
            for sequences, take in ((full, each), (1, rest)):
                if sequences and take:
                    rows.append((length, rank, first, take, capacity - room))
                    rank += sequences * take
                    left -= sequences * take
                    put(room - take * length, first, sequences)
                    first += sequences
                    many -= sequences
            put(room, first, many)
    return np.array(rows, np.int64).reshape(-1, 5)


def _placing(held):
    """A function for the executors: lengths and ranks to places in the broadcast plan."""

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        worker_cache(("places",), dict)  # frees the chunks that were cached here
        size, nth = length.to_numpy(), rank.to_numpy()
        planned = held.value
        row = planned[np.searchsorted(
            (planned[:, 0] << 44) + planned[:, 1], (size << 44) + nth, side="right") - 1]
        nth = nth - row[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(row[:, 2] + nth // row[:, 3]),
             pa.array(row[:, 4] + nth % row[:, 3] * size)],
            names=["sequence_id", "offset"],
        )

    return place


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
           end_id: int = END_ID, id_column: str = "doc_id",
           text_column: str = "text", kept: int = CACHE_CHUNKS) -> DataFrame:
    """Every piece of ``docs`` with its ``sequence_id`` and ``offset`` there.

    Columns: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``. NULL and empty texts have the end id only. Rows with equal ids are
    separate documents; equal lengths are told apart by id and piece. An empty table
    gives an empty one. Other columns are not returned. ``kept`` is how many chunks' ids a
    worker holds between texts; it changes no result.
    """
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id, id_column, text_column, kept))
    histogram = cut.groupBy("length").count().collect()  # at most ``capacity`` rows
    slots = plan({r["length"]: r["count"] for r in histogram}, capacity)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    held = docs.sparkSession.sparkContext.broadcast(slots)

    place = F.arrow_udf(_placing(held), "sequence_id long, offset long")
    ranked = ranked_within(cut, "length", [id_column, "piece"], "_rank")
    return ranked.withColumn("_slot", place("length", "_rank")).select(
        id_column, "piece", "start", "length", "ids_crc32", "_slot.sequence_id", "_slot.offset"
    )
