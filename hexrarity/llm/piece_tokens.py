"""SentencePiece BPE encoding and decoding by the last token of every prefix.

A text falls into units that no piece can span: before a run of word marks, and
between two characters that stand side by side in no piece. In a unit, each prefix has
one last token: the match ending there that is compatible with the last token of the
prefix before it. An automaton over the pieces gives the matches; two tokens are
compatible if encoding their joined text gives just these two, which walking their
merges backwards tells. The ids are read backwards from the last prefix, so a unit
costs time in proportion to its length, however long it is.
"""

from __future__ import annotations

import hashlib
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.common import WordCache, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
#: Rank of pieces that are single characters: there before any merge.
LEAF = -1


class Vocabulary:
    """Pieces of a model with merge ranks, splits and the automaton."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(library.vocab_size())
        self.bos, self.eos, self.unk = library.bos_id(), library.eos_id(), library.unk_id()
        special = {i for i in ids if library.is_control(i) or library.is_unknown(i)}
        self.bytes_of = {}
        self.text_of = [b""] * len(ids)
        piece_of = {}
        for i in ids:
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes_of[int(piece[3:5], 16)] = i
                self.text_of[i] = bytes([int(piece[3:5], 16)])
            elif i not in special:
                piece_of[i] = piece
                self.text_of[i] = piece.replace(MARK, " ").encode()
        if library.unk_id() in special:
            self.text_of[self.unk] = " ⁇ ".encode()
        self.id_of = {p: i for i, p in piece_of.items()}
        # Better scores merge first; runs of the mark share the worst score and are
        # merged by a rule of their own.
        self.runs = {len(p) for p in self.id_of if set(p) == {MARK}}
        order = sorted({library.get_score(i) for i in piece_of}, reverse=True)
        rank_of_score = {s: r for r, s in enumerate(order)}
        self.rank = {
            i: LEAF if len(p) == 1 else rank_of_score[library.get_score(i)]
            for i, p in piece_of.items()
        }
        self.length = [0] * len(ids)
        self.split: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        self.side_by_side = set()
        self.whole = {}
        for piece in sorted(self.id_of, key=len):
            i = self.id_of[piece]
            self.length[i] = len(piece)
            if len(piece) > 1 and set(piece) == {MARK}:
                continue
            if len(piece) > 1:
                last = self._last_merge(piece)
                if last is None:  # no order of merges ends in this piece
                    continue
                self.split[i] = last
            self.whole[piece] = i
            self.automaton.add_word(piece, (i, len(piece)))
            self.side_by_side.update(piece[k : k + 2] for k in range(len(piece) - 1))
        self.automaton.make_automaton()
        self.compatible = WordCache(self._compatible, 1_000_000)
        self.width = len(ids)
        self.parts = WordCache(self._part, 200_000)
        self.units = WordCache(self._unit)
        self.words = WordCache(lambda word: self._unit(MARK + word))
        self.begin = self.bos.to_bytes(4, "little")
        self.end = self.eos.to_bytes(4, "little")

    def _last_merge(self, piece: str):
        """The two tokens whose merge makes ``piece``, or None if merging its
        characters ends elsewhere."""
        symbols = list(piece)
        while len(symbols) > 2:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                i = self.id_of.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.rank[i] < best):
                    best, at = self.rank[i], k
            if best is None:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        if len(symbols) != 2 or any(s not in self.id_of for s in symbols):
            return None
        return self.id_of[symbols[0]], self.id_of[symbols[1]]

    def _joined_rank(self, left: int, right: int):
        pieces = self.piece_text
        i = self.id_of.get(pieces[left] + pieces[right])
        return None if i is None else self.rank[i]

    @property
    def piece_text(self):
        if not hasattr(self, "_piece_text"):
            self._piece_text = {i: p for p, i in self.id_of.items()}
        return self._piece_text

    def _compatible(self, pair: int) -> bool:
        """Whether no merge across the border comes before the merges that hide it. Of
        equal merges the left one goes first."""
        left, right = divmod(pair, self.width)
        rank, split = self.rank, self.split
        before = None
        while True:
            across = self._joined_rank(left, right)
            if across is not None and (before is None or across < before):
                return False
            if rank[left] == LEAF and rank[right] == LEAF:
                return True
            if rank[left] > rank[right]:
                before = rank[left]
                left = split[left][1]
            else:
                before = rank[right] + 1
                right = split[right][0]

    def _part(self, text: str) -> tuple[int, ...]:
        """Ids of a text without impossible neighbours."""
        whole = self.whole.get(text)
        if whole is not None:
            return (whole,)
        if len(text) == 1:
            return tuple(self.bytes_of[b] for b in text.encode()) if self.bytes_of else (self.unk,)
        last = [-1] * (len(text) + 1)
        compatible, width = self.compatible, self.width
        for end, (token, length) in self.automaton.iter(text):
            if last[end + 1] < 0:
                start = end + 1 - length
                if start == 0 or (last[start] >= 0 and compatible[last[start] * width + token]):
                    last[end + 1] = token
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= self.length[last[at]]
        return tuple(ids[::-1])

    def _unit(self, unit: str) -> bytes:
        """Ids, four bytes each, of a run of marks and what follows it."""
        body = unit.lstrip(MARK)
        marks = len(unit) - len(body)
        if body and marks:
            body, marks = MARK + body, marks - 1
        ids: list[int] = []
        start = 0
        for k in range(1, len(body)):
            if body[k - 1 : k + 1] not in self.side_by_side:
                ids += self.parts[body[start:k]]
                start = k
        if body:
            ids += self.parts[body[start:]]
        if marks:
            if ids and ids[0] == self.id_of.get(MARK):
                ids, marks = ids[1:], marks + 1
            ids = self._mark_run(marks) + ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _mark_run(self, count: int) -> list[int]:
        """A run of marks: all its merges are equal, so the leftmost possible one is
        always next."""
        done: list[int] = []
        for _ in range(count):
            done.append(1)
            while len(done) > 1 and done[-2] + done[-1] in self.runs:
                done[-2:] = [done[-2] + done[-1]]
        return [self.id_of[MARK * n] for n in done]


UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def encode(vocabulary: Vocabulary, text: str) -> bytes:
    """All ids with begin and end, four bytes each, little-endian."""
    if "  " in text or text[:1] in ("", " ") or MARK in text:
        units = UNITS.findall(MARK + text.replace(" ", MARK)) if text else []
        coded = map(vocabulary.units.__getitem__, units)
    else:
        coded = map(vocabulary.words.__getitem__, text.split(" "))
    return b"".join([vocabulary.begin, *coded, vocabulary.end])


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """The text of ids: begin and end vanish, marks are spaces, the space that encoding
    put first goes, bytes that are no UTF-8 become U+FFFD."""
    text = b"".join(map(vocabulary.text_of.__getitem__, memoryview(ids).cast("I")))
    return text.removeprefix(b" ").decode("utf-8", "replace")


def encoded(docs: DataFrame, model_path: str, id_column: str = "doc_id",
            text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """``id_column``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` per row of ``docs``.

    NULL text is empty and has the begin and end ids only. Rows with equal ids stay
    apart; other columns are not returned, so their names cannot clash. An empty table
    gives an empty one. ``keep_ids`` adds ``ids`` (array of int) and ``decoded``. The
    model is read where the driver runs and sent to the executors (it is a fixed file).
    """
    with open(model_path, "rb") as file:
        model = file.read()
    held = docs.sparkSession.sparkContext.broadcast(model)
    key = ("piece", hashlib.sha256(model).hexdigest())

    def run(batches):
        words = worker_cache(key, lambda: Vocabulary(held.value))
        for batch in batches:
            counts, sums, backs, ids, decoded = [], [], [], [], []
            for text in texts(batch.column(1)):
                code = encode(words, text)
                back = decode(words, code)
                counts.append(len(code) // 4)
                sums.append(hashlib.sha256(code).hexdigest())
                backs.append(hashlib.sha256(back.encode()).hexdigest())
                if keep_ids:
                    ids.append(memoryview(code).cast("I").tolist())
                    decoded.append(back)
            columns = [batch.column(0), pa.array(counts, pa.int64()),
                       pa.array(sums, pa.string()), pa.array(backs, pa.string())]
            names = ["_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"
    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", id_column)
