"""Toxic spans and document scores by a linear-chain conditional random field.

Two states, clean and toxic. A token's weight is the sum of its hashed features: word and
beginnings of it; transitions make spans. The labels given are of
documents, so tokens are labelled first: a feature's evidence is the likelihood ratio of
its toxic document rate against the base rate, and the tokens of a toxic document with
decisive evidence are its toxic tokens (its best token if none is decisive). The field
is trained on these. Forward and backward messages over the whole text give each
token's marginal probability; a logistic link of the largest and the summed marginals,
fitted on the training documents, is the document's score, and runs of tokens with a
marginal of one half or more are the offending offsets.

Training takes a bounded sample: ``toxic_rows`` and ``clean_rows`` labelled documents by
the hash of their id; scoring covers all documents, split over the executors.
"""

from __future__ import annotations

import pickle
import re
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexrarity.llm import common
from hexrarity.llm.chain import fitted, messages
from hexrarity.llm.common import WordCache, digest, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOXIC_ROWS = 1000
CLEAN_ROWS = 2500
HASHED = 1 << 18
WINDOW = 48
#: Texts that a worker scores at a time.
TEXTS = 1000
#: Windows of tokens that the field is trained on, at most.
WINDOWS = 24_000
EPOCHS = 60
#: Pull of the feature weights towards zero; a feature seen once so moves little.
RIDGE = 1.0


def features(word: str) -> list[int]:
    """Hashed features of a token: its word and the word's beginnings; signs around it and
    case do not matter. (Endings and inner n-grams of insults turn up in harmless words.)"""
    core = word.lower().strip(".,;:!?\"'()[]{}|*%&$#<>-_")
    found = [core + "$", *("^" + core[:k] for k in range(4, min(8, len(core)) + 1))]
    return [zlib.crc32(f.encode()) & (HASHED - 1) for f in found]


@dataclass
class Model:
    weights: np.ndarray  # by hashed feature
    bias: float
    start: float
    potential: np.ndarray
    link: np.ndarray  # intercept, largest marginal, log of the summed marginals

    def word(self, word: str) -> float:
        return self.bias + float(self.weights[features(word)].sum())

    def score(self, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        z = self.link[0] + self.link[1] * largest + self.link[2] * np.log1p(total)
        return 1 / (1 + np.exp(-z))


def distinct_texts(rows: list) -> list:
    """Labelled rows without copies and near copies: two rows with the same smallest
    hashed run of three words count once."""
    seen, kept = set(), []
    for row in rows:
        words = (row["text"] or "").lower().split()
        key = min((zlib.crc32(" ".join(words[k : k + 3]).encode())
                   for k in range(max(1, len(words) - 2))), default=0)
        if key not in seen:
            seen.add(key)
            kept.append(row)
    return kept


def sample(docs: DataFrame, labels: DataFrame, label: str, limits: dict[int, int],
           id_column: str, text_column: str) -> list:
    """Up to ``limits[value]`` labelled rows for each label value, by the hash of the id;
    the largest label counts where a document has several. Sorted by id."""
    spread = F.xxhash64(id_column)
    agreed = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull()).groupBy(
        id_column).agg(F.max(label).cast("int").alias("_label"))
    chosen = None
    for value, limit in limits.items():
        part = agreed.where(F.col("_label") == value).orderBy(spread, id_column).limit(limit)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text"))
        .join(F.broadcast(chosen.withColumnRenamed(id_column, "_id")), "_id").collect()
    )
    return sorted(rows, key=lambda r: (r["_id"], r["text"] or ""))


def _evidence(groups: list[np.ndarray], toxic: np.ndarray, csr: tuple) -> np.ndarray:
    """Evidence of each word: that of its best feature."""
    flat, first = csr
    size = np.diff(np.append(first, len(flat)))
    a, b = np.zeros(HASHED), np.zeros(HASHED)
    for words, label in zip(groups, toxic, strict=True):
        if len(words):
            span = np.repeat(first[words] - np.concatenate([[0], np.cumsum(size[words])[:-1]]), size[words])
            seen = np.unique(flat[np.arange(len(span)) + span])
            (a if label else b)[seen] += 1
    base = np.clip(toxic.mean(), 1e-3, 1 - 1e-3) if len(toxic) else 0.5
    rate = (a + 0.01) / (a + b + 0.02)
    gain = a * np.log(rate / base) + b * np.log((1 - rate) / (1 - base))
    gain[rate <= base] = 0
    return np.maximum.reduceat(gain[flat], first) if len(first) else np.empty(0)


def train(rows: list) -> Model:
    """The field and the document link from rows with ``text`` and ``_label``. Without
    toxic rows everything is clean; rows without words teach nothing. The link is fitted
    on marginals of documents that the field behind them was not trained on (two halves
    judge each other)."""
    rows = [r for r in distinct_texts(rows) if (r["text"] or "").split()]
    toxic = np.array([r["_label"] == 1 for r in rows], bool)
    if toxic.sum() < 2 or (~toxic).sum() < 2:
        return Model(np.zeros(HASHED), -4.0, 0.0, np.ones((2, 2)), np.array([-4.0, 4.0, 0.0]))
    number: dict[str, int] = {}
    tokens = [np.array([number.setdefault(w, len(number)) for w in r["text"].split()]) for r in rows]
    lists = [features(w) for w in number]
    flat = np.concatenate([np.array(x) for x in lists])
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]])
    half = np.zeros(len(rows), bool)
    for kind in (toxic, ~toxic):
        half[np.flatnonzero(kind)[::2]] = True
    largest, total = np.zeros(len(rows)), np.zeros(len(rows))
    for own in (half, ~half):
        other = np.flatnonzero(~own)
        field = _field(tokens, toxic, np.flatnonzero(own), flat, first)
        largest[other], total[other] = _summaries(field, [tokens[k] for k in other], flat, first)
    model = _field(tokens, toxic, np.arange(len(rows)), flat, first)
    model.link = _logistic(np.stack([np.ones(len(rows)), largest, np.log1p(total)], axis=1), toxic)
    return model


def _field(tokens: list, toxic: np.ndarray, own: np.ndarray, flat: np.ndarray,
           first: np.ndarray) -> Model:
    """The field from the documents ``own``."""
    gain = _evidence([np.unique(tokens[k]) for k in own], toxic[own], (flat, first))
    decisive = np.log(len(np.unique(flat))) + 1
    windows, marks = [], []
    for k in own:
        words = tokens[k]
        label = np.zeros(len(words), np.int8)
        if toxic[k]:
            label[gain[words] >= min(decisive, max(3.0, gain[words].max()))] = 1
        for at in range(0, len(words), WINDOW):
            windows.append(words[at : at + WINDOW])
            marks.append(label[at : at + WINDOW])
    rng = np.random.default_rng(1)
    holds = np.array([m.any() for m in marks])
    pick = np.concatenate([rng.permutation(np.flatnonzero(holds))[: WINDOWS // 2],
                           rng.permutation(np.flatnonzero(~holds))[: WINDOWS // 2]])
    lengths = np.array([len(windows[k]) for k in pick])
    words = np.concatenate([windows[k] for k in pick])
    mark = np.concatenate([marks[k] for k in pick]).astype(float)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    theta, bias, start, steps = fitted(
        flat, first, words, starts, lengths, mark, HASHED, EPOCHS, RIDGE)
    return Model(theta, bias, start, np.exp(steps), np.zeros(3))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - y) + ridge @ beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge
        beta = beta - np.linalg.solve(curve + 1e-9 * np.eye(len(beta)), slope)
    return beta


def _summaries(model: Model, tokens: list[np.ndarray], flat: np.ndarray, first: np.ndarray):
    """Largest and summed marginal of each document."""
    lead = model.bias + np.add.reduceat(model.weights[flat], first)
    lengths = np.array([len(t) for t in tokens])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    p = messages(lead[np.concatenate(tokens)], starts, lengths, model.start, model.potential)
    return np.maximum.reduceat(p, starts), np.add.reduceat(p, starts)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of one half or more, as offsets in code points."""
    spans: list[dict] = []
    last = -2
    for k, token in enumerate(re.finditer(r"\S+", text)):
        if p[k] >= 0.5:
            if last == k - 1:
                spans[-1]["end"] = token.end()
                spans[-1]["probability"] = max(spans[-1]["probability"], float(p[k]))
            else:
                spans.append({"start": token.start(), "end": token.end(), "probability": float(p[k])})
            last = k
    return spans


def _judge(docs: DataFrame, model: Model):
    """A function for the executors: texts to (scores, largest marginals, first tokens,
    numbers of tokens, marginals of all tokens)."""
    code = pickle.dumps((model.weights.astype(np.float32), model.bias, model.start,
                         model.potential, model.link))
    held = docs.sparkSession.sparkContext.broadcast(code)
    key = ("toxicity", digest(code))

    def load():
        own = Model(*pickle.loads(held.value))
        weights, bias = own.weights.tolist(), own.bias
        return own, WordCache(lambda w: bias + sum([weights[f] for f in features(w)]))

    def judge(found: list[str]):
        own, cache = worker_cache(key, load)
        # (Text by text: the words of thousands of texts would fill much memory.)
        weights = [
            np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
            for t in found for words in (t.split(),)
        ]
        lengths = np.array([len(w) for w in weights], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        full = np.flatnonzero(lengths)
        largest, total = np.zeros(len(found)), np.zeros(len(found))
        p = np.empty(0)
        if len(full):
            weight = np.concatenate(weights)
            p = messages(weight, starts[full], lengths[full], own.start, own.potential)
            largest[full] = np.maximum.reduceat(p, starts[full])
            total[full] = np.add.reduceat(p, starts[full])
        return own.score(largest, total), largest, starts, lengths, p

    return judge


def _slices(batches):
    """Every row of the batches, ``TEXTS`` at most at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, TEXTS):
            yield batch.slice(first, TEXTS)


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id",
           text_column: str = "text", keep_spans: bool = False) -> DataFrame:
    """``docs`` ids with ``score`` (0 to 1) and ``predicted`` (1 from one half on);
    ``keep_spans`` adds ``spans`` (start, end, probability).

    Texts that are NULL, empty or white space have no toxic token: largest and summed
    marginals are 0. Rows are scored one by one, so repeated rows get equal scores. Other
    columns are not returned.
    """
    judge = _judge(docs, model)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches):
        for part in _slices(batches):
            found = common.texts(part.column(1))
            score, largest, starts, lengths, p = judge(found)
            columns = [part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            names = ["_id", "score", "predicted"]
            if keep_spans:
                columns.append(pa.array([
                    _spans(t, p[s : s + n]) if big >= 0.5 else []
                    for t, s, n, big in zip(found, starts, lengths, largest, strict=True)
                ], span_type))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"_id {kind}, score double, predicted int"
    if keep_spans:
        schema += ", spans array<struct<start:int,end:int,probability:double>>"
    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", id_column)


def filtered(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below one half; their order
    within a task stays."""
    judge = _judge(docs, model)
    at = docs.columns.index(text_column)

    def run(batches):
        for part in _slices(batches):
            score = judge(common.texts(part.column(at)))[0]
            yield part.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_column: str) -> Column:
    """Whether a document's label is kept for judging: a fifth, by the CRC of its id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS,
        clean_rows: int = CLEAN_ROWS, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic") -> Model:
    """The model from the labelled documents that are not held out."""
    known = labels.where(~held_out(id_column))
    return train(sample(docs, known, label_column, {1: toxic_rows, 0: clean_rows},
                        id_column, text_column))
