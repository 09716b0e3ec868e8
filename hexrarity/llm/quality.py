"""Quality by ordinal cumulative-link regression on graded ratings.

A text is a vector of hashed words, word shapes and repeats, as shares of its words, and
a few shares of its characters. One weight vector is shared by all grades; ordered
thresholds cut its score: P(grade >= k) = logistic(score - threshold k). The expected
grade ranks documents, a tail probability selects them.

Training takes a bounded sample of rated documents (``per_grade`` of each grade, by the
hash of their id); scoring covers whole texts of all documents.
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

from hexrarity.llm import toxicity
from hexrarity.llm.common import WordCache, digest, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PER_GRADE = 2000
HASHED = 1 << 16
EPOCHS = 150
#: A document is kept if this likely to have at least the wanted grade.
KEPT_FROM = 0.5
#: Documents with fewer words are kept: shares of a few words say nothing.
SHORT = 3

RUNS = re.compile(r"[a-zà-öø-ÿ]+|[A-ZÀ-ÖØ-Þ]+|[0-9]+")


def word_features(word: str) -> tuple[int, int]:
    """Hashed word and hashed shape: letters of a case and digits as one sign each,
    other signs as they are."""
    shape = RUNS.sub(lambda m: "a" if m[0][0].islower() else "0" if m[0][0].isdigit() else
                     "AA" if len(m[0]) > 1 else "A", word)[:12]
    return (zlib.crc32(word.lower().encode()) & (HASHED - 1),
            zlib.crc32(b"shape " + shape.encode()) & (HASHED - 1))


#: Fixed places of what is not a word, after the hashed ones.
REPEATED, DISTINCT, LONG, LINES, BIAS = (HASHED + k for k in range(5))
WIDTH = HASHED + 5


def text_shares(text: str, words: list[str]) -> list[float]:
    """Share of words equal to the word before; share of repeats; long words; repeated
    lines."""
    n = len(words)
    lines = [x for x in text.split("\n") if x]
    return [
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(set(words)) / n,
        min(1.0, len(text) / n / 40),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    ]


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade but the lowest

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(score)[:, None] - self.thresholds, -60, 60)))


def _rows(rows: list):
    """Features (indexes, values, owners) of rated texts, and their grades."""
    at, value, owner, grades = [], [], [], []
    for row in rows:
        words = (row["text"] or "").split()
        if not words:
            continue
        k = len(grades)
        grades.append(row["_label"])
        pairs = np.array([word_features(w) for w in words]).ravel()
        ids, counts = np.unique(pairs, return_counts=True)
        at += [ids, np.arange(HASHED, WIDTH)]
        value += [counts / len(words), np.array([*text_shares(row["text"], words), 1.0])]
        owner += [np.full(len(ids), k), np.full(5, k)]
    if not grades:
        return None
    return np.concatenate(at), np.concatenate(value), np.concatenate(owner), np.array(grades)


def train(rows: list, grades: int) -> Model:
    """Weights and thresholds from rows with ``text`` and ``_label`` (0 .. grades - 1), by
    maximum likelihood with ridge. Without two different ratings everything scores alike."""
    made = _rows(toxicity.distinct_texts(rows))
    if made is None or len(np.unique(made[3])) < 2:
        return Model(np.zeros(WIDTH), np.full(grades - 1, -4.0))
    at, value, owner, rating = made
    n = len(rating)
    # Each grade counts alike, however rare.
    share = np.bincount(rating, minlength=grades)
    balance = (n / (share[share > 0].size * np.maximum(share, 1)))[rating]
    weights, first, gaps = np.zeros(WIDTH), 0.0, np.zeros(max(0, grades - 2))
    mean = [np.zeros(WIDTH), np.zeros(grades - 1)]
    var = [np.zeros(WIDTH), np.zeros(grades - 1)]
    for epoch in range(1, EPOCHS + 1):
        model = Model(weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))
        score = np.bincount(owner, weights[at] * value, n)
        tail = model.tails(score)
        # P(grade = k) = tail k - tail k+1, so its log's slope in each tail's argument:
        upper = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        p = np.maximum(upper[np.arange(n), rating] - upper[np.arange(n), rating + 1], 1e-9)
        slope = np.zeros((n, grades - 1))
        low, high = rating > 0, rating < grades - 1
        r = np.arange(n)
        slope[r[low], rating[low] - 1] += (tail * (1 - tail))[r[low], rating[low] - 1] / p[low]
        slope[r[high], rating[high]] -= (tail * (1 - tail))[r[high], rating[high]] / p[high]
        slope *= balance[:, None]
        down = -slope.sum(axis=1)  # of the loss, in the score
        grad = np.bincount(at, down[owner] * value, WIDTH) / n + 1e-4 * weights
        cuts = slope.sum(axis=0) / n
        grad_cuts = np.concatenate([
            [cuts.sum()], np.cumsum(cuts[::-1])[::-1][1:] * np.exp(gaps)])
        for j, g in enumerate((grad, grad_cuts)):
            mean[j] = 0.9 * mean[j] + 0.1 * g
            var[j] = 0.99 * var[j] + 0.01 * g * g
            step = 0.3 * (mean[j] / (1 - 0.9**epoch)) / (np.sqrt(var[j] / (1 - 0.99**epoch)) + 1e-4)
            if j == 0:
                weights = weights - step
            else:
                first -= step[0]
                gaps = np.clip(gaps - step[1:], -5, 3)
    return Model(weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def _judge(docs: DataFrame, model: Model):
    """A function for the executors: texts to (tail probabilities, whether very short)."""
    code = pickle.dumps((model.weights, model.thresholds))
    held = docs.sparkSession.sparkContext.broadcast(code)
    key = ("quality", digest(code))

    def load():
        own = Model(*pickle.loads(held.value))
        weights = own.weights.tolist()
        return own, weights, WordCache(lambda w: sum([weights[f] for f in word_features(w)]))

    def judge(found: list[str]):
        own, weights, cache = worker_cache(key, load)
        scores, short = np.zeros(len(found)), np.zeros(len(found), bool)
        for row, text in enumerate(found):
            words = text.split()
            short[row] = len(words) < SHORT
            if words:
                shares = zip((REPEATED, DISTINCT, LONG, LINES), text_shares(text, words), strict=True)
                scores[row] = (
                    sum(map(cache.__getitem__, words)) / len(words) + weights[BIAS]
                    + sum([weights[at] * share for at, share in shares]))
        return own.tails(scores), short

    return judge


def graded(docs: DataFrame, model: Model, wanted: int = 1, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """Ids of ``docs`` with ``expected_grade``, ``tail_probability`` of reaching the
    ``wanted`` grade, and ``kept``.

    NULL, empty and very short texts (below ``SHORT`` words) give no evidence against
    them: they get the thresholds' own probabilities at score 0 and are kept. Rows are
    judged one by one; repeated rows agree. Other columns are not returned.
    """
    judge = _judge(docs, model)

    def run(batches):
        for batch in batches:
            tails, short = judge(texts(batch.column(1)))
            reach = tails[:, wanted - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(reach),
                 pa.array((reach >= KEPT_FROM) | short)],
                names=["_id", "expected_grade", "tail_probability", "kept"])

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return chosen.mapInArrow(
        run, f"_id {kind}, expected_grade double, tail_probability double, kept boolean"
    ).withColumnRenamed("_id", id_column)


def filtered(docs: DataFrame, model: Model, wanted: int = 1, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    judge = _judge(docs, model)
    at = docs.columns.index(text_column)

    def run(batches):
        for batch in batches:
            tails, short = judge(texts(batch.column(at)))
            yield batch.filter(pa.array((tails[:, wanted - 1] >= KEPT_FROM) | short))

    return docs.mapInArrow(run, docs.schema)


def rating(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Graded rating from two marks: 0 for bad, 1 for good but toxic, 2 for good."""
    good = F.col(quality).cast("int")
    return F.when(good == 0, 0).when(F.coalesce(F.col(toxic), F.lit(0)) == 1, 1).when(good == 1, 2)


def fit(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE,
        id_column: str = "doc_id", text_column: str = "text") -> Model:
    """The model from rated documents that are not held out (a fifth is, as for
    toxicity)."""
    known = labels.where(~toxicity.held_out(id_column)).withColumn("_rating", rating())
    rows = toxicity.sample(docs, known, "_rating", {g: per_grade for g in range(3)},
                           id_column, text_column)
    return train(rows, 3)
