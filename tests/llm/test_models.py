"""Trained operators: held-out accuracy, exact inference, odd rows."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from hexrarity.llm import chain, quality, toxicity
from tests.llm.conftest import SF

BIG = "/root/testdata/sf0.1"


def by_enumeration(weight, start, potential):
    """Marginals and the best path of one chain, over all paths."""
    best, total, marginal = None, 0.0, np.zeros(len(weight))
    for path in itertools.product((0, 1), repeat=len(weight)):
        value = start * path[0] + sum(w for w, s in zip(weight, path, strict=True) if s)
        value += sum(np.log(potential[a, b]) for a, b in zip(path, path[1:], strict=False))
        total += np.exp(value)
        marginal += np.exp(value) * np.array(path)
        if best is None or value > best[0]:
            best = (value, path)
    return marginal / total, np.array(best[1])


def test_messages_and_best_path():
    rng = np.random.default_rng(8)
    lengths = np.array([1, 7, 3, 10, 2])
    weight = rng.normal(size=lengths.sum()) * 2
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    potential = np.exp(rng.normal(size=(2, 2)))
    found = chain.messages(weight, starts, lengths, 0.3, potential)
    for s, n in zip(starts, lengths, strict=True):
        marginal, path = by_enumeration(weight[s : s + n], 0.3, potential)
        assert np.allclose(found[s : s + n], marginal)
        assert (chain.best_path(weight[s : s + n], 0.3, potential) == path).all()
    none = np.empty(0, int)
    assert len(chain.messages(np.empty(0), none, none, 0.0, potential)) == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def judged(found, labels, label):
    rows = found.join(labels, "doc_id").where(toxicity.held_out("doc_id")).collect()
    return np.array([r[label] for r in rows]), rows


def test_toxicity_held_out(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    found = toxicity.scored(docs, model)
    assert found.columns == ["doc_id", "score", "predicted"]
    truth, rows = judged(found, labels, "toxic")
    predicted = np.array([r["predicted"] for r in rows])
    assert predicted[truth == 1].mean() > 0.9 and predicted[truth == 0].mean() < 0.03
    kept = toxicity.filtered(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == found.where("predicted = 0").count()


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert (one.weights == two.weights).all() and (one.link == two.link).all()


def test_spans(spark):
    weights = np.zeros(toxicity.HASHED)
    for word in ("idiot", "clown"):
        weights[toxicity.features(word)] = 4.0
    model = toxicity.Model(weights, -4.0, 0.0, np.array([[1.0, 0.5], [0.5, 2.0]]), np.array([-3.0, 6.0, 1.0]))
    text = "you é IDIOT, clown! and not 漢 a clown."
    df = spark.createDataFrame([(1, text), (2, "good words only"), (3, None), (4, " ")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in toxicity.scored(df, model, keep_spans=True).collect()}
    assert [text[s["start"] : s["end"]] for s in found[1]["spans"]] == ["IDIOT, clown!", "clown."]
    assert found[1]["predicted"] == 1 and found[2]["predicted"] == 0
    assert found[3]["score"] == found[4]["score"] and found[3]["spans"] == []


def test_quality_held_out(tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    found = quality.graded(docs, model)
    assert found.columns == ["doc_id", "expected_grade", "tail_probability", "kept"]
    truth, rows = judged(found, labels, "quality")
    kept = np.array([r["kept"] for r in rows])
    assert kept[truth == 1].mean() > 0.99 and kept[truth == 0].mean() < 0.05
    assert quality.filtered(docs, model).count() == found.where("kept").count()


def test_ordinal_thresholds():
    """Grades that a score orders are told apart, with the rarest grade as well."""
    rows = [{"text": " ".join(["good"] * g + ["bad"] * (6 - g) + [f"x{k}"]), "_label": g // 2}
            for k in range(300) for g in (0, 1, 2, 3, 4, 5) if g < 4 or k % 5 == 0]
    model = quality.train(rows, 3)
    def score(text):
        words = text.split()
        return (sum(model.weights[list(quality.word_features(w))].sum() for w in words) / len(words)
                + model.weights[quality.BIAS]
                + sum(model.weights[at] * s for at, s in zip(
                    (quality.REPEATED, quality.DISTINCT, quality.LONG, quality.LINES),
                    quality.text_shares(text, words), strict=True)))
    grades = [model.tails(np.array([score(" ".join(["good"] * g + ["bad"] * (6 - g)))])).sum() for g in (0, 2, 5)]
    assert grades[0] < grades[1] < grades[2]


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_odd_rows(spark, documents, clash, operator):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = operator.fit(clash(docs), clash(labels))
    run = toxicity.scored if operator is toxicity else quality.graded
    found = run(clash(documents), model)
    assert found.count() == documents.count()
    assert found.where("doc_id IS NULL").count() == 0
    assert run(documents.limit(0), model).count() == 0
    assert operator.filtered(clash(documents), model).columns == clash(documents).columns
    nothing = operator.fit(docs, labels.limit(0))
    assert run(documents, nothing).count() == documents.count()
    half = spark.createDataFrame([(0, None, None), (1, 1, None), (None, 0, 1)], labels.schema)
    operator.fit(docs, half)


def test_nothing_known_keeps_everything(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.filtered(documents, toxicity.fit(documents, labels)).count() == documents.count()
    assert quality.filtered(documents, quality.fit(documents, labels)).count() == documents.count()


def test_toxicity_takes_few_texts_at_a_time():
    """A worker holds the weights of that many texts' words; no row is lost between."""
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"n": list(range(n))}) for n in (2500, 0, 3, 1000)]
    found = list(toxicity._slices(batches))
    assert max(x.num_rows for x in found) <= 1000
    assert [r for x in found for r in x["n"].to_pylist()] == [r for x in batches for r in x["n"].to_pylist()]
