"""The pipeline's stages against each other and against brute force."""

from __future__ import annotations

import corpus_pipeline
from hexrarity.llm import quality, toxicity
from tests.llm.conftest import SF
from tests.llm.test_joins import joined_by_brute_force


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality classifier", "n-gram Jaccard join", "best-fit packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == columns
        ids = {r["doc_id"] for r in after.collect()}
        if name == "toxicity":
            model = toxicity.fit(before, labels)
            want = {r["doc_id"] for r in toxicity.scored(before, model).where("predicted = 0").collect()}
        elif name == "quality classifier":
            model = quality.fit(before, labels)
            want = {r["doc_id"] for r in quality.graded(before, model).where("kept").collect()}
        else:
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = {k for k, _, root in joined_by_brute_force(rows) if k == root}
        assert ids == want and 0 < len(ids) <= before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in before.collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)
