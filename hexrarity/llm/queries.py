"""One query per operator over its whole table, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexrarity.llm import (
    merkle,
    near_vectors,
    packing,
    page_text,
    piece_tokens,
    quality,
    shards,
    shingle_join,
    signatures,
    topk_codes,
    toxicity,
    url_templates,
    vantage_trees,
)

NEIGHBORS = 10
NEAREST = 20
RESULTS = 50
SHARDS = 40
#: Given rules: (verdict, host, path).
URL_RULES = [
    url_templates.Rule(*r) for r in (
        ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
        ("block", "net", "/es/"), ("block", "net", "/fr/"))
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.encoded(
        table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest sign codes of every vector whose id is divisible by 20, among all."""
    codes = table(spark, sf_dir, "embeddings").select(
        "vec_id", topk_codes.sign_code(F.col("embedding")).alias("code"))
    return topk_codes.nearest(codes, codes.where(F.col("vec_id") % 20 == 0), NEIGHBORS, "vec_id", "code")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.graded(docs, model)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return page_text.extracted(pages, page_text.fit(pages))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"), shards.tree(SHARDS))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is named after its document: the number in its path. Where that document is
    labelled, the page is bad if the document is of low quality or toxic."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    number = F.regexp_extract("url", r"://[^/?#]*/[^?#]*?([0-9]+)", 1)
    named = pages.select("page_id", number.try_cast("long").alias("doc_id"))
    known = named.join(labels, "doc_id").select("page_id", "bad")
    return url_templates.judged(pages, URL_RULES, known)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.linked(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.joined(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = signatures.build(table(spark, sf_dir, "documents"))
    return signatures.ranked(index, table(spark, sf_dir, "benchmark"), RESULTS)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(
        table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"])


def op13_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vantage_trees.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), NEAREST)


QUERIES = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_topk_search, op3_best_fit_packing, op4_quality_classifier,
        op5_html_extraction, op6_sharding, op7_url_filters, op8_embedding_near_dedup,
        op9_toxicity, op10_ngram_jaccard_join, op11_ranked_search,
        op12_merkle_manifest, op13_vantage_point_search)
}
