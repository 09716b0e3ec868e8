"""SentencePiece operator against the library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from hexrarity.llm import piece_tokens
from tests.llm.conftest import SF

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return piece_tokens.Vocabulary(file.read())


def agree(vocabulary, library, text):
    code = piece_tokens.encode(vocabulary, text)
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert memoryview(code).cast("I").tolist() == ids
    assert piece_tokens.decode(vocabulary, code) == library.decode(ids)


def test_random_texts(vocabulary, library):
    rng = random.Random(5)
    parts = ["a", "the", "ing", " ", "  ", " " * 9, " " * 37, "▁", "é", "ﬁ", "\n", "\t", "漢", "😀",
             "\0", "==", "--", "12", *rng.sample(sorted(vocabulary.id_of), 300)]
    for _ in range(4000):
        agree(vocabulary, library, "".join(rng.choices(parts, k=rng.randint(0, 20))))


@pytest.mark.parametrize("text", ["", " ", "a" * 50_000, " " * 3000, "=-" * 3000, "\n \n  x"])
def test_extremes(vocabulary, library, text):
    agree(vocabulary, library, text)


def test_cache_may_empty(vocabulary, library):
    vocabulary.words.limit = vocabulary.parts.limit = 3
    agree(vocabulary, library, "some words that do not fit into three places of a cache")
    vocabulary.words.limit = vocabulary.parts.limit = 200_000


def test_rows(spark, documents, clash, library):
    for df in (clash(documents), spark.read.parquet(f"{SF}/documents.parquet")):
        texts = sorted((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect())
        expected = []
        for key, text in texts:
            ids = library.encode(text, add_bos=True, add_eos=True)
            code = b"".join(i.to_bytes(4, "little") for i in ids)
            back = library.decode(ids).encode()
            expected.append((key, len(ids), hashlib.sha256(code).hexdigest(), hashlib.sha256(back).hexdigest()))
        found = piece_tokens.encoded(df, PATH)
        assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_empty_table_and_ids(spark, documents, library):
    assert piece_tokens.encoded(documents.limit(0), PATH).count() == 0
    row = piece_tokens.encoded(documents.where("doc_id = 14"), PATH, keep_ids=True).first()
    assert row["ids"] == library.encode(" lead and trail ", add_bos=True, add_eos=True)
    assert row["decoded"] == " lead and trail "
