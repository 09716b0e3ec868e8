from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

#: Columns whose names clash with what the operators add or use inside.
CLASHING = ["_id", "_text", "n_tokens", "piece", "length", "shard", "slot", "key", "n", "score",
            "kept", "component_id", "host", "rule", "purity", "code", "weight", "label_"]


@pytest.fixture(scope="session")
def clash():
    """Adds columns with clashing names and types that fit nowhere."""
    from pyspark.sql import functions as F

    def add(df):
        for name in CLASHING:
            if name not in df.columns:
                df = df.withColumn(name, F.array(F.lit("x")))
        return df

    return add


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with NULL, empty, blank, short, long, repeated and near-equal texts."""
    base = " ".join(f"word{k}" for k in range(60))
    rows = [
        (0, None), (1, ""), (2, "  \n\t "), (3, "one two"), (4, "One  two"), (5, base),
        (6, base.upper()), (7, base + " tail"), (8, " ".join(reversed(base.split()))),
        (9, "é漢字 😀\u0000x  double  spaces\n\n"), (10, "a" * 40_000), (11, "lorem ipsum " * 9_000),
        (12, base), (12, base), (13, "▁mark ▁ <|endoftext|> <s> İ ǅ ß"), (14, " lead and trail "),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")
