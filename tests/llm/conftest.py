from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for their own columns
    *(T.StructField(c, T.StringType()) for c in ("ids", "decoded", "size", "shard", "slot", "copies", "target", "lang_pred", "score", "key", "sig", "unit")),
])


def edge_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows."""
    extra = ("x",) * 12
    long = " ".join(f"word{i % 997} the {i}" for i in range(60_000))
    rows = [
        (1, None, None, None, None, *extra), (2, "", "en", "a", 0, *extra), (3, " \t\n", "de", "a", 3, *extra), (4, "one", "en", None, 3, *extra),
        (5, long, "en", "b", len(long), *extra), (6, "the same text stands here twice over", "en", "b", 5, *extra),
        (6, "the same text stands here twice over", "en", "b", 5, *extra), (7, "the same text stands here twice over", "fr", "a", 5, *extra),
        (None, "no id at all in this row of text", "en", "a", 7, *extra), (None, None, None, None, None, *(None,) * 12),
        (9, "¿Qué? 中文 😀 \x00 <s> <|endoftext|> ", "es", "c", 9, *extra), (10, "###  ---", None, "c", 8, *extra),
    ]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
