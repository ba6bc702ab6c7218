from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        *[T.StructField(name, T.LongType()) for name in ("size", "key", "n", "node", "range", "row", "hashes", "label")],
    ]
)


def document(doc_id, text, source="s1"):
    return (doc_id, text, "en", source, None if text is None else len(text), *range(8))


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table of (doc_id, text[, source]) rows with more, clashing columns."""
    return lambda rows: spark.createDataFrame([document(*row) for row in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls everywhere, empty and blank texts, repeated rows, ties, one very long text."""
    words = " ".join(f"word{i % 977} tail{i % 13}." for i in range(60_000))
    return documents(
        [
            (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "one two three"), (5, "one two three"),
            (6, "One TWO three"), (None, "a text without an id " * 9), (None, None), (7, words), (8, words),
            (9, "é" * 40 + " ß   中文 \U0001f600 á", None), (10, "one two three", None), (11, "x", ""),
        ]
    )


@pytest.fixture(scope="session")
def none(documents):
    return documents([])
