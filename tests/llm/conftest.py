from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

SYLLABLES = "an er in ou tha le mi sto ra ven du ko li pe sha tor".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def document(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text))


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, ...) tuples, over several partitions."""

    def make(rows, partitions=3):
        return spark.createDataFrame([document(*r) for r in rows], DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, tiny and long texts, repeated rows, and odd characters."""
    long = prose(1, 6000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One two"), (6, prose(2, 80)), (7, prose(2, 80)), (8, long),
        (9, prose(3, 60) + "\r\n" + prose(3, 60)), (10, "ÉTÉ 日本 😀 ▁  x\u0085y <|endoftext|> it's"), (6, prose(2, 80)),
        (11, "a " * 100), (12, prose(4, 50), None, None),
    ]
