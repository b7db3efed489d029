"""Near-copies by SimHash: fingerprints of word shingles, searched by multi-index hashing.

A fingerprint has 64 bits. Every shingle, repeats included, is hashed to 64
bits; a bit of the fingerprint is set if more than half of the hashes have it.

Documents with equal fingerprints are one class, so the search runs over
distinct fingerprints and copies cost nothing. A fingerprint is two segments of
32 bits. The table holds it under its own value and under every value of the
Hamming ball of radius one within each segment, the other segment as it is.
Two fingerprints that differ in two bits, be they in one segment or in both,
meet at the value between them; those that differ in one bit meet at either.
What meets is verified by the complete distance.

A key is both segments, not one: with one segment as key, the near copies of a
much copied text share a key, and a bucket of n of them is n² / 2 candidates.
Under both segments a bucket holds 65 fingerprints at most, whatever the data,
so no bucket needs a cap or a split. A bucket gives links to its smallest
member alone, since all of it lies within two bits of the key's value.

Null and blank texts have no shingle and the fingerprint zero, which is linked
like any other. Repeated rows are rows of their own with the same result. Null
ids take part, and are never the id of a component that has another; a
component of null ids alone has a null id. An empty table gives no rows. Other
columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolake.llm.base import byte_words, written
from cargolake.llm.components import components

BITS = 64
SEED = 42
MOST_BITS = 2  # how far linked fingerprints may differ: two balls of radius one meet up to there
PART = 1 << 15  # shingles hashed at a time, which bounds the memory of a long text


def set_bits(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the shingles, and the number of shingles."""
    if not words:
        return np.zeros(BITS, np.int64), 0
    size = min(size, len(words))
    n, counts = len(words) - size + 1, np.zeros(BITS, np.int64)
    for start in range(0, n, PART):
        part = words[start : min(n, start + PART) + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.dtype("<u8"), len(part) - size + 1)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return counts, n


def fingerprint(text: str | None, size: int) -> int:
    counts, n = set_bits(byte_words(text, lower=True), size)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint_of(text: Column, words: int) -> Column:
    """The fingerprint of each text, as a long with the same 64 bits."""

    @F.pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return made(text)


def links(found: DataFrame) -> DataFrame:
    """Pairs (a, b) that join all of the distinct fingerprints ``value`` that differ in two bits or fewer."""
    ball = F.array(*(F.lit(flip).cast("long") for flip in (0, *(1 << b for b in range(BITS - 1)), -(1 << BITS - 1))))
    met = found.select("value", F.explode(ball).alias("flip")).select("value", F.col("value").bitwiseXOR(F.col("flip")).alias("key"))
    first = met.select("value", F.min("value").over(Window.partitionBy("key")).alias("a"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("value")))
    return first.where((F.col("a") != F.col("value")) & (distance <= MOST_BITS)).select("a", F.col("value").alias("b")).distinct()


def near_copies(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable over links.

    Three narrow tables are written: fingerprints by document, classes of equal
    fingerprints, and the links' components. Texts never leave the scan.
    """
    prints = written(docs.select("doc_id", fingerprint_of(F.col("text"), words).alias("value")))
    classes = written(prints.groupBy("value").agg(F.min("doc_id").alias("first")))
    hung = components(links(classes.select("value")))
    # Nodes hang on their root; a root itself is listed by no link of its own.
    rooted = hung.union(hung.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "value")
    least = rooted.join(classes, "value").groupBy("root").agg(F.min("first").alias("least"))
    ids = written(
        classes.join(rooted.join(least, "root").select("value", "least"), "value", "left")
        .select("value", F.coalesce("least", "first").alias("component_id"))
    )
    return prints.join(ids, "value").select(
        "doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id"
    )
