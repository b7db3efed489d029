"""What the text operators share: words, word hashes, reading tables, written intermediate tables."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolake.config import checkpoint_folder

# The characters between words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


MADE: list[str] = []  # intermediate tables since the last ``forget_tables`` or ``drop_tables``


def written(df: DataFrame, intermediate: bool = True) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: its lineage is cut and survives lost executors."""
    path = f"{checkpoint_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if intermediate:
        MADE.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget_tables() -> None:
    """The intermediate tables made so far stay, since results may still read them."""
    MADE.clear()


def drop_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables made so far; for callers who have written every result that reads them."""
    for path in MADE:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    MADE.clear()


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text: the split into training and held-out rows."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def words_column(text: Column) -> Column:
    """Array of the maximal runs without blanks; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The same words as UTF-8; ``lower`` maps A-Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def hash_words(words: list[bytes]) -> np.ndarray:
    """A stable 64-bit hash of every word."""
    if not words:
        return np.empty(0, np.uint64)
    column = np.empty(len(words), object)
    column[:] = words
    return pd.util.hash_array(column, categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out + words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix(out)
