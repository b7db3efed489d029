"""The corpus pipeline: four stages that filter and clean ``documents``, and one that packs them into sequences.

A stage is called when the result of the one before has been written. So every
stage but the first begins by dropping the intermediate tables of the one
before it, and disk holds those of one stage at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolake.llm import host_quality, near_dedup, packing, substring_dedup, toxicity
from cargolake.llm.base import documents, drop_tables, forget_tables, labels, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or a rule that their host is known for, go."""
    forget_tables()
    return host_quality.keep_good(docs, host="source")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.5 or more go; the model learns from the labelled documents of the corpus."""
    drop_tables(spark)
    model = toxicity.fit(toxicity.labelled(documents(spark, sf_dir), labels(spark, sf_dir)))
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, keep=["row"])
    return scored.where("toxicity < 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    drop_tables(spark)
    return near_dedup.keep_first(docs, words=5, share=0.8)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occur more than once go."""
    drop_tables(spark)
    return substring_dedup.without_repeats(docs, window=35)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids: a row per piece, with its ids."""
    drop_tables(spark)
    return packing.best_fit_pack(docs, capacity=1024, end_id=2, with_ids=True)


STAGES = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("packing", pack),
]
# The stages learn, index and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), intermediate=False)
    return STAGES[-1][1](spark, docs, sf_dir)
