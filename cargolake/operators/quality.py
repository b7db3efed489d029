"""Quality report and constraint checks as aggregates over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cargolake.schemas import stamp


def repeated_rows(df: DataFrame, key: str) -> DataFrame:
    """One row with ``dups``, the surplus of rows equal in all columns.

    Equal rows share their key, so only rows whose key occurs twice are
    compared as a whole; the others are not moved. A NULL key is a key.
    """
    column = F.col(f"`{key}`")
    twice = df.groupBy(column.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key")
    suspects = df.join(twice, column.eqNullSafe(F.col("_key")), "left_semi")
    groups = suspects.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("dups"))


def table_quality(name: str, df: DataFrame, key: str) -> DataFrame:
    """Rows, exact duplicate rows and NULLs per column of one table, as long rows."""
    columns = df.columns
    figures = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)),
    )
    long = F.array(
        F.struct(F.lit("row_count").alias("metric"), F.lit("").alias("column"), F.col("_rows").alias("value")),
        *(
            F.struct(F.lit("null_count").alias("metric"), F.lit(c).alias("column"), F.col(f"_null_{i}").alias("value"))
            for i, c in enumerate(columns)
        ),
    )
    repeated = repeated_rows(df, key).select(
        F.lit(name).alias("table"), F.lit("duplicates").alias("metric"), F.lit("").alias("column"), F.col("dups").alias("value")
    )
    return figures.select(F.lit(name).alias("table"), F.inline(long)).unionByName(repeated)


def quality_report(tables: Mapping[str, DataFrame], run_ts: datetime, keys: Mapping[str, str] | None = None) -> DataFrame:
    """``table, metric, column, value, reported_at`` for every given table.

    ``keys`` names the column by which a table's repeated rows are looked for,
    best one with few repeats; by default the first.
    """
    keys = keys or {}
    parts = [table_quality(name, df, keys.get(name, df.columns[0])) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("reported_at", stamp(run_ts))


def check_rules(name: str, df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per rule; as in SQL, a rule whose outcome is NULL is not violated."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(~rule).alias(f"_bad_{i}") for i, rule in enumerate(rules.values())),
    )
    long = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.col("_rows").alias("rows_checked"), F.col(f"_bad_{i}").alias("violations"))
            for i, rule in enumerate(rules)
        )
    )
    return counts.select(F.lit(name).alias("table"), F.inline(long))


def unique_rules(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys are not compared."""
    return (
        df.select(*keys).na.drop().groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def fk_orphans(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """How many rows and distinct keys of the child point to no parent row.

    The child shrinks to one row per key before the join.
    """
    used = (
        child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    lost = used.join(parent.select(F.col(pk).alias("_key")), "_key", "left_anti")
    return lost.agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
    ).select(F.lit(name).alias("constraint"), "orphan_keys", "orphan_rows")


def derived_amount(df: DataFrame, price: str) -> DataFrame:
    """Rows whose stored amount is, or is not, quantity times price to the cent."""
    expected = F.round(F.col("quantity") * F.col(price), 2)
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.col("amount") != expected).alias("mismatches"),
        F.coalesce(F.sum(F.abs(F.col("amount") - expected)), F.lit(0)).alias("total_difference"),
    )
