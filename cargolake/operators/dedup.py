"""Deduplication with a defined order, and latest-version / upsert semantics.

``row_number() == 1`` is planned as a window group limit: every map task keeps
one row per key before the shuffle, so a key that holds a third of the table
(all NULL keys count as one) sends a row per task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def quoted(name: str) -> Column:
    """A column whose name may hold dots and blanks, as sheet headers do."""
    return F.col(f"`{name}`")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or the last in ``order``.

    Columns outside keys and order break ties, so the outcome does not depend
    on how the rows are spread over tasks. NULL keys form one group.
    """
    ranked = [*order, *(c for c in df.columns if c not in order and c not in keys)]
    if keep == "first":
        sort = [quoted(c).asc_nulls_last() for c in ranked]
    else:
        sort = [quoted(c).desc_nulls_last() for c in ranked]
    place = F.row_number().over(Window.partitionBy(*map(quoted, keys)).orderBy(*sort))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def distinct_business(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Distinct rows over all columns but the excluded ones, which keep their smallest value.

    Equal rows collapse map-side before the shuffle.
    """
    exclude = [c for c in exclude if c in df.columns]
    business = [c for c in df.columns if c not in exclude]
    if not exclude:
        return df.dropDuplicates()
    firsts = [F.min(quoted(c)).alias(c) for c in exclude]
    return df.groupBy(*map(quoted, business)).agg(*firsts).select(*map(quoted, df.columns))


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the largest version per key."""
    return dedup(df, keys, [version], keep="last")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a counterpart in ``source``, and all source rows.

    ``source`` must hold at most one row per key (see ``dedup``). The result
    reads ``target``: write it to another path.
    """
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return source.unionByName(untouched)
