"""Row and column cleaning shared by the entity plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cargolake.functions.numbers import clamp_min
from cargolake.functions.text import blank_to_null
from cargolake.schemas import stamp

# Parts of a column name that mark an upper-case identifier.
IDENTIFIER_WORDS = ("inn", "plate", "license", "sku")

# What stands in for missing texts and numbers.
UNKNOWN = "Unknown"
NOT_PROVIDED = "Not provided"
NO_LICENSE = "NO_LICENSE"
NO_PLATE = "NO_PLATE"


def normalise_text(df: DataFrame, upper_keywords: Sequence[str] = IDENTIFIER_WORDS) -> DataFrame:
    """Strip every text column, make blanks NULL, upper-case identifier columns."""

    def cleaned(f: T.StructField) -> Column:
        if not isinstance(f.dataType, T.StringType):
            return F.col(f"`{f.name}`")
        text = blank_to_null(F.col(f"`{f.name}`"))
        if any(word in f.name.lower() for word in upper_keywords):
            text = F.upper(text)
        return text.alias(f.name)

    return df.select(*map(cleaned, df.schema.fields))


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULLs, and NaN in floating columns, take the given constants in the type of their column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def filled(name: str, value: object) -> Column:
        c = F.col(name)
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return F.coalesce(c, F.lit(value).cast(kinds[name]))

    return df.withColumns({c: filled(c, v) for c, v in values.items()})


def lenient_cast(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Casts that turn unreadable values into NULL."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in kinds.items()})


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_sentinel(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows that still hold a placeholder."""
    return df.where(F.col(column) != value)


def drop_marker_rows(df: DataFrame, column: str, marker: str) -> DataFrame:
    """Drop rows whose column equals the marker; rows with NULL there stay."""
    return df.where(~F.col(f"`{column}`").eqNullSafe(F.lit(marker)))


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which every one of the columns is NULL."""
    return df.where(F.coalesce(*(F.col(f"`{c}`").cast("string") for c in columns)).isNotNull())


def keep_if(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate holds; a NULL outcome drops the row."""
    return df.where(predicate)


def keep_unless(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows for which the predicate holds; a NULL outcome keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def audit(df: DataFrame, run_ts: datetime, source: str | None = None, kind: str | None = None) -> DataFrame:
    """Audit columns: load time and, for file sources, origin and record type."""
    extra = {"etl_updated_at": stamp(run_ts)}
    if source is not None:
        extra["etl_source"] = F.lit(source)
    if kind is not None:
        extra["record_type"] = F.lit(kind)
    return df.withColumns(extra)


def fingerprint(df: DataFrame, columns: Sequence[str], out: str = "etl_hash") -> DataFrame:
    """A hash of the columns that is the same in every run and on every executor.

    The separator keeps ('ab', 'c') and ('a', 'bc') apart; NULL differs from ''.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u001e")) for c in columns]
    return df.withColumn(out, F.sha2(F.concat_ws("\u001f", *parts), 256))


def clamp(df: DataFrame, column: str, floor: int = 0) -> DataFrame:
    kind = df.schema[column].dataType
    return df.withColumn(column, clamp_min(F.col(column), floor).cast(kind))


def flag(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """A boolean column; a NULL outcome is false."""
    return df.withColumn(name, F.coalesce(predicate, F.lit(False)))


def repair_quantities(df: DataFrame) -> DataFrame:
    """Fill a missing after-quantity from before + change, then a missing change from after - before."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    before, change = F.col("quantity_before"), F.col("quantity_change")
    df = df.withColumn(
        "quantity_after",
        F.coalesce("quantity_after", (before + change).cast(kinds["quantity_after"])),
    )
    return df.withColumn(
        "quantity_change",
        F.coalesce(change, (F.col("quantity_after") - before).cast(kinds["quantity_change"])),
    )
