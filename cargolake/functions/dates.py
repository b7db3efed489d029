"""Date expressions. Both week conventions of the warehouse live here."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(c: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def week_start(c: Column) -> Column:
    """The Sunday on or before the date (reports count weeks from Sunday)."""
    return F.date_sub(c, F.dayofweek(c) - 1)


def from_epoch_millis(c: Column) -> Column:
    """Epoch milliseconds as a zone-less UTC timestamp, whatever the session zone."""
    seconds = c.cast("decimal(18,3)") / F.lit(1000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def whole_minutes(first: Column, last: Column) -> Column:
    """Minutes between two zone-less timestamps, truncated; no session zone comes into it."""
    return (last - first).cast("interval minute").cast("bigint")


def compose_date(day_month: Column, source_month: Column) -> Column:
    """``DD.MM`` plus the year in ``<month name>_<year>``; impossible dates are NULL.

    Day and month both come from the cell; the month name in the file stem
    is not used.
    """
    parts = F.split(day_month, r"\.")
    year = F.get(F.split(source_month, "_"), F.lit(1)).try_cast("int")
    month = F.get(parts, F.lit(1)).try_cast("int")
    day = F.get(parts, F.lit(0)).try_cast("int")
    # concat is NULL when a part is; a text that is no calendar day casts to NULL
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def calendar_columns(d: Column) -> list[Column]:
    """The thirteen attributes of a calendar day. Weekdays count from Monday = 1."""
    return [
        date_key(d).alias("time_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit("").alias("holiday_name"),
        F.weekofyear(d).alias("week_num"),
        F.year(d).alias("fiscal_year"),
    ]
