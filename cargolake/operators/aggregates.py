"""Aggregations. All keys are pre-aggregated map-side, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from cargolake.functions.dates import whole_minutes
from cargolake.functions.numbers import MONEY, round_mean, sum_money


def item_totals(items: DataFrame) -> DataFrame:
    """Sum of line amounts per sale; a sale whose amounts are all unreadable totals 0."""
    amount = F.col("amount").try_cast(MONEY)
    return (
        items.where(F.col("sale_id").isNotNull())
        .groupBy("sale_id")
        .agg(F.coalesce(sum_money(amount), F.lit(0)).alias("computed_total"))
    )


def expenses_by_vehicle_day(expenses: DataFrame) -> DataFrame:
    """Daily cost per vehicle: three categories as columns, ``total`` over all of them."""

    def part(category: str) -> Column:
        amount = F.when(F.col("expense_category_en") == category, F.col("amount_rub"))
        return F.coalesce(sum_money(amount), F.lit(0)).cast(MONEY).alias(f"{category}_expense")

    return (
        expenses.where(F.col("vehicle_id").isNotNull() & F.col("expense_date").isNotNull())
        .groupBy("vehicle_id", "expense_date")
        .agg(
            part("fuel"),
            part("other"),
            part("wash"),
            F.coalesce(sum_money(F.col("amount_rub")), F.lit(0)).cast(MONEY).alias("total_expense"),
        )
    )


def trip_metrics(telemetry: DataFrame) -> DataFrame:
    """Whole minutes between first and last point, and mean speed, of trips with two points or more.

    The first and last time are a min and a max: no per-trip sort.
    """
    return (
        telemetry.select(
            F.col("order_key").try_cast("bigint").alias("order_key"), "timestamp", "spd"
        )
        .where(F.col("order_key").isNotNull())
        .groupBy("order_key")
        .agg(
            F.count(F.lit(1)).alias("_points"),
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
            F.avg("spd").alias("_speed"),
        )
        .where(F.col("_points") >= 2)
        .select(
            "order_key",
            whole_minutes(F.col("_first"), F.col("_last")).alias("duration_minutes"),
            round_mean(F.col("_speed"), 2).alias("avg_speed_kmh"),
        )
    )


def balance_totals(balances: DataFrame) -> DataFrame:
    """Number of balances and the quantity they hold together."""
    return balances.agg(
        F.count(F.lit(1)).alias("total_balances"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
    )


def mapping_metrics(expenses: DataFrame) -> DataFrame:
    """Shares of expenses with a known vehicle and driver, and the date range they span."""
    return expenses.agg(*(c.alias(n) for n, c in expense_metrics().items()))


def unmapped_keys(df: DataFrame, key: str, mapped_id: str, limit: int = 10) -> DataFrame:
    """The first distinct keys that found no id."""
    return df.where(F.col(mapped_id) == 0).select(key).distinct().orderBy(key).limit(limit)


def _share(predicate: Column) -> Column:
    n = F.count(F.lit(1))
    return F.round(F.count_if(predicate) * 100.0 / F.nullif(n, F.lit(0)), 1).cast("double")


def expense_metrics() -> dict[str, Column]:
    """Run counters of the expense load."""
    return {
        "rows": F.count(F.lit(1)),
        "mapped_vehicles": F.count_if(F.col("vehicle_id") > 0),
        "mapped_drivers": F.count_if(F.col("driver_id") > 0),
        "vehicle_share_pct": _share(F.col("vehicle_id") > 0),
        "driver_share_pct": _share(F.col("driver_id") > 0),
        "first_date": F.min("expense_date"),
        "last_date": F.max("expense_date"),
    }


def product_metrics() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1)), "price_issues": F.count_if(F.col("price_logic_issue"))}


def movement_metrics() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1)), "negative_balances": F.count_if(F.col("is_negative_after"))}


def telemetry_metrics() -> dict[str, Column]:
    """Distinct counts shuffle by the counted value, so a hot order does no harm."""
    return {
        "rows": F.count(F.lit(1)),
        "orders": F.countDistinct("order_key"),
        "files": F.countDistinct("source_file"),
    }


def row_metrics() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1))}


def counters(name: str, df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Run counters of one table as rows ``table, counter, value``."""
    figures = df.agg(*(c.alias(n) for n, c in metrics.items()))
    long = F.array(
        *(F.struct(F.lit(n).alias("counter"), F.col(n).cast("bigint").alias("value")) for n in metrics)
    )
    return figures.select(F.lit(name).alias("table"), F.inline(long))


def matched_trips(sales: DataFrame, trips: DataFrame) -> DataFrame:
    """How many sales there are, and how many of them have trip metrics."""
    keys = sales.select(F.col("id").cast("bigint").alias("order_key"))
    joined = keys.join(trips.select("order_key", F.lit(True).alias("_hit")), "order_key", "left")
    return joined.agg(F.count(F.lit(1)).alias("orders"), F.count("_hit").alias("matched_trips"))


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Collect run counters while ``df`` is written, without a pass of their own."""
    watch = Observation(name)
    return df.observe(watch, *(c.alias(n) for n, c in metrics.items())), watch
