"""Gold: calendar, conformed dimensions and the order fact."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cargolake.functions.dates import calendar_columns, date_key
from cargolake.functions.text import token
from cargolake.schemas import STAR, STAR_DEFAULTS, Schema, conform, day, stamp


def calendar(days: DataFrame) -> DataFrame:
    """Calendar rows for a table of one ``start`` and one ``end`` date."""
    span = days.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("_day"))
    return span.select(*calendar_columns(F.col("_day")))


def dim_time(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(day(start).alias("start"), day(end).alias("end"))
    return calendar(days)


def _dimension(
    name: str, silver: DataFrame, run_ts: datetime, columns: Mapping[str, Column]
) -> DataFrame:
    """Silver columns under their star names, then the star's types and defaults."""
    df = silver.withColumns({**columns, "etl_updated_at": stamp(run_ts)})
    return conform(df, STAR[name], STAR_DEFAULTS[name])


def dim_customer(customers: DataFrame, run_ts: datetime) -> DataFrame:
    df = _dimension("dim_customer", customers, run_ts, {"customer_id": F.col("id")})
    joined = F.coalesce("registration_date", F.to_date(stamp(run_ts)))
    return df.withColumn("registration_date", joined)


def dim_driver(drivers: DataFrame, run_ts: datetime) -> DataFrame:
    """Drivers with their name split into last, first and middle name."""
    name = F.col("full_name")
    return _dimension(
        "dim_driver",
        drivers,
        run_ts,
        {
            "driver_id": F.col("id"),
            "last_name": token(name, 0),
            "first_name": token(name, 1),
            "middle_name": token(name, 2),
        },
    )


def dim_vehicle(vehicles: DataFrame, run_ts: datetime) -> DataFrame:
    return _dimension(
        "dim_vehicle", vehicles, run_ts,
        {"vehicle_id": F.col("id"), "gov_number": F.col("plate_number")},
    )


def dim_warehouse(warehouses: DataFrame, run_ts: datetime) -> DataFrame:
    return _dimension("dim_warehouse", warehouses, run_ts, {"warehouse_id": F.col("id")})


def dim_product(products: DataFrame, run_ts: datetime) -> DataFrame:
    return _dimension("dim_product", products, run_ts, {"product_id": F.col("id")})


def fact_orders(
    sales: DataFrame,
    expenses_by_day: DataFrame,
    trips: DataFrame,
    run_ts: datetime,
    schema: Schema = STAR["fact_orders"],
    watch: Observation | None = None,
) -> DataFrame:
    """One row per sale: amounts, the vehicle's cost of that day, trip metrics, profit.

    Every order of a vehicle on a day carries the full cost of that day. Both
    right sides hold one row per key, so the joins keep the number of sales.
    Orders and costs meet on the day's integer key, by which neither side is
    grouped before: both are shuffled for this join, so adaptive execution can
    split a vehicle and day that a third of the orders share (such as
    vehicle 0, the orders without one). ``watch`` counts orders and matched
    trips while the fact is written.
    """
    zero = F.lit(0)
    orders = sales.select(
        F.col("id").cast("bigint").alias("order_key"),
        F.coalesce(F.col("customer_id").cast("bigint"), zero).alias("customer_id"),
        F.coalesce(F.col("driver_id").cast("bigint"), zero).alias("driver_id"),
        F.coalesce(F.col("vehicle_id").cast("bigint"), zero).alias("vehicle_id"),
        F.coalesce(F.col("warehouse_id").cast("bigint"), zero).alias("warehouse_id"),
        F.col("total_amount").cast("decimal(15,2)").alias("order_amount"),
        date_key(F.to_date("created_at")).alias("time_id"),
    )
    costs = expenses_by_day.select(
        F.col("vehicle_id").cast("bigint").alias("_vehicle"),
        date_key(F.col("expense_date").cast("date")).alias("_expense_day"),
        "fuel_expense",
        "other_expense",
        "wash_expense",
        F.col("total_expense").alias("total_vehicle_expense"),
    )
    metrics = trips.select(
        F.col("order_key").alias("_trip"),
        F.col("duration_minutes").alias("trip_duration_minutes"),
        "avg_speed_kmh",
    )
    joined = orders.join(
        costs,
        (F.col("vehicle_id") == F.col("_vehicle")) & (F.col("time_id") == F.col("_expense_day")),
        "left",
    ).join(metrics, F.col("order_key") == F.col("_trip"), "left")

    if watch is not None:
        joined = joined.observe(
            watch, F.count(F.lit(1)).alias("orders"), F.count("_trip").alias("matched_trips")
        )
    filled = joined.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(0).cast(joined.schema[c].dataType))
            for c in (
                "fuel_expense", "other_expense", "wash_expense", "total_vehicle_expense",
                "trip_duration_minutes", "avg_speed_kmh",
            )
        }
    )
    net = (F.col("order_amount") - F.col("total_vehicle_expense")).cast("decimal(15,2)")
    amount = F.col("order_amount").cast("double")
    facts = filled.withColumn("net_profit", net).withColumns(
        {
            "total_quantity": F.lit(1),
            "gross_profit": F.col("order_amount"),
            "margin_percent": F.when(
                amount > 0, F.col("net_profit").cast("double") / amount * 100
            ).otherwise(0.0),
            "etl_loaded_at": stamp(run_ts),
        }
    )
    return conform(facts, schema, STAR_DEFAULTS["fact_orders"])
