"""The three analytic reports over the star.

Each report aggregates the fact by its foreign key first and joins the
dimension to that small result, so the fact itself is never shuffled for a
dimension join. The dimensions hold one row per key (``latest_by_key``).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolake.config import durable
from cargolake.functions.dates import week_start
from cargolake.functions.numbers import round_mean, safe_ratio, sum_money
from cargolake.operators.ordered import global_ntiles, global_rank, median_value, value_positions
from cargolake.schemas import day


def _calendar_days(dim_time: DataFrame) -> DataFrame:
    """The calendar for a join: one row per day, so a few thousand rows whatever the fact holds."""
    return F.broadcast(dim_time.select("time_id", "full_date"))


def customer_rfm_base(
    fact: DataFrame, dim_customer: DataFrame, dim_time: DataFrame, as_of: date,
    unique_orders: bool = False,
) -> DataFrame:
    """Recency, frequency and net profit per customer with at least one order in the calendar.

    ``unique_orders`` states that no order key repeats in the fact (the fact
    load guarantees it); the distinct count and its shuffle then fall away.
    """
    orders = F.count("order_key") if unique_orders else F.countDistinct("order_key")
    per_customer = (
        fact.select("customer_id", "order_key", "time_id", "net_profit")
        .join(_calendar_days(dim_time), "time_id")
        .groupBy("customer_id")
        .agg(
            F.max("full_date").alias("last_order_date"),
            orders.alias("frequency"),
            sum_money(F.col("net_profit")).alias("monetary"),
        )
    )
    people = dim_customer.select("customer_id", "name", "customer_segment")
    return per_customer.join(people, "customer_id").select(
        "customer_id",
        "name",
        "customer_segment",
        F.date_diff(day(as_of), F.col("last_order_date")).alias("recency_days"),
        "frequency",
        "monetary",
        "last_order_date",
    )


def _segment(r: Column, f: Column, m: Column) -> Column:
    """The segment as the report defines it: the first rule that holds names it.

    Score 1 is the best quarter of each measure. Fixed values: the rules are
    kept as the report states them.
    """
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), "Champions")
        .when((r >= 3) & (f >= 2), "Loyal")
        .when((r <= 2) & (f >= 3), "Potential")
        .when((r <= 2) & (f <= 2) & (m <= 2), "At Risk")
        .otherwise("Other")
    )


def rfm(
    fact: DataFrame, dim_customer: DataFrame, dim_time: DataFrame, as_of: date,
    unique_orders: bool = False,
) -> DataFrame:
    """Customer RFM: quartile scores, score code and segment, worst scores first.

    Ties in a measure are broken by customer id. The rows that close a quartile
    of the three measures are selected together, so no customer is moved.
    """
    base = durable(customer_rfm_base(fact, dim_customer, dim_time, as_of, unique_orders))
    measures = {
        "recency_score": ("recency_days", True),
        "frequency_score": ("frequency", False),
        "monetary_score": ("monetary", False),
    }
    scores = global_ntiles(base, 4, measures, ["customer_id"], base.count())
    r, f, m = (F.col(name) for name in measures)
    code = F.concat_ws("-", r.cast("string"), f.cast("string"), m.cast("string"))
    return (
        base.select("*", *(c.alias(name) for name, c in scores.items()))
        .withColumns({"rfm_code": code, "rfm_segment": _segment(r, f, m)})
        .orderBy(r.desc(), f.desc(), m.desc(), "customer_id")
    )


def vehicle_base(fact: DataFrame, dim_vehicle: DataFrame, min_trips: int = 5) -> DataFrame:
    """Totals and means per active vehicle with at least ``min_trips`` orders."""
    per_vehicle = fact.groupBy("vehicle_id").agg(
        F.count("order_key").alias("trips"),
        F.sum("total_quantity").alias("total_cargo_kg"),
        sum_money(F.col("total_vehicle_expense")).alias("_expenses"),
        F.avg("avg_speed_kmh").alias("_speed"),
        F.avg(safe_ratio(F.col("fuel_expense"), F.col("total_quantity"))).alias("_fuel_per_kg"),
        sum_money(F.col("net_profit")).alias("_profit"),
    )
    cars = dim_vehicle.where(F.col("is_active")).select("vehicle_id", "gov_number", "brand", "model")
    return (
        per_vehicle.where(F.col("trips") >= min_trips)
        .join(cars, "vehicle_id")
        .select(
            "vehicle_id",
            "gov_number",
            F.concat("brand", F.lit(" "), "model").alias("car_name"),
            "trips",
            "total_cargo_kg",
            F.col("_expenses").alias("total_expenses"),
            F.round(safe_ratio(F.col("_expenses"), F.col("total_cargo_kg")), 2).alias("cost_per_kg"),
            round_mean(F.col("_speed"), 1).alias("avg_speed_kmh"),
            round_mean(F.col("_fuel_per_kg"), 4).alias("avg_fuel_per_kg"),
            F.col("_profit").alias("profit"),
        )
    )


def vehicle_efficiency(fact: DataFrame, dim_vehicle: DataFrame, min_trips: int = 5) -> DataFrame:
    """Vehicles ranked by cost per unit of cargo, with the deviation from the median in percent.

    Median and rank use the cost rounded to cents, as the report shows it. The
    median is selected; ranks come from the distinct costs.
    """
    base = durable(vehicle_base(fact, dim_vehicle, min_trips))
    positions = value_positions(base, "cost_per_kg")
    ranked = global_rank(base, "cost_per_kg", positions, "efficiency_rank").withColumn(
        "_median", F.lit(median_value(base, "cost_per_kg", ["vehicle_id"])).cast("double")
    )
    deviation = safe_ratio(F.col("cost_per_kg"), F.col("_median")) * 100 - 100
    return (
        ranked.withColumn("cost_per_kg_deviation_pct", round_mean(deviation, 1))
        .drop("_median")
        .orderBy("efficiency_rank", "vehicle_id")
    )


def weekly_warehouse_base(
    fact: DataFrame, dim_warehouse: DataFrame, dim_time: DataFrame, since: date
) -> DataFrame:
    """Profit and revenue per warehouse and week; weeks start on Sunday."""
    first_key = since.year * 10000 + since.month * 100 + since.day
    weekly = (
        fact.where(F.col("time_id") >= first_key)  # follows from the calendar filter; reaches the scan
        .select("warehouse_id", "time_id", "net_profit", "order_amount")
        .join(_calendar_days(dim_time.where(F.col("full_date") >= day(since))), "time_id")
        .groupBy("warehouse_id", week_start(F.col("full_date")).alias("week_start"))
        .agg(
            sum_money(F.col("net_profit")).alias("weekly_profit"),
            sum_money(F.col("order_amount")).alias("weekly_revenue"),
        )
    )
    names = dim_warehouse.select("warehouse_id", F.col("name").alias("warehouse_name"))
    return weekly.join(names, "warehouse_id")


def weekly_warehouse(
    fact: DataFrame, dim_warehouse: DataFrame, dim_time: DataFrame, since: date = date(2023, 1, 1)
) -> DataFrame:
    """Weekly profit with running total, growth over the week before and four-week mean.

    The windows run over weeks, at most one row per calendar week and
    warehouse, however many orders a warehouse has.
    """
    weeks = Window.partitionBy("warehouse_id").orderBy("week_start")
    before = F.lag("weekly_profit").over(weeks)
    growth = safe_ratio(F.col("weekly_profit"), before) * 100 - 100
    recent = F.avg(F.col("weekly_profit").cast("double")).over(weeks.rowsBetween(-3, 0))
    return (
        weekly_warehouse_base(fact, dim_warehouse, dim_time, since)
        .withColumns(
            {
                "cum_profit": F.sum("weekly_profit").over(weeks),
                "wow_growth_pct": round_mean(growth, 1),
                "ma4_profit": round_mean(recent, 2),
            }
        )
        .select(
            "warehouse_id", "warehouse_name", "week_start", "weekly_profit", "cum_profit",
            "weekly_revenue", "wow_growth_pct", "ma4_profit",
        )
        .orderBy("warehouse_name", F.col("week_start").desc(), "warehouse_id")
        .drop("warehouse_id")
    )
