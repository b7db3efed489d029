"""Joins with a key that holds a third of all rows: adaptive execution must split it."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from cargolake.operators.aggregates import expenses_by_vehicle_day, trip_metrics
from cargolake.operators.dedup import dedup
from cargolake.operators.lookups import driver_lookup, vehicle_lookup
from cargolake.plans.entities import clean_telemetry
from cargolake.plans.marts import fact_orders
from cargolake.schemas import TELEMETRY_BRONZE, conform
from tests.conftest import RUN_TS

ROWS = 60_000


@contextmanager
def without_broadcasts(spark, **more):
    """Sort-merge joins only, and partitions that count as skewed at test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
        **more,
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def skewed(spark, hot):
    """Rows of which every third has the hot key (or none at all)."""
    return spark.range(0, ROWS, 1, 8).withColumn(
        "key", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise((F.col("id") % 499).cast("string"))
    )


@pytest.mark.parametrize("hot", ["7", None, "nobody"])
def test_vehicle_lookup(spark, hot):
    cars = spark.range(400).select("id", F.col("id").cast("string").alias("plate_number"))
    with without_broadcasts(spark):
        df = vehicle_lookup(skewed(spark, hot), cars, plate="key")
        got = df.groupBy("key", "vehicle_id").count().collect()
        joined = df.select("id", "vehicle_id")
        joined.collect()
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert sum(r["count"] for r in got) == ROWS
    assert all(r["vehicle_id"] == (int(r["key"]) if r["key"] not in (None, "nobody") and int(r["key"]) < 400 else 0) for r in got)


@pytest.mark.parametrize("hot", ["7 x", None])
def test_driver_lookup(spark, hot):
    people = spark.range(400).select(
        "id", F.concat(F.col("id").cast("string"), F.lit(" x")).alias("full_name"), F.lit(True).alias("is_active")
    )
    with without_broadcasts(spark):
        df = driver_lookup(skewed(spark, hot), people, name="key").select("id", "driver_id")
        got = df.collect()
        assert final_plan(df).count("SortMergeJoin(skew=true)") == 2
    assert len(got) == ROWS
    n = sum(1 for r in got if r["id"] % 3 == 0 and r["driver_id"] == (7 if hot else 0))
    assert n == ROWS // 3


def test_fact_with_a_hot_vehicle_and_day(spark):
    """Orders without a vehicle on one day; the costs straight from their aggregation."""
    sales = spark.range(0, ROWS, 1, 8).select(
        F.col("id").cast("string").alias("id"),
        F.lit(1).alias("customer_id"), F.lit(1).alias("driver_id"), F.lit(1).alias("warehouse_id"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 499).alias("vehicle_id"),
        F.lit(10).cast("decimal(15,2)").alias("total_amount"),
        F.lit("2025-01-05 10:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    expenses = spark.range(0, 3000).select(
        (F.col("id") % 300).alias("vehicle_id"), F.lit(date(2025, 1, 5)).alias("expense_date"),
        F.lit("fuel").alias("expense_category_en"), F.lit(1).cast("decimal(15,2)").alias("amount_rub"),
    )
    points = spark.createDataFrame([], "order_key string, timestamp timestamp_ntz, spd double")
    with without_broadcasts(spark):
        fact = fact_orders(sales, expenses_by_vehicle_day(expenses), trip_metrics(points), RUN_TS)
        df = fact.select("order_key", "vehicle_id", "total_vehicle_expense")
        got = df.collect()
        assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert len(got) == ROWS
    assert all(r["total_vehicle_expense"] == (10 if r["vehicle_id"] < 300 else 0) for r in got)


def test_a_third_of_all_points_are_copies_of_one(spark):
    points = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("ts"),
        F.lit("1").alias("order_key"), F.lit(5.0).alias("spd"), F.lit("f").alias("source_file"),
        F.col("id").cast("string").alias("load_timestamp"),
    )
    raw = conform(points, TELEMETRY_BRONZE, lenient=True)
    clean = clean_telemetry(raw, RUN_TS)
    assert clean.count() == ROWS - ROWS // 3 + 1
    # one order holds every point: its metrics still come from partial sums
    assert trip_metrics(clean).collect()[0].asDict() == {"order_key": 1, "duration_minutes": 0, "avg_speed_kmh": 5.0}


@pytest.mark.parametrize("hot", [None, "same"])
def test_a_third_of_all_rows_share_a_raw_key(spark, hot):
    df = spark.range(0, ROWS, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id").cast("string")).alias("inn")
    )
    kept = dedup(df, ["inn"], ["id"])
    assert kept.count() == ROWS - ROWS // 3 + 1
    first = kept.where(F.col("inn").eqNullSafe(F.lit(hot))).collect()
    assert [r["id"] for r in first] == [0]
