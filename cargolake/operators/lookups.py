"""Lookups of plates and driver names, and the two operational extracts.

The lookup sides are grouped to one row per key, so no join here multiplies
rows. Joins carry no broadcast hint: the size of a lookup is not known here.
Spark broadcasts it after seeing its size. Beyond that it is a sort-merge join
in which adaptive execution splits a hot key (unknown plates, missing names)
over many tasks. It does so only if both sides come straight from a shuffle
made for the join, hence ``own_shuffle``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from cargolake.functions.text import name_key, plate_key
from cargolake.operators.cleaning import UNKNOWN
from cargolake.schemas import day


def own_shuffle(lookup: DataFrame, key: str) -> DataFrame:
    """Derive the join key of a grouped lookup anew.

    Spark would otherwise see that the grouping has left the rows in place for
    the join, skip the (small) shuffle of the lookup, and with it the
    splitting of hot keys on the other, large side.
    """
    return lookup.withColumn(key, F.concat(key, F.lit("")))


def vehicle_lookup(df: DataFrame, vehicles: DataFrame, plate: str = "vehicle_plate") -> DataFrame:
    """Add ``vehicle_id`` by plate; of equal plates the last id wins, unknown plates get 0."""
    ids = vehicles.groupBy(plate_key(F.col("plate_number")).alias("_plate")).agg(
        F.max("id").alias("_vehicle")
    )
    ids = own_shuffle(ids, "_plate")
    joined = df.join(ids, plate_key(F.col(plate)) == F.col("_plate"), "left")
    return joined.withColumn(
        "vehicle_id", F.coalesce(F.col("_vehicle").cast("bigint"), F.lit(0).cast("bigint"))
    ).drop("_plate", "_vehicle")


def driver_lookup(df: DataFrame, drivers: DataFrame, name: str = "driver_name") -> DataFrame:
    """Add ``driver_id`` from the active drivers.

    A full-name match wins (of equal names the last id); otherwise the first
    token counts as a last name and matches if exactly one active driver has
    it. Anything else, and the placeholder name, gets 0.
    """
    active = drivers.where(F.col("is_active")).select(
        F.col("id").cast("bigint").alias("id"), name_key(F.col("full_name")).alias("_name")
    )
    first = F.lit(1)
    full = own_shuffle(active.groupBy("_name").agg(F.max("id").alias("_by_name")), "_name")
    last = (
        active.groupBy(F.split_part("_name", F.lit(" "), first).alias("_last"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("_by_last"))
        .where("_n = 1 AND _last <> ''")
        .drop("_n")
    )
    last = own_shuffle(last, "_last")
    given = F.when(~F.col(name).isin(UNKNOWN, ""), name_key(F.col(name)))
    keyed = df.withColumn("_given", given)
    return (
        keyed.join(full, F.col("_given") == F.col("_name"), "left")
        .join(last, F.split_part("_given", F.lit(" "), first) == F.col("_last"), "left")
        .withColumn("driver_id", F.coalesce("_by_name", "_by_last", F.lit(0).cast("bigint")))
        .drop("_given", "_name", "_by_name", "_last", "_by_last")
    )


def delivery_manifest(
    sales: DataFrame, vehicles: DataFrame, as_of: date, days: int, limit: int | None = None
) -> DataFrame:
    """Deliveries of the last ``days`` days, newest first."""
    recent = sales.where(
        F.col("vehicle_id").isNotNull()
        & F.col("driver_id").isNotNull()
        & (F.col("date") >= F.date_sub(day(as_of), days))
    )
    plates = vehicles.select(F.col("id").alias("_vehicle"), "plate_number")
    out = (
        recent.join(plates, F.col("vehicle_id") == F.col("_vehicle"), "left")
        .orderBy(F.col("date").desc(), F.col("id"))
        .select(
            F.col("id").alias("sale_id"), F.col("number").alias("sale_number"),
            "created_at", "plate_number",
        )
    )
    return out if limit is None else out.limit(limit)


def vehicle_driver_pairs(sales: DataFrame, vehicles: DataFrame, drivers: DataFrame) -> DataFrame:
    """Which active driver has driven which active vehicle.

    The sales shrink to distinct id pairs before anything is joined to them.
    """
    pairs = sales.select("vehicle_id", "driver_id").na.drop().distinct()
    cars = vehicles.where(F.col("is_active")).select(
        F.col("id").alias("vehicle_id"), "plate_number", "model"
    )
    people = drivers.where(F.col("is_active")).select(
        F.col("id").alias("driver_id"), F.col("full_name").alias("driver_name")
    )
    return (
        pairs.join(cars, "vehicle_id")
        .join(people, "driver_id")
        .select("plate_number", "model", "driver_name")
        .distinct()
        .orderBy("plate_number", "model", "driver_name")
    )
