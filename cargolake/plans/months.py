"""The order fact by months: which of them a run has to compute anew, and which a report has to read.

The fact is published in parts, one per month. Each run takes a digest per month
of what the fact is made of: orders with their trip, and costs. Months whose
digest is that of the run before keep their files; the others are joined and
written. The digests name the publication of the fact they belong to, so a fact
that was published otherwise, or a run that died between the two, leads to a
full refresh.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolake.functions.dates import date_key
from cargolake.sources.tables import part_names, publish_table, read_optional, read_parts
from cargolake.sources.versions import current

NO_MONTH = "none"  # the part of orders without a date
DIGESTS = "kind string, month string, n long, digest decimal(38,0), publication long"


def month_of(time_id: Column) -> Column:
    """The part of a day key such as 20250331."""
    return F.when(time_id > 0, F.floor(time_id / 100).cast("int").cast("string")).otherwise(NO_MONTH)


def order_month() -> Column:
    return month_of(date_key(F.to_date("created_at")))


def cost_month() -> Column:
    return month_of(date_key(F.col("expense_date").cast("date")))


def input_digests(sales: DataFrame, costs: DataFrame, trips: DataFrame) -> dict[tuple[str, str], tuple[int, int]]:
    """(kind, month) -> number and digest of the rows; the sum of 64-bit hashes, so the order of rows does not matter.

    Reads narrow columns and combines map-side; a row per month reaches the driver.
    """
    metrics = trips.select(F.col("order_key").alias("_trip"), "duration_minutes", "avg_speed_kmh")
    fields = ["id", "customer_id", "driver_id", "vehicle_id", "warehouse_id", "total_amount", "created_at"]
    orders = sales.select(*fields).join(metrics, F.col("id").cast("bigint") == F.col("_trip"), "left")
    parts = {
        "orders": (orders.withColumn("month", order_month()), [*fields, "duration_minutes", "avg_speed_kmh"]),
        "costs": (costs.withColumn("month", cost_month()), costs.columns),
    }
    found = None
    for kind, (df, columns) in parts.items():
        text = [F.coalesce(F.col(c).cast("string"), F.lit("\u001e")) for c in columns]  # NULL differs from every text
        sums = df.groupBy("month").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*text).cast("decimal(38,0)")).alias("digest")
        ).select(F.lit(kind).alias("kind"), "month", "n", "digest")
        found = sums if found is None else found.unionByName(sums)
    return {(r["kind"], r["month"]): (r["n"], int(r["digest"])) for r in found.collect()}


def touched_months(spark: SparkSession, fact: str, state: str, digests: dict[tuple[str, str], tuple[int, int]]) -> set[str] | None:
    """The months whose orders, trips or costs are not those of the run before; None if all must be computed."""
    known, entry = read_optional(spark, state), current(spark, fact)
    rows = known.collect() if known is not None else []  # a row per month and kind
    if entry is None or not rows or {r["publication"] for r in rows} != {entry.number}:
        return None
    before = {(r["kind"], r["month"]): (r["n"], int(r["digest"])) for r in rows}
    return {month for kind, month in before.keys() | digests.keys() if before.get((kind, month)) != digests.get((kind, month))}


def keep_digests(spark: SparkSession, fact: str, state: str, digests: dict[tuple[str, str], tuple[int, int]]) -> None:
    """Store the digests as those of the fact's current publication."""
    number = current(spark, fact).number
    rows = [(kind, month, n, Decimal(digest), number) for (kind, month), (n, digest) in digests.items()]
    publish_table(spark.createDataFrame(rows, DIGESTS), state)


def inputs_of(months: Collection[str], sales: DataFrame, costs: DataFrame, trips: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of the inputs that the fact of some months is made of."""
    own = sales.where(order_month().isin(*months))
    ids = own.select(F.col("id").cast("bigint").alias("order_key"))
    return own, costs.where(cost_month().isin(*months)), trips.join(ids, "order_key", "left_semi")


def fact_since(spark: SparkSession, fact: str, since: date) -> DataFrame:
    """The published fact of the months from that of ``since`` on; no file of an earlier month is opened."""
    first = f"{since.year}{since.month:02d}"
    return read_parts(spark, fact, {m for m in part_names(spark, fact) if m != NO_MONTH and m >= first})
